"""The moment table, correlation, trend lines and 2-D histograms against numpy and pandas."""

import math

import numpy as np
import pandas as pd
import pytest
from fixtures import SF_SMALL

from ledgerlens.operators import distributions as D
from ledgerlens.operators.moments import pair_moments
from ledgerlens.operators.profile import correlation
from ledgerlens.plans import registry as R


def table():
    rng = np.random.default_rng(4)
    n = 400
    a = rng.normal(size=n)
    df = pd.DataFrame({"a": a, "b": 3 * a + rng.normal(size=n), "far": 1e9 + a + 0.1 * rng.normal(size=n),
                       "same": 0.1, "gaps": np.where(rng.random(n) < 0.3, np.nan, rng.normal(size=n)),
                       "half": np.where(np.arange(n) < n // 2, 5.0, np.nan), "none": np.nan})
    df.loc[df.index[:n // 2], "gaps2"] = rng.normal(size=n // 2)  # meets "half" everywhere, others in part
    return df


def frame(spark, df):
    rows = [tuple(None if isinstance(v, float) and math.isnan(v) else float(v) for v in r) for r in df.itertuples(index=False)]
    return spark.createDataFrame(rows, ", ".join(f"`{c}` double" for c in df.columns)).repartition(5)


def test_moments_and_correlation(spark):
    df = table()
    cols = list(df.columns)
    found = {(r.column_a, r.column_b): r for r in pair_moments(frame(spark, df), cols).collect()}
    assert len(found) == len(cols) * (len(cols) + 1) // 2
    for (a, b), r in found.items():
        both = df[[a, b]].loc[:, ~df[[a, b]].columns.duplicated()].dropna()
        assert r.n == len(both)
        if not r.n:
            assert r.mean_a is None and r.m2_a is None and r.c_ab is None
            continue
        x, y = both[a].to_numpy(), both[b].to_numpy()
        assert r.mean_a == pytest.approx(x.mean(), rel=1e-12, abs=1e-12)
        assert r.m2_b == pytest.approx(((y - y.mean()) ** 2).sum(), rel=1e-7, abs=1e-12)
        assert r.c_ab == pytest.approx(((x - x.mean()) * (y - y.mean())).sum(), rel=1e-6, abs=1e-6)
    got = {(r.column_a, r.column_b): r.corr for r in correlation(frame(spark, df), cols, None).collect()}
    assert len(got) == len(cols) ** 2
    for (a, b), v in got.items():
        both = df[[a, b]].loc[:, ~df[[a, b]].columns.duplicated()].dropna()
        x, y = (both[c].to_numpy() for c in (a, b))
        if len(both) < 2 or x.min() == x.max() or y.min() == y.max():
            assert v is None, (a, b)
            continue
        x, y = x - x.mean(), y - y.mean()  # two passes: exact also far from zero
        assert v == pytest.approx((x * y).sum() / math.sqrt((x * x).sum() * (y * y).sum()), abs=1e-9)


def test_trend_lines(spark):
    df = table()[["a", "b", "far", "same", "gaps"]]
    for r in D.trend_lines(frame(spark, df), list(df.columns)).collect():
        both = df[[r.column_x, r.column_y]].dropna()
        x, y = both[r.column_x].to_numpy(), both[r.column_y].to_numpy()
        if r.column_x == "same":
            assert r.slope is None and r.intercept is None and r.r2 is None
            continue
        mx, my = x.mean(), y.mean()
        slope = ((x - mx) * (y - my)).sum() / ((x - mx) ** 2).sum()
        assert r.n == len(both) and r.slope == pytest.approx(slope, rel=1e-6, abs=1e-9)
        assert r.intercept == pytest.approx(my - slope * mx, rel=1e-6, abs=1e-6)
        assert 0 <= r.r2 <= 1 + 1e-9 and (r.column_y != "same" or r.r2 == 1)


def test_infinite_nan_and_empty(spark):
    df = spark.createDataFrame([(1.0, 2.0, float("inf")), (2.0, float("nan"), 1.0), (3.0, 5.0, 2.0), (None, 1.0, 1.0)],
                               "a double, b double, c double")
    got = {(r.column_a, r.column_b): r for r in pair_moments(df, ["a", "b", "c"]).collect()}
    assert got["a", "b"].n == 2 and got["a", "b"].c_ab == pytest.approx(3.0)
    assert math.isnan(got["a", "c"].c_ab) and not math.isnan(got["a", "a"].m2_a)
    empty = {(r.column_a, r.column_b): r.n for r in pair_moments(df.limit(0), ["a", "b"]).collect()}
    assert set(empty.values()) <= {0}
    assert all(r.corr is None for r in correlation(df.limit(0), ["a", "b"]).collect())
    with pytest.raises(ValueError):
        pair_moments(df, [])


def test_hist2d_by_hand(spark):
    df = table()[["a", "b", "same", "gaps"]]
    cols = list(df.columns)
    want = {}
    bins = {}
    for c in cols:
        lo, hi = df[c].min(), df[c].max()
        bins[c] = [None if math.isnan(v) else 0 if hi == lo else min(math.floor((v - lo) / (hi - lo) * 7), 6) for v in df[c]]
    for a in cols:
        for b in cols:
            for x, y in zip(bins[a], bins[b]):
                if a != b and x is not None and y is not None:
                    want[a, b, x, y] = want.get((a, b, x, y), 0) + 1
    got = {(r.column_a, r.column_b, r.bin_a, r.bin_b): r.n for r in D.hist2d(frame(spark, df), cols, 7).collect()}
    assert got == want


def nodes(df):
    """Names of the operators of a query's plan, the sink first, and how deep each lies."""
    lines = df._jdf.queryExecution().optimizedPlan().toString().splitlines()
    return [(len(x) - len(x.lstrip(" :+-")), x.strip(" :+-").split(" ")[0]) for x in lines]


def test_no_row_for_a_row_and_pair(spark):
    """One row of the table stays one row up to the aggregate that counts it."""
    for query in (R.correlation_query, R.dummy_correlation_query, R.dist_trend_query):
        found = nodes(query(spark, SF_SMALL))
        below = [name for _, name in found[[n for _, n in found].index("Aggregate"):]]
        assert "MapInArrow" in below and not {"Generate", "Expand", "Join"} & set(below)
    names = [n for _, n in nodes(R.dist_hist2d_query(spark, SF_SMALL))]
    pairs = [i for i, n in enumerate(names) if n == "Generate"][-1]  # the expansion to pairs ...
    assert "Aggregate" in names[pairs:]  # ... reads counted vectors
