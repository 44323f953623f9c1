"""Custom operators against brute force on small inputs."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from ledgerlens.ml.models import top_k
from ledgerlens.operators import quantiles
from ledgerlens.operators.distributions import density_curves, gauss_terms
from ledgerlens.operators.encoding import fit_onehot
from ledgerlens.operators.quantiles import exact_quantiles


def test_exact_quantiles_match_numpy(spark):
    rng = np.random.default_rng(0)
    rows = []
    for g in range(3):
        n = [1, 7, 500][g]
        for v in rng.normal(size=n) * (g + 1):
            rows.append((g, float(v), float(round(v)), None if rng.random() < 0.1 else float(v)))
    df = spark.createDataFrame(rows, "g int, a double, b double, c double")
    probs = [0.0, 0.25, 0.5, 0.75, 1.0]
    q = exact_quantiles(df, ["a", "b", "c"], probs, ["g"]).toPandas()
    for (g, col), sub in q.groupby(["g", "column_name"]):
        vals = np.array([r[{"a": 1, "b": 2, "c": 3}[col]] for r in rows if r[0] == g], dtype=float)
        vals = vals[~np.isnan(vals)]
        for p, v in zip(sub.p, sub.value):
            assert v == pytest.approx(np.quantile(vals, p, method="linear"), abs=1e-12)


def test_density_matches_brute_force(spark):
    xs = [0.0, 1.0, 1.0, 2.5, 4.0, 10.0]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    got = density_curves(df, ["x"], points=50).orderBy("i").toPandas()
    a = np.array(xs)
    h = a.std(ddof=1) * len(a) ** -0.2
    grid = a.min() + np.arange(50) * (a.max() - a.min()) / 50
    want = np.exp(-0.5 * ((grid[:, None] - a[None, :]) / h) ** 2).sum(1) / (len(a) * h * math.sqrt(2 * math.pi))
    assert np.allclose(got.density.to_numpy(), want, rtol=1e-12)


def test_top_k_matches_sort(spark):
    rng = np.random.default_rng(1)
    vals = [(i, float(rng.integers(0, 20))) for i in range(300)]
    df = spark.createDataFrame(vals, "id long, prediction double").repartition(7)
    got = [r.id for r in top_k(df, "prediction", 25).collect()]
    want = [i for i, _ in sorted(vals, key=lambda t: (-t[1], t[0]))[:25]]
    assert got == want


def test_onehot_threshold_boundary_and_tie(spark):
    # x: 'u' has exactly 10% -> no dummy, and then not every value passes
    # y: all pass; 'p' and 'q' tie for least frequent -> 'p' (smaller) dropped
    rows = [("m" if i < 50 else "f" if i < 90 else "u", ["p", "q", "r"][0 if i < 30 else 1 if i < 60 else 2])
            for i in range(100)]
    df = spark.createDataFrame(rows, "x string, y string")
    enc = fit_onehot(df, ["x", "y"])
    assert set(enc.names) == {"m", "f", "q", "r"}


def test_onehot_later_column_wins(spark):
    rows = [("k", "k" if i % 2 else "z") for i in range(10)]
    df = spark.createDataFrame(rows, "a string, b string")
    enc = fit_onehot(df, ["a", "b"])
    # 'a' has one value (all pass -> dropped); 'b' creates k and z, drops the
    # least frequent with the smaller value on a tie ('k')
    assert [d[0] for d in enc.dummies] == ["z"]
    out = enc.transform(df).agg(F.sum("z")).first()[0]
    assert out == 5


def test_density_far_clusters_exact(spark):
    """Most grid points lie far beyond the kernel reach of every value."""
    xs = [0.0, 0.1, 0.2, 0.2, 1000.0, 1000.1]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    got = density_curves(df, ["x"], points=500).orderBy("i").toPandas()
    a = np.array(xs)
    h = a.std(ddof=1) * len(a) ** -0.2
    grid = a.min() + np.arange(500) * (a.max() - a.min()) / 500
    want = np.exp(-0.5 * ((grid[:, None] - a[None, :]) / h) ** 2).sum(1) / (len(a) * h * math.sqrt(2 * math.pi))
    assert len(got) == 500
    assert np.allclose(got.density.to_numpy(), want, rtol=1e-12, atol=0)


def test_approx_quantiles_close_to_exact(spark):
    from ledgerlens.operators.quantiles import approx_quantiles

    rng = np.random.default_rng(5)
    vals = rng.exponential(size=5000)
    df = spark.createDataFrame([(float(v),) for v in vals], "a double")
    q = approx_quantiles(df, ["a"], [0.25, 0.5, 0.75]).orderBy("p").toPandas()
    assert q.p.tolist() == [0.25, 0.5, 0.75]
    for p, v in zip(q.p, q.value):
        rank = (vals <= v).mean()
        assert abs(rank - p) < 0.01


def test_quantiles_of_one_value_in_most_rows(spark):
    """90% of the rows share one value: no task holds more than one row for each distinct value."""
    from ledgerlens.operators.distributions import box_stats
    from ledgerlens.operators.quantiles import SortedValues

    df = spark.range(20_000).select(F.when(F.col("id") % 10 > 0, 7.0).otherwise(F.col("id").cast("double")).alias("a"),
                                    F.lit(None).cast("string").alias("g"))
    held = SortedValues(df, ["a"], ["g"]).values
    sizes = [r["count"] for r in held.groupBy("pid").count().collect()]
    assert sum(sizes) == 2001 and max(sizes) <= 2001
    assert held.agg(F.sum("w")).first()[0] == 20_000
    box = box_stats(df, ["a"], ["g"]).first()
    a = df.toPandas().a.to_numpy()
    assert (box.q1, box["median"], box.q3, box.n) == (7.0, 7.0, 7.0, 20_000)
    assert box.n_outliers == (a != 7.0).sum() and box.whisker_low == box.whisker_high == 7.0


def test_full_dummies_need_a_bound(spark):
    from ledgerlens.operators.encoding import full_dummies

    df = spark.createDataFrame([("a", 1)] * 9 + [("b", 2)], "c string, x int")
    with pytest.raises(ValueError):
        full_dummies(df, ["c"])
    with pytest.raises(ValueError):
        full_dummies(df, ["c"], min_share=0.2)
    assert full_dummies(df, ["c"], min_share=0.05).columns == ["x", "c_a", "c_b"]
    assert full_dummies(df, ["c"], values={"c": ["a", "z"]}).agg(F.sum("c_a"), F.sum("c_z")).first() == (9, 0)


def test_fitted_bounds_clamp_values_outside(spark):
    from ledgerlens.functions.expr import minmax_log

    df = spark.createDataFrame([(x,) for x in (-10.0, 0.0, 50.0, 100.0, 250.0)], "x double")
    low, zero, mid, top, high = (r[0] for r in df.select(minmax_log("x", F.lit(0.0), F.lit(100.0))).collect())
    assert low == zero < mid < top == high
    assert zero == pytest.approx(math.log(1e-6)) and top == pytest.approx(math.log(1 + 1e-6))


def test_age_of_accounts_registered_after_the_fitted_latest(spark):
    from fixtures import micro
    from ledgerlens.plans.base import base_features, population_stats

    labels, users, trx = micro(spark)
    old = base_features(labels.where("id <> 4"), users, trx)
    late = base_features(labels.where("id = 4"), users, trx, stats=population_stats(old)).first()
    assert late.days_from_registr == 0.0 and late.count_intensity == 0.0


def _skewed(n):
    rng = np.random.default_rng(3)
    x = np.exp(rng.normal(0, 4, n))
    x[: n // 3] = 7.0  # a value that a third of the rows have
    return x


@pytest.mark.parametrize("margin", [quantiles.MARGIN, 0])
def test_bracketed_quantiles_are_exact(spark, monkeypatch, margin):
    monkeypatch.setattr(quantiles, "MARGIN", margin)  # 0: brackets miss ranks, which are then counted one by one
    x = _skewed(30_000)
    df = spark.createDataFrame(pd.DataFrame({
        "g": ["big" if i % 10 else ("small" if i % 1000 else None) for i in range(len(x))], "x": x, "y": -x}))
    probs = [0.0, 0.25, 0.501, 0.75, 1.0]
    got = exact_quantiles(df, ["x", "y"], probs, ["g"]).toPandas()
    pdf = df.toPandas()
    assert len(got) == 3 * 2 * len(probs)
    for r in got.itertuples():
        rows = pdf[pdf["g"].isna()] if pd.isna(r.g) else pdf[pdf["g"] == r.g]
        assert np.isclose(r.value, np.quantile(rows[r.column_name], r.p), rtol=1e-12), r


def test_only_values_near_the_ranks_move(spark):
    n = 60_000
    df = spark.createDataFrame(pd.DataFrame({"x": _skewed(n)})).repartition(4)
    counted = quantiles.bracketed_counts(df, ["x"], [0.25, 0.5, 0.75])
    rows = counted.collect()
    assert sum(r["w"] for r in rows) == n
    assert len(rows) < 0.05 * n  # of 40,001 distinct values


@pytest.mark.parametrize("error", [1e-3, 1e-6, 1e-12])
def test_fast_density_stays_within_its_error(spark, error):
    rng = np.random.default_rng(8)
    far = np.concatenate([rng.normal(0, 1, 3000), rng.normal(40, 0.1, 2000), [1e3, -50.0]])
    df = spark.createDataFrame(pd.DataFrame({"x": far, "few": np.arange(len(far)) % 5.0, "one": 3.0}))
    got = density_curves(df, ["x", "few", "one"], cells_above=100, error=error).toPandas()
    exact = density_curves(df, ["x", "few", "one"]).toPandas()
    both = got.merge(exact, on=["column_name", "i"], suffixes=("", "_exact"))
    assert len(both) == len(got) == 1500 and gauss_terms(1e-3) < gauss_terms(1e-12)
    few = both[both.column_name == "few"]
    assert np.array_equal(few.x, few.x_exact) and np.allclose(few.density, few.density_exact, rtol=1e-12)
    one = both[both.column_name == "one"]
    assert one.density.isna().all() == one.density_exact.isna().all()
    x = both[both.column_name == "x"]
    h = far.std(ddof=1) * len(far) ** -0.2
    off = np.abs(x.density - x.density_exact).max()
    assert off <= error / (h * math.sqrt(2 * math.pi)) + 1e-14
    assert error < 1e-9 or off > 0  # the transform was used
