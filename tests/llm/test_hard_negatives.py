"""Hard negatives against all inner products."""

import math

import numpy as np
import pytest
from llm_fixtures import SF
from pyspark.sql import functions as F

from ledgerlens.llm import hard_negatives as H
from ledgerlens.llm.queries import op12_hard_negatives

SCHEMA = "vec_id bigint, label int, embedding array<float>, query string"


def by_hand(rows, positives=5, negatives=3):
    """rows: (vec_id, label, vector)."""
    good = []
    for i, label, v in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        row = (i, (label + 1) % 10 if i % 7 == 0 else label, tuple(math.floor(256 * x) for x in v))
        if row not in good:
            good.append(row)
    out = []
    for a, label, q in good:
        if a % 50:
            continue
        score = lambda v: sum(x * y for x, y in zip(q, v))
        others = sorted(((-score(v), i, own) for i, own, v in good if i != a))
        for minus, p, _ in [o for o in others if o[2] == label][:positives]:
            fit = [(-m, n) for m, n, own in others if own != label and 50 * -minus <= 100 * -m <= 95 * -minus][:negatives]
            out += [(a, p, k + 1, n, -minus, s) for k, (s, n) in enumerate(fit)]
    return sorted(out)


def mined(df):
    ident, label = F.col("vec_id"), F.col("label")
    done = H.mine(df, ident % 50 == 0, F.when(ident % 7 == 0, (label + 1) % 10).otherwise(label))
    return sorted(tuple(r) for r in done.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect())


def vectors(n, width, seed, spread=0.4):
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(6, width))
    x = middle[rng.integers(0, 6, n)] + spread * rng.normal(size=(n, width))
    return [(i, int(k), [float(np.float32(v)) for v in row]) for i, (k, row) in enumerate(zip(rng.integers(0, 10, n), x))]


@pytest.fixture
def small(monkeypatch):
    """Several centres, blocks, levels and batches on few rows.  Tasks get their values with the code."""
    for name, value in (("SAMPLE_ROWS", 60), ("CENTRES", 5), ("BLOCK_ROWS", 40)):
        monkeypatch.setattr(H, name, value)


def test_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "label", "embedding").collect()]
    done = op12_hard_negatives(spark, SF).collect()
    found = sorted((r.anchor_id, r.positive_id, r.rank, r.negative_id, r.positive_score, r.negative_score) for r in done)
    assert found == by_hand(rows) and found


def test_clusters_in_many_blocks(spark, small):
    rows = vectors(600, 5, 1)
    assert mined(spark.createDataFrame([(*r, "x") for r in rows], SCHEMA)) == by_hand(rows)


def test_a_third_of_all_rows_is_one_vector(spark, small):
    rows = vectors(300, 4, 2)
    rows = [(i, k, rows[0][2]) if i % 3 == 0 else (i, k, v) for i, k, v in rows]
    rows += rows[:40]  # repeated rows are one row each
    assert mined(spark.createDataFrame([(*r, "x") for r in rows], SCHEMA)) == by_hand(rows)


def test_odd_rows(spark):
    rows = vectors(120, 3, 3)
    odd = [(None, 1, [1.0, 1.0, 1.0]), (500, None, [1.0, 1.0, 1.0]), (550, 3, None), (600, 3, [1.0, None, 1.0]),
           (650, 3, [float("nan"), 1.0, 1.0]), (700, 3, [float("inf"), 1.0, 1.0]), (750, 3, [1.0]), (800, 3, []),
           (850, 3, [0.0, 0.0, 0.0]), (50, 4, [0.5, 0.5, 0.5]), (50, 4, [0.25, 0.5, 0.5])]
    assert mined(spark.createDataFrame([(*r, "x") for r in rows + odd], SCHEMA)) == by_hand(rows + odd)


def test_empty_and_alone(spark):
    assert mined(spark.createDataFrame([], SCHEMA)) == []
    assert mined(spark.createDataFrame([(0, 1, [1.0], "x")], SCHEMA)) == []
    assert mined(spark.createDataFrame([(1, 1, [1.0], "x"), (2, 1, [1.0], "x")], SCHEMA)) == []


def test_too_large_components_fail(spark):
    with pytest.raises(ValueError):
        mined(spark.createDataFrame([(0, 1, [1e9], "x")], SCHEMA))


def test_bounds_hold_and_radii_cover():
    rng = np.random.default_rng(5)
    x = rng.integers(-300, 300, (2000, 6))
    x[500:900] = x[0]
    top = float(np.linalg.norm(x, axis=1).max())
    tree = H.CoverTree(x, top)
    below = {}

    def rows_below(node):
        if node not in below:
            own = tree.rows[node]
            below[node] = own if own is not None else np.concatenate([rows_below(c) for c in tree.children[node]])
        return below[node]

    assert sorted(rows_below(0).tolist()) == list(range(2000))
    q = rng.integers(-300, 300, (20, 6)).astype(float)
    least, most = H.bounds(q, tree.centre, tree.radius, top)
    lifted = H._lifted(x, top)
    for node in range(len(tree.centre)):
        own = rows_below(node)
        assert np.linalg.norm(lifted[own] - tree.centre[node], axis=1).max() <= tree.radius[node] + 1e-9
        scores = q @ x[own].T
        assert (scores >= least[:, node:node + 1]).all() and (scores <= most[:, node:node + 1]).all()


def test_a_descent_skips_what_lies_outside():
    rng = np.random.default_rng(6)
    x = np.concatenate([rng.normal(c, 3, (500, 3)) for c in ((900, 0, 0), (0, 900, 0), (0, 0, 900), (-900, 0, 0))]).astype(np.int64)
    tree = H.CoverTree(x, float(np.linalg.norm(x, axis=1).max()))
    seen = []
    q = np.array([[100.0, 0, 0]])
    best = H.Best(1, 5, np.array([-np.inf]))

    def visit(rows, of):
        seen.extend(rows.tolist())
        best.offer(of, q[of] @ x[rows].T, rows, np.ones((len(of), len(rows)), bool))

    tree.descend(q, best.least, np.array([np.inf]), visit)
    scores = q[0] @ x.T
    want = sorted(range(2000), key=lambda i: (-scores[i], i))[:5]
    assert best.ident[0].tolist() == want and len(seen) <= 1000
