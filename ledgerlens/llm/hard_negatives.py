"""Hard-negative mining: a cover tree over norm-augmented vectors, searched best first.

Inner products become geometry: every candidate x gets one more coordinate, sqrt(M^2 - |x|^2) with
M the largest norm, so that all lie on one sphere, and an anchor q gets 0 there.  If all candidates
below a node are within distance r of its centre c, they are within the angle 2 asin(r / 2M) of c,
so their inner products with q lie in |q| M cos(angle(q, c) -+ that angle).

* The top of the tree (the centres of its first level) comes from a bounded sample; every row then
  hangs below its nearest centre, and each centre's covering radius is measured over all its rows.
* A centre's rows are dealt by a hash into blocks of a bounded size, so a centre that holds a third
  of all rows is many blocks.  A block's own levels are built in the task that holds it: a level
  halves the covering radius of the one above, equal vectors end the descent.
* An anchor goes to the blocks whose bounds meet its window.  There a batch of anchors descends best
  first; nodes outside of every anchor's window are skipped with all below them, and leaves are
  verified by exact integer inner products.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerlens.llm.frames import staged

#: Rows (about) from which the centres of the first level are chosen, and how many there are at most.
SAMPLE_ROWS = 2048
CENTRES = 64
#: Rows (about) of one block, children of a node, rows of a leaf, anchors that descend together.
BLOCK_ROWS = 8192
FANOUT = 16
LEAF_ROWS = 128
BATCH = 512

_ROW = "vec_id bigint, label bigint, vector array<bigint>"


# -- rows

def prepared(vectors: DataFrame, scale: int, label: Column, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, label, vector) of the rows that take part: components become floor(scale * x)."""
    x = vectors[f"`{vector_col}`"]
    whole = F.transform(x, lambda v: v.cast("double"))
    odd = lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))
    # equal rows of one id are one row
    return (vectors.select(vectors[f"`{id_col}`"].cast("bigint").alias("vec_id"), label.cast("bigint").alias("label"), whole.alias("x"))
            .where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("x").isNotNull() & ~F.exists("x", odd))
            .select("vec_id", "label", F.transform("x", lambda v: F.floor(v * scale)).alias("vector")))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Vectors as rows; a shorter one counts as followed by zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat, size = column.flatten().to_numpy(zero_copy_only=False), np.diff(column.offsets.to_numpy())
    out = np.zeros((len(size), width), np.int64)
    row = np.repeat(np.arange(len(size)), size)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)] = flat
    return out


def _windows(anchors: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """``low`` and ``high`` of every anchor (rows); an anchor with fewer windows has empty ones in their place."""
    low, high = (anchors.column(c).to_pylist() for c in ("low", "high"))
    most = max(map(len, low), default=0)
    return (np.array([[*x, *[np.inf] * (most - len(x))] for x in low], np.float64).reshape(len(low), most),
            np.array([[*x, *[-np.inf] * (most - len(x))] for x in high], np.float64).reshape(len(high), most))


def _lifted(x: np.ndarray, top: float) -> np.ndarray:
    """Vectors with the coordinate that puts them on the sphere of radius ``top``."""
    x = x.astype(np.float64)
    rest = np.sqrt(np.maximum(top * top - np.einsum("ij,ij->i", x, x), 0))
    return np.column_stack((x, rest))


def _farthest_first(x: np.ndarray, start: int, most: int, within: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Centres each farther than ``within`` from those before it, until all rows are covered or there
    are ``most``: their rows, the nearest centre of every row and the distance to it."""
    chosen, near = [start], np.zeros(len(x), np.int64)
    gap = np.linalg.norm(x - x[start], axis=1)
    while len(chosen) < most:
        far = int(gap.argmax())
        if gap[far] <= within:
            break
        other = np.linalg.norm(x - x[far], axis=1)
        closer = other < gap
        near[closer] = len(chosen)
        gap[closer] = other[closer]
        chosen.append(far)
    return np.array(chosen), near, gap


# -- bounds

def bounds(q: np.ndarray, centres: np.ndarray, radius: np.ndarray, top: float) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest inner products of anchors (rows) with candidates on the sphere of radius
    ``top`` within ``radius`` of the centres (columns), a little widened against rounding."""
    norm = np.linalg.norm(q, axis=1)
    reach = norm * top
    cos = np.clip((q @ centres[:, :-1].T) / np.where(reach > 0, reach, 1)[:, None], -1, 1)
    angle = np.arccos(cos)
    spread = 2 * np.arcsin(np.clip(radius / (2 * top) if top > 0 else radius * 0, 0, 1))
    high = reach[:, None] * np.cos(np.maximum(angle - spread, 0))
    low = reach[:, None] * np.cos(np.minimum(angle + spread, np.pi))
    slack = 1e-6 * reach[:, None] + 1e-6
    return low - slack, high + slack


class CoverTree:
    """The levels below one block: nodes with centre, covering radius, children or rows."""

    def __init__(self, x: np.ndarray, top: float):
        self.top = top
        lifted = _lifted(x, top)
        centre, radius, children, rows = [], [], [], []
        todo = [(np.arange(len(x)), int(np.linalg.norm(lifted - lifted.mean(axis=0), axis=1).argmin()), None)]
        while todo:
            own, middle, above = todo.pop()
            node = len(centre)
            if above is not None:
                children[above].append(node)
            points = lifted[own]
            cover = float(np.linalg.norm(points - lifted[middle], axis=1).max())
            centre.append(lifted[middle])
            radius.append(cover)
            children.append([])
            if len(own) <= LEAF_ROWS or cover <= 1e-9 * max(top, 1):
                rows.append(own)
                continue
            rows.append(None)
            chosen, near, _ = _farthest_first(points, int(np.flatnonzero(own == middle)[0]), FANOUT, cover / 2)
            for k, c in enumerate(chosen):
                todo.append((own[near == k], int(own[c]), node))
        self.centre, self.radius = np.array(centre), np.array(radius)
        self.children, self.rows = children, rows

    def descend(self, q: np.ndarray, low: np.ndarray, high: np.ndarray, visit) -> None:
        """Best-first descent of anchors ``q`` together.  ``low(nodes)`` and ``high`` give every anchor's
        window as it stands; ``visit(rows, anchors)`` verifies a leaf for the anchors it may matter to."""
        least, most = bounds(q, self.centre, self.radius, self.top)
        meets = lambda node: (most[:, node] >= low()) & (least[:, node] <= high)
        best = lambda node: -float(np.minimum(most[:, node], high).max())
        heap = [(best(0), 0)]
        while heap:
            _, node = heapq.heappop(heap)
            of = np.flatnonzero(meets(node))
            if not len(of):
                continue
            if self.rows[node] is None:
                for child in self.children[node]:
                    heapq.heappush(heap, (best(child), child))
            else:
                visit(self.rows[node], of)


class Best:
    """The first ``k`` rows of every query by score, then by smaller id, as they are found."""

    def __init__(self, queries: int, k: int, low: np.ndarray):
        self.k = k
        self.score = np.full((queries, k), -np.inf)
        self.ident = np.full((queries, k), np.iinfo(np.int64).max)
        self.low = np.array(low, np.float64)  # the least score that still matters

    def least(self) -> np.ndarray:
        return np.maximum(self.low, self.score[:, -1])

    def offer(self, of: np.ndarray, scores: np.ndarray, ident: np.ndarray, allowed: np.ndarray) -> None:
        """Scores of rows ``ident`` for the queries ``of``, where ``allowed``."""
        last, last_id = self.score[of, -1][:, None], self.ident[of, -1][:, None]
        hit = allowed & (scores >= self.low[of][:, None]) & ((scores > last) | ((scores == last) & (ident[None, :] < last_id)))
        some = np.flatnonzero(hit.any(axis=1))
        if not len(some):
            return
        score = np.where(hit[some], scores[some], -np.inf)
        if score.shape[1] > 4 * self.k:  # only the best and all that tie with the last of them
            edge = -np.partition(-score, self.k - 1, axis=1)[:, self.k - 1:self.k]
            keep = (score >= edge).any(axis=0)
            score, ident = score[:, keep], ident[keep]
        row = of[some]
        score = np.concatenate((self.score[row], score), axis=1)
        ids = np.concatenate((self.ident[row], np.broadcast_to(ident, (len(row), len(ident)))), axis=1)
        ids = np.where(np.isneginf(score), np.iinfo(np.int64).max, ids)
        order = np.lexsort((ids, -score), axis=-1)[:, :self.k]
        self.score[row] = np.take_along_axis(score, order, axis=1)
        self.ident[row] = np.take_along_axis(ids, order, axis=1)


# -- the index

class Index:
    """Rows below their centres: ``rows`` (centre, part, vec_id, label, vector) as a written table, and
    what the driver keeps of it, one line for each centre."""

    def __init__(self, rows: DataFrame):
        spark = rows.sparkSession
        # floor() keeps whole numbers; the widest vector, the largest component and norm of all rows
        norm = F.aggregate("vector", F.lit(0.0), lambda a, v: a + v.cast("double") * v.cast("double"))
        n, width, most, top = rows.agg(
            F.count(F.lit(1)), F.max(F.size("vector")), F.max(F.array_max(F.transform("vector", F.abs))), F.max(F.sqrt(norm))).first()
        self.n, self.width, self.most, self.top = n, width or 0, int(most or 0), float(top or 0) * (1 + 1e-9)
        if self.most * self.most * max(self.width, 1) >= 1 << 53:
            raise ValueError(f"components up to {self.most}: inner products of {self.width} of them may leave 2**53")
        self.sample = self._sampled(rows)
        lifted = _lifted(self.sample[1], self.top)
        if n:
            chosen, _, _ = _farthest_first(lifted, 0, CENTRES, 0.0)
            self.centre = lifted[chosen]
        else:
            self.centre = np.zeros((0, self.width + 1))
        shared = spark.sparkContext.broadcast((self.centre, self.width, self.top))

        def below(batches):
            centre, width, top = shared.value
            for batch in batches:
                for i in range(0, batch.num_rows, 4096):
                    part = batch.slice(i, 4096)
                    x = _lifted(_matrix(part.column("vector"), width), top)
                    # nearest: on one sphere the largest inner product
                    near = (x @ centre.T).argmax(axis=1)
                    gap = np.linalg.norm(x - centre[near], axis=1)
                    yield pa.record_batch([*[part.column(c) for c in ("vec_id", "label", "vector")], pa.array(near.astype(np.int32)),
                                           pa.array(gap)], names=["vec_id", "label", "vector", "centre", "gap"])

        placed = rows.mapInArrow(below, _ROW + ", centre int, gap double")
        self.placed = staged(placed, "cover-tree")
        seen = self.placed.groupBy("centre").agg(F.count(F.lit(1)).alias("n"), F.max("gap").alias("gap")).collect()
        self.parts = np.zeros(len(self.centre), np.int64)  # CENTRES rows at most
        self.radius = np.zeros(len(self.centre))
        for r in seen:
            self.parts[r["centre"]] = -(-r["n"] // BLOCK_ROWS)
            self.radius[r["centre"]] = r["gap"] * (1 + 1e-9)

    def _sampled(self, rows: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(labels, vectors, ids) of about SAMPLE_ROWS rows, those with the smallest hashes of their ids."""
        share = min(1.0, SAMPLE_ROWS / max(self.n, 1))
        drawn = rows.where(F.pmod(F.xxhash64(F.lit("sample"), "vec_id"), F.lit(1 << 40)) < int(share * (1 << 40)))
        if share < 1 and drawn.isEmpty():  # hardly ever: one row has to do
            drawn = rows.limit(1)
        found = drawn.orderBy("vec_id", "label").toArrow()
        labels = found.column("label").to_numpy()
        return labels, _matrix(found.column("vector"), self.width), found.column("vec_id").to_numpy()

    def search(self, queries: DataFrame, k: int, same_label: bool) -> DataFrame:
        """(query, vec_id, score): the first ``k`` rows of every query in its window.

        ``queries``: (query, vec_id, label, vector, low, high), ``query`` an array of keys with one
        ``low`` and ``high`` each: windows of one anchor, which travel together.  Rows have the anchor's
        label (``same_label``) or another one, and never its id."""
        spark = queries.sparkSession
        facts = spark.sparkContext.broadcast((self.centre, self.radius, self.parts, self.width, self.top, self.sample))

        def wanted(batches):
            """Which blocks an anchor has to see."""
            centre, radius, parts, width, top, sample = facts.value
            labels, vectors, ids = sample
            for batch in batches:
                for i in range(0, batch.num_rows, BATCH):
                    part = batch.slice(i, BATCH)
                    q, own = _matrix(part.column("vector"), width), part.column("label").to_numpy()
                    lows, highs = _windows(part)
                    # rows of the sample show how good the k-th row is at least
                    scores = q.astype(np.float64) @ vectors.T.astype(np.float64)
                    ok = (labels[None, :] == own[:, None]) == same_label
                    ok &= ids[None, :] != part.column("vec_id").to_numpy()[:, None]
                    for w in range(lows.shape[1]):
                        if k <= len(labels):
                            inside = np.where(ok & (scores >= lows[:, w:w + 1]) & (scores <= highs[:, w:w + 1]), scores, -np.inf)
                            kth = -np.partition(-inside, k - 1, axis=1)[:, k - 1]
                            lows[:, w] = np.maximum(lows[:, w], kth)
                    least, most = bounds(q.astype(np.float64), centre, radius, top)
                    need = np.zeros(least.shape, bool)
                    for w in range(lows.shape[1]):
                        need |= (most >= lows[:, w:w + 1]) & (least <= highs[:, w:w + 1]) & (lows[:, w:w + 1] <= highs[:, w:w + 1])
                    need &= parts[None, :] > 0
                    row, of = np.nonzero(need)
                    times = parts[of]
                    which = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
                    row, of = np.repeat(row, times), np.repeat(of, times)
                    narrowed = pa.array([list(x) for x in lows], pa.list_(pa.float64()))
                    for j in range(0, len(row), 4096):
                        at = pa.array(row[j:j + 4096])
                        yield pa.record_batch(
                            [pa.array(of[j:j + 4096].astype(np.int32)), pa.array(which[j:j + 4096].astype(np.int32)),
                             pa.array(np.ones(len(at), np.int32)), *[part.column(c).take(at) for c in ("vec_id", "label", "vector", "query")],
                             narrowed.take(at), part.column("high").cast(pa.list_(pa.float64())).take(at)],
                            names=["centre", "part", "kind", "vec_id", "label", "vector", "query", "low", "high"])

        key = "centre int, part int, kind int, "
        more = ", query array<string>, low array<double>, high array<double>"
        asked = queries.select("vec_id", "label", "vector", "query", "low", "high").mapInArrow(wanted, key + _ROW + more)
        counts = F.array(*[F.lit(int(p)) for p in self.parts]) if len(self.parts) else F.array(F.lit(1))
        spread = F.greatest(F.get(counts, F.col("centre")), F.lit(1))
        held = self.placed.select(
            "centre", F.pmod(F.xxhash64("vec_id"), spread).cast("int").alias("part"), F.lit(0).alias("kind"), "vec_id", "label", "vector",
            F.lit(None).cast("array<string>").alias("query"), F.lit(None).cast("array<double>").alias("low"),
            F.lit(None).cast("array<double>").alias("high"))
        # a block's rows, then its anchors, stream through one task
        streams = held.unionByName(asked).repartition("centre", "part").sortWithinPartitions("centre", "part", "kind")

        def answered(batches):
            _, _, _, width, top, _ = facts.value
            for rows, anchors in _blocks(batches):
                x = np.concatenate([_matrix(b.column("vector"), width) for b in rows]) if rows else None
                if x is None:
                    continue
                ids = np.concatenate([b.column("vec_id").to_numpy() for b in rows])
                labels = np.concatenate([b.column("label").to_numpy() for b in rows])
                first = _first_of_equals(x, labels, ids, k + 1)
                x, ids, labels, tree = x[first], ids[first], labels[first], None
                for batch in anchors:
                    for i in range(0, batch.num_rows, BATCH):
                        tree = tree or CoverTree(x, top)
                        yield _found(tree, x, ids, labels, batch.slice(i, BATCH), k, same_label, width)

        found = streams.mapInArrow(answered, "query string, vec_id bigint, score bigint")
        # blocks return k rows at most; Spark keeps the first k of every task before it shuffles
        order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
        return found.select("*", F.row_number().over(order).alias("rank")).where(F.col("rank") <= k)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[pa.RecordBatch], Iterator[pa.RecordBatch]]]:
    """(rows, anchors) of every block: its rows are gathered, its anchors stream past."""
    pieces = _pieces(batches)
    piece = next(pieces, None)
    while piece is not None:
        block, rows = piece[0], []
        while piece is not None and piece[0] == block and piece[1] == 0:
            rows.append(piece[2])
            piece = next(pieces, None)

        def anchors():
            nonlocal piece
            while piece is not None and piece[0] == block:
                yield piece[2]
                piece = next(pieces, None)

        stream = anchors()
        yield rows, stream
        for _ in stream:  # whatever was not asked for
            pass


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[int, int], int, pa.RecordBatch]]:
    """((centre, part), kind, rows): stretches of one block and kind."""
    for batch in batches:
        keys = np.array([batch.column(c).to_numpy() for c in ("centre", "part", "kind")])
        cut = np.flatnonzero(np.concatenate(([True], (keys[:, 1:] != keys[:, :-1]).any(axis=0)))) if batch.num_rows else []
        for a, b in zip(cut, [*cut[1:], batch.num_rows]):
            yield (int(keys[0][a]), int(keys[1][a])), int(keys[2][a]), batch.slice(a, b - a)


def _first_of_equals(x: np.ndarray, labels: np.ndarray, ids: np.ndarray, most: int) -> np.ndarray:
    """Rows but those after the first ``most`` ids of one vector and label.  Equal rows tie with each other
    for every anchor, which can be one of them itself, so with ``k`` + 1 of them the others are never
    among the first ``k``."""
    order = np.lexsort((ids, labels, *x.T))
    same = np.concatenate(([False], (x[order[1:]] == x[order[:-1]]).all(axis=1) & (labels[order[1:]] == labels[order[:-1]])))
    place = np.arange(len(order))
    nth = place - np.maximum.accumulate(np.where(same, 0, place))
    return np.sort(order[nth < most])


def _found(tree: CoverTree, x: np.ndarray, ids: np.ndarray, labels: np.ndarray, anchors: pa.RecordBatch, k: int,
           same_label: bool, width: int) -> pa.RecordBatch:
    """The best rows of one block for a batch of anchors."""
    q, own, me = _matrix(anchors.column("vector"), width), anchors.column("label").to_numpy(), anchors.column("vec_id").to_numpy()
    low, high = _windows(anchors)
    best = [Best(len(q), k, low[:, w]) for w in range(low.shape[1])]
    exact, exact_x = q.astype(np.float64), x.astype(np.float64)  # whole numbers below 2**53 throughout

    def visit(rows: np.ndarray, of: np.ndarray) -> None:
        scores = exact[of] @ exact_x[rows].T
        allowed = ((labels[rows][None, :] == own[of][:, None]) == same_label) & (ids[rows][None, :] != me[of][:, None])
        for w, b in enumerate(best):
            b.offer(of, scores, ids[rows], allowed & (scores <= high[of, w][:, None]))

    # an anchor's windows together: from the least score any of them still wants
    tree.descend(exact, lambda: np.min([np.where(low[:, w] <= high[:, w], b.least(), np.inf)
                                                       for w, b in enumerate(best)], axis=0), high.max(axis=1), visit)
    keys = anchors.column("query").to_pylist()
    out = []
    for w, b in enumerate(best):
        row, col = np.nonzero(~np.isneginf(b.score))
        out += [(keys[r][w], i, s) for r, i, s in zip(row.tolist(), b.ident[row, col].tolist(), b.score[row, col].tolist())]
    return pa.record_batch([pa.array([o[0] for o in out], pa.string()), pa.array([o[1] for o in out], pa.int64()),
                            pa.array([int(o[2]) for o in out], pa.int64())], names=["query", "vec_id", "score"])


def mine(vectors: DataFrame, is_anchor: Column, label: Column, positives: int = 5, negatives: int = 3,
         least: int = 50, most: int = 95, scale: int = 256, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Scores are inner products of the components ``floor(scale * x)``; higher ones come first, ties by
    smaller id.  An anchor's positives are its first ``positives`` other rows of its label.  For each, the
    first ``negatives`` rows of other labels with ``least`` <= 100 * negative / positive score <= ``most``
    are ranked from 1.  ``is_anchor`` and ``label`` are columns of ``vectors``.

    * a null id, label or vector, or a null or non-finite component: the row takes no part
    * vectors of different lengths: the shorter ones count as followed by zeros
    * equal rows of one id are one row; an id with different rows has each of them, and is never its own
      positive or negative
    * a positive score below zero has no window and no negatives
    * components so large that inner products may leave 2**53 fail; empty tables and no anchors: empty result
    """
    table = vectors.select(vectors[f"`{id_col}`"].alias("_id"), vectors[f"`{vector_col}`"].alias("_vector"),
                           label.alias("_label"), is_anchor.alias("_anchor"))
    rows = staged(prepared(table, scale, F.col("_label"), "_id", "_vector").distinct(), "vectors")
    index = Index(rows)
    anchor_ids = table.where("_anchor").select(F.col("_id").cast("bigint").alias("vec_id")).distinct()
    anchors = staged(rows.join(anchor_ids, "vec_id", "left_semi").withColumn(
        "anchor", F.concat_ws(":", "vec_id", "label", F.xxhash64("vector"))), "anchors")
    # first wave: positives, from any score on
    wide = F.array(F.lit(float("-inf"))), F.array(F.lit(float("inf")))
    good = index.search(anchors.select("vec_id", "label", "vector", F.array("anchor").alias("query"),
                                       wide[0].alias("low"), wide[1].alias("high")), positives, True)
    good = staged(good.select(F.col("query").alias("anchor"), F.col("vec_id").alias("positive_id"),
                              F.col("score").alias("positive_score"), F.col("rank").alias("_nth")), "positives")
    # second wave: an anchor's windows travel with it, one for each positive
    share = lambda percent, up: (F.ceil if up else F.floor)(F.col("positive_score").cast("decimal(38,0)") * percent / 100)
    windows = (good.where(F.col("positive_score") >= 0).groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct(
        "_nth", F.concat_ws("|", "anchor", "_nth").alias("query"), share(least, True).cast("double").alias("low"),
        share(most, False).cast("double").alias("high")))).alias("w")))  # ``positives`` windows at most
    asked = anchors.join(windows, "anchor").select("vec_id", "label", "vector", F.col("w.query").alias("query"),
                                                   F.col("w.low").alias("low"), F.col("w.high").alias("high"))
    bad = index.search(asked, negatives, False)
    return (bad.join(good.withColumn("query", F.concat_ws("|", "anchor", "_nth")), "query").select(
        F.split("anchor", ":")[0].cast("bigint").alias("anchor_id"), "positive_id", F.col("rank").cast("int").alias("rank"),
        F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")))
