"""Benchmark decontamination by size-partitioned MinHash containment search.

Short test items are looked for inside long documents.  Items are partitioned by
the size of their shingle set (powers of two).  A document is cut into windows
that fit a partition: two neighbouring blocks of as many shingles as its largest
item, so an item that stands in the document lies whole in a window only a few
times its size, and its Jaccard similarity to that window is high however long
the document is.  Windows and items are compared by MinHash; an item that agrees
with some window in at least one of the hash functions is a candidate, which is
then verified by exact containment of its shingles in the whole document.

Items of up to BLOCK shingles are too small for a window: they are found without
MinHash.  A document that holds enough of an item's n shingles to contain it lacks at
most n - needed of them, so it holds one of any n - needed + 1; these are looked up
among all its shingles, which misses nothing.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ledgerlens.llm import arrays
from ledgerlens.llm.frames import free_name

#: Hash functions.  The least similarity of a whole item to its window is 9 / 32 (9 shingles in two blocks of 16):
#: it is missed with probability 0.72 ** 64 = 7e-10; of one with 7 of its 9 shingles, 7 / 34, with 5e-7.
HASHES = 64
#: Smallest block of shingles; all windows consist of such blocks.
BLOCK = 8
#: Items that are sent to the tasks at once; a larger benchmark is searched in several such blocks.
ITEM_BLOCK = 20_000
_WORD = re.compile("[^\x20\x09-\x0d]+")
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text: str | None, k: int) -> set[tuple[str, ...]]:
    """Distinct k-word shingles; with fewer words the whole sequence, without words none."""
    words = _WORD.findall((text or "").translate(_LOWER))
    if not words:
        return set()
    return {tuple(words[i:i + k]) for i in range(max(1, len(words) - k + 1))}


_SEEDS = arrays.mix(np.arange(1, HASHES + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)) | np.uint64(1)


def _signature(values: np.ndarray) -> np.ndarray:
    """MinHash of one set under every hash function."""
    return np.array([(values * s).min() >> np.uint64(16) for s in _SEEDS], np.uint64)


def size_class(n: int) -> int:
    """Partition of an item with n shingles: the power of two, at least BLOCK, that holds it."""
    c = BLOCK
    while c < n:
        c *= 2
    return c


class ItemIndex:
    """MinHash values of a block of items by size class and hash function."""

    def __init__(self, items: list[tuple[int, str]], k: int, num: int = 75, den: int = 100):
        self.k = k
        small: list[tuple[int, int]] = []  # (shingle, item) of the smallest items
        self.sets: list[tuple[int, set]] = []
        by_class: dict[int, list[tuple[int, np.ndarray]]] = defaultdict(list)
        for ident, text in items:
            exact = shingles(text, k)
            if not exact:
                continue
            data, offsets = arrays.buffers(pa.array([text]))
            words = arrays.Words(data, offsets, 0, 1, lower=True)
            hashed = arrays.shingle_sets(words.hashes(), words.row, k)[0]
            if len(exact) <= BLOCK:
                needed = max(1, -(-num * len(exact) // den))
                small += [(int(h), len(self.sets)) for h in hashed[:len(exact) - needed + 1]]
            else:
                by_class[size_class(len(hashed))].append((len(self.sets), _signature(hashed)))
            self.sets.append((ident, exact))
        small.sort()
        self.small = np.array([h for h, _ in small], np.uint64), np.array([i for _, i in small], np.int64)
        self.classes: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        for c, members in by_class.items():
            number = np.array([m[0] for m in members])
            signs = np.stack([m[1] for m in members])
            order = np.argsort(signs, axis=0, kind="stable")
            self.classes[c] = [(signs[order[:, f], f], number[order[:, f]]) for f in range(HASHES)]

    def _small(self, grams: np.ndarray, begin: np.ndarray) -> Iterator[tuple[int, int]]:
        known, item = self.small
        if not len(known) or not len(grams):
            return
        lo = np.searchsorted(known, grams, "left")
        hit = np.flatnonzero(known[np.minimum(lo, len(known) - 1)] == grams)
        rows = np.searchsorted(begin, hit, "right") - 1
        found = set()
        for g, r in zip(hit.tolist(), rows.tolist()):
            i = int(lo[g])
            while i < len(known) and known[i] == grams[g]:
                found.add((r, int(item[i])))
                i += 1
        yield from found

    def candidates(self, grams: np.ndarray, begin: np.ndarray) -> Iterator[tuple[int, int]]:
        """(row, item) pairs that agree in a hash function or, of the smallest items, in a shingle looked up,
        from the shingle hashes of a slice of texts."""
        yield from self._small(grams, begin)
        size = np.diff(begin)
        n_blocks = -(-size // BLOCK)
        used = np.flatnonzero(size > 0)
        if not len(used) or not self.classes:
            return
        first = np.concatenate(([0], np.cumsum(n_blocks)))
        row_of = np.repeat(np.arange(len(size)), n_blocks)
        within = np.arange(first[-1]) - np.repeat(first[:-1], n_blocks)
        starts = np.repeat(begin[:-1], n_blocks) + within * BLOCK
        found = set()
        for f, seed in enumerate(_SEEDS):
            # minimum of every block, then of ever larger aligned blocks, then of two neighbours
            low = np.minimum.reduceat(grams * seed, starts) >> np.uint64(16)
            rows, place, width = row_of, within, BLOCK
            top = max(self.classes)
            while True:
                if width in self.classes:
                    pair = low.copy()
                    follows = rows[1:] == rows[:-1]
                    pair[:-1][follows] = np.minimum(pair[:-1][follows], low[1:][follows])
                    value, item = self.classes[width][f]
                    lo = np.searchsorted(value, pair, "left")
                    hit = np.flatnonzero((lo < len(value)) & (value[np.minimum(lo, len(value) - 1)] == pair))
                    for w in hit.tolist():
                        i = int(lo[w])
                        while i < len(value) and value[i] == pair[w]:
                            found.add((int(rows[w]), int(item[i])))
                            i += 1
                if width >= top:
                    break
                keep = np.flatnonzero(place % 2 == 0)  # a row's blocks are merged in twos
                merged = low[keep]
                has = keep + 1 < len(low)
                has[has] = rows[keep[has] + 1] == rows[keep[has]]
                merged[has] = np.minimum(merged[has], low[keep[has] + 1])
                low, rows, place, width = merged, rows[keep], place[keep] // 2, width * 2
        yield from found


def contained_items(docs: DataFrame, items: DataFrame, k: int = 5, num: int = 75, den: int = 100,
                    id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id",
                    item_text: str = "text") -> DataFrame:
    """(doc_id, item_id, n_item, n_shared): items of which ``num / den`` or more of the distinct
    ``k``-word shingles stand in a document.

    Words are runs without white space, A-Z lower-cased; a text with fewer than
    ``k`` words is one shingle.  The documents are read once for every ITEM_BLOCK
    items and are not shuffled; the items, which a benchmark bounds, go to the
    tasks block by block.  Items of up to BLOCK shingles are found always.  Larger items in one
    piece are missed with a probability below 1e-6; in several pieces far apart they have smaller
    similarities to single windows and may be missed.

    * null or empty text or item: contains nothing, is contained in nothing
    * null ids stay null in the result; repeated rows of either table each count
    * empty tables: empty result; other columns are not read
    """
    spark = docs.sparkSession
    rows = docs.select(docs[f"`{id_col}`"].cast("bigint").alias("doc_id"), docs[f"`{text_col}`"].alias("text"))
    test = items.select(items[f"`{item_id}`"].cast("bigint").alias("item_id"), items[f"`{item_text}`"].alias("text"))
    schema = "doc_id bigint, item_id bigint, n_item bigint, n_shared bigint"

    def search(block):
        index = spark.sparkContext.broadcast(block)

        def find(batches):
            known = ItemIndex(index.value, k, num, den)
            for batch in batches:
                out = []
                data, offsets = arrays.buffers(batch.column("text"))
                for i, j in arrays.slices(offsets):
                    words = arrays.Words(data, offsets, i, j, lower=True)
                    hashes = words.hashes()
                    grams, begin = arrays.ngrams(hashes, words.row, k)
                    size = np.diff(words.row)
                    few = np.flatnonzero((size > 0) & (size < k))
                    if len(few):  # short texts: their one shingle, in place
                        full = arrays.whole(hashes, words.row)
                        grams = np.insert(grams, begin[few], full[few])
                        begin = begin + np.searchsorted(few, np.arange(len(begin)), "left")
                    exact: dict[int, set] = {}
                    for r, n in sorted(set(known.candidates(grams, begin))):
                        if r not in exact:
                            exact[r] = shingles(batch.column("text")[i + r].as_py(), k)
                        ident, item = known.sets[n]
                        shared = len(item & exact[r])
                        if den * shared >= num * len(item):
                            out.append((batch.column("doc_id")[i + r].as_py(), ident, len(item), shared))
                yield pa.record_batch([pa.array([x[c] for x in out], pa.int64()) for c in range(4)],
                                      names=["doc_id", "item_id", "n_item", "n_shared"])

        return rows.mapInArrow(find, schema)

    result, block = None, []
    for r in test.toLocalIterator():
        block.append((r["item_id"], r["text"]))
        if len(block) == ITEM_BLOCK:
            result = search(block) if result is None else result.union(search(block))
            block = []
    if block or result is None:
        result = search(block) if result is None else result.union(search(block))
    return result


def drop_contaminated(docs: DataFrame, items: DataFrame, k: int = 5, num: int = 75, den: int = 100,
                      id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the documents that contain a test item.  Rows with a null id are judged by
    the other rows with a null id; rows that repeat an id go together."""
    name = free_name(docs, "_leaked")
    hit = (contained_items(docs, items, k, num, den, id_col, text_col)
           .select(F.col("doc_id").alias(name)).distinct())
    return docs.join(hit, docs[f"`{id_col}`"].eqNullSafe(hit[name]), "left_anti")
