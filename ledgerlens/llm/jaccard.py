"""N-gram Jaccard join by T-occurrence search over inverted lists.

Two documents link when ``den * |intersection| >= num * |union|`` of their
shingle sets.  A partner of a set of n shingles must share T = ceil(num * n / den)
of them, so if each document sets its T - 1 longest inverted lists aside, partners
still meet in one of the remaining short lists.  Those short lists are the index
that is shuffled (a quarter of the shingles for 0.75); how long the lists are is
counted over all documents beforehand.

Inside a list not all pairs are made.  First every document meets only the
smallest document of the list; DivideSkip then searches the gathered candidates
of each such query: its short lists are heap-merged, its long ones probed by
binary search, and the documents that reach the required overlap are retained.
After components of these links are known, documents that share a list but not
yet a component are verified in the same way, so no link between components is
lost, while large groups of copies cost one comparison a document.  The join itself
then verifies all other pairs that share a list, inside the components; equal sets
are one node there, and its copies are listed as its members.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ledgerlens.llm import arrays
from ledgerlens.llm.buckets import FLUSH, by_bucket, dealt, even_keys, partitions, parts
from ledgerlens.llm.components import connected
from ledgerlens.llm.frames import few_files, free_name, staged

#: Lists from this length on count as long when a document orders its shingles.
LONG_LIST = 8
#: At most so many long lists are told apart (their table is sent to every task: 16 bytes each).
LONG_LISTS = 1 << 20
#: A list longer than this is split by document into parts of about this size.
LIST_PART = 4096
#: Candidates searched together for one query.
SEARCH_PART = 256

#: Slots over which candidate ids are hashed to screen the documents before their texts are shuffled.
SCREEN_SLOTS = 1 << 20

#: Texts are hashed so many rows and bytes at a time: what a worker holds beside an Arrow batch is a few times that.
SET_ROWS, SET_BYTES = 512, 512 << 10
#: Postings that a task gathers before it writes them out as rows.
INDEX_FLUSH = 500_000

_KEY_BITS = 22  # of a shingle's hash inside a bucket, when lengths are counted
_KEY_MASK = np.uint64((1 << _KEY_BITS) - 1)
_LIST_MASK = np.uint64((1 << 47) - 1)  # of a shingle's hash, to name its list
_SPLIT = np.uint64(1 << 47)  # marks postings of a list that is split
_FULL = 65535  # sizes from here on are not told apart in the index, and rule no pair out


def required(a: int, b: int, num: int, den: int) -> int:
    """Smallest overlap of sets of sizes a and b that link."""
    return -(-num * (a + b) // (num + den))


def divide_skip(query: np.ndarray, sets: list[np.ndarray], least: list[int]) -> list[int]:
    """T-occurrence search: the overlap of ``query`` with each of ``sets`` (sorted arrays), or 0
    where it does not reach ``least``.

    The inverted list of a query value holds the sets with that value.  With T the
    smallest bound, the longest lists (fewer than T) are left out; a set must then
    occur in T - L of the others, which are heap-merged and counted, and only sets
    that do are probed in the long lists, by binary search of the list's value.
    """
    found = [0] * len(sets)
    if not sets or not len(query):
        return found
    size = np.array([len(s) for s in sets])
    value = np.concatenate(sets) if size.sum() else np.empty(0, query.dtype)
    at = np.searchsorted(query, value)
    at[at == len(query)] = 0
    hit = query[at] == value
    owner, at = np.repeat(np.arange(len(sets)), size)[hit], at[hit]
    order = np.lexsort((owner, at))
    owner, at = owner[order], at[order]
    cut = np.searchsorted(at, np.arange(len(query) + 1))
    length = np.diff(cut)
    t = max(1, min(least))
    longest = int(length.max(initial=0))
    n_long = min(t - 1, int(t / (0.0085 * np.log(max(longest, 1)) + 1)))
    by_length = np.argsort(length, kind="stable")
    short, long = by_length[:len(query) - n_long], np.sort(by_length[len(query) - n_long:])
    lists = [owner[cut[i]:cut[i + 1]].tolist() for i in short if length[i]]
    seen: dict[int, int] = {}
    for s in heapq.merge(*lists):
        seen[s] = seen.get(s, 0) + 1
    probes = query[long]
    for s, n in seen.items():
        if n < least[s] - n_long:
            continue
        if len(probes):
            mine = sets[s]
            where = np.searchsorted(mine, probes)
            where[where == len(mine)] = 0
            n += int((mine[where] == probes).sum())
        if n >= least[s]:
            found[s] = n
    return found


def _sets(batches: Iterator[pa.RecordBatch], k: int):
    """(row of the batch's other columns, shingle set) of every row with words."""
    for batch in batches:
        text = batch.column("text")
        for at in range(0, len(text), SET_ROWS):
            data, offsets = arrays.buffers(text.slice(at, SET_ROWS))
            for i, j in arrays.slices(offsets, SET_BYTES):
                words = arrays.Words(data, offsets, i, j, lower=True)
                for r, s in enumerate(arrays.shingle_sets(words.hashes(), words.row, k)):
                    yield batch, at + i + r, s


def shingle_classes(docs: DataFrame, k: int) -> DataFrame:
    """(id, n_shingles, a, b): set size and a 128-bit signature of every row's shingle set."""

    def describe(batches):
        for batch in batches:
            n, a, b = [], [], []
            for _, _, s in _sets([batch], k):
                n.append(len(s))
                a.append(int(arrays.mix(s).sum(dtype=np.uint64).astype(np.int64)))
                b.append(int(arrays.mix(s ^ np.uint64(0xA5A5A5A5DEADBEEF)).sum(dtype=np.uint64).astype(np.int64)))
            yield pa.record_batch({"id": batch.column("id"), "n_shingles": pa.array(n, pa.int64()),
                                   "a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return docs.mapInArrow(describe, "id bigint, n_shingles bigint, a bigint, b bigint")


def _long_lists(docs: DataFrame, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys (bucket and 22 bits of the hash) and length, in eighths of its log2, of the long inverted lists.

    Lengths are counted over all documents.  Of the lists with LONG_LIST postings
    or more the longest are kept, down to the power of two at which there are
    LONG_LISTS of them at most.  Two shingles may share a key: their order changes
    then, but no result.
    """
    n_buckets = partitions(docs.sparkSession)
    deal = even_keys(docs.sparkSession, n_buckets)

    def pack(held: list[np.ndarray]):
        h = np.concatenate(held)
        held.clear()
        key = h >> np.uint64(32)
        key %= np.uint64(n_buckets)
        key <<= np.uint64(_KEY_BITS)
        h &= _KEY_MASK
        key |= h
        del h
        key.sort()
        out = []
        for b, i, j in parts(key >> np.uint64(_KEY_BITS), n_buckets):
            gaps = np.diff(key[i:j] & _KEY_MASK, prepend=np.uint64(0))
            wide = bool(gaps.max() >= 1 << 16)
            out.append((int(deal[b]), b, wide, gaps.astype(np.uint32 if wide else np.uint16).tobytes()))
        return pa.record_batch({"bucket": pa.array([x[0] for x in out], pa.int32()),
                                "number": pa.array([x[1] for x in out], pa.int32()),
                                "wide": pa.array([x[2] for x in out]),
                                "gaps": pa.array([x[3] for x in out], pa.binary())})

    def send(batches):
        held, n = [], 0
        for _, _, s in _sets(batches, k):
            held.append(s)
            n += len(s)
            if n >= FLUSH:
                yield pack(held)
                held, n = [], 0
        if n:
            yield pack(held)

    def count(batches):
        for _, rows in by_bucket(batches):
            key = np.sort(np.concatenate([np.cumsum(np.frombuffer(
                r["gaps"], np.uint32 if r["wide"] else np.uint16).astype(np.uint64)) for r in rows]))
            first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
            length = np.diff(np.append(first, len(key)))
            far = length >= LONG_LIST
            if far.any():
                yield pa.record_batch({
                    "key": pa.array((key[first[far]] | np.uint64(rows[0]["number"] << _KEY_BITS)).astype(np.int64)),
                    "length": pa.array(length[far].astype(np.int64))})

    packed = docs.mapInArrow(send, "bucket int, number int, wide boolean, gaps binary")
    found = staged(few_files(dealt(packed).mapInArrow(count, "key bigint, length bigint")), "long")
    power = F.floor(F.log2("length")).cast("int")
    kept, least = 0, 63
    for r in found.groupBy(power.alias("power")).count().orderBy(F.desc("power")).collect():  # 63 rows at most
        kept += r["count"]
        if kept > LONG_LISTS:
            break
        least = r["power"]
    found = found.where(power >= least).toArrow()  # LONG_LISTS rows at most
    key = found.column("key").to_numpy().astype(np.uint64)
    order = np.argsort(key)
    return key[order], (8 * np.log2(found.column("length").to_numpy()[order])).astype(np.uint8)


def _index(docs: DataFrame, k: int, num: int, den: int, long_lists) -> DataFrame:
    """Short inverted lists, packed: each document posts the n - T + 1 shingles with the shortest lists.

    A posting is 47 bits of the shingle's hash and its place in the document's
    order (in 256ths, rounded down); ids and sizes stand once for each document
    and bucket.  Shingles that the 47 bits confuse only add candidates.
    """
    spark = docs.sparkSession
    n_buckets = partitions(spark)
    deal = even_keys(spark, n_buckets)
    table = spark.sparkContext.broadcast(long_lists)
    slots = (1 << 22) - 1

    def post(batches):
        keys, rank = table.value
        screen = np.zeros(slots + 1, bool)  # most shingles are in no long list and stop here
        screen[(keys & np.uint64(slots)).astype(np.int64)] = True
        hashes, ids, sizes, counts, salts, splits, places, held = [], [], [], [], [], [], [], 0

        def pack():
            h = np.concatenate(hashes)
            salt, split, place = np.concatenate(salts), np.concatenate(splits), np.concatenate(places)
            rows_of = np.argsort(np.array(ids, np.int64), kind="stable")  # owners in the order of their ids
            turn = np.empty(len(ids), np.int64)
            turn[rows_of] = np.arange(len(ids))
            ident, size = np.array(ids, np.int64)[rows_of], np.minimum(np.array(sizes), _FULL)[rows_of]
            owner = np.repeat(turn, counts)
            bucket = arrays.mix(h + salt.astype(np.uint64)) % np.uint64(n_buckets)
            h = np.where(split, _SPLIT, np.uint64(0)) | (h & _LIST_MASK)
            order = np.lexsort((owner, bucket))
            bucket = bucket[order]
            rows = []
            for b, i, j in parts(bucket, n_buckets):
                mine = order[i:j]
                who, n = np.unique(owner[mine], return_counts=True)
                gaps = np.diff(ident[who], prepend=ident[who[0]])
                wide = bool(gaps.max() >= 1 << 32)
                rows.append((int(deal[b]), h[mine].astype(np.uint32).tobytes(),
                             (h[mine] >> np.uint64(32)).astype(np.uint16).tobytes(), place[mine].tobytes(),
                             int(ident[who[0]]), wide, gaps.astype(np.uint64 if wide else np.uint32).tobytes(),
                             size[who].astype(np.uint16).tobytes(), n.astype(np.uint16).tobytes()))
            types = [pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.int64(), pa.bool_(), *[pa.binary()] * 3]
            return pa.record_batch([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)],
                                   names=["bucket", "low", "high", "places", "first", "wide", "gaps", "sizes", "counts"])

        for batch, r, s in _sets(batches, k):
            n = len(s)
            if not n:
                continue
            level = np.zeros(n, np.uint8)
            may = np.flatnonzero(screen[(s & np.uint64(slots)).astype(np.int64)]) if len(keys) else ()
            if len(may):
                h = s[may]
                key = ((h >> np.uint64(32)) % np.uint64(n_buckets) << np.uint64(_KEY_BITS)) | (h & _KEY_MASK)
                at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
                known = keys[at] == key
                level[may[known]] = rank[at[known]]
            short = n - -(-num * n // den) + 1
            order = np.argsort(level, kind="stable")[:short]  # ties by hash, as s is sorted
            ident = batch.column("id")[r].as_py()
            pieces = np.ceil(np.exp2((level[order].astype(float) + 1) / 8) / LIST_PART).astype(np.int64)
            mine = int(arrays.mix(np.array([ident & (2**64 - 1)], np.uint64))[0] >> np.uint64(33))
            for lo in range(0, short, _FULL):  # a count has 16 bits
                part = order[lo:lo + _FULL]
                hashes.append(s[part])
                salts.append(mine % pieces[lo:lo + _FULL])
                splits.append(pieces[lo:lo + _FULL] > 1)
                places.append((256 * np.arange(lo, lo + len(part)) // n).astype(np.uint8))
                ids.append(ident)
                sizes.append(n)
                counts.append(len(part))
                held += len(part)
                if held >= INDEX_FLUSH:
                    yield pack()
                    hashes, ids, sizes, counts, salts, splits, places, held = [], [], [], [], [], [], [], 0
        if held:
            yield pack()

    return docs.mapInArrow(post, "bucket int, low binary, high binary, places binary, first bigint, wide boolean, "
                                 "gaps binary, sizes binary, counts binary")


def _lists(index: DataFrame) -> DataFrame:
    """Postings (shingle, id, size, place) of the lists with two documents or more and of all parts of
    split lists, each with the smallest document of the list or part: head, head_size, head_place."""

    def group(batches):
        for _, rows in by_bucket(batches):
            n = [np.frombuffer(r["counts"], np.uint16) for r in rows]
            h = np.concatenate([np.frombuffer(r["low"], np.uint32).astype(np.int64)
                                | np.frombuffer(r["high"], np.uint16).astype(np.int64) << 32 for r in rows])
            place = np.concatenate([np.frombuffer(r["places"], np.uint8) for r in rows])
            ident = np.concatenate([np.repeat(r["first"] + np.cumsum(np.frombuffer(
                r["gaps"], np.uint64 if r["wide"] else np.uint32).astype(np.int64)), c) for r, c in zip(rows, n)])
            size = np.concatenate([np.repeat(np.frombuffer(r["sizes"], np.uint16), c) for r, c in zip(rows, n)])
            order = np.argsort(h, kind="stable")
            twice = np.zeros(len(h), bool)
            same = h[order[1:]] == h[order[:-1]]
            twice[1:] |= same
            twice[:-1] |= same
            order = order[twice | (h[order] >= int(_SPLIT))]
            if not len(order):
                continue
            order = order[np.lexsort((ident[order], h[order]))]
            h, ident, size, place = h[order], ident[order], size[order], place[order]
            new = np.concatenate(([True], h[1:] != h[:-1]))
            head = np.flatnonzero(new)[np.cumsum(new) - 1]
            last = np.append(np.flatnonzero(new)[1:], len(h))[np.cumsum(new) - 1] - 1
            keep = (ident[last] != ident[head]) | (h >= int(_SPLIT))
            head = head[keep]
            if len(head):
                yield pa.record_batch({
                    "shingle": pa.array(h[keep]), "id": pa.array(ident[keep]),
                    "size": pa.array(size[keep].astype(np.int32)), "place": pa.array(place[keep].astype(np.int32)),
                    "head": pa.array(ident[head]), "head_size": pa.array(size[head].astype(np.int32)),
                    "head_place": pa.array(place[head].astype(np.int32))})

    return dealt(index).mapInArrow(group, "shingle bigint, id bigint, size int, place int, "
                                          "head bigint, head_size int, head_place int")


def _may_link(a: Column, a_place: Column, b: Column, b_place: Column, num: int, den: int) -> Column:
    """Sizes a and b can link, and a first common shingle at these places leaves room for the overlap."""
    need = F.ceil(F.lit(num) * (a + b) / F.lit(num + den))
    room = F.least(a - F.floor(a_place * a / 256), b - F.floor(b_place * b / 256))
    return ((a >= _FULL) | (b >= _FULL)) | ((a * den >= b * num) & (b * den >= a * num) & (room >= need))


def _enough_short_lists(pairs: DataFrame, postings: DataFrame, num: int, den: int) -> DataFrame:
    """The ``pairs`` (query, id) that share enough short lists.

    Each document has set T - 1 lists aside, so of the required overlap at most
    the larger T - 1 can lie there; the rest must be met in the short lists.
    """
    x = postings.select("shingle", F.col("id").alias("query"), F.col("size").alias("n_query"))
    y = postings.select("shingle", "id", F.col("size").alias("n_id"))
    met = (pairs.join(x, "query").join(y, ["shingle", "id"])
           .groupBy("query", "id", "n_query", "n_id").agg(F.count("*").alias("n")))
    need = F.ceil(F.lit(num) * (F.col("n_query") + F.col("n_id")) / F.lit(num + den))
    aside = F.ceil(F.lit(num) * F.greatest("n_query", "n_id") / F.lit(den)) - 1
    return met.where((F.greatest("n_query", "n_id") >= _FULL) | (F.col("n") >= need - aside)).select("query", "id")


def _retained(docs: DataFrame, pairs: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """The ``pairs`` (query, id) that link, with their overlap, by DivideSkip over each query's candidates."""
    n_parts = pairs.groupBy("query").agg(F.ceil(F.count("*") / SEARCH_PART).cast("int").alias("n"))
    members = pairs.join(n_parts, "query").select(
        "query", F.pmod(F.xxhash64("id"), F.col("n")).cast("int").alias("part"), "id", F.lit(1).alias("role"))
    queries = n_parts.select("query", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("part"),
                             F.col("query").alias("id"), F.lit(0).alias("role"))
    wanted = members.union(queries)
    # texts of most documents that are no candidates stay where they are: at most SCREEN_SLOTS numbers are broadcast
    slot = F.pmod(F.xxhash64("id"), F.lit(SCREEN_SLOTS)).cast("int")
    likely = docs.where(F.col("id").isNotNull()).withColumn("slot", slot).join(
        F.broadcast(wanted.select(slot.alias("slot")).distinct()), "slot", "left_semi").drop("slot")
    blocks = (wanted.join(likely, "id")
              .repartition(partitions(docs.sparkSession), "query", "part").sortWithinPartitions("query", "part", "role", "id"))

    def search(batches):
        block, queries, sets, ids = None, [], [], []

        def answer():
            best: dict[int, tuple[int, int, int]] = {}
            for q in queries:  # several only if rows repeat the query's id
                least = [required(len(q), len(s), num, den) for s in sets]
                for ident, s, n in zip(ids, sets, divide_skip(q, sets, least)):
                    if n:
                        best[ident] = max(best.get(ident, (0, 0, 0)), (n, len(q), len(s)))
            return pa.record_batch({
                "u": pa.array([block[0]] * len(best), pa.int64()), "v": pa.array(list(best), pa.int64()),
                "overlap": pa.array([x[0] for x in best.values()], pa.int64()),
                "n_u": pa.array([x[1] for x in best.values()], pa.int64()),
                "n_v": pa.array([x[2] for x in best.values()], pa.int64())})

        for batch, r, s in _sets(batches, k):
            here = (batch.column("query")[r].as_py(), batch.column("part")[r].as_py())
            if here != block:
                if queries and sets:
                    yield answer()
                block, queries, sets, ids = here, [], [], []
            if batch.column("role")[r].as_py() == 0:
                queries.append(s)
            else:
                sets.append(s)
                ids.append(batch.column("id")[r].as_py())
        if queries and sets:
            yield answer()

    return blocks.mapInArrow(search, "u bigint, v bigint, overlap bigint, n_u bigint, n_v bigint")


def ngram_jaccard_join(docs: DataFrame, k: int = 5, num: int = 75, den: int = 100, id_col: str = "doc_id",
                       text_col: str = "text", every_link: bool = True) -> tuple[DataFrame, DataFrame]:
    """Link documents by the Jaccard similarity of their distinct ``k``-word shingles.

    Words are runs without white space, A-Z lower-cased.  A text with fewer words
    than ``k`` has its whole word sequence as one shingle; without words the set is
    empty and links with nothing.

    Returns ``(classes, links)``: classes has for every row of ``docs`` its id as
    ``doc_id``, ``n_shingles`` and ``component_id``, the smallest id reachable by
    links; links (u, v, overlap, n_u, n_v) has every pair of different sets that
    link once (u < v), each set by the smallest id that has it, and for each further
    id of a set the row (id, smallest id).  A text is compared with all its partners, so
    this takes time with the number of links.  A caller that needs the classes
    alone passes ``every_link=False``: links then are those that join the components.

    * null or empty text: empty set, its own component
    * null id: the row counts its shingles, links with nothing, component null
    * rows that repeat an id are one node: it links if any of its rows does
    * equal sets link without a comparison; ties are broken by the smaller id
    * empty table: two empty results; columns of ``docs`` other than id and text are not read
    """
    docs = docs.select(docs[f"`{id_col}`"].cast("bigint").alias("id"), docs[f"`{text_col}`"].alias("text"))
    classes = staged(few_files(shingle_classes(docs, k)), "classes")
    known = classes.where("id IS NOT NULL AND n_shingles > 0")
    heads = known.groupBy("a", "b").agg(F.min("id").alias("head"), F.count("*").alias("n")).where("n > 1")
    # copies: each id with the smallest id of an equal set
    copies = staged(known.join(heads, ["a", "b"]).where("id <> head").select("id", "head").distinct(), "copies")

    index = _index(docs.where(F.col("id").isNotNull()), k, num, den, _long_lists(docs, k))
    lists = _lists(index)
    # a copy is searched through its head, unless other rows of its id have other texts
    several = known.groupBy("id").agg(*[f(c).alias(f"{f.__name__}_{c}") for c in ("a", "b") for f in (F.min, F.max)]).where(
        "min_a <> max_a or min_b <> max_b")
    names = (copies.join(several.select("id"), "id", "left_anti")
             .select(F.col("id").alias("copy"), F.col("head").alias("same")))
    for c in ("id", "head"):
        lists = (lists.join(names, lists[c] == names["copy"], "left").withColumn(c, F.coalesce("same", c))
                 .drop("copy", "same"))
    lists = staged(lists.distinct(), "lists")
    # first every document meets the head that it shares most lists with; the parts of a split list
    # meet through their heads
    shared = (lists.where("id <> head").where(_may_link(*(F.col(c) for c in (
        "size", "place", "head_size", "head_place")), num, den)).groupBy("id", "head").count())
    tops = lists.groupBy("shingle").agg(F.min("head").alias("top"), F.max("head").alias("other")).where("top <> other")
    between = lists.join(tops.select("shingle", "top"), "shingle").where("id = head and head <> top")
    first = staged(shared.groupBy("id").agg(F.max_by("head", F.struct("count", -F.col("head"))).alias("query"))
                   .select("query", "id").union(between.select(F.col("top").alias("query"), "id")).distinct(), "pairs")
    first = staged(_enough_short_lists(first, lists, num, den), "pairs")
    links = staged(few_files(_retained(docs, first, k, num, den)), "retained")
    same = copies.select(F.col("id").alias("u"), F.col("head").alias("v"))
    so_far = staged(connected(links.select("u", "v").union(same)), "components")

    # then those that share a list but no component yet, if a first common shingle there leaves room
    placed = (lists.select("shingle", "id", "size", "place").join(so_far, "id", "left")
              .withColumn("label", F.coalesce("component", "id")).drop("component"))
    mixed = placed.groupBy("shingle").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo <> hi")
    open_ = staged(placed.join(mixed.select("shingle"), "shingle", "left_semi"), "open")
    x, y = open_.alias("x"), open_.alias("y")
    rest = (x.join(y, (F.col("x.shingle") == F.col("y.shingle")) & (F.col("x.id") < F.col("y.id"))
                   & (F.col("x.label") != F.col("y.label")) & _may_link(*(F.col(c) for c in (
                       "x.size", "x.place", "y.size", "y.place")), num, den))
            .select(F.col("x.id").alias("query"), F.col("y.id").alias("id")).distinct()
            .join(first, ["query", "id"], "left_anti")
            .join(first.select(F.col("id").alias("query"), F.col("query").alias("id")), ["query", "id"], "left_anti"))
    rest = staged(_enough_short_lists(staged(rest, "met"), open_, num, den), "rest")
    more = staged(few_files(_retained(docs, rest, k, num, den)), "retained")
    every = staged(connected(so_far.select(F.col("id").alias("u"), F.col("component").alias("v"))
                             .union(more.select("u", "v"))), "components")
    out = classes.join(every, "id", "left").select(
        F.col("id").alias("doc_id"), "n_shingles", F.coalesce("component", "id").alias("component_id"))
    links = links.union(more)
    if every_link:
        x, y = lists.alias("x"), lists.alias("y")
        inside = (x.join(y, (F.col("x.shingle") == F.col("y.shingle")) & (F.col("x.id") < F.col("y.id"))
                         & _may_link(*(F.col(c) for c in ("x.size", "x.place", "y.size", "y.place")), num, den))
                  .select(F.col("x.id").alias("query"), F.col("y.id").alias("id")).distinct())
        for done in (first, rest):
            inside = (inside.join(done, ["query", "id"], "left_anti")
                      .join(done.select(F.col("id").alias("query"), F.col("query").alias("id")), ["query", "id"], "left_anti"))
        inside = staged(_enough_short_lists(staged(inside, "met"), lists, num, den), "inside")
        n = F.col("n_shingles")
        members = (known.join(heads.drop("n"), ["a", "b"]).where("id <> head").select(
            F.col("id").alias("u"), F.col("head").alias("v"), n.alias("overlap"), n.alias("n_u"), n.alias("n_v")).distinct())
        links = links.union(staged(few_files(_retained(docs, inside, k, num, den)), "retained"))
        up, swapped = F.col("u") < F.col("v"), {"u": "v", "v": "u", "n_u": "n_v", "n_v": "n_u"}
        links = (links.select(*[F.when(up, F.col(c)).otherwise(F.col(swapped.get(c, c))).alias(c) for c in links.columns])
                 .dropDuplicates(["u", "v"]).union(members))
    return out, links


def drop_near_copies(docs: DataFrame, k: int = 5, num: int = 75, den: int = 100, id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """``docs`` with one document of each component: the one with the smallest id.

    Documents without words stay; so do rows with a null id.  Of rows that repeat
    an id all stay or go together.
    """
    name = free_name(docs, "_component")
    classes, _ = ngram_jaccard_join(docs, k, num, den, id_col, text_col, every_link=False)
    gone = classes.where("doc_id <> component_id").select(F.col("doc_id").alias(name)).distinct()
    return docs.join(gone, docs[f"`{id_col}`"] == gone[name], "left_anti")
