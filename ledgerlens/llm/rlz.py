"""Substring deduplication by relative Lempel-Ziv parsing.

Every document is factored against the windows of all documents with smaller
ids.  The reference is indexed in blocks: each run of windows goes to the block
that its minimal 20-word gram names, so neighbouring windows mostly stay
together, and equal windows always meet.  A block finds for each window the
smallest document that has it; consecutive windows whose references are
consecutive too grow greedily into one fragment.  A fragment ends where a block
ends; back at their document, fragments that touch or overlap and whose references
go on in step are joined to maximal factors, so a copied passage is one factor
however many blocks have indexed it.  Windows that cross from one factor into the
next have been looked up like all others, so nothing between two factors is missed.
Factors are at least one window long and become the spans to remove.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from ledgerlens.llm import arrays
from ledgerlens.llm.buckets import FLUSH, by_bucket, dealt, even_keys, partitions, parts
from ledgerlens.llm.frames import free_name, without

#: Words of the gram whose smallest hash in a window names the window's block.
GRAM = 20
#: 88 bits of two independent hashes of a window are sent: 56 of the first, 32 of the second.
_HASH_BYTES = (np.uint32, np.uint16, np.uint8, np.uint32)
_SECOND = np.uint64(0xA0761D6478BD642F)


def _smallest(grams: np.ndarray, begin: np.ndarray, count: np.ndarray, span: int) -> np.ndarray:
    """Minimum of ``span`` consecutive grams for the first ``count`` positions of every row."""
    low, width = grams, 1
    while 2 * width <= span:
        low = np.minimum(low[:-width] if len(low) > width else low[:0], low[width:])
        width *= 2
    first = np.concatenate(([0], np.cumsum(count)))
    at = np.arange(first[-1]) + np.repeat(begin[:-1] - first[:-1], count)
    return np.minimum(low[at], low[at + span - width])


def _grown(doc, tag, start, ref, ref_start):
    """Factors from matched windows: (doc, tag, start, windows, ref, ref_start) arrays."""
    order = np.lexsort((start, tag, doc))
    doc, tag, start, ref, ref_start = (x[order] for x in (doc, tag, start, ref, ref_start))
    new = np.ones(len(doc), bool)
    new[1:] = ((doc[1:] != doc[:-1]) | (tag[1:] != tag[:-1]) | (start[1:] != start[:-1] + 1)
               | (ref[1:] != ref[:-1]) | (ref_start[1:] != ref_start[:-1] + 1))
    at = np.flatnonzero(new)
    return doc[at], tag[at], start[at], np.diff(np.append(at, len(doc))), ref[at], ref_start[at]


_COLUMNS = ["ids", "tags", "starts", "lengths", "h0", "h1", "h2", "h3", "refs", "ref_starts"]


def _row(bucket, ids, tags, starts, lengths, hashes=None, second=None, refs=None, ref_starts=None):
    hashes = np.empty(0, np.uint64) if hashes is None else hashes
    second = np.empty(0, np.uint32) if second is None else second
    empty = np.empty(0, np.int64)
    return (bucket, ids.astype(np.int64), tags.astype(np.int64), starts.astype(np.int32), lengths.astype(np.int32),
            hashes.astype(np.uint32), (hashes >> np.uint64(32)).astype(np.uint16),
            (hashes >> np.uint64(48)).astype(np.uint8), second,
            (empty if refs is None else refs).astype(np.int64),
            (empty if ref_starts is None else ref_starts).astype(np.int32))


def _batch(rows) -> pa.RecordBatch:
    cols = [pa.array([r[0] for r in rows], pa.int32())]
    cols += [pa.array([r[i].tobytes() for r in rows], pa.binary()) for i in range(1, len(_COLUMNS) + 1)]
    return pa.record_batch(cols, names=["bucket", *_COLUMNS])


def _indexed(docs: DataFrame, window: int) -> DataFrame:
    """Packed runs of windows by reference block, and the factors already found inside a task."""
    n_buckets = partitions(docs.sparkSession)
    deal = even_keys(docs.sparkSession, n_buckets)
    gram = min(GRAM, window)

    def send(batches):
        held, n = [], 0

        def pack():
            ids = np.concatenate([np.array(x[0], np.int64) for x in held])
            tags = np.concatenate([np.array(x[1], np.int64) for x in held])
            rank = np.unique(ids, return_inverse=True)[1]
            shift = np.cumsum([0] + [len(x[0]) for x in held[:-1]])
            row = np.concatenate([x[2] + s for x, s in zip(held, shift)])
            pos = np.concatenate([x[3] for x in held])
            h = np.concatenate([x[4] for x in held])
            g = np.concatenate([x[5] for x in held])
            block = np.concatenate([x[6] for x in held])
            # a window that several documents of the task have is sent once, by the smallest of them
            mine = rank[row]
            order = np.lexsort((pos, mine, g, h))
            new = np.concatenate(([True], (h[order[1:]] != h[order[:-1]]) | (g[order[1:]] != g[order[:-1]])))
            leader = order[np.flatnonzero(new)][np.cumsum(new) - 1]
            later = mine[order] > mine[leader]
            out = []
            if later.any():
                x, y = order[later], leader[later]
                d, t, s, c, r, rs = _grown(ids[row[x]], tags[row[x]], pos[x], ids[row[y]], pos[y])
                out.append(_row(int(deal[int(arrays.mix(h[:1])[0] % np.uint64(n_buckets))]), d, t, s, c, None, None, r, rs))
            sent = np.ones(len(h), bool)
            sent[order[later]] = False
            row, pos, h, g, block = row[sent], pos[sent], h[sent], g[sent], block[sent]
            order = np.argsort(block, kind="stable")
            row, pos, h, g = row[order], pos[order], h[order], g[order]
            for b, i, j in parts(block[order], n_buckets):
                new = np.ones(j - i, bool)
                new[1:] = (row[i + 1:j] != row[i:j - 1]) | (pos[i + 1:j] != pos[i:j - 1] + 1)
                at = np.flatnonzero(new)
                out.append(_row(int(deal[b]), ids[row[i:j][at]], tags[row[i:j][at]], pos[i:j][at],
                                np.diff(np.append(at, j - i)), h[i:j], g[i:j]))
            return _batch(out)

        for batch in batches:
            data, offsets = arrays.buffers(batch.column("text"))
            for i, j in arrays.slices(offsets):
                words = arrays.Words(data, offsets, i, j)
                hashes = words.hashes()
                h, begin = arrays.ngrams(hashes, words.row, window)
                if not len(h):
                    continue
                second = arrays.ngrams(arrays.mix(hashes + _SECOND), words.row, window)[0].astype(np.uint32)
                grams, first = arrays.ngrams(hashes, words.row, gram)
                count = np.diff(begin)
                low = _smallest(grams, first, count, window - gram + 1)
                block = (low % np.uint64(n_buckets)).astype(np.uint16 if n_buckets <= 1 << 16 else np.uint32)
                row = np.repeat(np.arange(j - i), count)
                pos = (np.arange(len(h)) - np.repeat(begin[:-1], count)).astype(np.int32)
                held.append((batch.column("id").slice(i, j - i).to_pylist(),
                             batch.column("tag").slice(i, j - i).to_pylist(), row, pos, h, second, block))
                n += len(h)
                if n >= FLUSH:
                    yield pack()
                    held, n = [], 0
        if n:
            yield pack()

    return docs.mapInArrow(send, "bucket int, " + ", ".join(f"{c} binary" for c in _COLUMNS))


def _fragments(indexed: DataFrame, window: int) -> DataFrame:
    """(id, tag, start, n_words, ref_id, ref_start): what every block has found of the factors."""
    types = dict(zip(_COLUMNS, (np.int64, np.int64, np.int32, np.int32, *_HASH_BYTES, np.int64, np.int32)))

    def result(d, t, s, c, r, rs):
        return pa.record_batch({
            "id": pa.array(d), "tag": pa.array(t), "start": pa.array(s.astype(np.int32)),
            "n_words": pa.array((c + window - 1).astype(np.int32)), "ref_id": pa.array(r),
            "ref_start": pa.array(rs.astype(np.int32))})

    def parse(batches):
        for _, rows in by_bucket(batches):
            found = {c: np.concatenate([np.frombuffer(r[c], t) for r in rows if r["refs"]] or [np.empty(0, t)])
                     for c, t in types.items()}
            if len(found["ids"]):  # a task's own factors pass through
                yield result(*(found[c] for c in ("ids", "tags", "starts", "lengths", "refs", "ref_starts")))
            col = {c: np.concatenate([np.frombuffer(r[c], t) for r in rows if not r["refs"]] or [np.empty(0, t)])
                   for c, t in types.items()}
            length = col["lengths"]
            h = (col["h0"].astype(np.uint64) | col["h1"].astype(np.uint64) << np.uint64(32)
                 | col["h2"].astype(np.uint64) << np.uint64(48))
            if not len(h):
                continue
            run = np.repeat(np.arange(len(length)), length)
            first = np.concatenate(([0], np.cumsum(length)[:-1]))
            pos = col["starts"][run] + (np.arange(len(h)) - first[run]).astype(np.int32)
            g = col["h3"]
            order = np.lexsort((g, h))
            same = (h[order[1:]] == h[order[:-1]]) & (g[order[1:]] == g[order[:-1]])
            shared = np.zeros(len(h), bool)
            shared[1:] |= same
            shared[:-1] |= same
            order = order[shared]
            if not len(order):
                continue
            doc = col["ids"][run[order]]
            order = order[np.lexsort((pos[order], doc, g[order], h[order]))]
            doc, key, check = col["ids"][run[order]], h[order], g[order]
            new = np.concatenate(([True], (key[1:] != key[:-1]) | (check[1:] != check[:-1])))
            leader = np.flatnonzero(new)[np.cumsum(new) - 1]
            later = np.flatnonzero(doc > doc[leader])
            if len(later):
                x, y = order[later], order[leader[later]]
                yield result(*_grown(col["ids"][run[x]], col["tags"][run[x]], pos[x], col["ids"][run[y]], pos[y]))

    return dealt(indexed).mapInArrow(
        parse, "id bigint, tag bigint, start int, n_words int, ref_id bigint, ref_start int")


def _maximal(found: DataFrame) -> DataFrame:
    """Factors from fragments: those of one document that touch or overlap, with references in step, are one."""
    end, shift = F.col("start") + F.col("n_words"), F.col("start") - F.col("ref_start")
    line = Window.partitionBy("id", "tag", "ref_id", "shift").orderBy("start", "end")
    before = F.max("end").over(line.rowsBetween(Window.unboundedPreceding, -1))
    return (found.repartition("id", "tag").withColumn("end", end).withColumn("shift", shift)
            .withColumn("new", F.coalesce(F.col("start") > before, F.lit(True)).cast("int"))
            .withColumn("factor", F.sum("new").over(line.rowsBetween(Window.unboundedPreceding, 0)))
            .groupBy("id", "tag", "ref_id", "shift", "factor")
            .agg(F.min("start").alias("start"), F.max("end").alias("end"))
            .select("id", "tag", "start", (F.col("end") - F.col("start")).alias("n_words"), "ref_id",
                    (F.col("start") - F.col("shift")).alias("ref_start")))


def _tagged(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = docs[f"`{text_col}`"]
    return docs.select(docs[f"`{id_col}`"].cast("bigint").alias("id"), F.xxhash64(text).alias("tag"),
                       text.alias("text"))


def factors(docs: DataFrame, window: int = 50, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The duplicate spans: (doc_id, tag, start, n_words, ref_id, ref_start) in words.

    A factor says that ``n_words`` words (``window`` or more) from word ``start``
    of a document also stand from word ``ref_start`` of the document ``ref_id``,
    whose id is smaller.  ``tag`` is the hash of the row's text, which tells rows
    with a repeated id apart.  A passage that a document has in step with one reference
    is one factor, whatever blocks indexed it.
    """
    rows = _tagged(docs, id_col, text_col).where("id IS NOT NULL AND text IS NOT NULL")
    return _maximal(_fragments(_indexed(rows, window), window)).withColumnRenamed("id", "doc_id")


def drop_repeated_passages(docs: DataFrame, window: int = 50, id_col: str = "doc_id",
                           text_col: str = "text") -> DataFrame:
    """Remove every word that a ``window``-word passage of a document with a smaller id covers.

    Words are runs without white space, unchanged; a window is ``window``
    consecutive words of one document.  Windows are judged on the input, not on
    what is left.  Returns the columns of ``docs`` with the kept words joined by
    one space as text, and ``n_words`` and ``n_removed`` (bigint); columns of
    ``docs`` with these names are replaced.

    * null or empty text, or fewer than ``window`` words: nothing is removed; a
      null text stays null with 0 words
    * null id: the row is neither a reference nor shortened
    * rows that repeat an id are judged each by itself and never against each other
    * of equal documents the one with the smallest id stays whole
    * empty table: empty result
    """
    spans, tag, result = (free_name(docs, x) for x in ("_spans", "_tag", "_kept"))
    ident, text = docs[f"`{id_col}`"], docs[f"`{text_col}`"]
    found = (factors(docs, window, id_col, text_col).groupBy("doc_id", "tag")
             .agg(F.collect_list(F.struct("start", "n_words")).alias(spans))
             .withColumnRenamed("doc_id", result).withColumnRenamed("tag", tag))
    joined = docs.join(found, (ident.cast("bigint") == found[result]) & (F.xxhash64(text) == found[tag]), "left")

    @F.arrow_udf("struct<text:string, n_words:bigint, n_removed:bigint>")
    def cut(texts: pa.Array, cuts: pa.Array) -> pa.Array:
        data, offsets = arrays.buffers(texts)
        where, missing = cuts.to_pylist(), texts.is_null().to_pylist()
        out, total, removed = [], [], []
        for i, j in arrays.slices(offsets):
            words = arrays.Words(data, offsets, i, j)
            raw = words.data.tobytes()
            for r in range(j - i):
                a, b = words.row[r], words.row[r + 1]
                gone = np.zeros(b - a + 1, np.int32)
                for s in where[i + r] or ():
                    gone[s["start"]] += 1
                    gone[s["start"] + s["n_words"]] -= 1
                keep = np.flatnonzero(np.cumsum(gone[:-1]) == 0) + a
                kept = b" ".join([raw[x:y] for x, y in zip(words.start[keep].tolist(), words.end[keep].tolist())])
                out.append(None if missing[i + r] else kept.decode("utf-8", "replace"))
                total.append(int(b - a))
                removed.append(int(b - a) - len(keep))
        return pa.StructArray.from_arrays(
            [pa.array(out, pa.string()), pa.array(total, pa.int64()), pa.array(removed, pa.int64())],
            names=["text", "n_words", "n_removed"])

    new = ["n_words", "n_removed"]
    order = [c for c in docs.columns if c.lower() not in new]
    done = joined.select(*without(docs, new), cut(text, F.col(spans)).alias(result))
    return done.select(*[F.col(f"{result}.text").alias(c) if c == text_col else F.col(f"`{c}`") for c in order],
                       *[F.col(f"{result}.{c}") for c in new])
