"""SentencePiece encoding and decoding over a lattice of pieces.

A word's lattice has an edge for each of its bounded-length substrings that is a
piece.  The edges come from an equi-join of the substrings with the piece table
and are grouped by word; folding a word's edges gives its segmentation.  How
they are folded follows the model: the best path (Viterbi) for a unigram model,
the model's own merges, best score first, for a BPE model, where the sum of
scores means nothing.

``viterbi_words`` is that plan in Spark, for a table of words.  Whole documents
(``encode_documents``) build the same lattice inside their task, for the
distinct words of a slice of texts at once, because sending every word of every
document to a word table and back costs several times the corpus in shuffles
(figures in the README).
"""

from __future__ import annotations

import hashlib
import heapq
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ledgerlens.llm import arrays
from ledgerlens.llm.frames import free_name, without

#: Where the public vocabulary files lie; always a parameter.
MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
#: Words of up to this many characters are folded together; longer ones one by one.
SHORT_WORD = 24
#: Words whose pieces a task remembers.
CACHED_WORDS = 400_000


@dataclass
class PieceTable:
    """A model's pieces: text, score, and which of them stand for single bytes."""

    text: list[str]
    score: list[float]
    bytes_: list[int]  # id of every byte's piece
    special: frozenset[int]
    unknown: int

    def __post_init__(self):
        self.byte_of = {i: b for b, i in enumerate(self.bytes_) if i >= 0}
        self.usable = {t: i for i, t in enumerate(self.text) if i not in self.special and i not in self.byte_of}
        self.longest = max(map(len, self.usable), default=1)
        inside = {c for t in self.usable if len(t) > 1 for c in t}
        #: ASCII bytes that stand in no longer piece: nothing merges across them
        self.lone = np.array([chr(b) not in inside and b != 32 for b in range(128)] + [False] * 128)
        texts = list(self.usable)
        h = np.array([_text_hash(t) for t in texts], np.uint64)
        order = np.argsort(h)
        if len(np.unique(h)) != len(h):
            raise ValueError("two pieces have the same hash")
        self.hashes, self.ids = h[order], np.array([self.usable[t] for t in texts], np.int32)[order]
        self.scores = np.array([self.score[self.usable[t]] for t in texts], np.float32)[order]
        surface = [bytes([self.byte_of[i]]) if i in self.byte_of else b"" if i in self.special
                   else t.replace(SPACE, " ").encode() for i, t in enumerate(self.text)]
        self.surface = np.frombuffer(b"".join(surface), np.uint8)
        self.surface_at = np.concatenate(([0], np.cumsum([len(s) for s in surface])))


def load_pieces(path: str = MODEL) -> PieceTable:
    """Read a model's piece table; its size is fixed by the model."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = range(model.get_piece_size())
    by_byte = [-1] * 256
    for i in ids:
        if model.is_byte(i):
            by_byte[int(model.id_to_piece(i)[1:-1], 16)] = i
    return PieceTable([model.id_to_piece(i) for i in ids], [model.get_score(i) for i in ids], by_byte,
                      frozenset(i for i in ids if model.is_control(i) or model.is_unknown(i) or model.is_unused(i)),
                      model.unk_id())


_MULTIPLIER = 0x9E3779B97F4A7C15


def _text_hash(text: str) -> int:
    h = 0
    for c in text:
        h = (h * _MULTIPLIER + int(_CODES(np.array([ord(c)]))[0])) & 0xFFFFFFFFFFFFFFFF
    return h


def _CODES(code_points: np.ndarray) -> np.ndarray:
    return arrays.mix(code_points.astype(np.uint64) + np.uint64(0x1F123BB5))


def _edges(chars: np.ndarray, table: PieceTable) -> tuple[np.ndarray, np.ndarray]:
    """Lattices of words of one length: id and score of the piece from i to j as [word, i, j]."""
    m, n = chars.shape
    ident = np.full((m, n, n + 1), -1, np.int32)
    score = np.full((m, n, n + 1), -np.inf, np.float32)
    codes = _CODES(chars)
    h = np.zeros((m, n), np.uint64)
    for size in range(1, min(n, table.longest) + 1):
        # hashes of all substrings of this size, each from the one shorter by a character
        h = h[:, :n - size + 1] * np.uint64(_MULTIPLIER) + codes[:, size - 1:]
        at = np.minimum(np.searchsorted(table.hashes, h), len(table.hashes) - 1)
        word, i = np.nonzero(table.hashes[at] == h)
        found = at[word, i]
        ident[word, i, i + size] = table.ids[found]
        score[word, i, i + size] = table.scores[found]
    return ident, score


def _merge(score: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Fold lattices of one length by merges: (end of the segment at every start, whether a segment starts there)."""
    m, n = score.shape[:2]
    end = np.tile(np.arange(1, n + 1), (m, 1))
    alive = np.ones((m, n), bool)
    active = np.arange(m)
    starts = np.arange(n)
    while len(active):
        e = end[active]
        last = e >= n
        far = np.where(last, n, np.take_along_axis(e, np.minimum(e, n - 1), 1))
        gain = np.where(last | ~alive[active], -np.inf, score[active[:, None], starts, far])
        best = gain.argmax(1)  # the leftmost of equal scores
        able = gain[np.arange(len(active)), best] > -np.inf
        active, best, e, far = active[able], best[able], e[able], far[able]
        rows = np.arange(len(active))
        alive[active, e[rows, best]] = False
        end[active, best] = far[rows, best]
    return end, alive


def _merge_long(text: str, table: PieceTable) -> list[str]:
    """The same merges for one long word, by a heap."""
    n = len(text)
    end, start_of, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
    heap: list[tuple[float, int, int, int]] = []

    def push(i: int) -> None:
        j = end[i]
        if j < n and end[j] - i <= table.longest:
            piece = table.usable.get(text[i:end[j]])
            if piece is not None:
                heapq.heappush(heap, (-table.score[piece], i, j, end[j]))

    for i in range(n):
        push(i)
    while heap:
        _, i, j, k = heapq.heappop(heap)
        if not (alive[i] and j < n and alive[j] and end[i] == j and end[j] == k):
            continue
        alive[j], end[i] = False, k
        if k < n:
            start_of[k] = i
        push(i)
        if start_of[i] >= 0:
            push(start_of[i])
    return [text[i:end[i]] for i in range(n) if alive[i]]


def _ids_of(segment: str, ident: int, table: PieceTable) -> list[int]:
    if ident >= 0:
        return [ident]
    if len(segment) == 1 and table.bytes_[0] >= 0:
        return [table.bytes_[b] for b in segment.replace(SPACE, " ").encode()]
    return [table.unknown]


def merge_words(words: list[str], table: PieceTable) -> list[list[int]]:
    """Piece ids of every word (spaces written as ``SPACE``) by the model's merges."""
    out: list[list[int]] = [[] for _ in words]
    by_length: dict[int, list[int]] = {}
    for i, w in enumerate(words):
        by_length.setdefault(len(w) if len(w) <= SHORT_WORD else -1, []).append(i)
    for n, members in by_length.items():
        if n == 0:
            continue
        if n < 0:
            for i in members:
                segments = _merge_long(words[i], table)
                out[i] = [x for s in segments for x in _ids_of(s, table.usable.get(s, -1), table)]
            continue
        step = max(1, 2_000_000 // (n * (n + 1)))
        for lo in range(0, len(members), step):
            part = members[lo:lo + step]
            text = "".join([words[i] for i in part])
            chars = np.frombuffer(text.encode("utf-32-le"), np.uint32).reshape(len(part), n)
            ident, score = _edges(chars, table)
            end, alive = _merge(score)
            row, start = np.nonzero(alive)
            found = ident[row, start, end[row, start]]
            odd = np.zeros(len(part), bool)
            odd[row[found < 0]] = True
            cut = np.searchsorted(row, np.arange(len(part) + 1))
            ids = found.tolist()
            for k, i in enumerate(part):
                mine = ids[cut[k]:cut[k + 1]]
                if odd[k]:
                    mine = [x for a, f in zip(range(cut[k], cut[k + 1]), mine)
                            for x in _ids_of(words[i][start[a]:end[k, start[a]]], f, table)]
                out[i] = mine
    return out


class Encoder:
    """Encodes columns of texts; remembers the pieces of up to CACHED_WORDS words."""

    def __init__(self, table: PieceTable):
        self.table = table
        self.known: dict[bytes, np.ndarray] = {}

    def _words(self, raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where words start and how many each row has.  A word is a run of spaces with what
        follows it up to the next space; a lone byte is a word of its own."""
        n = len(raw)
        space, lone = raw == 32, self.table.lone[raw]
        start = np.zeros(n, bool)
        start[0] = True
        start[1:] = (space[1:] & ~space[:-1]) | lone[1:] | lone[:-1]
        start[off[:-1][off[:-1] < n]] = True
        at = np.flatnonzero(start)
        return at, np.searchsorted(at, off)

    def encode(self, col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Piece ids of all texts after each other, and the offsets (n + 1) of every text's ids."""
        texts = ["" if not t else " " + t.replace(SPACE, " ") for t in col.to_pylist()]
        data, offsets = arrays.buffers(pa.array(texts, pa.large_string()))
        flat, sizes = [np.empty(0, np.int32)], []
        for i, j in arrays.slices(offsets):
            raw, off = data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]
            if not len(raw):
                sizes.append(np.zeros(j - i, np.int64))
                continue
            at, row = self._words(raw, off)
            end = np.append(at[1:], len(raw))
            sums = arrays._sums(arrays._CODE[raw])
            _, first, which = np.unique(arrays._runs(sums, at, end), return_index=True, return_inverse=True)
            body = raw.tobytes()
            words = [body[a:b] for a, b in zip(at[first].tolist(), end[first].tolist())]
            new = [w for w in words if w not in self.known]
            if len(self.known) + len(new) > CACHED_WORDS:
                self.known = {}
                new = words
            for w, ids in zip(new, merge_words([w.decode().replace(" ", SPACE) for w in new], self.table)):
                self.known[w] = np.array(ids, np.int32)
            pieces = [self.known[w] for w in words]
            size = np.array([len(p) for p in pieces])
            begin = np.concatenate(([0], np.cumsum(size)[:-1]))
            pool = np.concatenate(pieces)
            count = size[which]
            upto = np.concatenate(([0], np.cumsum(count)))
            flat.append(pool[np.arange(upto[-1]) + np.repeat(begin[which] - upto[:-1], count)])
            sizes.append(np.diff(upto[row]))
        sizes = np.concatenate(sizes) if sizes else np.empty(0, np.int64)
        return np.concatenate(flat), np.concatenate(([0], np.cumsum(sizes)))


def decode(ids: np.ndarray, offsets: np.ndarray, table: PieceTable) -> list[bytes]:
    """The texts of rows of piece ids: pieces after each other, without the first space."""
    size = np.diff(table.surface_at)[ids]
    out = []
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        n = size[a:b]
        upto = np.concatenate(([0], np.cumsum(n)))
        text = table.surface[np.arange(upto[-1]) + np.repeat(table.surface_at[ids[a:b]] - upto[:-1], n)].tobytes()
        out.append(text[1:] if text[:1] == b" " else text)
    return out


def _normal(text: str | None) -> bytes:
    """What encoding keeps of a text: everything, with the space sign as a space."""
    return (text or "").replace(SPACE, " ").encode()


def encode_documents(docs: DataFrame, model: str = MODEL, text_col: str = "text") -> DataFrame:
    """Add ``ids``, the model's piece ids of every whole text (array of int).

    One map over the rows; a text's ids equal the model's own encoding.

    * null text: null; empty text: no ids
    * characters without a piece become their bytes' pieces (or the unknown id in
      a model without byte pieces)
    * a space sign (U+2581) in a text is a space
    * repeated rows: each by itself; empty table: empty result; a column ``ids`` is replaced
    """
    table = docs.sparkSession.sparkContext.broadcast(load_pieces(model))
    state: dict[str, Encoder] = {}

    @F.arrow_udf("array<int>")
    def encode(col: pa.Array) -> pa.Array:
        if "encoder" not in state:
            state["encoder"] = Encoder(table.value)
        ids, offsets = state["encoder"].encode(col)
        return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids), mask=col.is_null())

    name = free_name(docs, "_ids")
    out = docs.withColumn(name, encode(docs[f"`{text_col}`"]))
    return out.select(*without(out.drop(name), ["ids"]), F.col(name).alias("ids"))


def decode_documents(docs: DataFrame, model: str = MODEL, ids_col: str = "ids") -> DataFrame:
    """Add ``decoded``, the text of the piece ids; null ids give null, no ids the empty text."""
    table = docs.sparkSession.sparkContext.broadcast(load_pieces(model))

    @F.arrow_udf("string")
    def text(col: pa.Array) -> pa.Array:
        out = []
        for row in col.to_pylist():
            ids = np.array(row or [], np.int64)
            out.append(None if row is None else decode(ids, np.array([0, len(ids)]), table.value)[0].decode("utf-8", "replace"))
        return pa.array(out, pa.string())

    name = free_name(docs, "_decoded")
    out = docs.withColumn(name, text(docs[f"`{ids_col}`"]))
    return out.select(*without(out.drop(name), ["decoded"]), F.col(name).alias("decoded"))


def round_trip(docs: DataFrame, model: str = MODEL, text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """Encode and decode every whole text: ``n_pieces``, ``ids_sha256`` (of the ids as little-endian
    32-bit numbers), ``round_trip``, whether the decoded ids give the text back, and with
    ``with_ids`` the ``ids`` themselves.  Null counts as empty; clashing columns are replaced."""
    table = docs.sparkSession.sparkContext.broadcast(load_pieces(model))
    state: dict[str, Encoder] = {}

    kinds = {"n_pieces": "bigint", "ids_sha256": "string", "round_trip": "boolean"}
    kinds |= {"ids": "array<int>"} if with_ids else {}

    @F.arrow_udf("struct<" + ", ".join(f"{k}:{v}" for k, v in kinds.items()) + ">")
    def check(col: pa.Array) -> pa.Array:
        if "encoder" not in state:
            state["encoder"] = Encoder(table.value)
        n, digest, same, every = [], [], [], [np.empty(0, np.int32)]
        texts = col.to_pylist()
        lo = 0
        while lo < len(texts):  # some texts at a time, so that ids and text of all need not be held
            hi, size = lo, 0
            while hi < len(texts) and (hi == lo or size < arrays.SLICE_BYTES):
                size += len(texts[hi] or "")
                hi += 1
            ids, offsets = state["encoder"].encode(col.slice(lo, hi - lo))
            ids = ids.astype("<i4")
            if with_ids:
                every.append(ids)
            for t, a, b, back in zip(texts[lo:hi], offsets[:-1].tolist(), offsets[1:].tolist(),
                                     decode(ids, offsets, table.value)):
                n.append(b - a)
                digest.append(hashlib.sha256(ids[a:b].tobytes()).hexdigest())
                same.append(back == _normal(t))
            lo = hi
        cols = [pa.array(n, pa.int64()), pa.array(digest, pa.string()), pa.array(same, pa.bool_())]
        if with_ids:
            upto = np.concatenate(([0], np.cumsum(n))).astype(np.int32)
            cols.append(pa.ListArray.from_arrays(pa.array(upto), pa.array(np.concatenate(every))))
        return pa.StructArray.from_arrays(cols, names=list(kinds))

    new = list(kinds)
    name = free_name(docs, "_check")
    out = docs.withColumn(name, check(docs[f"`{text_col}`"]))
    return out.select(*without(out.drop(name), new), *[F.col(f"{name}.{c}") for c in new])


def piece_frame(spark: SparkSession, model: str = MODEL) -> DataFrame:
    """The piece table as (piece, id, score), without control and byte pieces."""
    table = load_pieces(model)
    return spark.createDataFrame([(t, i, float(table.score[i])) for t, i in table.usable.items()],
                                 "piece string, id int, score double")


def viterbi_words(words: DataFrame, pieces: DataFrame, longest: int = 16, word_col: str = "word") -> DataFrame:
    """Best paths of a unigram model: (word, ids, score) for the distinct words of a table.

    Substrings of up to ``longest`` characters are exploded, equi-joined with the
    piece table (whose size the model fixes, so it is broadcast) and grouped by
    word; words are dealt once, by themselves, and stay where they are.  The fold
    over end positions keeps the best path to every position; of equal scores the
    one with the longer last piece wins.

    * null words are left out; the empty word has no ids and score 0
    * a word that pieces cannot cover has null ids and score
    * repeated words give one row; an empty table gives an empty result
    """
    w = F.col("word")
    distinct = words.select(words[f"`{word_col}`"].alias("word")).where(w.isNotNull()).distinct()
    spots = distinct.select("word", F.explode_outer(F.when(F.length(w) > 0, F.sequence(F.lit(1), F.length(w)))).alias("a"))
    cuts = spots.select("word", "a", F.explode_outer(F.when(w != "", F.sequence(
        F.lit(1), F.least(F.lit(longest), F.length(w) - F.col("a") + 1)))).alias("n"))
    edges = cuts.select("word", "a", "n", F.substring(w, F.col("a"), F.col("n")).alias("piece")).join(
        F.broadcast(pieces), "piece", "left")
    grouped = edges.groupBy("word").agg(F.collect_list(F.when(F.col("id").isNotNull(), F.struct(
        (F.col("a") + F.col("n") - 1).alias("end"), F.col("n"), "id", "score"))).alias("edges"))
    path = "struct<score:double,n:int,ids:array<int>>"
    zero = F.array(F.struct(F.lit(0.0).alias("score"), F.lit(0).alias("n"), F.array().cast("array<int>").alias("ids"))
                   .cast(path)).cast(f"array<{path}>")

    def step(best: Column, end: Column) -> Column:
        def via(e: Column) -> Column:
            left = F.get(best, end - e["n"])
            return F.when(left["ids"].isNotNull(), F.struct(
                (left["score"] + e["score"]).alias("score"), e["n"].alias("n"),
                F.concat(left["ids"], F.array(e["id"])).alias("ids")).cast(path))

        ways = F.transform(F.filter("edges", lambda e: e["end"] == end), via)
        none = F.lit(None).cast(path)
        return F.concat(best, F.array(F.coalesce(F.array_max(ways), none))).cast(f"array<{path}>")

    last = F.element_at(F.aggregate(F.when(w == "", F.array().cast("array<int>")).otherwise(
        F.sequence(F.lit(1), F.length(w))), zero, step), -1)
    return grouped.withColumn("last", last).select("word", F.col("last.ids").alias("ids"), F.col("last.score").alias("score"))
