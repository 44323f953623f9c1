"""Token ids as binary files: canonical length-limited Huffman coding from the corpus's own counts.

1. ``tokenize``: the ids of every whole text (a public tokenizer's file; words are looked up in a
   table that a worker fills as it meets them, so the library encodes a word once for each worker).
2. ``fit_code``: counts of all ids, added up in the tasks and once for each id; the code lengths
   come from the package-merge algorithm, the codes are canonical (by length, then id), so a
   table of lengths is the whole code.
3. ``write_ids``: each document is coded on its own, then only coded bytes are shuffled, by ranges
   of the document id; a shard's documents are laid into segments one after another.
4. ``read_ids``: a segment's blocks of ``BLOCK_IDS`` ids start at stored bit offsets and are
   decoded independently, all blocks of a segment step by step with one table lookup an id.
"""

from __future__ import annotations

import json
import re
import string
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ledgerlens.llm import arrays
from ledgerlens.llm.frames import staged

#: Ids from one checkpoint to the next.
BLOCK_IDS = 1024
#: Ids after which a segment ends (with the document that reaches them).
SEGMENT_IDS = 1 << 20
#: Longest code, unless more distinct ids need a longer one; the decoding table has 2 ** MAX_BITS rows.
MAX_BITS = 18
#: Words that a worker's table holds before it is emptied.
TABLE_WORDS = 1_400_000
#: Ids of one pass of the coder.
SLICE_IDS = 1 << 20

_MAGIC = b"HUFI"
_HEAD = struct.Struct("<4sIIIQ")


def _default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


# -- ids of texts

class WordTable:
    """Numbers of words of up to 23 bytes: open addressing over their own bytes, many words at a time.

    A word's key is its bytes in three numbers with its length on top, so equal keys are equal words."""

    LONGEST = 23
    _LOW = [np.array([(1 << 8 * min(max(n - at, 0), 8)) - 1 for n in range(24)], np.uint64) for at in (0, 8, 16)]

    def __init__(self, bits: int = 21):
        self.mask = np.uint64((1 << bits) - 1)
        self.keys = [np.zeros(1 << bits, np.uint64) for _ in range(3)]
        self.number = np.full(1 << bits, -1, np.int32)

    @classmethod
    def key(cls, data: np.ndarray, start: np.ndarray, size: np.ndarray) -> list[np.ndarray]:
        """Keys of the words ``data[start:start + size]``; 24 more bytes must follow the last start."""
        eight = np.ndarray(len(data) - 7, "<u8", data, strides=(1,))  # the 8 bytes from every byte on
        out = [eight[start + at] & low[size] for at, low in zip((0, 8, 16), cls._LOW)]
        out[2] |= size.astype(np.uint64) << np.uint64(56)
        return out

    @staticmethod
    def scattered(key: list[np.ndarray]) -> np.ndarray:
        h = key[0] * np.uint64(0x9E3779B97F4A7C15) + key[1] * np.uint64(0xC2B2AE3D27D4EB4F) + key[2] * np.uint64(0x165667B19E3779F9)
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        return h ^ h >> np.uint64(32)

    def find(self, key: list[np.ndarray], h: np.ndarray) -> np.ndarray:
        """Numbers of the words, -1 where the table does not hold one."""
        out = np.full(len(h), -1, np.int32)
        todo, slot = np.arange(len(h)), h & self.mask
        while len(todo):
            there = self.number[slot]
            same = there >= 0
            goes_on = same.copy()
            for held, own in zip(self.keys, key):
                same &= held[slot] == own[todo]
            out[todo[same]] = there[same]
            goes_on &= ~same  # another word lies here; an empty place ends the search
            todo, slot = todo[goes_on], slot[goes_on] + np.uint64(1) & self.mask
        return out

    def add(self, key: list[np.ndarray], h: np.ndarray, number: np.ndarray) -> None:
        todo, slot = np.arange(len(h)), h & self.mask
        while len(todo):
            free = self.number[slot] < 0
            self.number[slot[free]] = number[todo[free]]  # of several words for one place the last gets it
            placed = free & (self.number[slot] == number[todo])
            for held, own in zip(self.keys, key):
                held[slot[placed]] = own[todo[placed]]
            todo, slot = todo[~placed], slot[~placed] + np.uint64(1) & self.mask


_KIND = np.zeros(256, np.uint8)  # 1 white space, 2 plain letters and digits, 4 marks that end a word (all but ')
_KIND[[9, 10, 11, 12, 13, 32]] = 1
_KIND[[*range(48, 58), *range(65, 91), *range(97, 123)]] = 2
_KIND[[ord(c) for c in string.punctuation if c != "'"]] = 4
# The second bytes of the letters that begin with 0xC3.
_LETTER = np.zeros(256, bool)
_LETTER[[b for b in range(0x80, 0xC0) if b not in (0x97, 0xB7)]] = True
# Words that the byte-level pre-tokenizer leaves whole: plain letters and those of 0xC3, or digits.
_ONE_PIECE = re.compile(rb" ?(?:(?:[A-Za-z]|\xC3[\x80-\x96\x98-\xB6\xB8-\xBF])+|[0-9]+)")
# How a byte-level file writes the 256 bytes.
_PRINTED = [*range(33, 127), *range(161, 173), *range(174, 256)]
_WRITTEN = dict(zip(_PRINTED + [b for b in range(256) if b not in _PRINTED], _PRINTED + [*range(256, 324)]))
# First bytes of white space beyond ASCII, and all of it in UTF-8.
_WIDE = [c.encode() for c in "\x85\xa0\u1680\u2028\u2029\u202f\u205f\u3000"] + [chr(c).encode() for c in range(0x2000, 0x200B)]
_WIDE_FIRST = np.zeros(256, bool)
_WIDE_FIRST[[w[0] for w in _WIDE]] = True
_WIDE_SECOND = np.zeros((256, 256), bool)
_WIDE_SECOND[[w[0] for w in _WIDE], [w[1] for w in _WIDE]] = True


def word_starts(data: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """Where the words of texts begin (``data[begin[i]:begin[i + 1]]``), ASCII white space only.

    A text's ids are its words' ids one after another.  White space is cut before the last
    character of a run that a word follows, and a single space goes with the word after it, as
    the byte-level pre-tokenizer cuts; marks are cut from the plain letter or digit, or the letter that
    begins with 0xC3, before them."""
    n = len(data)
    kind = np.concatenate(([0], _KIND[data], [0])).astype(np.uint8)
    before, here, after = kind[:-2], kind[1:-1], kind[2:]
    space = np.concatenate(([0], data)) == 32
    ends = np.zeros(n + 1, bool)
    ends[begin[1:]] = True  # a run at the end of a text stays whole
    gap = here == 1
    cut = (gap & ((before != 1) | ((after != 1) & ~ends[1:])))
    cut |= ~gap & (before == 1) & ~space[:-1]
    cut |= (here == 4) & (before == 2)
    cut[2:] |= (here[2:] == 4) & _LETTER[data[1:-1]] & (data[:-2] == 0xC3)
    first = begin[:-1][begin[:-1] < begin[1:]]
    cut[first] = True
    return np.flatnonzero(cut)


class WordEncoder:
    """Ids of texts by a byte-level tokenizer file, word by word: the library encodes a word once."""

    def __init__(self, path: str, special: bool = False):
        from tokenizers import Tokenizer, pre_tokenizers

        try:
            self.tokenizer = Tokenizer.from_file(path)
        except Exception as e:  # the library raises a bare Exception
            raise FileNotFoundError(f"no tokenizer file at {path}: {e}") from None
        self.tokenizer.encode_special_tokens = not special
        # strings that the file treats as one id are cut out of the text before any word
        marks = [] if not special else [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.marks = re.compile(b"|".join(re.escape(m.encode()) for m in marks)) if marks else None
        made = json.loads(self.tokenizer.to_str())
        cut = made["pre_tokenizer"] or {}
        # only such a file's ids are those of its words one after another
        self.by_word = (made["normalizer"] is None and cut.get("type") == "ByteLevel" and not cut["add_prefix_space"]
                        and cut.get("use_regex", True))
        self.line_end = self.tokenizer.encode("\n", add_special_tokens=False).ids[0] if self.by_word else None
        if self.by_word:  # the same model, told where words end
            self.pieces = Tokenizer.from_file(path)
            self.pieces.encode_special_tokens = not special
            self.pieces.pre_tokenizer = pre_tokenizers.Split(chr(_WRITTEN[10]), "isolated")
        self.clear()

    def clear(self) -> None:
        self.table, self.long = WordTable(), {}
        self.flat, self.size = np.empty(0, np.uint32), np.empty(0, np.int64)

    def _learn(self, words: list[bytes]) -> list[bytes]:
        """Ids of new words, numbered on.  Words that end in no white space go to the library as
        lines of one text: the line end between them has an id of its own that no word holds.  Of
        these, words of one piece go to its model as the file writes their bytes, uncut.
        Returns the words in the order of their numbers."""
        apart = [w for w in words if _KIND[w[-1]] == 1]
        whole, plain = [], []
        for w in words:
            if not _KIND[w[-1]] == 1:
                (whole if w[w[0] == 32:].isalpha() or _ONE_PIECE.fullmatch(w) else plain).append(w)
        ids, size = [self.flat], [self.size]
        for group, library, read in ((whole, getattr(self, "pieces", None), lambda x: x.decode("latin-1").translate(_WRITTEN)),
                                     (plain, self.tokenizer, bytes.decode)):
            for i in range(0, len(group), 200):
                part = group[i:i + 200]
                found = library.encode_batch_fast([read(b"\n".join(part))], add_special_tokens=False)[0]
                lines = np.array(found.ids, np.uint32)
                is_end = lines == self.line_end
                between = np.flatnonzero(is_end)
                if len(between) != len(part) - 1:
                    raise ValueError("a word that holds the id of a line end")
                ids.append(lines[~is_end])
                size.append(np.diff(np.concatenate(([-1], between, [len(lines)]))) - 1)
        for w in apart:
            own = self.tokenizer.encode(w.decode(), add_special_tokens=False).ids
            ids.append(np.array(own, np.uint32))
            size.append(np.array([len(own)]))
        self.flat, self.size = np.concatenate(ids), np.concatenate(size)
        return whole + plain + apart

    def _numbers(self, data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Number of every word; new ones are learned first."""
        out = np.empty(len(start), np.int64)
        short = size <= WordTable.LONGEST
        key = WordTable.key(data, start[short], size[short])
        h = WordTable.scattered(key)
        number = self.table.find(key, h)
        new = np.flatnonzero(number < 0)
        raw = data.tobytes()
        s, n = start[short], size[short]
        by = new[np.argsort(h[new], kind="stable")]
        differs = np.ones(len(by), bool)
        differs[1:] = np.any([k[by[1:]] != k[by[:-1]] for k in key], axis=0)
        rows = by[differs]  # one place of every new word
        words = [raw[a:a + b] for a, b in zip(s[rows].tolist(), n[rows].tolist())]
        long = [raw[a:a + b] for a, b in zip(start[~short].tolist(), size[~short].tolist())]
        fresh = list(dict.fromkeys(w for w in long if w not in self.long))
        first = len(self.size)
        order = self._learn(words + fresh)
        place = dict(zip(order, range(first, first + len(order))))
        self.long |= {w: place[w] for w in fresh}
        if len(rows):
            mine = np.array([place[w] for w in words], np.int32)
            self.table.add([k[rows] for k in key], h[rows], mine)
            number[by] = mine[np.cumsum(differs) - 1]
        out[short] = number
        out[~short] = [self.long[w] for w in long]
        return out

    def encode(self, column: pa.Array, end_id: int | None) -> Iterator[tuple[int, list[np.ndarray]]]:
        """(first row, ids of every text with ``end_id`` after them), slice by slice; null is empty."""
        end = np.empty(0, np.uint32) if end_id is None else np.array([end_id], np.uint32)
        whole, offsets = arrays.buffers(column)
        for i, j in arrays.slices(offsets):
            if len(self.size) > TABLE_WORDS:
                self.clear()
            begin = offsets[i:j + 1] - offsets[i]
            data = np.concatenate((whole[offsets[i]:offsets[j]], np.zeros(32, np.uint8)))
            texts = data[:begin[-1]]
            alone = self._alone(texts, begin)
            start = word_starts(texts, begin) if self.by_word else np.empty(0, np.int64)
            size = np.diff(np.append(start, len(texts)))
            if alone.any():
                keep = ~alone[np.searchsorted(begin, start, "right") - 1]
                start, size = start[keep], size[keep]
            word = self._numbers(data, start, size)
            n = self.size[word]
            upto = np.concatenate(([0], np.cumsum(n)))
            first = np.concatenate(([0], np.cumsum(self.size)))[word] if len(word) else word
            ids = self.flat[np.repeat(first - upto[:-1], n) + np.arange(upto[-1])]
            row = upto[np.searchsorted(start, begin)]
            out = []
            for r in range(j - i):
                own = ids[row[r]:row[r + 1]]
                if alone[r]:
                    text = texts[begin[r]:begin[r + 1]].tobytes().decode()
                    own = np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)
                out.append(np.concatenate((own, end)))
            yield i, out

    def _alone(self, texts: np.ndarray, begin: np.ndarray) -> np.ndarray:
        """The texts that the library gets whole: with white space beyond ASCII or special strings, or
        all of them, if the file's ids are not those of single words."""
        rows = len(begin) - 1
        if not self.by_word:
            return np.ones(rows, bool)
        out = np.zeros(rows, bool)
        lead = np.flatnonzero(_WIDE_FIRST[texts])
        lead = lead[lead + 1 < len(texts)]
        maybe = lead[_WIDE_SECOND[texts[lead], texts[lead + 1]]]
        three = maybe[texts[maybe] >= 0xE0]
        three = three[three + 2 < len(texts)]
        known = {w for w in _WIDE if len(w) == 3}
        sure = [p for p in three.tolist() if texts[p:p + 3].tobytes() in known]
        at = np.concatenate((maybe[texts[maybe] < 0xE0], np.array(sure, np.int64)))
        out[np.searchsorted(begin, at, "right") - 1] = True
        if self.marks:
            raw = texts.tobytes()
            out[[int(np.searchsorted(begin, m.start(), "right")) - 1 for m in self.marks.finditer(raw)]] = True
        return out


_encoders: dict[tuple, WordEncoder] = {}  # of this worker; a table outlives its task


def tokenize(docs: DataFrame, tokenizer: str | None = None, end_id: int | None = 0, special: bool = True,
             id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids, tally): the ids of every whole text as little-endian unsigned 32-bit numbers, with
    ``end_id`` after each text.  The last row of a task also holds how often each id came up in the
    task (``tally``, null in all other rows), so that the ids need not be read again to be counted.

    ``tokenizer`` is the path of a byte-level tokenizer file on every machine, read once a worker;
    ``special`` says whether the file's special strings in a text become their ids.

    * null or empty text: the end id alone (no ids without one)
    * null id stays null; rows that repeat an id each stay; other columns are not read
    * empty table: empty result
    """
    path = tokenizer or _default_tokenizer()
    rows = docs.select(docs[f"`{id_col}`"].cast("bigint").alias("doc_id"), docs[f"`{text_col}`"].cast("string").alias("text"))

    def rows_of(ident: pa.Array, found: list[np.ndarray], tally: np.ndarray | None = None) -> pa.RecordBatch:
        counts = [None] * len(found)
        if tally is not None:
            counts[-1] = [{"id": int(k), "n": int(tally[k])} for k in np.flatnonzero(tally)]
        kind = pa.list_(pa.struct([("id", pa.int64()), ("n", pa.int64())]))
        return pa.record_batch([ident, pa.array([x.tobytes() for x in found], pa.binary()), pa.array(counts, kind)],
                               names=["doc_id", "ids", "tally"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        key = (path, special)
        if key not in _encoders:
            _encoders[key] = WordEncoder(path, special)
        encoder = _encoders[key]
        total, last = np.zeros(0, np.int64), None
        for batch in batches:
            for first, found in encoder.encode(batch.column("text"), end_id):
                if last is not None:
                    yield rows_of(*last)
                last = batch.column("doc_id").slice(first, len(found)), found
                total = _added(total, np.concatenate(found))
        if last is not None:
            yield rows_of(*last, tally=total)

    return rows.mapInArrow(work, "doc_id bigint, ids binary, tally array<struct<id: bigint, n: bigint>>")


# -- the code

def limited_lengths(counts: np.ndarray, max_bits: int = MAX_BITS) -> np.ndarray:
    """Code lengths of least total size with no code longer than ``max_bits`` (package-merge);
    more symbols than ``max_bits`` can tell apart raise the limit to the least that can."""
    n = len(counts)
    if n <= 1:
        return np.ones(n, np.int64)
    bits = max(max_bits, int(n - 1).bit_length())
    order = np.argsort(counts, kind="stable")
    leaves = counts[order].astype(np.int64)
    level, is_leaf = leaves, [np.ones(n, bool)]
    for _ in range(bits - 1):
        even = len(level) // 2 * 2
        both = np.concatenate((leaves, level[0:even:2] + level[1:even:2]))
        by = np.argsort(both, kind="stable")  # equal weights: single symbols first
        level = both[by]
        is_leaf.append(by < n)
    lengths, take = np.zeros(n, np.int64), 2 * n - 2
    for leaf in reversed(is_leaf):  # the cheapest items of a level: its rarest symbols, and pairs of the level below
        singles = int(np.count_nonzero(leaf[:take]))
        lengths[:singles] += 1
        take = 2 * (take - singles)
    out = np.empty(n, np.int64)
    out[order] = lengths
    return out


class Code:
    """The canonical code of ``ids`` (ascending, distinct) with the given lengths."""

    def __init__(self, ids: np.ndarray, lengths: np.ndarray):
        self.ids, self.lengths = np.asarray(ids, np.int64), np.asarray(lengths, np.int64)
        self.bits = int(self.lengths.max(initial=1))
        order = np.lexsort((self.ids, self.lengths))
        sizes = self.lengths[order]
        # codes count on from each other; written from the top, each takes 2 ** (bits - length) table rows
        rows = np.left_shift(np.int64(1), self.bits - sizes)
        first = np.cumsum(rows) - rows
        self.codes = np.empty(len(order), np.uint64)
        self.codes[order] = (first >> (self.bits - sizes)).astype(np.uint64)
        self.symbol = np.zeros(1 << self.bits, np.uint32)
        self.size = np.ones(1 << self.bits, np.uint8)
        filled = int(rows.sum())
        self.symbol[:filled] = np.repeat(self.ids[order], rows)
        self.size[:filled] = np.repeat(sizes, rows)

    def places(self, ids: np.ndarray) -> np.ndarray:
        where = np.searchsorted(self.ids, ids) if len(self.ids) else np.zeros(len(ids), np.int64)
        if len(ids) and (not len(self.ids) or (self.ids[np.minimum(where, len(self.ids) - 1)] != ids).any()):
            raise ValueError("an id that the code does not know")
        return where


def _added(total: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Counts by id with those of ``ids`` added."""
    own = np.bincount(ids) if len(ids) else total[:0]
    out = np.pad(total, (0, max(0, len(own) - len(total))))
    out[:len(own)] += own
    return out


def fit_code(tokens: DataFrame, max_bits: int = MAX_BITS) -> Code:
    """The code of all ids in ``tokens``, from their tallies where ``tokenize`` has left them.  Tasks add
    their counts up first; what reaches the driver is one row for each distinct id, which the
    vocabulary bounds."""

    def count(batches):
        total = np.zeros(0, np.int64)
        for batch in batches:
            total = _added(total, _ids(batch.column("ids"))[0])
        met = np.flatnonzero(total)
        yield pa.record_batch([pa.array(met.astype(np.int64)), pa.array(total[met])], names=["id", "n"])

    counted = (tokens.where("tally is not null").select(F.inline("tally")) if "tally" in tokens.columns
               else tokens.select("ids").mapInArrow(count, "id bigint, n bigint"))
    rows = (counted.groupBy("id").agg(F.sum("n").alias("n")).toPandas().sort_values("id"))
    ids = rows["id"].to_numpy(np.int64)
    return Code(ids, limited_lengths(rows["n"].to_numpy(np.int64), max_bits))


def _ids(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All ids of a binary column, and where each row's begin (n + 1); null has none."""
    rows = [x or b"" for x in column.to_pylist()]
    begin = np.concatenate(([0], np.cumsum(np.fromiter(map(len, rows), np.int64, len(rows))))) // 4
    return np.frombuffer(b"".join(rows), "<u4"), begin


class Coder:
    """Writes ids as bits, most significant first, each document from a new byte."""

    def __init__(self, code: Code):
        top = int(code.ids[-1]) if len(code.ids) else -1
        self.code, self.dense = code, top < 1 << 22
        if self.dense:  # from an id straight to its code
            self.length = np.zeros(top + 2, np.uint8)
            self.length[code.ids] = code.lengths
            self.bits = np.zeros(top + 2, np.uint32)
            self.bits[code.ids] = code.codes

    def _look_up(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not self.dense:
            at = self.code.places(ids)
            return self.code.lengths[at], self.code.codes[at]
        at = np.minimum(ids, len(self.length) - 1)
        size = self.length[at]
        if len(size) and not size.all():
            raise ValueError("an id that the code does not know")
        return size.astype(np.int64), self.bits[at].astype(np.uint64)

    def encode(self, ids: np.ndarray, begin: np.ndarray) -> tuple[list[bytes], list[bytes]]:
        """Of every document its bytes and its checkpoints: the bit offset of each block but the first."""
        size, code = self._look_up(ids)
        upto = np.concatenate(([0], np.cumsum(size)))
        n_bytes = (upto[begin[1:]] - upto[begin[:-1]] + 7) // 8
        byte = np.concatenate(([0], np.cumsum(n_bytes)))
        n_ids = np.diff(begin)
        at = upto[:-1] + np.repeat(8 * byte[:-1] - upto[begin[:-1]], n_ids)  # first bit of every id
        words = np.zeros(int(byte[-1]) // 8 + 2, np.uint64)
        if len(ids):
            word = at >> 6
            free = 64 - (at & 63) - size  # bits left in the word; negative: the code goes on in the next one
            over = np.flatnonzero(free < 0)
            part = code << np.maximum(free, 0).astype(np.uint64)
            part[over] = code[over] >> (-free[over]).astype(np.uint64)
            first = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))
            words[word[first]] = np.add.reduceat(part, first)  # no two codes share a bit
            words[word[over] + 1] |= code[over] << (64 + free[over]).astype(np.uint64)
        data = words.byteswap().tobytes()
        bits, marks = [], []
        for d in range(len(n_ids)):
            bits.append(data[byte[d]:byte[d + 1]])
            starts = np.arange(begin[d] + BLOCK_IDS, begin[d + 1], BLOCK_IDS)
            marks.append((at[starts] - 8 * byte[d]).astype("<u8").tobytes())
        return bits, marks


def _segment(docs: list[tuple]) -> bytes:
    """Header, document ids (with a byte that says null), ids in each, checkpoints of all blocks,
    coded bytes.  ``docs``: (doc_id, n, bits, marks)."""
    n = np.array([d[1] for d in docs], np.int64)
    start = np.concatenate(([0], np.cumsum([len(d[2]) for d in docs]))).astype(np.uint64) * np.uint64(8)
    points = [np.concatenate((start[k:k + 1], start[k] + np.frombuffer(d[3], "<u8"))) if d[1] else start[:0]
              for k, d in enumerate(docs)]
    blocks = np.concatenate([*points, start[:0]])
    return b"".join([
        _HEAD.pack(_MAGIC, BLOCK_IDS, len(docs), len(blocks), int(n.sum())),
        np.array([d[0] or 0 for d in docs], "<i8").tobytes(), bytes(d[0] is None for d in docs),
        n.astype("<u8").tobytes(), blocks.astype("<u8").tobytes(), *[d[2] for d in docs]])


def read_segment(data: bytes, code: Code) -> Iterator[tuple[int | None, np.ndarray]]:
    """(doc_id, ids) of every document of a segment, in order."""
    magic, per_block, n_docs, n_blocks, total = _HEAD.unpack_from(data)
    if magic != _MAGIC:
        raise ValueError("not a segment of token ids")
    at = _HEAD.size
    ident = np.frombuffer(data, "<i8", n_docs, at)
    null = np.frombuffer(data, np.uint8, n_docs, at + 8 * n_docs)
    n = np.frombuffer(data, "<u8", n_docs, at + 9 * n_docs).astype(np.int64)
    points = np.frombuffer(data, "<u8", n_blocks, at + 17 * n_docs).astype(np.int64)
    payload = np.frombuffer(data, np.uint8, offset=at + 17 * n_docs + 8 * n_blocks)
    each = -(-n // per_block)
    size = np.full(n_blocks, per_block, np.int64)
    last = np.cumsum(each)[each > 0] - 1
    size[last] = (n - (each - 1) * per_block)[each > 0]
    ids = decode_blocks(payload, points, size, code)
    begin = np.concatenate(([0], np.cumsum(n)))
    if begin[-1] != total:
        raise ValueError("a segment whose counts do not add up")
    for d in range(n_docs):
        yield (None if null[d] else int(ident[d])), ids[begin[d]:begin[d + 1]]


def decode_blocks(payload: np.ndarray, start: np.ndarray, size: np.ndarray, code: Code) -> np.ndarray:
    """The ids of blocks that begin at the given bits, block after block: one id of every block a step."""
    padded = np.concatenate((payload, np.zeros(8, np.uint8))).astype(np.uint32)
    window = padded[:-3] << 24 | padded[1:-2] << 16 | padded[2:-1] << 8 | padded[3:]  # 32 bits from every byte on
    out = np.empty(int(size.sum()), np.uint32)
    order = np.argsort(-size, kind="stable")  # the blocks that still go on come first
    pos, to = start[order], (np.cumsum(size) - size)[order]
    active = len(order) - np.searchsorted(np.sort(size), np.arange(int(size.max(initial=0))), "right")
    shift, mask = 32 - code.bits, (1 << code.bits) - 1
    for step, k in enumerate(active.tolist()):
        here = pos[:k]
        row = window[here >> 3] >> (shift - (here & 7)).astype(np.uint32) & np.uint32(mask)
        out[to[:k] + step] = code.symbol[row]
        pos[:k] += code.size[row]
    return out


# -- files

def write_ids(tokens: DataFrame, path: str, max_bits: int = MAX_BITS, shards: int | None = None) -> None:
    """Write the ids of every document below ``path``, in ascending order of ``doc_id``.

    ``path/code`` is the code: the length of every id.  ``path/segments`` holds shards of ascending
    id ranges (``shard``), each a run of segments (``segment``): the number of documents and ids, and
    the segment's bytes.  ``tokens`` (doc_id, ids) is read three times, once for its ids alone, and
    should be a written table.  The shards (``shards`` of them, or as many as shuffle partitions) are
    cut at approximate quantiles of the document id; a task streams its shard, holding one segment.

    * null id: before all others; no ids or null: a document without ids
    * rows that repeat an id each stay, in the order of their coded bytes
    * empty table: a code without rows and no segment
    """
    spark = tokens.sparkSession
    code = fit_code(tokens, max_bits)
    if code.bits > 25:
        raise ValueError("codes of more than 25 bits")
    lengths = spark.createDataFrame([(int(i), int(n)) for i, n in zip(code.ids, code.lengths)], "id bigint, length int")
    lengths.coalesce(1).write.parquet(f"{path}/code")
    shared = spark.sparkContext.broadcast(code)  # as large as the vocabulary and 2 ** max_bits

    n = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = tokens.agg(F.percentile_approx("doc_id", [k / n for k in range(1, n)], max(10_000, 20 * n))).first()[0] if n > 1 else None
    bounds = np.unique(np.array(cuts or [], np.int64))  # one number for each shard

    def encode(batches):
        coder = Coder(shared.value)
        for batch in batches:
            ids, begin = _ids(batch.column("ids"))
            ident = batch.column("doc_id")
            shard = np.searchsorted(bounds, pc.fill_null(ident, -(1 << 63)).to_numpy(), "left").astype(np.int32)
            i, rows = 0, batch.num_rows
            while i < rows:
                j = min(rows, max(i + 1, int(np.searchsorted(begin, begin[i] + SLICE_IDS, "right")) - 1))
                bits, marks = coder.encode(ids[begin[i]:begin[j]], begin[i:j + 1] - begin[i])
                yield pa.record_batch([pa.array(shard[i:j]), ident.slice(i, j - i), pa.array(np.diff(begin[i:j + 1])),
                                       pa.array(bits, pa.binary()), pa.array(marks, pa.binary())],
                                      names=["shard", "doc_id", "n", "bits", "marks"])
                i = j

    coded = tokens.select("doc_id", "ids").mapInArrow(
        encode, "shard int, doc_id bigint, n bigint, bits binary, marks binary")
    # only the coded bytes are shuffled
    placed = coded.repartitionById(n, "shard").sortWithinPartitions("shard", "doc_id", "n", "bits")

    def lay(batches):
        docs, held, number, shard = [], 0, 0, None

        def segment():
            return pa.record_batch([pa.array([shard], pa.int32()), pa.array([number], pa.int32()),
                                    pa.array([len(docs)], pa.int64()), pa.array([held], pa.int64()),
                                    pa.array([_segment(docs)], pa.large_binary())],
                                   names=["shard", "segment", "n_docs", "n_ids", "data"])

        for batch in batches:
            for row in zip(*[batch.column(c).to_pylist() for c in ("shard", "doc_id", "n", "bits", "marks")]):
                if docs and (held >= SEGMENT_IDS or row[0] != shard):
                    yield segment()
                    docs, held, number = [], 0, number + 1
                shard = row[0]
                docs.append(row[1:])
                held += row[2]
        if docs:
            yield segment()

    (placed.mapInArrow(lay, "shard int, segment int, n_docs bigint, n_ids bigint, data binary")
     .write.option("compression", "none").parquet(f"{path}/segments"))


def read_ids(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """Read files of ``write_ids`` back: doc_id, start (ids of all documents before it), n_tokens,
    ids_crc32 (of the ids as little-endian unsigned 32-bit numbers) and, with ``with_ids``, the ids.

    A document's start is its place within the segment, after the totals of the segments before it,
    which are one number a segment.  Repeated and null ids: as written.
    """
    table = spark.read.parquet(f"{path}/code").orderBy("id").toPandas()  # one row for each distinct id
    shared = spark.sparkContext.broadcast(Code(table["id"].to_numpy(np.int64), table["length"].to_numpy(np.int64)))
    stored = spark.read.parquet(f"{path}/segments")

    def decode(batches):
        code = shared.value
        for batch in batches:
            for shard, number, data in zip(*[batch.column(c) for c in ("shard", "segment", "data")]):
                out, at = [], 0
                for ident, ids in read_segment(data.as_py(), code):
                    raw = ids.astype("<u4").tobytes()
                    out.append((ident, at, len(ids), zlib.crc32(raw), raw if with_ids else None))
                    at += len(ids)
                yield pa.record_batch(
                    [pa.array([shard.as_py()] * len(out), pa.int32()), pa.array([number.as_py()] * len(out), pa.int32()),
                     *[pa.array([r[k] for r in out], pa.int64()) for k in range(4)], pa.array([r[4] for r in out], pa.binary())],
                    names=["shard", "segment", "doc_id", "within", "n_tokens", "ids_crc32", "ids"])

    docs = stored.select("shard", "segment", "data").mapInArrow(
        decode, "shard int, segment int, doc_id bigint, within bigint, n_tokens bigint, ids_crc32 bigint, ids binary")
    # totals of shards (one row for each), then of the segments inside a shard
    shards = stored.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    shards = shards.select("shard", (F.sum("n").over(Window.orderBy("shard")) - F.col("n")).alias("shard_start"))
    inside = Window.partitionBy("shard").orderBy("segment")
    starts = (stored.select("shard", "segment", (F.sum("n_ids").over(inside) - F.col("n_ids")).alias("segment_start"))
              .join(shards, "shard"))
    out = docs.join(starts, ["shard", "segment"]).select(
        "doc_id", (F.col("shard_start") + F.col("segment_start") + F.col("within")).alias("start"),
        "n_tokens", "ids_crc32", "ids")
    return out if with_ids else out.drop("ids")


def staged_tokens(docs: DataFrame, **options) -> DataFrame:
    """``tokenize`` written once to the shared folder, since counting and coding both read it."""
    return staged(tokenize(docs, **options), "token-ids", compression="zstd")

