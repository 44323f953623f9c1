"""Token files: the code against textbook Huffman, files against the library's own ids."""

import heapq
import itertools
import random
import zlib

import numpy as np
import pytest
from llm_fixtures import ODD, SF, frame

from ledgerlens.llm import token_files as K
from ledgerlens.llm.frames import shared_folder

public_tokenizers = pytest.importorskip("public_tokenizers")
FILE = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(FILE)


def huffman_total(counts):
    heap, total = [int(c) for c in counts], 0
    heapq.heapify(heap)
    while len(heap) > 1:
        both = heapq.heappop(heap) + heapq.heappop(heap)
        total += both
        heapq.heappush(heap, both)
    return total


def test_lengths_are_optimal():
    rng = np.random.default_rng(1)
    for n in (2, 3, 10, 300, 2000):
        counts = rng.integers(1, 10**6, n)
        lengths = K.limited_lengths(counts, 40)
        assert int((counts * lengths).sum()) == huffman_total(counts)
    for _ in range(30):  # under a limit: the best of all lengths that a code can have
        counts = rng.integers(1, 100, rng.integers(2, 6))
        best = min(int(np.dot(x, counts)) for x in itertools.product((1, 2, 3), repeat=len(counts)) if sum(.5**k for k in x) <= 1)
        assert int(np.dot(K.limited_lengths(counts, 3), counts)) == best
    fibonacci = [1, 1]
    while len(fibonacci) < 40:
        fibonacci.append(fibonacci[-1] + fibonacci[-2])
    lengths = K.limited_lengths(np.array(fibonacci), 8)
    assert lengths.max() == 8 and sum(0.5**x for x in lengths) <= 1
    assert K.limited_lengths(np.ones(1000, int), 4).max() == 10  # too few bits for so many ids: raised
    assert K.limited_lengths(np.array([7]), 8).tolist() == [1] and len(K.limited_lengths(np.array([], int))) == 0


def test_code_is_canonical():
    code = K.Code(np.array([3, 5, 9, 70]), np.array([2, 1, 3, 3]))
    assert [format(int(c), f"0{n}b") for c, n in zip(code.codes, code.lengths)] == ["10", "0", "110", "111"]


@pytest.mark.parametrize("top", [500, 1 << 31])
def test_segment_round_trip(top):
    rng = np.random.default_rng(2)
    ids = np.unique(rng.integers(0, top, 300))
    share = 1 / np.arange(1, len(ids) + 1) ** 1.3
    code = K.Code(ids, K.limited_lengths((1e6 * share).astype(int) + 1, 14))
    docs = [rng.choice(ids, n, p=share / share.sum()).astype(np.uint32) for n in (0, 1, 1023, 1024, 1025, 3 * 1024, 0, 20_000, 7)]
    begin = np.concatenate(([0], np.cumsum([len(d) for d in docs])))
    bits, marks = K.Coder(code).encode(np.concatenate(docs), begin)
    assert [len(m) // 8 for m in marks] == [0, 0, 0, 0, 1, 2, 0, 19, 0]
    segment = K._segment([(None if k == 2 else -k, len(d), b, m) for k, (d, b, m) in enumerate(zip(docs, bits, marks))])
    back = list(K.read_segment(segment, code))
    assert [i for i, _ in back] == [0, -1, None, -3, -4, -5, -6, -7, -8]
    assert all((a == b).all() and len(a) == len(b) for a, (_, b) in zip(docs, back))
    # a block is decoded from its checkpoint alone
    start = int(np.frombuffer(marks[7], "<u8")[4])
    alone = K.decode_blocks(np.frombuffer(bits[7], np.uint8), np.array([start]), np.array([1024]), code)
    assert (alone == docs[7][5 * 1024:6 * 1024]).all()
    with pytest.raises(ValueError):
        K.Coder(code).encode(np.array([top + 1], np.uint32), np.array([0, 1]))
    with pytest.raises(ValueError):
        list(K.read_segment(b"XXXX" + segment[4:], code))


def test_words_one_by_one_are_the_library_s_ids(library):
    rng = random.Random(3)
    signs = list("ab'st re\n\n\t  .,!?1²é ㄱ\x1c\x1f\x85\xa0᠎  　﻿​\r\x0b\x0c\0中\U0001f600_-Ⅷ٣'ll'd\"") + ["<|endoftext|>"]
    texts = ["".join(rng.choice(signs) for _ in range(rng.randrange(40))) for _ in range(20_000)]
    for special in (True, False):
        encoder = K.WordEncoder(FILE, special)
        library.encode_special_tokens = not special
        assert coded(encoder, texts) == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    library.encode_special_tokens = False


def test_table_is_emptied_and_long_words(library, monkeypatch):
    monkeypatch.setattr(K, "TABLE_WORDS", 50)
    monkeypatch.setattr(K.arrays, "SLICE_BYTES", 300)
    rng = random.Random(4)
    texts = [" ".join("xyz"[rng.randrange(3)] * rng.randrange(60) + rng.choice(("", ".", "\0", "é")) for _ in range(30)) for _ in range(100)]
    texts += ["\0", "a\0", "a", "a\0\0", None]
    encoder = K.WordEncoder(FILE)
    assert coded(encoder, texts) == [library.encode(t or "", add_special_tokens=False).ids for t in texts]


def test_other_files_go_to_the_library_whole():
    path = public_tokenizers.path("word_bpe_49k.json")
    encoder = K.WordEncoder(path)
    assert not encoder.by_word
    texts = ["Some  Words\nhere.", "", "word 12"]
    assert coded(encoder, texts, 9) == [
        e.ids + [9] for e in encoder.tokenizer.encode_batch(texts, add_special_tokens=False)]
    with pytest.raises(FileNotFoundError):
        K.WordEncoder("/nowhere/file.json")


def coded(encoder, texts, end=None):
    import pyarrow as pa

    out = []
    for first, found in encoder.encode(pa.array(texts, pa.string()), end):
        assert first == len(out)
        out += [x.tolist() for x in found]
    return out


def by_hand(rows, library, end=0):
    out, start = [], 0
    coded = [(i, [*library.encode(t or "", add_special_tokens=False).ids, end]) for i, t in rows]
    for i, ids in sorted(coded, key=lambda r: (r[0] is not None, r[0] or 0)):
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def written(spark, docs, **options):
    path = shared_folder(spark, "tokens")
    K.write_ids(K.staged_tokens(docs), path, **options)
    return path


def test_whole_table(spark, library):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    path = written(spark, docs)
    found = K.read_ids(spark, path)
    want = by_hand([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()], library)
    rows = found.orderBy("start").collect()
    assert [(r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in rows] == want
    assert all(zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.n_tokens for r in rows)
    stored = spark.read.parquet(f"{path}/segments").orderBy("shard", "segment").collect()
    assert len(stored) > 1 and sum(r.n_ids for r in stored) == sum(w[2] for w in want)


def test_odd_rows_small_segments_and_shards(spark, library, monkeypatch):
    rows = [(i, t) for i, t in ODD if i != 9] + [(-5, "minus"), (-5, "minus"), (50, "a\nb" * 900), (51, "\0 \x1f")]
    path = written(spark, frame(spark, rows), max_bits=9, shards=3)
    found = sorted(((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in K.read_ids(spark, path, False).collect()), key=lambda r: r[1])
    assert found == by_hand(rows, library)


def test_empty_table_and_rows_without_ids(spark):
    empty = frame(spark, [], "doc_id bigint, text string, ids int")
    assert K.read_ids(spark, written(spark, empty)).count() == 0
    path = shared_folder(spark, "tokens")
    K.write_ids(frame(spark, [(1, None), (2, bytearray(b"")), (3, bytearray(b"\1\0\0\0"))], "doc_id bigint, ids binary"), path)
    assert [(r.doc_id, r.start, r.n_tokens) for r in K.read_ids(spark, path).orderBy("doc_id").collect()] == [(1, 0, 0), (2, 0, 0), (3, 0, 1)]


def test_words_before_any_mark_are_learned_once(library):
    import pyarrow as pa

    encoder = K.WordEncoder(FILE)
    list(encoder.encode(pa.array([" same### same%%% same élé$$ élé& élé"]), None))
    assert len(encoder.size) == 6  # both words and four runs of marks
    rng = random.Random(1)
    letters = "abZ09éß×÷ñ…'#%.,!\"(<|>/ \n\t  中🙂'sst"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(60))) for _ in range(5000)]
    got = [x.tolist() for _, found in K.WordEncoder(FILE, special=False).encode(pa.array(texts), None) for x in found]
    library.encode_special_tokens = True
    assert got == [library.encode(t, add_special_tokens=False).ids for t in texts]
    library.encode_special_tokens = False
