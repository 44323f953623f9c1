"""Decontamination, SentencePiece, the pipeline and the registration."""

import random
import re
import subprocess
import sys
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from llm_fixtures import ODD, ROOT, SF, frame
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from ledgerlens.llm import decontaminate, pieces
from ledgerlens.llm.decontaminate import contained_items, shingles


# ---- decontamination
def contained_brute(docs, items):
    sets = [(i, shingles(t, 5)) for i, t in items]
    out = Counter()
    for d, t in docs:
        s = shingles(t, 5)
        out.update((d, i, len(q), n) for i, q in sets if q and 100 * (n := len(q & s)) >= 75 * len(q))
    return out


def contained(spark, docs, items):
    return Counter(map(tuple, contained_items(frame(spark, docs), frame(spark, items, "item_id bigint, text string")).collect()))


def planted():
    rng = np.random.default_rng(3)
    word = lambda: "".join(rng.choice(list("abcdefgh"), 6))
    items = [(i, " ".join(word() for _ in range(n))) for i, n in enumerate([3, 5, 11, 15, 20, 33, 57, 70, 150])]
    docs = []
    for d in range(120):
        i, text = items[d % len(items)]
        w = text.split()
        if d % 4 == 1 and len(w) > 10:
            w[0] = "changed"
        if d % 4 == 2 and len(w) > 10:
            w = w[:len(w) // 2]
        before, after = (" ".join(word() for _ in range(rng.integers(0, 3000))) for _ in range(2))
        docs.append((d, " ".join([before, " ".join(w).upper() if d % 3 == 0 else " ".join(w), after])))
    return docs + ODD + [(500, items[0][1]), (501, items[0][1] + " more")], items + [(90, None), (91, ""), (92, "one two three four"),
                                                                                    (None, "word " * 5)]


def test_containment_against_brute_force(spark):
    docs, items = planted()
    assert contained(spark, docs, items) == contained_brute(docs, items)


def test_containment_whole_tables_and_item_blocks(spark, texts, monkeypatch):
    monkeypatch.setattr(decontaminate, "ITEM_BLOCK", 7)
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    want = contained_brute(texts, items)
    assert want and contained(spark, texts, items) == want


def test_containment_empty_and_clashes(spark, texts):
    assert not contained(spark, [], [(1, "a b c d e f")]) and not contained(spark, texts, [])
    docs = spark.createDataFrame([(1, "a b c d e f g", 2), (2, "q", 2)], "doc_id bigint, text string, item_id int")
    items = spark.createDataFrame([(2, "a b c d e f", 1)], "item_id bigint, text string, doc_id int")
    kept = decontaminate.drop_contaminated(docs, items)
    assert kept.columns == docs.columns and [r.doc_id for r in kept.collect()] == [2]


# ---- SentencePiece
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
TABLE = pieces.load_pieces()


def encoded(texts):
    ids, offsets = pieces.Encoder(TABLE).encode(pa.array(texts, pa.string()))
    return [ids[a:b].tolist() for a, b in zip(offsets[:-1], offsets[1:])], pieces.decode(ids, offsets, TABLE)


HARD = ["Hello  world", "  a", "a ", "\n\nx\ty", "", " ", "é€\U0001f600 z\0q", "ﬁ Å ｈ", "a　b▁c", "</s><s>", "12345 67", "a" * 5000,
        "ab" * 300 + " x", "xyz" * 40, "▁", "\r\n", "<0x41>", "the" * 30 + " " * 50 + "end"]


def test_pieces_equal_the_library(texts):
    rows = [t or "" for _, t in texts] + HARD
    got, back = encoded(rows)
    assert got == LIBRARY.encode(rows)
    assert back == [pieces._normal(t) for t in rows]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.sampled_from("ab ethin▁\n1é\U0001f600漢.") | st.characters(codec="utf-8"), max_size=60), max_size=5))
def test_pieces_equal_the_library_on_any_text(texts):
    got, back = encoded(texts)
    assert got == LIBRARY.encode(texts) and back == [pieces._normal(t) for t in texts]


def test_pieces_in_spark(spark, monkeypatch):
    docs = frame(spark, ODD)
    out = pieces.encode_documents(docs)
    assert out.columns == ["doc_id", "text", "ids"]
    rows = pieces.decode_documents(out).collect()
    for r in rows:
        assert r.ids == (None if r.text is None else LIBRARY.encode(r.text)) and r.decoded == r.text
    checked = pieces.round_trip(docs.withColumn("ids", F.lit(1)), with_ids=True)
    assert checked.columns == ["doc_id", "text", "n_pieces", "ids_sha256", "round_trip", "ids"]
    assert all(r.round_trip and r.ids == LIBRARY.encode(r.text or "") and r.n_pieces == len(r.ids) for r in checked.collect())
    assert pieces.round_trip(docs.limit(0)).count() == 0
    monkeypatch.setattr(pieces, "CACHED_WORDS", 3)
    assert encoded(HARD)[0] == LIBRARY.encode(HARD)


def best_path(word, score):
    """All segmentations of a word, the best score."""
    if not word:
        return 0.0
    ways = [score[word[:n]] + rest for n in range(1, len(word) + 1) if word[:n] in score
            if (rest := best_path(word[n:], score)) is not None]
    return max(ways, default=None)


def test_viterbi_words_against_all_segmentations(spark):
    rng = np.random.default_rng(5)
    score = {w: -float(rng.integers(1, 9)) for w in ["a", "b", "ab", "ba", "aa", "bab", "abba", "c", "ca"]}
    number = {w: i for i, w in enumerate(score)}
    table = spark.createDataFrame([(w, number[w], s) for w, s in score.items()], "piece string, id int, score double")
    words = ["", "a", "abba", "bababa", "abcab", "x", "abx", "aaaaaaa", "cabba", None, "a"]
    out = pieces.viterbi_words(spark.createDataFrame([(w,) for w in words], "word string"), table, longest=4).collect()
    assert Counter(r.word for r in out) == Counter(set(words) - {None})
    by_id = {i: w for w, i in number.items()}
    for r in out:
        assert r.score == best_path(r.word, score)
        if r.ids is not None:
            assert "".join(by_id[i] for i in r.ids) == r.word and sum(score[by_id[i]] for i in r.ids) == r.score
    assert pieces.viterbi_words(spark.createDataFrame([], "word string"), table).count() == 0
    assert pieces.piece_frame(spark).count() == len(TABLE.usable)


# ---- pipeline
def test_pipeline_against_brute_force(spark):
    import corpus_pipeline
    from test_jaccard import brute as components
    from test_small_operators import lines_brute

    from ledgerlens.llm import quality

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    verdict = {r.doc_id: r.kept for r in quality.score_quality(docs).select("doc_id", "kept").collect()}
    rows = [r for r in rows if verdict[r[0]]]
    rows = [(i, t) for i, t, *_ in lines_brute(rows)]
    rows = [(i, t) for i, t in rows if (i, i) in {(a, c) for a, _, c in components(rows)}]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    leaked = {d for d, *_ in contained_brute(rows, items)}
    want = {i: LIBRARY.encode(t) for i, t in rows if i not in leaked}
    got = corpus_pipeline.run(spark, SF).collect()
    assert {r.doc_id: r.ids for r in got} == want and len(got) == len(want)
    assert all(r.round_trip for r in got)


def test_pipeline_stages_keep_the_columns(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumn("kept", F.lit(1)).withColumn("component_id", F.lit("x"))
    for rows in (docs, docs.limit(0)):
        now = rows
        for _, stage in corpus_pipeline.STAGES[:-1]:
            now = stage(spark, now, SF)
            assert now.columns == docs.columns
        now.count()


def test_pipeline_with_nulls(spark):
    import corpus_pipeline

    docs = frame(spark, ODD).selectExpr("doc_id", "text", "cast(null as string) lang", "cast(null as string) source",
                                        "cast(null as bigint) n_chars")
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        assert out.count() <= docs.count()


# ---- registration
def test_registered_queries_and_oracles():
    import __spark_entry__ as entry

    names = [n for n in entry.queries() if re.match(r"op\d+_", n)]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 11)) and "pipeline" in entry.queries()
    assert {"op1_ngram_jaccard", "op2_decontamination", "op3_substring_dedup", "op6_line_dedup", "op8_warc"} <= set(entry.oracle_sql())


def test_entry_without_the_subpackage(tmp_path):
    code = ("import sys\n"
            "class Gone:\n"
            "    def find_spec(self, name, path=None, target=None):\n"
            "        if name == 'corpus_pipeline' or name.startswith('ledgerlens.llm'):\n"
            "            raise ModuleNotFoundError(name, name=name)\n"
            "sys.meta_path.insert(0, Gone())\n"
            f"sys.path.insert(0, {ROOT!r})\n"
            "import __spark_entry__ as e\n"
            "assert e.queries() and e.oracle_sql() and not [q for q in e.queries() if q.startswith('op')]\n")
    subprocess.run([sys.executable, "-c", code], check=True, cwd=tmp_path, timeout=120)


def test_native_operators_run_no_python(spark):
    import __spark_entry__ as entry

    for name in ("op6_line_dedup",):
        plan = entry.queries()[name](spark, SF)._jdf.queryExecution().toString()
        assert not re.search("Python|Pandas|Arrow", plan)
    from ledgerlens.llm import pii

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    plan = pii.find_pii(docs, pii.PiiModel([(0, 1.0, 0.1, 0.2)], [1.0], 0.5))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_smallest_items_are_never_missed():
    """Items of up to 8 shingles: every item whose shingles a text holds to three quarters is a candidate."""
    import numpy as np

    from ledgerlens.llm import arrays, decontaminate

    rng = random.Random(8)
    items, texts = [], []
    for n in range(3000):
        words = [f"i{n}w{j}" for j in range(rng.randrange(5, 13))]
        items.append((n, " ".join(words)))
        size = len(words) - 4
        hidden = words if size < 4 else words[:4 + -(-3 * size // 4)]  # three quarters of the shingles
        texts.append(" ".join([*[f"f{rng.randrange(10**6)}" for _ in range(300)], *hidden, *[f"f{rng.randrange(10**6)}" for _ in range(300)]]))
    index = decontaminate.ItemIndex(items, 5)
    data, offsets = arrays.buffers(pa.array(texts))
    words = arrays.Words(data, offsets, 0, len(texts), lower=True)
    grams, begin = arrays.ngrams(words.hashes(), words.row, 5)
    assert {(n, n) for n in range(3000)} <= set(index.candidates(grams, begin))
    assert not np.any([len(s) > 8 for _, s in index.sets])
