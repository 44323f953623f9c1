import hashlib
import re
from collections import Counter

import pytest
from llm_fixtures import ODD, frame

from ledgerlens.llm import buckets, rlz


def brute(rows, window=50):
    words = [(i, re.findall("[^\x20\x09-\x0d]+", t or "")) for i, t in rows]
    first = {}
    for i, w in words:
        for a in range(len(w) - window + 1):
            key = tuple(w[a:a + window])
            if i is not None and i < first.get(key, float("inf")):
                first[key] = i
    out = []
    for (i, t), (_, w) in zip(rows, words):
        gone = set()
        for a in range(len(w) - window + 1):
            if i is not None and first[tuple(w[a:a + window])] < i:
                gone |= set(range(a, a + window))
        kept = " ".join(x for n, x in enumerate(w) if n not in gone)
        out.append((i, len(w), len(gone), None if t is None else kept))
    return Counter(out)


def result(spark, rows, window=50):
    out = rlz.drop_repeated_passages(frame(spark, rows), window)
    return Counter(tuple(r) for r in out.select("doc_id", "n_words", "n_removed", "text").collect())


def test_whole_table_against_brute_force(spark, texts):
    assert result(spark, texts) == brute(texts)


@pytest.mark.parametrize("flush", [50, 2_000_000])
def test_factors_that_meet_and_overlap(spark, monkeypatch, flush):
    monkeypatch.setattr(rlz, "FLUSH", flush)  # many small rows, or one for each task and block
    a, b, c = ([f"{x}{i}" for i in range(90)] for x in "abc")
    rows = [(1, " ".join(a)), (2, " ".join(b)), (3, " ".join(c)), (4, " ".join(a[20:] + b[:60] + c)),
            (5, " ".join(a[30:] + ["new"] + b)), (6, " ".join(a[:49])), (7, " ".join(a[:50] * 3)), (8, " ".join(a * 2)),
            (9, " ".join(b[10:60] + a[:10] + b[10:60]))]
    assert result(spark, rows) == brute(rows)
    assert result(spark, rows[::-1]) == brute(rows)


def test_factors_point_at_their_reference(spark, texts):
    by_id = {i: re.findall("[^\x20\x09-\x0d]+", t or "") for i, t in texts}
    found = rlz.factors(frame(spark, texts)).collect()
    assert found
    for f in found:
        assert f.n_words >= 50 and f.ref_id < f.doc_id
        assert (by_id[f.doc_id][f.start:f.start + f.n_words] == by_id[f.ref_id][f.ref_start:f.ref_start + f.n_words])


@pytest.mark.parametrize("flush", [50, 2_000_000])
def test_a_long_passage_copied_between_tasks_is_one_factor(spark, monkeypatch, flush):
    monkeypatch.setattr(rlz, "FLUSH", flush)
    passage = [f"p{i}" for i in range(1000)]
    rows = [(1, " ".join(["x"] * 30 + passage + ["y"])), (2, " ".join(["z"] * 7 + passage[100:])),
            (3, " ".join(["a", *passage, "b", *passage[:60]]))]
    found = rlz.factors(frame(spark, rows).repartition(3, "doc_id")).select(
        "doc_id", "start", "n_words", "ref_id", "ref_start").collect()
    assert sorted(map(tuple, found)) == [(2, 7, 900, 1, 130), (3, 1, 1000, 1, 30), (3, 1002, 60, 1, 30)]


def test_windows_that_agree_in_the_first_hash_only_are_different(spark, monkeypatch):
    ngrams = rlz.arrays.ngrams
    calls = []

    def first_hash_equal(words, row, k):
        h, begin = ngrams(words, row, k)
        calls.append(k)
        return (h * 0 if len(calls) % 3 == 1 else h), begin  # 1st: window, 2nd: its check, 3rd: gram

    rows = [(1, " ".join(f"p{i}" for i in range(60))), (2, " ".join(f"q{i}" for i in range(60)))]
    batch = rlz.pa.RecordBatch.from_pydict({"id": [1, 2], "tag": [1, 2], "text": [t for _, t in rows]})
    monkeypatch.setattr(rlz.arrays, "ngrams", first_hash_equal)
    sent = {}

    class Docs:
        sparkSession = spark

        def mapInArrow(self, f, schema):
            sent["rows"] = [r for b in f(iter([batch])) for r in b.to_pylist()]

    rlz._indexed(Docs(), 50)
    assert len(calls) == 3 and sent["rows"] and not any(r["refs"] for r in sent["rows"])


def test_odd_rows_short_windows_and_empty_tables(spark):
    assert result(spark, ODD) == brute(ODD)
    assert result(spark, ODD, 2) == brute(ODD, 2)
    assert result(spark, []) == Counter()


def test_clashing_columns(spark):
    docs = spark.createDataFrame([(1, "a b", 7, "z")], "doc_id bigint, text string, n_words int, tag string")
    out = rlz.drop_repeated_passages(docs)
    assert out.columns == ["doc_id", "text", "tag", "n_words", "n_removed"]
    assert out.first() == (1, "a b", "z", 2, 0)


def test_every_partition_gets_a_bucket(spark):
    from pyspark.sql import functions as F

    for n in (1, 7, 50):
        keys = buckets.even_keys(spark, n)
        df = spark.createDataFrame([(int(k),) for k in keys], "bucket int").repartition(n, "bucket")
        assert df.groupBy(F.spark_partition_id()).count().count() == n
