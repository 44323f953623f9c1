import re
import tracemalloc
from collections import Counter, defaultdict
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from llm_fixtures import ODD, frame
from hypothesis import given, settings, strategies as st

from ledgerlens.llm import jaccard
from ledgerlens.llm.components import connected

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, k=5):
    w = re.findall("[^\x20\x09-\x0d]+", (text or "").translate(LOWER))
    return frozenset(tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))) if w else frozenset()


def brute(rows):
    """id -> (set sizes, component) by comparing all sets that share a shingle."""
    sets = [(i, shingles(t)) for i, t in rows]
    parent = {i: i for i, _ in rows if i is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    lists = defaultdict(list)
    for n, (i, s) in enumerate(sets):
        if i is not None:
            for x in s:
                lists[x].append(n)
    common = Counter()
    for members in lists.values():
        for a in range(len(members)):
            for b in range(a):
                common[members[b], members[a]] += 1
    for (a, b), n in common.items():
        (i, s), (j, t) = sets[a], sets[b]
        if 100 * n >= 75 * (len(s) + len(t) - n):
            x, y = sorted((find(i), find(j)))
            parent[y] = x
    return Counter((i, len(s), None if i is None else find(i)) for i, s in sets)


def result(spark, rows):
    out, _ = jaccard.ngram_jaccard_join(frame(spark, rows))
    return Counter(tuple(r) for r in out.select("doc_id", "n_shingles", "component_id").collect())


def test_whole_table_against_brute_force(spark, texts):
    assert result(spark, texts) == brute(texts)


def near_copies():
    base = [f"w{i}" for i in range(120)]
    rows = [(100 + n, " ".join(base[:n] + [f"edit{n}"] + base[n + 1:])) for n in range(40)]
    chain = [(200 + n, " ".join(f"c{i}" for i in range(n * 6, n * 6 + 60))) for n in range(6)]
    passage = [f"p{i}" for i in range(30)]
    shared = [(300 + n, " ".join([f"a{n}x{i}" for i in range(40)] + passage + [f"b{n}x{i}" for i in range(40)])) for n in range(30)]
    return rows + chain + shared + [(400, rows[0][1]), (401, rows[0][1].upper())]


def test_groups_chains_and_shared_passages(spark):
    rows = near_copies()
    assert result(spark, rows) == brute(rows)


def test_split_lists(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "LIST_PART", 4)
    monkeypatch.setattr(jaccard, "LONG_LIST", 2)
    monkeypatch.setattr(jaccard, "SEARCH_PART", 3)
    rows = near_copies()
    assert result(spark, rows) == brute(rows)


def test_odd_rows(spark):
    assert result(spark, ODD) == brute(ODD)


def test_a_repeated_id_links_by_each_of_its_texts(spark):
    one, two = (" ".join(f"{x}{i}" for i in range(60)) for x in "ab")
    near = " ".join([f"b{i}" for i in range(60)][:-2] + ["x", "y"])
    rows = [(1, one), (5, one), (5, two), (9, near), (7, near), (7, None)]
    want = brute(rows)
    assert want[9, 56, 1] == 1 and result(spark, rows) == want


def test_empty_table_and_clashing_columns(spark):
    assert result(spark, []) == Counter()
    docs = spark.createDataFrame([(1, "a b c d e f", 5, "x"), (2, "a b c d e f", 6, "y")],
                                 "doc_id bigint, text string, component_id int, query string")
    kept = jaccard.drop_near_copies(docs)
    assert kept.columns == docs.columns
    assert [r.doc_id for r in kept.collect()] == [1]


@pytest.mark.parametrize("part", [jaccard.LIST_PART, 4])
def test_every_link_is_listed(spark, monkeypatch, part):
    monkeypatch.setattr(jaccard, "LIST_PART", part)
    monkeypatch.setattr(jaccard, "LONG_LIST", 2 if part == 4 else jaccard.LONG_LIST)
    rows = near_copies()
    sets = {}
    for i, t in sorted(rows):
        sets.setdefault(shingles(t), []).append(i)
    want = {(min(i), min(j)): (len(a & b), len(a), len(b)) for a, i in sets.items() for b, j in sets.items()
            if min(i) < min(j) and 100 * len(a & b) >= 75 * len(a | b)}
    want |= {(i, min(ids)): (len(s),) * 3 for s, ids in sets.items() for i in ids[1:]}
    links = jaccard.ngram_jaccard_join(frame(spark, rows))[1].collect()
    got = {(r.u, r.v) if r.overlap == r.n_u == r.n_v else (min(r.u, r.v), max(r.u, r.v)):
           (r.overlap, r.n_u, r.n_v) if r.u < r.v or r.overlap == r.n_u == r.n_v else (r.overlap, r.n_v, r.n_u) for r in links}
    assert got == want and len(links) == len(want) > 300


def test_small_results_are_written_in_few_files_and_lists_once(spark, monkeypatch):
    written = defaultdict(list)

    def staged(df, stem):
        out = jaccard_staged(df, stem)
        written[stem].append(len(out.inputFiles()))
        return out

    jaccard_staged = jaccard.staged
    monkeypatch.setattr(jaccard, "staged", staged)
    rows = near_copies()
    out, _ = jaccard.ngram_jaccard_join(frame(spark, rows).repartition(8), every_link=False)
    got = Counter(tuple(r) for r in out.select("doc_id", "n_shingles", "component_id").collect())
    assert got == brute(rows)
    assert {stem: max(written[stem]) for stem in ("classes", "long", "retained")} == {"classes": 1, "long": 1, "retained": 1}
    assert len(written["lists"]) == 1


class Docs:
    """Hands out the functions that a join gives to its tasks."""

    sparkSession = SimpleNamespace(sparkContext=SimpleNamespace(broadcast=lambda x: SimpleNamespace(value=x)))

    def mapInArrow(self, task, schema):
        return task


def test_a_worker_holds_little_beside_its_batch(monkeypatch):
    monkeypatch.setattr(jaccard, "partitions", lambda spark: 200)
    monkeypatch.setattr(jaccard, "even_keys", lambda spark, n: np.arange(n))
    rng = np.random.default_rng(3)
    text = [" ".join(map(str, rng.integers(0, 10**6, 600))) for _ in range(4000)]  # 16 MB, 600,000 postings
    batch = pa.record_batch({"id": pa.array(range(len(text))), "text": pa.array(text)})
    tasks = [jaccard.shingle_classes(Docs(), 5),
             jaccard._index(Docs(), 5, 75, 100, (np.empty(0, np.uint64), np.empty(0, np.uint8)))]
    for task in tasks:
        list(task([batch.slice(0, 1000)]))  # what is made once
        tracemalloc.start()
        for _ in task([batch]):
            pass
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert peak < 56e6


def test_sets_do_not_depend_on_how_a_batch_is_cut(monkeypatch):
    text = [None, "", "a b", "A b c d e f", " x ", "a b c d e f g" * 9, None, "é b c d e", "q " * 40] * 3
    batch = pa.record_batch({"id": pa.array(range(len(text))), "text": pa.array(text)})

    def found():
        return [(r, s.tolist()) for b in (batch, batch.slice(4, 11)) for _, r, s in jaccard._sets([b], 5)]

    want = found()
    assert [len(s) for _, s in want[:len(text)]] == [len(shingles(t)) for t in text]
    for rows, size in ((1, 1), (2, 5), (4, 60), (7, 1 << 20)):
        monkeypatch.setattr(jaccard, "SET_ROWS", rows)
        monkeypatch.setattr(jaccard, "SET_BYTES", size)
        assert found() == want


@settings(max_examples=60, deadline=None)
@given(st.data())
def test_divide_skip_counts_overlaps(data):
    numbers = st.lists(st.integers(0, 40), min_size=1, max_size=30).map(lambda x: np.unique(np.array(x, np.uint64)))
    query, sets = data.draw(numbers), data.draw(st.lists(numbers, max_size=8))
    least = [jaccard.required(len(query), len(s), 75, 100) for s in sets]
    want = [n if (n := len(np.intersect1d(query, s))) >= t else 0 for s, t in zip(sets, least)]
    assert jaccard.divide_skip(query, sets, least) == want


@pytest.mark.parametrize("links", [[], [(1, 1)], [(5, 4), (4, 3), (3, 2), (2, 1)], [(9, 1), (9, 2), (7, 8), (None, 3)],
                                   [(i, i + 1) for i in range(50)]])
def test_components(spark, links):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for u, v in links:
        if u is not None and u != v:
            a, b = sorted((find(u), find(v)))
            parent[b] = a
    got = connected(spark.createDataFrame(links, "u bigint, v bigint")).collect()
    assert sorted(map(tuple, got)) == sorted((x, find(x)) for x in parent)
