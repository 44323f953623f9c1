"""Quality rules combined by weak supervision.

Every rule looks at a few counts of a text and votes good (1), bad (-1) or
abstains (0).  How far each rule can be trusted is not set by hand: expectation
maximisation over the vote patterns of the whole corpus estimates the share of
good texts and of each kind of bad ones, and how often every rule votes either
way on them.  The posterior probability that a text is good then decides, instead
of a filter that every rule must pass.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ledgerlens.llm import arrays
from ledgerlens.llm.frames import free_name, without

STATS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines",
         "n_letters", "n_capitals", "n_marks"]
# Fixed value: the symbols counted by n_symbols.
_SYMBOLS = np.zeros(256, bool)
_SYMBOLS[[ord(c) for c in "#*$%&|<>"]] = True
_CAPITALS = np.zeros(256, bool)
_CAPITALS[65:91] = True
_LETTERS = _CAPITALS.copy()
_LETTERS[97:123] = True
_MARKS = np.zeros(256, bool)
_MARKS[[ord("!"), ord("?")]] = True


def _per_row(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
    return total[offsets[1:]] - total[offsets[:-1]]


def _repeat_words(hashes: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Words of each row inside a 3-word window that the row has twice or more."""
    grams, begin = arrays.ngrams(hashes, row, 3)
    out = np.zeros(len(row) - 1, np.int64)
    for i in range(len(out)):
        g = grams[begin[i]:begin[i + 1]]
        if len(g) < 2:
            continue
        order = np.argsort(g)
        same = g[order[1:]] == g[order[:-1]]
        if not same.any():
            continue
        again = np.zeros(len(g) + 2, bool)
        at = np.concatenate((order[1:][same], order[:-1][same]))
        for shift in range(3):
            again[at + shift] = True
        out[i] = again.sum()
    return out


def _dup_lines(text: str) -> tuple[int, int]:
    lines = [x for x in text.split("\n") if x.strip(" \t\n\x0b\x0c\r")]
    return len(lines) - len(set(lines)), len(lines)


def text_stats(col: pa.Array) -> pa.Array:
    """The counts of ``STATS`` for every text; null counts as empty."""
    data, offsets = arrays.buffers(col)
    n = len(offsets) - 1
    out = {name: np.zeros(n, np.int64) for name in STATS}
    for i, j in arrays.slices(offsets):
        words = arrays.Words(data, offsets, i, j)
        raw, off = words.data, words.offsets
        part = slice(i, j)
        out["n_words"][part] = np.diff(words.row)
        first_bytes = (raw & 0xC0) != 0x80  # one for each code point
        out["word_chars"][part] = _per_row(first_bytes & ~arrays._SPACE[raw], off)
        out["n_symbols"][part] = _per_row(_SYMBOLS[raw], off)
        out["n_letters"][part] = _per_row(_LETTERS[raw], off)
        out["n_capitals"][part] = _per_row(_CAPITALS[raw], off)
        out["n_marks"][part] = _per_row(_MARKS[raw], off)
        out["n_repeat_words"][part] = _repeat_words(words.hashes(), words.row)
    for k, text in enumerate(col.to_pylist() if not isinstance(col, pa.ChunkedArray) else col.combine_chunks().to_pylist()):
        if text:
            out["n_dup_lines"][k], out["n_lines"][k] = _dup_lines(text)
    return pa.StructArray.from_arrays([pa.array(out[s]) for s in STATS], names=STATS)


def stats_column(text: Column) -> Column:
    fields = ", ".join(f"{s} bigint" for s in STATS)

    @F.arrow_udf(f"struct<{fields}>")
    def stats(col: pa.Array) -> pa.Array:
        return text_stats(col)

    return stats(text)


#: Expected share of good texts with a bad vote of one rule.
FALSE_ALARMS = 0.005


def rule_votes(s: Column) -> dict[str, Column]:
    """The rules: name -> vote (1 good, -1 bad, 0 abstain) from a struct of ``STATS``."""
    words = s["n_words"]

    def vote(bad: Column, good: Column | None = None) -> Column:
        out = F.when(bad, -1)
        return (out if good is None else out.when(good, 1)).otherwise(0)

    # The last five look for one fault each: not to find it says little, so they abstain.
    return {
        "length": vote(words < 50, words >= 100),
        "word_length": vote(~s["word_chars"].between(words * 2, words * 14), s["word_chars"].between(words * 3, words * 9)),
        "symbols": vote(100 * s["n_symbols"] > 10 * words),
        "same_lines": vote(2 * s["n_dup_lines"] > s["n_lines"]),
        "repeats": vote(100 * s["n_repeat_words"] > 50 * words),
        "capitals": vote(2 * s["n_capitals"] > s["n_letters"]),
        "marks": vote(100 * s["n_marks"] > 20 * words),
    }


def fit_rules(patterns: dict[tuple[int, ...], int], n_rules: int, rounds: int = 500,
              tolerance: float = 1e-9) -> tuple[np.ndarray, np.ndarray]:
    """Expectation maximisation over vote patterns and their counts.

    Every rule looks for a fault of its own, and texts with one fault need not
    have another; so beside the good texts there is a kind of bad texts for each
    rule.  Returns the share of the good texts and of each kind (1 + rules), and
    the probability of the votes -1, 0, 1 given the kind (1 + rules, rules, 3).
    Rules are taken as independent given the kind.  The start has 8 of 10 texts
    good, few bad votes on them, and 9 of 10 texts of a kind found by its rule.
    Whether a vote that meets no other is a false alarm cannot be seen in the votes;
    the belief that FALSE_ALARMS of the good texts get a rule's bad vote therefore
    weighs as much as they do.  Counts are smoothed with one vote of each kind, so
    that no vote gets probability 0.  Without texts the start values are returned.
    """
    kinds = 1 + n_rules
    share = np.array([0.8] + [0.2 / n_rules] * n_rules)
    table = np.tile([FALSE_ALARMS, 0.5 - FALSE_ALARMS / 2, 0.5 - FALSE_ALARMS / 2], (kinds, n_rules, 1))
    table[np.arange(1, kinds), np.arange(n_rules)] = [0.9, 0.05, 0.05]
    if not patterns:
        return share, table
    votes = np.array(list(patterns), int).reshape(-1, n_rules)
    weight = np.array(list(patterns.values()), float)
    for _ in range(rounds):
        belong = _belong(votes, share, table) * weight[:, None]
        was, share = share, (belong.sum(0) + 1) / (weight.sum() + kinds)
        for v in range(3):
            table[:, :, v] = 1 + belong.T @ (votes == v - 1)
        table /= table.sum(2, keepdims=True)
        alarm = (table[0, :, 0] + FALSE_ALARMS) / 2
        table[0, :, 1:] *= ((1 - alarm) / (1 - table[0, :, 0]))[:, None]
        table[0, :, 0] = alarm
        if np.abs(share - was).max() < tolerance:
            break
    return share, table


def _belong(votes: np.ndarray, share: np.ndarray, table: np.ndarray) -> np.ndarray:
    rules = np.arange(votes.shape[1])
    score = np.log(share) + np.log(table[:, rules, votes + 1]).sum(2).T
    score = np.exp(score - score.max(1, keepdims=True))
    return score / score.sum(1, keepdims=True)


def posterior(votes: np.ndarray, share: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Probability of good for each row of votes."""
    return _belong(np.asarray(votes, int), share, table)[:, 0]


def accuracies(votes: np.ndarray, weight: np.ndarray, share: np.ndarray, table: np.ndarray) -> np.ndarray:
    """How often each rule is right when it votes, by the fitted posterior."""
    good, weight = posterior(votes, share, table)[:, None], np.asarray(weight, float)[:, None]
    right = ((votes > 0) * good + (votes < 0) * (1 - good)) * weight
    return right.sum(0) / np.maximum(((votes != 0) * weight).sum(0), 1e-300)


NEW_COLUMNS = STATS[:5] + ["base_failed", "quality", "kept"]


def _verdict(docs: DataFrame, threshold: float, text_col: str) -> tuple[DataFrame, str]:
    """``docs`` with a struct of NEW_COLUMNS under a free name."""
    stats, key, name = (free_name(docs, x) for x in ("_stats", "_votes", "_verdict"))
    rules = rule_votes(F.col(stats))
    code = sum(((v + 1) * 3 ** i for i, v in enumerate(rules.values())), F.lit(0)).cast("int")
    counted = docs.select(docs[f"`{text_col}`"].alias(name)).select(stats_column(F.col(name)).alias(stats))
    seen = counted.select(code.alias(key)).groupBy(key).count()
    patterns = {tuple((r[0] // 3 ** i) % 3 - 1 for i in range(len(rules))): r[1] for r in seen.collect()}
    share, chances = fit_rules(dict(sorted(patterns.items())), len(rules))
    # in the order of the code: the first rule varies fastest
    every = np.array([v[::-1] for v in itertools.product((-1, 0, 1), repeat=len(rules))])
    chance = F.array(*[F.lit(float(p)) for p in posterior(every, share, chances)])
    s = F.col(stats)
    scored = docs.withColumn(stats, stats_column(docs[f"`{text_col}`"])).withColumn(key, code)
    quality = F.get(chance, F.col(key))
    failed = (s["n_words"] < 50) | (100 * s["n_repeat_words"] > 50 * s["n_words"])
    scored = scored.withColumn(name, F.struct(
        *[s[x].alias(x) for x in STATS[:5]], failed.alias("base_failed"), quality.alias("quality"),
        (~failed & (quality >= threshold)).alias("kept")))
    return scored.drop(stats, key), name


def score_quality(docs: DataFrame, threshold: float = 0.5, text_col: str = "text") -> DataFrame:
    """Add the counts, the votes' posterior ``quality`` and ``kept`` to every document.

    ``base_failed`` holds for texts under 50 words or with over half of the words
    in repeated 3-word windows; such texts are never kept.  Others are kept if the
    posterior is at least ``threshold``.  One pass counts the vote patterns of all
    texts (at most 3 ** rules rows, whatever the corpus), which alone reach the
    driver; a second pass scores the rows, so no text is shuffled.

    Columns of ``docs`` with the names of the new ones are replaced.

    * null or empty text: all counts 0, base_failed, not kept
    * repeated rows: each row is counted and scored by itself
    * empty table: empty result
    """
    scored, name = _verdict(docs, threshold, text_col)
    return scored.select(*without(scored.drop(name), NEW_COLUMNS), F.col(f"{name}.*"))


def keep_quality(docs: DataFrame, threshold: float = 0.5, text_col: str = "text") -> DataFrame:
    """The documents that ``score_quality`` keeps, with the columns of ``docs``."""
    scored, name = _verdict(docs, threshold, text_col)
    return scored.where(F.col(f"{name}.kept")).drop(name)
