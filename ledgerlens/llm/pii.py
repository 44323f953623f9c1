"""Personal data by candidate gradient boosting, with DataFrame functions and Spark ML only.

Base patterns (email, ip, card, phone) always count.  Beside them, wide
generators propose overlapping candidate spans; boosted trees, trained on
candidates that a base pattern confirms against those that none does (and on a
short fixed list of known ones, so that small corpora have both), score each
candidate by its format and context, and a threshold calibrated on held-out
candidates selects further spans.  The fitted trees are turned into column
expressions, so texts are scored where they are read, without a shuffle.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ledgerlens.llm.frames import free_name, staged, without

#: Kinds in the order in which spans are listed.
KINDS = ["email", "ip", "card", "phone"]

_LOCAL, _LABEL = "[A-Za-z0-9._%+-]", "[A-Za-z0-9-]"
# The base patterns, each written so that no step recurses or goes back over a long run:
# a match starts where its run starts or where the last match ended.
_EMAIL = (rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@{_LABEL}++(?=\.{_LABEL})[A-Za-z0-9.-]+?"
          rf"(?<={_LABEL})(?!{_LABEL})(?!\.{_LABEL})")
_IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
_CARD = r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){12,18}(?![ -]?[0-9])"
_PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"

# The generators: wide, and free to overlap with each other.
_GENERATORS = {
    "digits": r"(?<![0-9A-Za-z])\(?[0-9](?:[ ().-]{0,2}[0-9]){6,18}(?![0-9A-Za-z])",
    "dotted": r"(?<![0-9A-Za-z.])[0-9]{1,4}(?:\.[0-9]{1,4}){2,5}(?![0-9A-Za-z])",
    "at": rf"(?<!{_LOCAL}){_LOCAL}{{1,64}}(?: ?@ ?| ?[\[(]at[\])] ?){_LABEL}{{1,63}}"
          rf"(?:(?: ?\. ?| ?[\[(]dot[\])] ?){_LABEL}{{1,63}}){{1,4}}(?!{_LABEL})",
}
_KIND_OF = {"digits": "phone", "dotted": "ip", "at": "email"}
_CONTEXT = r"(?i)(tel|phone|call|fax|mobil|cell|card|visa|mail|contact|addr|host|server|\bip\b)[^\n]{0,20}$"

#: Pairs of a gap and a match that one fold goes through.
FOLD = 64

_HIT = "struct<start:int,end:int,hit:string,before:string,lead:string>"


def _hits(text: Column, pattern: str, needs: Column) -> Column:
    """All matches with their positions: the gaps between matches and the matches alternate, so a
    fold over their lengths gives every start.  The last element holds the text after the last match.

    A fold copies its array at every step, so it runs over slices of FOLD pairs, one after another; the
    steps of a text with n matches copy n * FOLD + (n / FOLD) ** 2 elements, not n ** 2."""
    parts = F.zip_with(F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
                       lambda gap, hit: F.struct(gap.alias("gap"), hit.alias("hit")))
    nothing = F.array().cast(f"array<{_HIT}>")
    state = f"struct<at:int,out:array<{_HIT}>>"

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.length(x["gap"])
        end = start + F.coalesce(F.length(x["hit"]), F.lit(0))
        one = F.struct(start.alias("start"), end.alias("end"), x["hit"].alias("hit"),
                       F.right(x["gap"], F.lit(32)).alias("before"), F.left(x["gap"], F.lit(16)).alias("lead"))
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(one)).alias("out")).cast(state)

    def follow(done: Column, own: Column) -> Column:
        at = F.coalesce(F.try_element_at(done, F.lit(-1))["at"], F.lit(0))
        start = F.struct(at.alias("at"), nothing.alias("out")).cast(state)
        return F.concat(done, F.array(F.aggregate(own, start, step))).cast(f"array<{state}>")

    sliced = F.transform(F.sequence(F.lit(0), F.floor((F.size(parts) - 1) / FOLD).cast("int")),
                         lambda k: F.slice(parts, k * FOLD + 1, F.lit(FOLD)))
    folded = F.aggregate(sliced, F.array().cast(f"array<{state}>"), follow)
    return F.when(needs, F.flatten(F.transform(folded, lambda x: x["out"]))).otherwise(nothing)


def _digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def _octets_fit(c: Column) -> Column:
    return F.forall(F.split(c, r"\."), lambda p: F.coalesce(
        F.regexp_replace(p, "^0+", "").try_cast("int"),
        F.when(F.regexp_replace(p, "^0+", "") == "", F.lit(0)).otherwise(F.lit(999))) <= 255)


def _luhn(c: Column) -> Column:
    return F.call_function("luhn_check", _digits(c))


def _base(text: Column) -> Column:
    """Base spans: array of (rank of the kind, start, end)."""
    digit = F.regexp_like(text, F.lit("[0-9]"))
    checks = {
        "email": (_EMAIL, F.contains(text, F.lit("@")), lambda h: F.lit(True)),
        "ip": (_IP, digit, _octets_fit),
        "card": (_CARD, digit, _luhn),
        "phone": (_PHONE, F.contains(text, F.lit("+")), lambda h: F.length(_digits(h)).between(9, 15)),
    }

    def spans(rank: int, pattern: str, needs: Column, ok) -> Column:
        good = F.filter(_hits(text, pattern, needs), lambda x: x["hit"].isNotNull() & ok(x["hit"]))
        return F.transform(good, lambda x: F.struct(
            F.lit(rank).alias("kind"), x["start"].alias("start"), x["end"].alias("end")))

    return F.concat(*[spans(k, *checks[name]) for k, name in enumerate(KINDS)])


FEATURES = ["generator", "length", "digits", "letters", "dots", "hyphens", "spaces", "brackets", "groups",
            "last_group", "luhn", "octets", "context", "near_digits", "glued"]


def _features(x: Column, after: Column, generator: int) -> list[Column]:
    hit, before = x["hit"], x["before"]
    n = lambda chars: F.length(F.regexp_replace(hit, f"[^{chars}]", ""))
    flag = lambda c: F.when(c, 1.0).otherwise(0.0)
    groups = F.filter(F.split(hit, "[^0-9A-Za-z]+", -1), lambda g: g != "")
    return [
        F.lit(float(generator)), F.length(hit), n("0-9"), n("A-Za-z"), n("."), n(r"\-"), n(" "), n(r"()\[\]"),
        F.size(groups), F.length(F.element_at(groups, -1)),
        flag(n("0-9").between(13, 19) & _luhn(hit)), flag((n("0-9.") == F.length(hit)) & (n(".") == 3) & _octets_fit(hit)),
        flag(F.regexp_like(before, F.lit(_CONTEXT))), F.length(_digits(F.concat(before, after))),
        flag(F.regexp_like(F.right(before, F.lit(1)), F.lit(r"[\w@]")) | F.regexp_like(F.left(after, F.lit(1)), F.lit(r"[\w@]"))),
    ]


_CANDIDATE = "struct<kind:int,start:int,end:int,x:array<double>>"


def _candidates(df: DataFrame, text: Column) -> tuple[DataFrame, Column]:
    """``df`` with one column of matches for each generator, and an expression of all candidates."""
    needs = {"digits": F.regexp_like(text, F.lit("[0-9]")), "dotted": F.regexp_like(text, F.lit(r"[0-9]\.[0-9]")),
             "at": F.regexp_like(text, F.lit(r"@|[\[(]at[\])]"))}
    def proposed(c: str, g: int, kind: int) -> Column:
        def one(x: Column, i: Column) -> Column:
            values = _features(x, F.coalesce(F.get(F.col(c), i + 1)["lead"], F.lit("")), g)
            rank = F.when(values[10] == 1.0, KINDS.index("card")).otherwise(kind) if g == 0 else F.lit(kind)
            return F.when(x["hit"].isNotNull(), F.struct(
                rank.alias("kind"), x["start"].alias("start"), x["end"].alias("end"),
                F.array(*[v.cast("double") for v in values]).alias("x")).cast(_CANDIDATE))

        return F.filter(F.transform(F.col(c), one), lambda y: y.isNotNull())

    found = []
    for g, (name, pattern) in enumerate(_GENERATORS.items()):
        c = free_name(df, f"_hits_{name}")
        df = df.withColumn(c, _hits(text, pattern, needs[name]))
        found.append(proposed(c, g, KINDS.index(_KIND_OF[name])))
    return df, F.concat(*found)


def _overlaps(c: Column, spans: Column) -> Column:
    return F.exists(spans, lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"]))


@dataclass
class PiiModel:
    """Trees as nested (feature, threshold, left, right) or leaf values, with their weights."""

    trees: list = field(default_factory=list)
    weights: list[float] = field(default_factory=list)
    margin: float = float("inf")  # candidates score above this to be selected
    held_out_precision: float | None = None
    held_out_recall: float | None = None

    def score(self, x: Column) -> Column:
        """The boosted margin of a feature array."""
        def walk(node) -> Column:
            if not isinstance(node, tuple):
                return F.lit(float(node))
            f, threshold, left, right = node
            return F.when(F.get(x, F.lit(f)) <= F.lit(threshold), walk(left)).otherwise(walk(right))

        return sum((F.lit(w) * walk(t) for t, w in zip(self.trees, self.weights)), F.lit(0.0))


def _tree(node):
    if node.getClass().getSimpleName() == "LeafNode":
        return node.prediction()
    split = node.split()
    return split.featureIndex(), split.threshold(), _tree(node.leftChild()), _tree(node.rightChild())


def read_trees(model: GBTClassificationModel) -> tuple[list, list[float]]:
    return [_tree(t._call_java("rootNode")) for t in model.trees], list(model.treeWeights)


# What the trees know before they see a corpus: lines whose candidates are personal data, and lines whose are not.
_PRIOR = {
    1.0: """Call me on 743-555-3824 after six.|Phone (212) 555-0147, ask for Ann.|Tel: 030 1234567|Fax 020 7946 0958 or by mail
        Mobile 0171 2345678|our cell is 415.555.0132|phone: +1 202 555 0186|+49 30 9876543 is the office|tel. 555-867-5309
        Contact 0044 20 7946 0321|dial (030) 765 4321 and wait|Call +33 1 23 45 67 89 today|write to ann.lee@example.com
        mail: bob@mail.example.org|j.doe (at) example (dot) com|Contact sue [at] firm [dot] net please|info@shop.example
        e-mail kim_99 @ example.org|address tom.b@uni.example.edu|ops (at) host.example.net|reach max+news@example.co
        card 4111 1111 1111 1111|Visa 4012-8888-8888-1881|paid by card 5555555555554444|5105 1051 0510 5100 on file
        card number 378282246310005|host 192.168.17.44 is down|from 10.200.31.7 port 22|server at 172.16.254.101
        ip 203.0.113.77|login from 198.51.100.23 failed|address 8.8.4.4""",
    0.0: """on 2021-03-04 10:22 the log ends|between 1914-1918 and 1939-1945|released 2019.11.30 and later|12.05.1998 was a Tuesday
        version 4.18.0 of the library|see section 3.2.1 above|chapter 12.4.7|release 2.0.13.|about 12500000 rows|7800000000 people
        order 0000123456|ISBN 978-3-16-148410-1|item 55-1234-987 left|300.400.500.600 is a size|score 1000.2000.3000
        at 1234567 units|serial 20200102030405|the years 1998 1999 2000|pages 101 102 103|pi is 3.1415926|1.618033988 by eye
        10 000 000 in all|1-2-3-4-5-6-7 done|(2020) 1234 (2021) 4321|build 20231107|Lunch @ noon. Then home|meet (at) five. Bring food
        we sat [at] home. It rained|sold @ market. Nobody came|total 1 500 000.00 paid|999.999.999.999|rev 77.88.99""",
}


def _prior(spark: SparkSession, seed: int) -> DataFrame:
    lines = [(label, line.strip()) for label, text in _PRIOR.items() for line in text.replace("\n", "|").split("|")]
    df, found = _candidates(spark.createDataFrame(lines, "label double, text string"), F.col("text"))
    return df.select("label", "text", F.explode(found).alias("c")).select(
        "label", F.xxhash64(F.lit(seed), "text", "c.start", "c.end").alias("draw"), F.col("c.x").alias("x"))


def _sampled(rows: DataFrame, per_class: int) -> DataFrame:
    """Rows that hold the ``per_class`` smallest draws of each class, and few others.

    The classes are counted, and a row goes on if its draw is below the share of the range
    in which about twice as many rows as wanted lie: no task sends more than its part of them.
    """
    counts = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}  # 2 rows
    low = F.lit(False)
    for label, n in counts.items():
        share = min(1.0, 2.0 * per_class / n)
        most = min(int(-2 ** 63 + share * 2 ** 64), 2 ** 63 - 1)
        low = low | ((F.col("label") == label) & (F.col("draw") <= F.lit(most)))
    below = staged(rows.where(low), "pii-draws")
    held = {r["label"]: r["n"] for r in below.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if any(held.get(label, 0) < min(n, per_class) for label, n in counts.items()):
        return rows  # unlikely: the draws are not spread evenly, as where many rows repeat
    return below


def _counted(rows: DataFrame) -> DataFrame:
    """(label, held, x, n): how many ``rows`` (label, draw, x) have each feature vector, the held-out third
    of the draws apart.  All rows count; equal ones are one row with their number."""
    held = (F.pmod(F.col("draw"), F.lit(3)) == 0).alias("held")
    return rows.groupBy("label", held, "x").agg(F.count("*").alias("n"))


def fit_pii(docs: DataFrame, sample: int | None = None, least: int = 50, precision: float = 0.98, rounds: int = 10,
            depth: int = 3, text_col: str = "text", id_col: str = "doc_id", seed: int = 7) -> PiiModel:
    """Train the trees on all candidates, calibrate the threshold on a held-out third of them.

    Candidates are proposed over all texts; a candidate that overlaps a base span
    is a positive.  Candidates with equal features and labels are counted, and a
    feature vector weighs as much as candidates have it, so no candidate is left
    out of the trees or the threshold (unless a caller asks for a trial on a
    ``sample`` of about so many, half of each class).  The trees choose among all values that a feature takes.  The candidates of a fixed list
    of lines are always added as a prior, which weighs ``least`` rows in each
    class: with few rows or none it decides, with many it does not matter.  The
    threshold is the smallest margin from which on the share of positives among
    held-out candidates is at least ``precision``.
    """
    spark = docs.sparkSession
    text = F.coalesce(docs[f"`{text_col}`"], F.lit(""))
    df = docs.select(docs[f"`{id_col}`"].alias("doc"), text.alias("text"))
    df, found = _candidates(df.withColumn("base", _base(F.col("text"))), F.col("text"))
    rows = (df.select("doc", "base", F.explode(found).alias("c"))
            .select(F.when(_overlaps(F.col("c"), F.col("base")), 1.0).otherwise(0.0).alias("label"),
                    F.xxhash64(F.lit(seed), "doc", "c.start", "c.end").alias("draw"), F.col("c.x").alias("x")))
    if sample is not None:
        rows = _sampled(rows, max(1, sample // 2))
    prior = _prior(spark, seed)
    in_class = F.lit(1)
    for r in prior.groupBy("label").agg(F.count("*").alias("n")).collect():  # 2 rows
        in_class = F.when(F.col("label") == r["label"], r["n"]).otherwise(in_class)
    known = _counted(prior).withColumn("weight", F.col("n") * F.lit(float(least)) / in_class)
    counted = staged(_counted(rows).withColumn("weight", F.col("n").cast("double")).union(known), "pii-counted")
    flat = counted.select("label", "held", "weight", *[F.get("x", F.lit(i)).alias(n) for i, n in enumerate(FEATURES)])
    vectors = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(flat).where(~F.col("held"))
    # Spark ML takes the thresholds to try from a sample of max(10000, bins ** 2) rows: with these bins, from all
    bins = max(32, math.isqrt(vectors.count()) + 1)
    fitted = GBTClassifier(featuresCol="features", labelCol="label", weightCol="weight", maxIter=rounds, maxDepth=depth,
                           maxBins=bins, seed=seed).fit(vectors)
    trees, weights = read_trees(fitted)
    model = PiiModel(trees, weights)
    test = counted.where("held").select("label", "weight", F.round(model.score(F.col("x")), 6).alias("m"))
    # at most one row for each combination of leaves
    by_margin = (test.groupBy("m").agg(F.sum("weight").alias("n"), F.sum(F.col("label") * F.col("weight")).alias("good"))
                 .orderBy(F.desc("m")).collect())
    n = good = 0
    positives = sum(r["good"] for r in by_margin)
    for r in by_margin:
        n, good = n + r["n"], good + r["good"]
        if r["m"] > 0 and good >= precision * n:
            model.margin, model.held_out_precision = r["m"], good / n
            model.held_out_recall = good / positives if positives else None
    return model


def find_pii(docs: DataFrame, model: PiiModel | None = None, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """Add ``pii_base`` and ``pii``: arrays of (kind, start, end), code points, end exclusive, by kind
    as in ``KINDS``, then start.  ``pii`` holds the base spans and the candidates that the model
    selects and that overlap no base span; of equal spans one is kept.

    Without ``model`` one is fitted on ``docs`` (see ``fit_pii``).  One map over the rows.

    * null or empty text: no spans
    * repeated rows: each by itself; empty table: empty result
    * columns of ``docs`` with these names are replaced
    """
    model = fit_pii(docs, text_col=text_col, id_col=id_col) if model is None else model
    order = [c for c in docs.columns if c.lower() not in ("pii", "pii_base")]
    df = docs.select(*without(docs, ["pii", "pii_base"]))
    body, base = free_name(df, "_body"), free_name(df, "_base")
    df = df.withColumn(body, F.coalesce(docs[f"`{text_col}`"], F.lit("")))
    df = df.withColumn(base, _base(F.col(body)))
    every = F.col(base)
    if model.trees:
        df, found = _candidates(df, F.col(body))
        added = F.filter(found, lambda c: (F.round(model.score(c["x"]), 6) >= model.margin)
                         & ~_overlaps(c, F.col(base)))
        every = F.concat(F.col(base), F.transform(added, lambda c: F.struct(
            c["kind"].alias("kind"), c["start"].alias("start"), c["end"].alias("end"))))
    kinds = F.array(*map(F.lit, KINDS))
    named = lambda spans: F.transform(F.array_sort(F.array_distinct(spans)), lambda s: F.struct(
        F.get(kinds, s["kind"]).alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    return df.select(*[F.col(f"`{c}`") for c in order], named(F.col(base)).alias("pii_base"), named(every).alias("pii"))


def redact_pii(docs: DataFrame, model: PiiModel | None = None, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``docs`` with every span of ``find_pii`` replaced by its kind in brackets; overlapping spans
    become one mark.  A null text stays null."""
    keep = free_name(docs, "_text")
    found = find_pii(docs.select(docs[f"`{text_col}`"].alias(keep), *[docs[f"`{c}`"] for c in docs.columns]),
                     model, text_col, id_col)
    spans = F.array_sort(F.transform("pii", lambda s: F.struct(s["start"].alias("a"), s["end"].alias("b"),
                                                              s["kind"].alias("kind"))))
    zero = F.struct(F.lit(0).alias("at"), F.lit("").alias("out")).cast("struct<at:int,out:string>")
    cut = F.aggregate(spans, zero, lambda acc, s: F.when(s["a"] < acc["at"], F.struct(
        F.greatest(acc["at"], s["b"]).alias("at"), acc["out"].alias("out"))).otherwise(F.struct(
            s["b"].alias("at"), F.concat(acc["out"], F.substring(F.col(keep), acc["at"] + 1, s["a"] - acc["at"]),
                                         F.lit("["), s["kind"], F.lit("]")).alias("out"))),
        lambda acc: F.concat(acc["out"], F.substring(F.col(keep), acc["at"] + 1, F.length(keep))))
    return found.select(*[cut.alias(c) if c == text_col else F.col(f"`{c}`")
                          for c in found.columns if c not in (keep, "pii", "pii_base")])
