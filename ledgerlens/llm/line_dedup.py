"""Line deduplication across documents, with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ledgerlens.llm.frames import SPACES, free_name, lower_ascii, without


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _key(line: Column) -> Column:
    return lower_ascii(F.btrim(line, F.lit(SPACES)))


def dedup_lines(docs: DataFrame, min_chars: int = 20, min_docs: int = 3,
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Drop lines whose normalised form is in ``min_docs`` or more documents.

    A line's key is the line without white space at both ends and with A-Z
    lower-cased.  Lines whose key has ``min_chars`` code points or more and is in
    at least ``min_docs`` documents are dropped, except in the largest document
    id that holds the key.

    Lines are exploded to one 128-bit key for each document and distinct line,
    grouped by the key (a partial aggregate absorbs a line that a third of all
    documents hold), and the dropped keys return to their documents, whose
    remaining lines are joined again in their positions.  Lines are compared by
    the two 64-bit halves together; inside one document by the first half.

    Returns the columns of ``docs`` with the new text, and ``n_lines``,
    ``n_dropped`` (bigint); columns of ``docs`` with these names are replaced.

    * null or empty text: one empty line, nothing dropped; a null text stays null
    * null id: the row counts for nothing and keeps its lines
    * rows that repeat an id are one document: they count once, and all keep a
      line if their id is the largest
    * empty table: empty result
    """
    first, second, doc = (free_name(docs, x) for x in ("_key_a", "_key_b", "_doc"))
    a, b = (lambda k: F.xxhash64(k)), (lambda k: F.xxhash64(F.lit(1), k))
    text, ident = docs[f"`{text_col}`"], docs[f"`{id_col}`"]
    # distinct keys of each document: a line that it repeats is one row
    long_keys = F.filter(F.transform(_lines(text), _key), lambda k: F.length(k) >= min_chars)
    held = (docs.where(ident.isNotNull())
            .select(ident.alias(doc), F.explode(F.array_distinct(long_keys)).alias("line"))
            .select(doc, a(F.col("line")).alias(first), b(F.col("line")).alias(second)))
    common = (held.groupBy(first, second)
              .agg(F.count_distinct(doc).alias("n"), F.max(doc).alias("keeper"))
              .where(F.col("n") >= min_docs).drop("n"))
    dropped = (held.join(common, [first, second]).where(F.col(doc) < F.col("keeper"))
               .groupBy(doc).agg(F.collect_set(first).alias(second)))
    joined = docs.join(dropped, ident == dropped[doc], "left")
    kept = F.when(F.col(second).isNull(), _lines(text)).otherwise(F.filter(
        _lines(text), lambda x: ~((F.length(_key(x)) >= min_chars)
                                  & F.array_contains(F.col(second), a(_key(x))))))
    cols = without(docs, ["n_lines", "n_dropped"])
    order = [c for c in docs.columns if c.lower() not in ("n_lines", "n_dropped")]
    return (joined.select(*cols, F.col(second), kept.alias(first))
            .select(*[(F.when(F.col(f"`{c}`").isNull(), None)
                       .when(F.col(second).isNull(), F.col(f"`{c}`"))
                       .otherwise(F.array_join(first, "\n")).alias(c) if c == text_col else F.col(f"`{c}`"))
                      for c in order],
                    F.size(_lines(F.col(f"`{text_col}`"))).cast("bigint").alias("n_lines"),
                    (F.size(_lines(F.col(f"`{text_col}`"))) - F.size(first)).cast("bigint").alias("n_dropped")))
