"""Rows and names that the tests of this folder share."""

import os

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
SF = "/root/testdata/sf0.001"

#: nulls, empty, blank, ties and repeated rows
ODD = [(1, None), (2, ""), (3, " \t\n "), (4, "one"), (5, "one two three four"), (6, "one two three four"),
       (None, "one two three four"), (7, "x" * 20_000), (8, "word " * 5_000), (9, "word " * 5_000),
       (9, "word " * 5_000), (9, "other text of the same id"), (10, "a\n\nb\n" * 300), (11, "  padded  line \r\n")]


def frame(spark, rows, schema="doc_id bigint, text string"):
    return spark.createDataFrame(rows, schema)
