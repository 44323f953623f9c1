"""ledgerlens: account-ledger analytics on Spark.

Turns (labelled accounts, account profiles, directed transactions) into
per-account features, profiles any table, and fits/ranks accounts by their
likelihood of becoming inactive with Spark ML.  Everything is lazy DataFrame
code over built-in expressions.

Layout
------
sources/    schemas, file scans and sinks, stand-in views over the test tables
functions/  column expressions (zero-safe ratios, safe logs, day differences)
operators/  ledger aggregation, dormant neighbours, scaling, encoding,
            exact quantiles, profiling, distribution tables, top-k
plans/      composite pipelines: base features, model features, scoring
ml/         Spark ML model operators (forests, linear models, search, PCA)
"""

from ledgerlens.session import checkpoint_dir, get_session, materialize

__all__ = ["checkpoint_dir", "get_session", "materialize"]
