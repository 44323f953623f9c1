"""Training-data operators over `documents`, `pages` and `benchmark`.

Nothing outside this package imports it (``corpus_pipeline.py`` counts as part
of it), so it can be removed without touching the rest of the library.
"""
