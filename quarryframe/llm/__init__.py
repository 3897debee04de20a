"""Training-data operators: one module for each operator, `queries` for the registered queries.

Nothing outside this subpackage (but for `corpus_pipeline.py` and the guarded import in `__spark_entry__.py`) uses it.
"""
