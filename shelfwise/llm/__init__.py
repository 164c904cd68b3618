"""Training-data operators: one module per operator, each usable alone.

Every operator takes and returns DataFrames and has its own general
interface; ``queries`` holds the thin registered forms and ``sql`` their
DuckDB counterparts.  Nothing outside this package imports it except the
guarded block in ``__spark_entry__``.
"""
