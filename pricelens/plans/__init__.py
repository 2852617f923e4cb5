"""Named queries.

Each ``q_*`` module registers queries with ``registry.register(name,
inventory, sql)``: a builder ``(spark, sf_dir) -> DataFrame`` plus, where SQL
can express it, the DuckDB oracle text built from ``sqlviews``.  The
``inventory`` string lists the survey operator ids the query exercises
(``COVERAGE.md``).
"""
