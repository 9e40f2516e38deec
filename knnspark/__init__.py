"""knnspark: nearest-neighbour search and vector clustering as Spark DataFrame jobs.

Vectors live in ``ARRAY<DOUBLE>`` columns.  Base sets are ``(id BIGINT, v ARRAY<DOUBLE>)``
and query sets are ``(qid BIGINT, qv ARRAY<DOUBLE>)``.  Indexes are ordinary tables,
candidate generation is an equi-join, and ranking is a windowed top-k.
"""

from knnspark.session import checkpoint_dir, get_spark, prepare

__all__ = ["get_spark", "checkpoint_dir", "prepare"]
