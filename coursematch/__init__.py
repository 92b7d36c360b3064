"""coursematch: which offered courses satisfy which degree sub-requirements, as Spark jobs.

Layers:

* ``sources``   – schemas, readers (parquet / CSV / JDBC), domain views derived from the
                  driver tables, and the partitioned CSV sink.
* ``functions`` – column expressions (code maps, term codes, code-set predicates).
* ``operators`` – general table operators usable on any DataFrame (effective dating,
                  running cutoff, lag marker, interval-overlap join, wildcard join,
                  keyed deduplication, character explode).
* ``plans``     – the course-matching steps composed from the above.
* ``llm``       – training-data operators, used by nothing else here.
"""

from coursematch.config import build_session, checkpoint_dir, tune_session

__all__ = ["build_session", "checkpoint_dir", "tune_session"]
