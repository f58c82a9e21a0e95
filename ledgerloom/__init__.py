"""ledgerloom: ledger- and passenger-style table workloads expressed as Spark jobs.

Everything here is DataFrame / Spark SQL / MLlib code; Catalyst plans it and
Spark executes it.  Sub-packages:

* ``sources``   - delimited text readers/writers, locale-tolerant cell typing,
                  the distributed ledger generator, Parquet sink.
* ``operators`` - keyed tables on versioned Parquet, row indexes, layout
                  helpers (repartition, persist, size-checked broadcast, explain).
* ``functions`` - column expressions (cell typing, defaults, safe casts).
* ``plans``     - the end-to-end flows (ledger join/average, SQL text,
                  update, passenger count, decision tree) and the query registry.
"""

from ledgerloom.session import build_session, scratch_path, ensure_checkpoint_dir

__all__ = ["build_session", "scratch_path", "ensure_checkpoint_dir"]
