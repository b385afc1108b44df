"""threadlens: chat checkpoint analytics as plain Spark DataFrame functions.

Every operator takes DataFrames and returns a DataFrame; nothing is collected
to the driver beyond small, bounded values.

* ``operators``  enrich, scd2, metrics, expectations, monitor, checks, reports, upkeep
* ``sources``    by-name CSV parsing with rescue; adapters for the test tables
* ``streaming``  incremental ingestion and streaming SCD2 (Structured Streaming)
* ``plans``      layer wiring, the refresh job, SQL views, registered queries

See README.md for the layer model and the operator list.
"""

from threadlens.session import build_session, work_dir

__all__ = ["build_session", "work_dir"]
