"""ratewatch: product-pricing snapshot analytics on Spark DataFrames.

Layers:
  functions/  Column -> Column scalar helpers (safe casts, JSON access, text, URLs)
  sources/    readers for landed files, page tables and the table registry
  operators/  parametrised DataFrame -> DataFrame operators (flatten, latest, changes,
              coverage, upsert, drift, quality, collection bookkeeping)
  plans/      compositions of operators into the staging/silver/gold models and reports
  streaming/  incremental (file-stream) variant of the landing ingest
"""

from ratewatch.session import build_session, checkpoint_dir

__all__ = ["build_session", "checkpoint_dir"]
