"""larder — supermarket analytics as Spark DataFrame jobs.

Layers:
  functions/  Column-returning helpers (text cleaning, keys, money, dates, bands)
  sources/    raw-table readers, schemas, the test-data adapter, run-log reader
  operators/  reusable DataFrame operators (lookback, latest snapshot, windows,
              merge/upsert, publishing, data-quality checks, top-k)
  plans/      the models: staging -> intermediate -> facts/dimensions -> reports,
              plus alerts and the full / incremental pipelines
"""

from larder.params import Params

__all__ = ["Params"]
