"""tessera — corpus curation and evaluation-data operators on Spark.

Every operator is a function ``DataFrame -> DataFrame`` (plus explicit
parameters) built from public PySpark APIs.  Sub-packages:

* ``functions``  — Column-level helpers (keyed hashing, text measures,
  language cascades) and the fixed reference values.
* ``sources``    — scans and sinks (JSONL, JSON arrays, text trees,
  shards, sidecars).
* ``operators``  — table operators: quality filters, dedup, sampling,
  sequences/packing, tokenisation, prompts, teacher accounting,
  evaluation metrics, logit scoring, run metrics.
* ``plans``      — reusable multi-stage plans (distributed prefix scan,
  corpus report, label propagation) and the driver-table adapters.
* ``streaming``  — Structured Streaming versions of the run monitors.
"""

from tessera.session import checkpoint_dir, get_session

__all__ = ["get_session", "checkpoint_dir"]
