"""tidemark: incremental reporting tables on Spark.

Main entry points:

* ``tidemark.plans.ingest.ingest_source`` / ``ingest_all`` - watermark-based pulls into bronze change logs
* ``tidemark.operators.staging`` - newest state per key, scoped
* ``tidemark.operators.marts`` - ``mart_penetration``, ``mart_phone_quality``
* ``tidemark.operators.quality`` / ``reconcile`` - checks, freshness, reconciliation
* ``tidemark.operators.layout`` / ``changelog`` - compaction, Z-order, retention, upsert
* ``tidemark.operators.textscan`` - secret-shaped string scan
* ``tidemark.streaming.latest_state`` - latest-state tables kept up to date by a stream
"""

__version__ = "0.1.0"
