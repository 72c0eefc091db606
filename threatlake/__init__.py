"""threatlake — vulnerability and threat-feed analytics as Spark DataFrame jobs.

Every operator is a function ``DataFrame(s) + parameters -> DataFrame``; nothing in the
core path collects to the driver.  Sub-packages:

* ``sources``    – landed-file scans (feeds, NVD, KEV, EPSS), window planning, bindings
* ``functions``  – scalar Column expressions (scores, buckets, JSON projections, URLs, IOCs)
* ``operators``  – stateful table writes (append-if-absent, upsert, snapshot load, cursors)
                   and the request-grammar filter operator
* ``plans``      – query plans: feed QA views, dashboard panels, EPSS analyses, alerting,
                   documented relations, triage commands, run-log rollups
* ``streaming``  – Structured Streaming jobs wrapping the batch operators
"""

from threatlake.session import get_spark, checkpoint_dir

__all__ = ["get_spark", "checkpoint_dir"]
