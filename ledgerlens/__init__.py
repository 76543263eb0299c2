"""ledgerlens: labelled-transaction risk scoring expressed as Spark plans.

Subpackages
-----------
sources    schemas, table readers, the ``txn`` fixture, files and metrics I/O
functions  column expressions (hash coin, guarded ratios, text, distances)
operators  sampling, features, models, anomaly detector, evaluation, scoring,
           explanation columns
plans      end-to-end training plan and the query catalog with oracle SQL
streaming  Structured Streaming scoring
"""

__all__ = ["sources", "functions", "operators", "plans", "streaming"]
