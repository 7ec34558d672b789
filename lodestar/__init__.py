"""lodestar: Spark-native predictive table analytics.

Ingest raw tables, profile and clean them, build feature tables with joins,
group statistics and text/time expressions, encode/scale/balance/split them,
train and rank Spark ML classifiers, and score rows in batch or on a stream.
Every operator is a DataFrame -> DataFrame function.
"""

__version__ = "0.1.0"
