"""Signalling messages derived from the `events` table.

Two consecutive event ids form a transaction: even is the request, odd the response. `error`
events count as lost packets and leave their partner alone.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Runs unchanged in Spark SQL and in DuckDB, all but the `timestamp` text.
FIELD_SQL = {
    "id": "event_id",
    "ts": "CAST(ts AS TIMESTAMP)",
    "source_ip": "CASE WHEN event_id % 2 = 0 THEN CONCAT('10.0.0.', CAST(txn % 4 AS STRING)) "
    "ELSE CONCAT('9.0.0.', CAST(txn % 5 AS STRING)) END",
    "dest_ip": "CASE WHEN event_id % 2 = 0 THEN CONCAT('9.0.0.', CAST(txn % 5 AS STRING)) "
    "ELSE CONCAT('10.0.0.', CAST(txn % 4 AS STRING)) END",
    "message_type": "CONCAT(CASE txn % 3 WHEN 0 THEN 'Create Session' WHEN 1 THEN 'Modify Bearer' "
    "ELSE 'Delete Session' END, CASE WHEN event_id % 2 = 0 THEN ' Request' ELSE ' Response' END)",
    "sequence_number": "CAST(txn % 100 AS INT)",
    "imsi": "CASE WHEN event_id % 6 = 0 THEN "
    "CONCAT('45204', LPAD(CAST(user_id AS STRING), 10, '0')) END",
    "msisdn": "CASE WHEN event_id % 6 = 0 THEN "
    "CONCAT('84', LPAD(CAST(user_id AS STRING), 9, '0')) END",
    "teid": "CASE WHEN event_id % 2 = 1 THEN "
    "CONCAT('T', CAST(CAST(FLOOR(txn / 3) AS BIGINT) AS STRING)) END",
    "cause": "CASE WHEN event_id % 2 = 1 THEN (CASE WHEN value < 20 THEN '16' ELSE '64' END) END",
    "user_location": "CASE WHEN event_id % 2 = 0 THEN "
    "CONCAT('TAI-', CAST(user_id % 10 AS STRING)) END",
    "bearer_context": "CASE WHEN txn % 3 = 1 THEN CONCAT('EBI-', CAST(user_id % 8 AS STRING)) END",
    "dpi_ip": "CAST(NULL AS STRING)",
}
TXN_SQL = "CAST(FLOOR(event_id / 2) AS BIGINT)"


def derive_messages(events: DataFrame) -> DataFrame:
    packets = events.where("event_type <> 'error'").withColumn("txn", F.expr(TXN_SQL))
    fields = [F.expr(sql).alias(name) for name, sql in FIELD_SQL.items()]
    return packets.select(
        *fields[:2], F.date_format("ts", "yyyy/MM/dd HH:mm:ss.SSS").alias("timestamp"), *fields[2:]
    )


def event_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive_messages(spark.read.parquet(f"{sf_dir}/events.parquet"))
