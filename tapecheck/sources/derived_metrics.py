"""Metric samples derived from the trades: one sample per trade and metric, with counters that
grow, pause and restart, and gauges that drop out."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

# metric -> (labels, value); plain SQL expressions over event_id, recv_seq, kafka_partition.
# ``div`` is integer division.
METRICS: dict[str, tuple[dict[str, str], str]] = {
    "trades_total": ({"instance": "CASE WHEN event_id % 50 = 0 THEN 'ingest-1' ELSE 'ingest-0' END"}, "recv_seq"),
    "connected": ({"instance": "'ingest-0'"}, "CASE WHEN (event_id div 20) % 12 = 0 THEN 0 ELSE 1 END"),
    "candle_rows_total": ({"task": "kafka_partition"}, "(event_id div 100) * 100"),
    "failed_checkpoints_total": (
        {"job_id": "event_id div 2500"}, "50 * (event_id div 500) + least(event_id % 500, 250) div 5"),
    "job_uptime_ms": ({"job_id": "event_id div 2500"}, "(event_id % 2500) * 240000"),
    "job_restarts_total": (
        {"job_name": "'candles'", "attempt": "event_id % 2"}, "10 * (event_id div 1000) + least(event_id % 1000, 30) div 3"),
    "late_dropped_total": ({"task": "kafka_partition"}, "500 * (event_id div 400) + least(event_id % 400, 50) * 10"),
    "group_lag": (
        {"grp": "CASE WHEN event_id % 2 = 0 THEN 'candles' ELSE 'shadow' END", "part": "kafka_partition"},
        "CASE WHEN event_id % 89 = 0 THEN -1 ELSE (event_id % 1000) * 60 END"),
    "topic_end_offset": ({"topic": "'trades.raw'", "partition": "event_id % 7"}, "event_id"),
    "group_offset": (
        {"grp": "CASE WHEN event_id % 2 = 0 THEN 'candles' ELSE 'shadow' END", "topic": "'trades.raw'", "partition": "event_id % 7"},
        "CASE WHEN event_id % 7 >= 5 AND (event_id div 700) % 2 = 0 THEN -1 ELSE event_id END"),
    "reconnects_total": ({"instance": "'ingest-0'"}, "event_id div 333"),
    "dead_letters_total": ({"outcome": "CASE event_id % 3 WHEN 0 THEN 'written' WHEN 1 THEN 'failed' ELSE 'dropped' END"}, "event_id div 30"),
    "records_out_total": ({"subtask": "kafka_partition"}, "event_id"),
}


def metric(trades: DataFrame, name: str) -> DataFrame:
    """Samples of one metric, labels as columns."""
    labels, value = METRICS[name]
    return trades.select(
        "event_id", F.col("ingest_ms").alias("ts_ms"),
        *[F.expr(e).cast("string").alias(k) for k, e in labels.items()],
        F.expr(value).cast("double").alias("value"),
    )


def metric_samples(trades: DataFrame) -> DataFrame:
    """All metrics in the stored form (ts, metric, labels, value). One pass over the trades."""
    cells = []
    for name, (labels, value) in METRICS.items():
        pairs = [x for k, e in labels.items() for x in (F.lit(k), F.expr(e).cast("string"))]
        cells.append(
            F.struct(F.lit(name).alias("metric"), F.create_map(*pairs).alias("labels"), F.expr(value).cast("double").alias("value"))
        )
    from tapecheck.functions.timecols import wall_clock

    return trades.select("event_id", wall_clock("ingest_ms").alias("ts"), F.explode(F.array(*cells)).alias("m")).select(
        "event_id", "ts", "m.*"
    )
