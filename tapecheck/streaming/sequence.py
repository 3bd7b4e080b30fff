"""Numbering trades within their millisecond while they stream in."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tapecheck.operators.ordering import out_of_order, sequence_in_ms
from tapecheck.streaming.state import BatchTable

# Fixed value: counters older than this behind a symbol's newest event are dropped.
HORIZON_MS = 120_000


class SequenceStage:
    """``foreachBatch`` body that gives every trade its number and an out-of-order flag.

    Counters are kept per (symbol, millisecond), so a symbol that makes up a third of the stream
    still spreads over all tasks. A counter is dropped once it lies ``horizon_ms`` behind its
    symbol's newest event; the horizon must exceed watermark delay plus allowed lateness.
    """

    def __init__(self, base: str, columns: str, tie: str, horizon_ms: int = HORIZON_MS):
        self.tie, self.horizon_ms = tie, horizon_ms
        self.counters = BatchTable(f"{base}/counters", "symbol STRING, event_ms BIGINT, n BIGINT")
        self.out = BatchTable(f"{base}/sequenced", f"{columns}, seq_in_ms INT, out_of_order INT")

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch = batch.drop("seq_in_ms").persist()
        try:
            prior = self.counters.at(spark, batch_id - 1)
            newest = prior.groupBy("symbol").agg(F.max("event_ms").alias("prior_max_ms"))
            numbered = out_of_order(sequence_in_ms(batch, self.tie), self.tie)
            done = (
                numbered.join(prior, ["symbol", "event_ms"], "left")
                .join(newest, "symbol", "left")
                .withColumns(
                    {
                        "seq_in_ms": (F.col("seq_in_ms") + F.coalesce("n", F.lit(0))).cast("int"),
                        "out_of_order": F.coalesce(
                            F.col("event_ms") < F.greatest("max_before_ms", "prior_max_ms"), F.lit(False)
                        ).cast("int"),
                    }
                )
            )
            names = [c.split()[0] for c in self.out.schema.split(", ")]
            self.out.write(done.select(*names), batch_id)
            counts = prior.unionByName(
                batch.groupBy("symbol", "event_ms").agg(F.count(F.lit(1)).alias("n"))
            ).groupBy("symbol", "event_ms").agg(F.sum("n").alias("n"))
            top = counts.groupBy("symbol").agg(F.max("event_ms").alias("top_ms"))
            self.counters.write(
                counts.join(top, "symbol").filter(F.col("event_ms") >= F.col("top_ms") - self.horizon_ms).drop("top_ms"),
                batch_id,
            )
            self.counters.forget(spark, batch_id)
        finally:
            batch.unpersist()


class Numbering(StatefulProcessor):
    """Counters of one (symbol, time cell), kept in the engine's state store.

    A cell closes once the arrival watermark has passed its end by the horizon: a timer then drops its counters, and
    records that still come for it are late. They are returned without a number, since theirs may have been given away.
    """

    def __init__(self, cell_ms: int, horizon_ms: int):
        self.cell_ms, self.horizon_ms = cell_ms, horizon_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.counts = handle.getMapState("counts", "event_ms bigint", "n bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        symbol, cell = key
        closes = (cell + 1) * self.cell_ms + self.horizon_ms
        batch = pd.concat(list(rows)).sort_values(["ingest_ms", "tie"])
        late = closes <= timerValues.getCurrentWatermarkInMs()
        number = pd.Series(pd.NA, index=batch.index, dtype="Int32")
        if not late:
            self.handle.registerTimer(closes)
            number = batch.groupby("event_ms").cumcount()
            for at, n in batch.groupby("event_ms").size().items():
                had = self.counts.getValue((int(at),))[0] if self.counts.containsKey((int(at),)) else 0
                number = number.where(batch["event_ms"] != at, number + had)
                self.counts.updateValue((int(at),), (int(had + n),))
        yield pd.DataFrame({"tie": batch["tie"], "symbol": symbol, "event_ms": batch["event_ms"], "seq_in_ms": number.astype("Int32"), "late": late})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.counts.clear()
        return iter(())

    def close(self) -> None:
        pass


def numbered(trades: DataFrame, tie: str, cell_ms: int, horizon_ms: int = HORIZON_MS, arrival_delay_ms: int = 0) -> DataFrame:
    """(tie, symbol, event_ms, seq_in_ms, late) of a stream: each trade's number in its millisecond.

    The key is (symbol, time cell), so a busy symbol is spread over its cells and nothing is joined. The watermark follows the
    *arrival* time, which (unlike event time) never runs backwards by more than ``arrival_delay_ms``: no record is dropped
    by the engine, and late ones are part of the result. Needs ``stream_session(spark, several_states=True)``.
    """
    rows = trades.select(
        "symbol", "event_ms", "ingest_ms", F.col(tie).alias("tie"), F.expr(f"event_ms div {cell_ms}").alias("cell"),
        F.timestamp_millis("ingest_ms").alias("arrived"),
    )
    rows = rows.withWatermark("arrived", f"{arrival_delay_ms} milliseconds")
    return rows.groupBy("symbol", "cell").transformWithStateInPandas(
        Numbering(cell_ms, horizon_ms), "tie bigint, symbol string, event_ms bigint, seq_in_ms int, late boolean", "Append", "EventTime"
    )
