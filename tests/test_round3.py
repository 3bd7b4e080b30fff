"""Findings of the third review."""

import duckdb
import pytest

from __spark_entry__ import oracle_sql, queries
from tapecheck.plans.queries_streaming import _records, _run, _with_block
from tapecheck.settings import shared_dir
from tapecheck.sources import derived as dv
from tapecheck.streaming import candles as sc, job, sinks
from tapecheck.streaming.sequence import numbered
from tests.oracle import differences


class DefaultStore:
    """The session of a cluster that names no state store."""

    def __init__(self, spark):
        self.spark, self.conf = spark, spark.conf

    def newSession(self):
        s = self.spark.newSession()
        s.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider")
        return s


def test_numbering_brings_its_state_store(spark):
    base = shared_dir(spark, "numbers")
    rows = [(0, "A", 1000, 1000), (1, "A", 1000, 1001), (2, "B", 1000, 1002)]
    spark.createDataFrame(rows, "id BIGINT, symbol STRING, event_ms BIGINT, ingest_ms BIGINT").coalesce(1).write.json(f"{base}/in")
    session = sc.stream_session(DefaultStore(spark), several_states=True)
    stream = session.readStream.schema("id BIGINT, symbol STRING, event_ms BIGINT, ingest_ms BIGINT").json(f"{base}/in")
    sc.to_batches(numbered(stream, "id", cell_ms=10_000), sinks.by_batch(f"{base}/out"), f"{base}/ck").awaitTermination()
    got = {r.tie: r.seq_in_ms for r in spark.read.parquet(f"{base}/out").collect()}
    assert got == {0: 0, 1: 1, 2: 0}


@pytest.fixture(scope="module")
def crowded(tmp_path_factory, sf_dir):
    """One hour of events, a few seconds apart: nothing closes in it."""
    d = str(tmp_path_factory.mktemp("crowded"))
    duckdb.sql(
        f"""COPY (SELECT event_id, TIMESTAMP '2024-01-01 00:00:00.5' + to_seconds(CAST(event_id * 3 AS DOUBLE)) AS ts, user_id, event_type, value, props
            FROM '{sf_dir}/events.parquet' WHERE event_id < 900) TO '{d}/events.parquet'"""
    )
    return d


@pytest.mark.parametrize("name", ["str19_stream_sessions", "str5_stream_candles", "snk1_append_store", "agg3_stream_rollup"])
def test_streams_that_close_nothing_are_empty(spark, crowded, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{crowded}/events.parquet'")
    want = con.execute(oracle_sql()[name])
    got = queries()[name](spark, crowded)
    assert sorted(got.columns) == sorted(c[0] for c in want.description)
    assert got.collect() == want.fetchall() == []


def test_selected_groups_are_judged_until_the_last_sample_of_all(spark, sf_dir, tmp_path):
    """The candles group (even ids) ends with a growing lag, the other group goes on for an hour."""
    duckdb.sql(
        f"""COPY (SELECT event_id, TIMESTAMP '2024-01-01 00:00:00.5' + to_seconds(CAST(event_id * 30 AS DOUBLE)) AS ts, user_id, event_type, value, props
            FROM '{sf_dir}/events.parquet' WHERE event_id < 900 AND (event_id < 780 OR event_id % 2 = 1)) TO '{tmp_path}/events.parquet'"""
    )
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{tmp_path}/events.parquet'")
    for name in ("mon5_lag_growing_selected", "mon5_lag_growing"):
        err = differences(spark, con, str(tmp_path), name, queries()[name], oracle_sql()[name])
        assert err is None, (name, err)


def test_blocks_are_landed_in_one_pass_and_one_by_one(spark, sf_dir, monkeypatch):
    """The trades are read once whatever the number of blocks; each run of the stream finds one more block."""
    trades = dv.disordered(dv.events_trades(spark, sf_dir))
    want = {r[0]: r[1] for r in _with_block(trades).groupBy("block").count().collect()}
    passes, stage = [], job.stage_blocks
    monkeypatch.setattr(job, "stage_blocks", lambda *a, **k: passes.append(1) or stage(*a, **k))
    monkeypatch.setattr(job, "land_block", lambda *a: pytest.fail("a block was written by a pass of its own"))
    landing, out, ck = shared_dir(spark, "landing"), shared_dir(spark, "read"), shared_dir(spark, "ck")
    _run(spark, trades, lambda stream: sc.to_batches(stream, sinks.by_batch(out), ck), landing)
    sizes = {r[0]: r[1] for r in spark.read.parquet(out).groupBy("batch_id").count().collect()}
    assert [sizes[b] for b in sorted(sizes)] == [want[b] for b in sorted(want)]
    assert len(want) > 3 and len(passes) == 1
    got = spark.read.parquet(out).drop("batch_id")
    assert got.exceptAll(_records(trades)).isEmpty() and got.count() == trades.count()
