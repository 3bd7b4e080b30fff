"""Frames, wire records, official pages and dead letters: literal cases."""

import json
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from tapecheck.functions.timecols import wall_clock
from tapecheck.operators import letters as lt
from tapecheck.settings import CandleSettings
from tapecheck.sources import frames as fr, official as of, trades as tr


def frame(topic="trade:kr:K7", price="12345.5", ts="2031-02-03T18:05:06.007+09:00", volume="3.25", **more):
    return json.dumps({"type": "message", "topic": topic, "data": {"price": price, "volume": volume, "timestamp": ts, "currency": "KRW"}, **more})


def parse(spark, *values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, value string")
    return {r.i: r for r in fr.frame_trades(fr.frames(df)).collect()}


def test_good_frame_goes_to_utc(spark):
    r = parse(spark, frame())[0]
    assert (r.symbol, r.price, r.volume, r.currency) == ("K7", "12345.5", "3.25", "KRW")
    assert r.event_ms == 1927875906007  # 2031-02-03T09:05:06.007Z


@pytest.mark.parametrize("bad", [
    frame(ts="2031-02-03 18:05"), frame(ts="in the evening"), frame(ts=""), frame(topic="quote:kr:K7"),
    frame(topic="trade:kr"), frame(topic="trade:kr:"), frame(topic="a:trade:kr:x"), frame(price=""), frame(volume="  "),
    "PONG", " PONG ", "", "   ", None, "{not json", "[1,2]", "null", "5", '{"type":"message","topic":"trade:kr:x","data":"text"}',
    '{"type":"message","topic":"trade:kr:x"}', '{"type":"error","code":1}',
])
def test_not_a_trade(spark, bad):
    assert parse(spark, bad) == {}


def test_other_market_and_text_numbers(spark):
    r = parse(spark, frame(topic="trade:xx:ZQ", price="9.875"), frame(price="0.7"), frame(price="1.1"), frame(ts="2031-02-03T09:05:06.007Z"))
    assert r[0].symbol == "ZQ" and r[0].price == "9.875"
    assert (r[1].price, r[2].price) == ("0.7", "1.1")
    assert r[3].event_ms == 1927875906007


def wire(**over):
    base = {"symbol": "K7", "event_ms": 4321, "seq_in_ms": 0, "ingest_ms": 4400, "price": "512.25", "volume": "6", "currency": "KRW", "conn_id": "c1", "recv_seq": 7}
    base.update(over)
    return json.dumps({k: v for k, v in base.items() if v is not ...})


REASONS = [
    (wire(), None), ("{broken", "malformed-json"), ("[]", "malformed-json"), ("", "malformed-json"), ("null", "malformed-json"),
    (wire(symbol=" "), "missing-symbol"), (wire(symbol=None), "missing-symbol"), (wire(price=""), "missing-field"),
    (wire(volume=None), "missing-field"), (wire(price="abc"), "malformed-number"), (wire(event_ms=...), "missing-field"),
    (wire(symbol="", price=""), "missing-symbol"), (wire(extra="ignored"), None),
]


def test_reasons(spark):
    df = spark.createDataFrame([(i, v) for i, (v, _) in enumerate(REASONS)] + [(99, None)], "i int, value string")
    got = {r.i: r.reason for r in lt.classify(df).select("i", "reason").collect()}
    assert got == {i: want for i, (_, want) in enumerate(REASONS)}


def test_trade_record_round_trip(spark):
    df = spark.createDataFrame([(wire(), 2, 41)], "value string, partition int, offset bigint")
    t = lt.good_trades(lt.classify(df))
    r = t.first()
    assert (r.symbol, r.price, r.volume, r.kafka_partition, r.kafka_offset) == ("K7", D("512.25"), D(6), 2, 41)
    back = json.loads(tr.keyed_records(t).first().value)
    assert "kafka_partition" not in back and "kafka_offset" not in back and back["recv_seq"] == 7
    plain = lt.good_trades(lt.classify(df.select("value"))).first()
    assert (plain.kafka_partition, plain.kafka_offset) == (-1, -1)


def test_truncation(spark):
    df = spark.createDataFrame([(None,), ("abc",), ("x" * 50,)], "s string")
    assert [r[0] for r in df.select(lt.truncated(F.col("s"), 10)).collect()] == ["", "abc", "x" * 10 + "…(truncated)"]


def test_dead_letters_and_summary(spark):
    df = spark.createDataFrame([(1, "{bad"), (2, wire(price="")), (3, wire(price="", symbol="B")), (4, wire())], "i bigint, value string")
    letters = lt.dead_letters(lt.classify(df), "run-x", wall_clock(F.col("i") * 1000))
    rows = {(r.reason, r.symbol) for r in letters.collect()}
    assert rows == {("malformed-json", ""), ("missing-field", "K7"), ("missing-field", "B")}
    s = {r.reason: r for r in lt.dead_letter_summary(letters).collect()}
    assert (s["missing-field"].dropped, s["missing-field"].symbols) == (2, 2)
    assert s["missing-field"].first_seen == "1970-01-01 00:00:02.000" and s["malformed-json"].sample == "{bad"
    assert lt.dead_letters(lt.classify(df), "r").filter("seen_at > timestamp_ntz'2020-01-01'").count() == 3


CANDLE = {"timestamp": "2026-06-18T08:42:00+09:00", "openPrice": "1", "highPrice": "4", "lowPrice": "0.5", "closePrice": "2", "volume": "10"}
SHORT = {"time": "2026-06-18T08:42:00+09:00", "open": "1", "high": "4", "low": "0.5", "close": "2", "accVolume": ""}


@pytest.mark.parametrize("body,volume", [
    ({"result": {"candles": [CANDLE], "nextBefore": "x"}}, "10"), ([CANDLE], "10"), ({"data": [SHORT]}, "0"),
    ({"items": [CANDLE]}, "10"), ({"candles": [SHORT]}, "0"), ({"data": {"candles": [CANDLE]}}, "10"), ({"result": [CANDLE]}, "10"),
])
def test_official_page_shapes(spark, body, volume):
    df = spark.createDataFrame([("S", json.dumps(body))], "symbol string, body string")
    rows = of.official_rows(of.official_pages(df), F.lit(None).cast("timestamp_ntz")).collect()
    assert len(rows) == 1 and str(rows[0].window_start) == "2026-06-17 23:41:00"
    assert (rows[0].open, rows[0].low, rows[0].volume) == (D(1), D("0.5"), D(volume))


def test_official_bad_time_and_no_array(spark):
    df = spark.createDataFrame([("S", json.dumps([{**CANDLE, "timestamp": "soon"}])), ("S", '{"x":1}'), ("S", "oops")], "symbol string, body string")
    assert of.official_pages(df).count() == 0


def test_settle_cutoff(spark):
    df = spark.createDataFrame([(1_000_000,), (1_000_001,)], "label_ms bigint")
    assert of.settled(df, 1_000_000 + 120_000).count() == 1


def test_start_positions():
    assert tr.start_options("committed") == {"startingOffsets": "earliest"}
    assert tr.start_options("latest") == {"startingOffsets": "latest"}
    with pytest.raises(ValueError):
        tr.start_options("somewhere")


def test_settings_row(spark):
    cfg = CandleSettings(run_id="r7", window_ms=60_000)
    r = cfg.as_row(spark).first()
    told = json.loads(r.description)
    assert r.run_id == told["run_id"] == "r7" and told["window_ms"] == 60_000 and told["allowed_lateness_ms"] == 0
