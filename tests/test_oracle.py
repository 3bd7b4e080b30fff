"""Every registered batch query against its SQL, on the smallest data set."""

import pytest

from __spark_entry__ import oracle_sql, queries
from tapecheck.plans import catalog
from tests.oracle import connect, differences

# Streams run for several batches each; a few stand for all of them here.
STREAMS = {n for n in catalog.QUERIES if n.startswith(("src1_", "src3", "str4", "str5", "str6", "str7", "str9", "str12", "str18", "snk1_", "snk3", "snk4", "snk5", "exp7", "exp8", "str13", "str18", "str19_stream", "agg3_stream", "src2", "snk2_", "snk8", "str11"))}
RUN = {
    "str6_allowed_lateness", "str7_late_letters", "exp7_crash_between_write_and_commit", "exp8_restart_modes", "str13_live_job", "src2_start_position",
    "agg3_stream_rollup", "str19_stream_sessions", "str5_odd_numbers", "str9_odd_numbers", "snk8_table_made_at_start", "str11_open_windows",
}

LARGER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", [n for n in catalog.ORACLE if n not in STREAMS or n in RUN])
def test_matches_sql(spark, con, sf_dir, name):
    err = differences(spark, con, sf_dir, name, queries()[name], oracle_sql()[name])
    if err == "EMPTY":  # nothing to compare on the smallest data set
        err = differences(spark, connect(LARGER), LARGER, name, queries()[name], oracle_sql()[name])
    assert err is None, err


def test_names_agree():
    assert set(oracle_sql()) <= set(queries())
    assert set(catalog.QUERIES) == set(catalog.ORACLE)


def test_session_zone_does_not_matter(spark, con, sf_dir):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        for name in ("agg1_ohlcv_60s", "agg6_source_continuity", "prj3_offset_times", "jn1_candle_diff", "prj10_official_rows"):
            err = differences(spark, con, sf_dir, name, queries()[name], oracle_sql()[name])
            assert err is None, (name, err)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
