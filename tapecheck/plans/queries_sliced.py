"""The ordered queries once more, cut into slices of a few hundred rows.

The given tables fit into one slice of the normal size, so without these queries the plans that large
inputs take would never be compared with anything: slices that the plan names, and slices that are cut again by a table.
"""

from __future__ import annotations

from tapecheck.operators import scan
from tapecheck.plans.catalog import ORACLE, QUERIES, Query

SLICE, COARSE = 400, 3
NAMES = (
    "win1_connection_gaps", "win1_coverage_gaps", "win2_sequence_in_ms", "win3_out_of_order", "win4_gap_compression", "win5_record_watermark",
    "agg17_clock_ahead", "agg18_disorder_report", "srt3_skip_and_take", "src4_bounded_scan", "prj7_log_coordinates",
    "str19_session_candles", "str20_fill_quiet_windows", "mon0_counter_increase",
)


def _sliced(base: Query, **sizes: int) -> Query:
    def run(spark, d):
        with scan.slicing(SLICE, **sizes):  # slices are measured while the plan is built
            return base(spark, d)

    return run


def register() -> None:
    for name in NAMES:
        for suffix, sizes in (("sliced", {}), ("sliced_twice", {"coarse": COARSE})):
            QUERIES[f"{name}_{suffix}"] = _sliced(QUERIES[name], **sizes)
            ORACLE[f"{name}_{suffix}"] = ORACLE[name]
