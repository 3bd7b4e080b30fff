"""The whole verification as one table of checks: (section, check, value, verdict)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tapecheck.operators import compare as cmp, continuity as ct, letters as lt


def _rows(df: DataFrame, section: str, names: list[str], verdict: dict[str, object] | None = None) -> DataFrame:
    verdict = verdict or {}
    cells = [
        F.struct(
            F.lit(section).alias("section"), F.lit(n).alias("check"), F.col(n).cast("double").alias("value"),
            verdict.get(n, F.lit("info")).alias("verdict"),
        )
        for n in names
    ]
    return df.select(F.explode(F.array(*cells)).alias("c")).select("c.*")


def verification_report(
    trades: DataFrame, own: DataFrame, official: DataFrame, dead_letters: DataFrame | None, window_ms: int
) -> DataFrame:
    """Rules: volumes must match exactly; no matched window means nothing may be claimed;
    contamination voids the scorecard; duplicates show at-least-once writes."""
    cont = ct.source_continuity(trades).agg(
        F.sum(F.when(F.col("gaps") > 0, F.col("gaps")).otherwise(0)).alias("lost"),
        F.sum(F.when(F.col("gaps") < 0, -F.col("gaps")).otherwise(0)).alias("delivered_twice"),
    )
    foreign = trades.agg(F.count_if(~ct.is_real_origin()).alias("foreign_rows"))
    overlaps = ct.overlap_count(ct.connection_spans(trades))
    counts = cmp.count_check_summary(cmp.trade_count_check(trades, own, window_ms))
    score = cmp.scorecard(own, official)
    ok = lambda cond, bad: F.when(cond, "ok").otherwise(bad)
    parts = [
        _rows(cont, "continuity", ["lost", "delivered_twice"],
              {"lost": ok(F.col("lost") == 0, "source loss"), "delivered_twice": ok(F.col("delivered_twice") == 0, "duplicates")}),
        _rows(foreign, "origin", ["foreign_rows"],
              {"foreign_rows": ok(F.col("foreign_rows") == 0, "scorecard void")}),
        _rows(overlaps, "origin", ["overlapping_pairs"],
              {"overlapping_pairs": ok(F.col("overlapping_pairs") == 0, "second producer")}),
        _rows(counts, "raw-vs-candle", ["windows", "exact", "mismatched"],
              {"mismatched": ok(F.col("mismatched") == 0, "lost in the job")}),
        _rows(score, "scorecard", ["matched", "open_ok", "high_ok", "low_ok", "close_ok", "vol_ok", "duplicated"],
              {"matched": ok(F.col("matched") > 0, "no claim possible"),
               "vol_ok": ok(F.col("vol_ok") == F.col("matched"), "not exact"),
               "duplicated": ok(F.col("duplicated") == 0, "written more than once")}),
    ]
    if dead_letters is not None:
        parts.append(_rows(dead_letters.agg(F.count(F.lit(1)).alias("dropped")), "dead-letters", ["dropped"],
                           {"dropped": ok(F.col("dropped") == 0, "see reasons")}))
        parts.append(lt.dead_letter_summary(dead_letters).select(
            F.lit("dead-letters").alias("section"), F.concat_ws(": ", "stage", "reason").alias("check"),
            F.col("dropped").cast("double").alias("value"), F.lit("info").alias("verdict"),
        ))
    parts.append(cmp.range_summary(own, official).select(
        F.lit("range").alias("section"), F.concat_ws(", ", "src", "first_kst", "last_kst").alias("check"),
        F.col("n_rows").cast("double").alias("value"), ok(F.col("n_rows") > 0, "empty").alias("verdict"),
    ))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
