"""Quality reports over the rule counters, and run tracking."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from merchlake import schemas as S

JOB_NAME = "merchlake-build"

# Rule, what it finds, what happens to the row, its counter.
RULE_TABLE = [
    ("R01", "省份 / 城市 / 支付方式为空", "填充为「未知」", "null_field_cnt"),
    ("R02", "完全重复记录", "去重，仅保留一条", "dup_record_cnt"),
    ("R03", "下单时间无法解析", "丢弃并留痕", "invalid_time_cnt"),
    ("R04-R06", "数量 / 单价 / 实付金额异常", "异常丢弃，金额不一致按公式重算", "invalid_amount_cnt"),
    ("R07", "订单状态非合法枚举", "标准化为「其他」", "invalid_status_cnt"),
    ("R08", "商品主数据缺失", "类目填充为「未知类目」", "missing_dim_cnt"),
]
FUNNEL_STEPS = [
    ("原始记录", "raw_cnt"),
    ("含空值", "null_field_cnt"),
    ("重复记录", "dup_record_cnt"),
    ("时间异常", "invalid_time_cnt"),
    ("金额异常", "invalid_amount_cnt"),
    ("状态非法", "invalid_status_cnt"),
    ("维度缺失", "missing_dim_cnt"),
    ("有效记录", "valid_cnt"),
]


def _score(kept: str, raw: str) -> Column:
    share = F.col(kept).cast("decimal(20,0)") / F.col(raw).cast("decimal(20,0)")
    return F.when(F.col(raw) > 0, F.round(share, 4)).otherwise(F.lit(0)).cast(S.RATE)


def clean_stat(
    counters: DataFrame,
    batch_id: str,
    duration_ms: int = 0,
    at: dt.datetime | None = None,
) -> DataFrame:
    """The quality row of one batch. Discards are what is neither a copy nor kept."""
    moment = F.current_timestamp() if at is None else F.lit(at)
    return counters.withColumns(
        {
            "batch_id": F.lit(batch_id),
            "run_date": F.to_date(moment),
            "discard_cnt": F.col("raw_cnt") - F.col("dup_record_cnt") - F.col("valid_cnt"),
            "quality_score": _score("valid_cnt", "raw_cnt"),
            "duration_ms": F.lit(duration_ms).cast("bigint"),
            "update_time": moment,
        }
    ).select(*S.CLEAN_STAT_COLUMNS)


def count_invariant(counters: DataFrame) -> DataFrame:
    """raw = copies + discards + kept, with the parts counted independently."""
    c = F.col
    return counters.select(
        "raw_cnt",
        "dup_record_cnt",
        "discard_cnt",
        "valid_cnt",
        (c("raw_cnt") == c("dup_record_cnt") + c("discard_cnt") + c("valid_cnt")).alias("passed"),
    )


def quality_funnel(counters: DataFrame) -> DataFrame:
    steps = [
        F.struct(
            F.lit(place).alias("step_no"), F.lit(label).alias("step"), F.col(name).alias("row_cnt")
        )
        for place, (label, name) in enumerate(FUNNEL_STEPS, start=1)
    ]
    return counters.select(F.inline(F.array(*steps)))


def rule_table(counters: DataFrame) -> DataFrame:
    rows = [
        F.struct(
            F.lit(code).alias("rule_code"),
            F.lit(text).alias("rule_desc"),
            F.lit(action).alias("action"),
            F.col(name).alias("hit_cnt"),
        )
        for code, text, action, name in RULE_TABLE
    ]
    return counters.select(F.inline(F.array(*rows)))


def pass_rate(counters: DataFrame) -> DataFrame:
    """Share of the rows that passed the rules. On converted data it says how well the rules fit
    the conversion, not how clean the source was."""
    return counters.select(
        "raw_cnt",
        "valid_cnt",
        F.when(
            F.col("raw_cnt") > 0,
            F.round(F.col("valid_cnt").cast("decimal(20,0)") / F.col("raw_cnt").cast("decimal(20,0)"), 6),
        )
        .otherwise(F.lit(0))
        .cast("decimal(10,6)")
        .alias("pass_rate"),
    )


def reject_summary(rejected: DataFrame) -> DataFrame:
    return rejected.groupBy("rule_code").agg(F.count(F.lit(1)).alias("reject_cnt")).orderBy("rule_code")


def latest_quality(clean_stats: DataFrame) -> DataFrame:
    """The row written last; of rows written at the same time, the one with the later batch id."""
    return clean_stats.orderBy(F.desc("update_time"), F.desc("batch_id")).limit(1)


def job_logs(log: DataFrame) -> DataFrame:
    return log.orderBy("start_time", "batch_id")


def job_log_rows(snapshots: DataFrame, verdict: DataFrame) -> DataFrame:
    """Log rows of the builds in one run.

    ``snapshots`` has one row per build (see ``reconcile.build_snapshot``) with batch, mode, times
    and row counts; ``verdict`` is the row of ``reconcile.compare_builds``. A failed comparison
    turns every build's status to WARN. The last build is the published one.
    """
    last = snapshots.agg(F.max("start_time")).scalar()
    outcome = verdict.select("verdict").scalar()
    published = F.when(F.col("start_time") == last, F.lit("是")).otherwise(F.lit("否"))
    # The words of the remark.
    remark = F.concat(
        F.lit("清洗耗时 "),
        F.col("clean_ms"),
        F.lit("ms；统计与落库耗时 "),
        F.col("duration_ms") - F.col("clean_ms"),
        F.lit("ms；结果发布："),
        published,
        F.lit("；跨轮比对："),
        outcome,
    )
    return snapshots.select(
        "batch_id",
        F.lit(JOB_NAME).alias("job_name"),
        "compute_mode",
        "start_time",
        "end_time",
        "duration_ms",
        F.col("raw_rows").alias("input_rows"),
        (F.col("silver_rows") + F.col("gold_rows")).alias("output_rows"),
        F.when(outcome == "FAIL", F.lit("WARN")).otherwise(F.lit("SUCCESS")).alias("job_status"),
        remark.alias("remark"),
    )


def compare_durations(log: DataFrame, base: str, other: str) -> DataFrame:
    """Durations of two kinds of build side by side, and how much slower the other one is in
    percent of the base."""
    pivoted = log.groupBy("job_name").pivot("compute_mode", [base, other]).agg(F.max("duration_ms"))
    a, b = F.col(base), F.col(other)
    return pivoted.select(
        "job_name",
        a.alias("base_ms"),
        b.alias("other_ms"),
        (b - a).alias("diff_ms"),
        F.when(a > 0, F.round((b - a) * 100.0 / a, 2)).otherwise(F.lit(0.0)).alias("slower_pct"),
    )
