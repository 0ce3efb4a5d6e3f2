"""The three published marts, each a pure function of silver."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ticketlake.config import MART_SCHEMAS, LakeConfig
from ticketlake.functions.numeric import hours_between, month_start, ratio, round_half_away
from ticketlake.operators.positions import with_positions
from ticketlake.operators.quantiles import grouped_summary


def response_time(silver: DataFrame) -> DataFrame:
    """Closed requests per month and borough: count, exact median and p90, mean (2 decimals)."""
    closed = silver.filter(F.col("closed_at").isNotNull()).select(
        month_start(F.col("created_at")).alias("month"), "borough", "response_hours"
    )
    summary = grouped_summary(
        closed, ["month", "borough"], "response_hours", {"median": 0.5, "p90": 0.9}
    )
    return summary.select(
        "month",
        "borough",
        F.col("rows").alias("closed_tickets"),
        round_half_away(F.col("median"), 2).alias("median_response_hours"),
        round_half_away(F.col("p90"), 2).alias("p90_response_hours"),
        round_half_away(F.col("mean"), 2).alias("mean_response_hours"),
    )


def complaint_counts(silver: DataFrame) -> DataFrame:
    return (
        silver.filter(F.col("incident_zip").isNotNull())
        .groupBy("incident_zip", "complaint_type")
        .agg(F.count(F.lit(1)).alias("tickets"))
    )


def top_complaints(silver: DataFrame, per_zip: int = 5) -> DataFrame:
    """The most frequent complaint types of each ZIP, with their share of all its requests.

    The total is an aggregate and the cut a ranked limit, so both shrink before they shuffle and
    a ZIP with very many complaint types is never held by one task. The two meet on the ZIP both
    are already partitioned by.
    """
    counts = complaint_counts(silver)
    totals = counts.groupBy("incident_zip").agg(F.sum("tickets").alias("zip_tickets"))
    order = Window.partitionBy("incident_zip").orderBy(
        F.col("tickets").desc(), F.col("complaint_type").asc_nulls_last()
    )
    top = counts.withColumn("rank", F.row_number().over(order).cast("bigint")).filter(
        F.col("rank") <= per_zip
    )
    return top.join(totals, "incident_zip").select(
        "incident_zip",
        "rank",
        "complaint_type",
        "tickets",
        ratio(F.col("tickets"), F.col("zip_tickets")).alias("share_of_zip"),
    )


def as_of(silver: DataFrame) -> DataFrame:
    """One row: the newest creation time, the reproducible 'now' of open requests."""
    return silver.agg(F.max("created_at").alias("as_of"))


def sla_flagged(silver: DataFrame, sla_hours: int) -> DataFrame:
    """Per request: agency, creation month, and whether it took (or is open) longer than the SLA."""
    # one row by construction, so the broadcast does not grow with the data
    now = F.broadcast(as_of(silver))
    limit = F.lit(float(sla_hours))
    late = F.when(F.col("closed_at").isNotNull(), F.col("response_hours") > limit).otherwise(
        hours_between(F.col("created_at"), F.col("as_of")) > limit
    )
    return silver.crossJoin(now).select(
        "unique_key",
        "agency",
        month_start(F.col("created_at")).alias("month"),
        late.alias("breached"),
    )


def sla_breach(silver: DataFrame, sla_hours: int) -> DataFrame:
    grouped = (
        sla_flagged(silver, sla_hours)
        .groupBy("agency", "month")
        .agg(
            F.count(F.lit(1)).alias("tickets"),
            F.count_if(F.coalesce("breached", F.lit(False))).alias("breached_tickets"),
        )
    )
    return grouped.withColumn(
        "breach_rate", ratio(F.col("breached_tickets"), F.col("tickets"))
    ).withColumn("sla_hours", F.lit(int(sla_hours)).cast("int"))


# The display order of each mart; NULLs last.
MART_ORDER = {
    "response_time_by_borough_month": ("month", "borough"),
    "top_complaints_by_zip": ("incident_zip", "rank"),
    "sla_breach_rate": ("agency", "month"),
}


def build_marts(silver: DataFrame, cfg: LakeConfig) -> dict[str, DataFrame]:
    plans: dict[str, Callable[[], DataFrame]] = {
        "response_time_by_borough_month": lambda: response_time(silver),
        "top_complaints_by_zip": lambda: top_complaints(silver),
        "sla_breach_rate": lambda: sla_breach(silver, cfg.sla_hours),
    }
    return {n: plans[n]().select(*MART_SCHEMAS[n].fieldNames()) for n in MART_SCHEMAS}


def _display_order(name: str) -> list[Column]:
    return [F.col(c).asc_nulls_last() for c in MART_ORDER[name]]


def in_order(mart: DataFrame, name: str) -> DataFrame:
    return mart.orderBy(*_display_order(name))


def numbered(mart: DataFrame, name: str) -> DataFrame:
    """The mart's rows with their `position` in the display order, from 0; sorted by ranges, never in one task."""
    return with_positions(mart, _display_order(name), f"{name}-order")
