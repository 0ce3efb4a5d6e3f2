"""Datasets behind the report: every function takes tables and returns a table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketlake.config import MART_NAMES
from ticketlake.functions.numeric import month_start
from ticketlake.plans.lake import Lake


def month_label(month: Column) -> Column:
    return F.date_format(month, "yyyy-MM")


def bronze_stats(bronze: DataFrame) -> DataFrame:
    """Rows, batches and distinct keys, exact.

    The two distinct counts are separate scans of one column each (the batch is a folder name):
    counted together they would multiply every row before the shuffle.
    """
    keys = bronze.agg(
        F.count(F.lit(1)).alias("bronze_rows"),
        F.countDistinct("unique_key").alias("bronze_keys"),
    )
    batches = bronze.agg(F.countDistinct("_batch_id").alias("bronze_batches"))
    return keys.crossJoin(batches)  # one row each


def silver_stats(silver: DataFrame) -> DataFrame:
    month = month_start(F.col("created_at"))
    return silver.agg(
        F.count(F.lit(1)).alias("silver_rows"),
        F.min("created_at").alias("first_created"),
        F.max("created_at").alias("last_created"),
        F.countDistinct(month).alias("months"),
    )


def rule_table(spark: SparkSession, rules: Sequence[str]) -> DataFrame:
    """The rule names in order; one row per rule."""
    return spark.createDataFrame(list(enumerate(rules)), "position int, rule string")


def rule_counts(quarantine: DataFrame, rules: Sequence[str]) -> DataFrame:
    """Rows per broken rule from the stored tags; a rule nobody broke counts 0."""
    found = (
        quarantine.select(F.explode(F.split("failed_rules", ",")).alias("rule"))
        .groupBy("rule")
        .agg(F.count(F.lit(1)).alias("found"))
    )
    names = rule_table(quarantine.sparkSession, rules)
    return names.join(found, "rule", "left").select(
        "position", "rule", F.coalesce("found", F.lit(0)).cast("bigint").alias("failures")
    )


def agency_totals(sla: DataFrame) -> DataFrame:
    """Per agency over all months: the volume-weighted breach rate and the volume."""
    rate = F.sum("breached_tickets").cast("double") / F.sum("tickets").cast("double")
    return sla.groupBy("agency").agg(
        rate.alias("breach_rate"), F.sum("tickets").cast("bigint").alias("tickets")
    )


def busiest_agencies(sla: DataFrame, n: int) -> DataFrame:
    """The n agencies with the most requests; equal volumes by name."""
    by_volume = [F.col("tickets").desc(), F.col("agency").asc_nulls_last()]
    return agency_totals(sla).orderBy(*by_volume).limit(n)


def agency_breach(sla: DataFrame, n: int = 8) -> DataFrame:
    return busiest_agencies(sla, n).orderBy("breach_rate", "agency")


def sla_grid(sla: DataFrame, n: int = 10) -> DataFrame:
    """One row per busiest agency and month of any of them; a cell without requests has a NULL rate."""
    agencies = busiest_agencies(sla, n).select("agency")
    months = sla.join(agencies, "agency", "left_semi").select("month").distinct()
    cells = agencies.crossJoin(months)  # n agencies by the months of the data
    rates = sla.select("agency", "month", "breach_rate")
    return cells.join(rates, ["agency", "month"], "left").select(
        "agency", month_label(F.col("month")).alias("label"), "breach_rate"
    )


def response_series(response: DataFrame, areas: Sequence[str]) -> DataFrame:
    """Median hours by month, one column per known area."""
    known = response.filter(F.col("borough").isin(*areas))
    labelled = known.select(
        month_label(F.col("month")).alias("month"), "borough", "median_response_hours"
    )
    series = labelled.groupBy("month").pivot("borough", list(areas))
    return series.agg(F.first("median_response_hours"))


def busiest_zips(complaints: DataFrame, n: int = 6) -> DataFrame:
    """ZIPs by requests within their published top complaints; equal sums by ZIP."""
    per_zip = complaints.groupBy("incident_zip").agg(
        F.sum("tickets").cast("bigint").alias("tickets")
    )
    return per_zip.orderBy(F.col("tickets").desc(), "incident_zip").limit(n)


def zip_complaints(complaints: DataFrame, n: int = 6) -> DataFrame:
    zips = busiest_zips(complaints, n).select("incident_zip")
    return complaints.join(zips, "incident_zip", "left_semi")


def gold_row_counts(marts: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per mart."""
    counts = None
    for name, mart in marts.items():
        one = mart.agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(name).alias("table_name"), "rows"
        )
        counts = one if counts is None else counts.unionByName(one)
    return counts


def _counts_row(marts: Mapping[str, DataFrame]) -> DataFrame:
    """The same counts as columns of one row."""
    counts = gold_row_counts(marts)
    return counts.agg(
        *[F.sum(F.when(F.col("table_name") == n, F.col("rows"))).alias(n) for n in marts]
    )


def _rules_row(quarantine: DataFrame, rules: Sequence[str]) -> DataFrame:
    tags = F.split("failed_rules", ",")
    return quarantine.agg(
        F.count(F.lit(1)).alias("quarantined"),
        *[F.count_if(F.array_contains(tags, r)).alias(r) for r in rules],
    )


def stats(
    bronze: DataFrame,
    silver: DataFrame,
    quarantine: DataFrame,
    marts: Mapping[str, DataFrame],
    rules: Sequence[str],
    threshold: float,
    source: str,
) -> DataFrame:
    """Everything the report quotes, in one row."""
    sla = marts["sla_breach_rate"].agg(F.max("sla_hours").alias("sla_hours"))
    row = bronze_stats(bronze)
    for other in (silver_stats(silver), _rules_row(quarantine, rules), _counts_row(marts), sla):
        row = row.crossJoin(other)  # one row each
    staged = F.col("silver_rows") + F.col("quarantined")
    rate = F.when(staged == 0, F.lit(0.0)).otherwise(
        F.col("quarantined").cast("double") / staged.cast("double")
    )
    return (
        row.withColumn("staged_rows", staged)
        .withColumn("fail_rate", rate)
        .withColumn("threshold", F.lit(float(threshold)))
        .withColumn("source", F.lit(source))
    )


def layer_summary(stats_row: DataFrame, marts: Sequence[str]) -> DataFrame:
    """One row per layer and table with its row count, in reading order."""
    lines = [
        ("bronze", "raw rows", "bronze_rows"),
        ("bronze", "distinct unique_key", "bronze_keys"),
        ("silver", "published requests", "silver_rows"),
        ("quarantine", "rejected requests", "quarantined"),
        *[("gold", m, m) for m in marts],
    ]
    return _unpivot(
        stats_row,
        "layer string, table_name string, rows bigint",
        [(F.lit(layer), F.lit(name), F.col(c)) for layer, name, c in lines],
    )


def gate_panel(stats_row: DataFrame, rules: Sequence[str]) -> DataFrame:
    """Per rule: its count beside the overall rate and the threshold."""
    lines = [
        (F.lit(i), F.lit(r), F.col(r), F.col("fail_rate"), F.col("threshold"))
        for i, r in enumerate(rules)
    ]
    schema = "position int, rule string, failures bigint, fail_rate double, threshold double"
    return _unpivot(stats_row, schema, lines)


def _total(columns: Sequence[str]) -> Column:
    return sum((F.col(c) for c in columns), F.lit(0).cast("bigint"))


def _percent(rate: Column, digits: int) -> Column:
    return F.concat(F.format_string(f"%.{digits}f", rate * 100.0), F.lit("%"))


def _thousands(n: Column) -> Column:
    return F.format_number(n.cast("bigint"), 0)


def tiles(stats_row: DataFrame, marts: Sequence[str]) -> DataFrame:
    """Headline figures as label, value and note."""
    verdict = F.when(F.col("fail_rate") <= F.col("threshold"), "PASSED").otherwise("FAILED")
    lines = [
        (
            F.lit("bronze rows"),
            _thousands(F.col("bronze_rows")),
            F.concat(F.col("bronze_batches").cast("string"), F.lit(" batches")),
        ),
        (F.lit("silver rows"), _thousands(F.col("silver_rows")), F.lit("latest version per key")),
        (
            F.lit("quarantined"),
            _thousands(F.col("quarantined")),
            F.concat(_percent(F.col("fail_rate"), 2), F.lit(" of staged rows")),
        ),
        (
            F.lit("gold tables"),
            F.lit(str(len(marts))),
            F.concat(_thousands(_total(marts)), F.lit(" rows total")),
        ),
        (
            F.lit("quality gate"),
            verdict,
            F.concat(F.lit("fails above "), _percent(F.col("threshold"), 0)),
        ),
    ]
    return _unpivot(stats_row, "label string, value string, note string", lines)


def summary_lines(stats_row: DataFrame, rules: Sequence[str]) -> DataFrame:
    """The report's closing sentences."""
    day = "yyyy-MM-dd"
    per_rule = F.concat_ws(
        ", ", *[F.concat(F.lit(f"{r}: "), F.col(r).cast("string")) for r in rules]
    )
    lines = [
        F.format_string(
            "created from %s to %s in %d months",
            F.date_format("first_created", day),
            F.date_format("last_created", day),
            F.col("months"),
        ),
        F.concat(
            _thousands(F.col("quarantined")),
            F.lit(" of "),
            _thousands(F.col("staged_rows")),
            F.lit(" requests quarantined, "),
            _percent(F.col("fail_rate"), 2),
            F.lit(" (allowed "),
            _percent(F.col("threshold"), 0),
            F.lit(")"),
        ),
        F.concat(F.lit("requests per broken rule: "), per_rule),
        F.format_string("SLA of %d hours", F.col("sla_hours")),
    ]
    numbered = [(F.lit(i), line) for i, line in enumerate(lines, start=1)]
    return _unpivot(stats_row, "line int, text string", numbered)


def _unpivot(one_row: DataFrame, schema: str, lines: list[tuple[Column, ...]]) -> DataFrame:
    """Turn a one-row table into the given lines."""
    fields = [f.strip().split(" ") for f in schema.split(",")]
    structs = [
        F.struct(*[v.cast(t).alias(n) for v, (n, t) in zip(line, fields, strict=True)])
        for line in lines
    ]
    return one_row.select(F.inline(F.array(*structs)))


def lake_stats(lake: Lake, rules: Sequence[str]) -> DataFrame:
    """`stats` of the published run of a lake, with the threshold and source it recorded."""
    visible, record = lake.visible(), lake.published_record()
    return stats(
        lake.bronze(),
        visible.silver(),
        visible.quarantine(),
        {m: visible.mart(m) for m in MART_NAMES},
        rules,
        record["threshold"],
        record["source"],
    )
