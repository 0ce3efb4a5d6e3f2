"""Raw service requests derived from order tables: each line item is a version of its order."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketlake.config import RAW_COLUMNS, LakeConfig
from ticketlake.sources.bronze import STORED_ROW_ID

# The parameters that fit this input.
ORDER_LAKE = LakeConfig(
    areas=("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"),
    area_aliases={"MIDDLE E": "MIDDLE EAST"},
)


# The columns that are read, declared so that no job is spent on finding them out.
TABLES = {
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_linestatus string, l_shipdate timestamp_ntz",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp_ntz, "
    "o_orderpriority string",
    "customer": "c_custkey bigint, c_nationkey int",
    "nation": "n_nationkey int, n_regionkey int",
    "region": "r_regionkey int, r_name string",
    "part": "p_partkey bigint, p_name string, p_brand string",
}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def _iso(ts) -> F.Column:
    """ISO text with zero milliseconds."""
    return F.concat(F.replace(F.substring(ts.cast("string"), 1, 19), F.lit(" "), F.lit("T")), F.lit(".000"))


def spread(scan: DataFrame, *keys: str) -> DataFrame:
    """Shuffle a scan that has fewer tasks than the session has slots; leave a wide one alone.

    A small file, or one with a single row group, would keep all work up to the next shuffle in
    one task. `keys` should tell rows apart, so that no value draws many of them to one task.
    """
    slots = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(slots, *keys) if scan.rdd.getNumPartitions() < slots else scan


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The joined input; which side is broadcast is left to the sizes Spark sees.

    Parts come first and orders, which have met their customers, last: the wider rows are shuffled once, and by their
    order. So the versions of a request leave one task together, which packs what is stored of them, and staging
    cuts them to one before its shuffle. What a line item adds is narrowed before it is shuffled.
    """
    t = {name: _table(spark, sf_dir, name) for name in TABLES}
    row_id = [F.col(f"_metadata.{m}").alias(n) for n, m in STORED_ROW_ID.items()]
    lines = spread(t["lineitem"].select("*", *row_id), "l_orderkey", "l_linenumber")
    hours = F.when(F.col("l_partkey") % 200 == 0, F.lit(-5)).otherwise((F.col("l_quantity") * 5).cast("int"))
    lines = lines.withColumns({"hours": hours, "closed": F.col("l_linestatus") == "F"}).drop("l_quantity", "l_linestatus")
    place = t["nation"].join(t["region"], F.col("n_regionkey") == F.col("r_regionkey"))
    orders = t["orders"].join(t["customer"], F.col("o_custkey") == F.col("c_custkey"))
    return lines.join(t["part"], F.col("l_partkey") == F.col("p_partkey")).join(
        orders.join(place, F.col("c_nationkey") == F.col("n_nationkey")), F.col("l_orderkey") == F.col("o_orderkey")
    )


def raw_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 12 raw text columns, the lineage columns, the line number and the stored row's id."""
    c = F.col
    line = c("l_linenumber")
    closed = c("closed")
    # times are moved by whole seconds on the zone-less order date
    second = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), (c("o_orderkey") % 86400).cast("decimal(18,6)"))
    created = c("o_orderdate") + second
    closing = created + F.make_dt_interval(F.lit(0), c("hours"), F.lit(0), F.lit(0).cast("decimal(18,6)"))
    agency = F.when(line == 1, F.concat(F.lit(" "), F.lower("o_orderpriority"), F.lit(" ")))
    zip_text = (F.lit(10000) + c("n_nationkey")).cast("string")
    zip_code = (
        F.when(c("o_custkey") % 50 == 0, F.lit(None))
        .when(c("o_custkey") % 7 == 0, F.concat(zip_text, F.lit("-1234")))
        .otherwise(zip_text)
    )
    area = (
        F.when(c("o_orderkey") % 151 == 0, F.lit("Unspecified"))
        .when((c("r_name") == "MIDDLE EAST") & (line == 2), F.lit(" Middle E "))
        .when(line == 3, F.lower("r_name"))
        .otherwise(c("r_name"))
    )

    def coordinate(prefix: str, base: int, spread: int):
        digits = (F.lit(base) + c("o_custkey") % spread).cast("string")
        return (
            F.when(c("o_custkey") % 33 == 0, F.lit(None))
            .when(c("o_orderkey") % 499 == 0, F.lit("0.000000"))
            .otherwise(F.concat(F.lit(prefix), digits))
        )

    def padded(col):
        return F.lpad(col.cast("string"), 8, "0")

    start = F.lit("2024-01-01").cast("timestamp_ntz")
    columns = {
        "unique_key": F.when(c("l_orderkey") % 997 == 5, F.lit("n/a")).otherwise(
            c("l_orderkey").cast("string")
        ),
        "created_date": _iso(created),
        "closed_date": F.when(closed, _iso(closing)),
        "resolution_action_updated_date": _iso(c("l_shipdate")),
        "agency": agency.otherwise(c("o_orderpriority")),
        "complaint_type": c("p_brand"),
        "descriptor": c("p_name"),
        "status": F.when(closed, F.lit("Closed")).otherwise(F.lit("Open")),
        "incident_zip": zip_code,
        "borough": area,
        "latitude": coordinate("40.", 50, 40),
        "longitude": coordinate("-73.", 70, 30),
        "_source": F.lit("fixture"),
        "_ingested_at": start
        + F.make_dt_interval(F.lit(0), line, F.lit(0), F.lit(0).cast("decimal(18,6)")),
        "ingest_date": F.date_add(F.lit("2024-01-01").cast("date"), line),
        "_batch_id": F.concat(F.lit("b"), padded(c("l_partkey")), padded(c("l_suppkey"))),
        "line": line,
        **{n: c(n) for n in STORED_ROW_ID},
    }
    return order_lines(spark, sf_dir).select(*[v.alias(n) for n, v in columns.items()])


def raw_only(raw: DataFrame) -> DataFrame:
    return raw.select(*RAW_COLUMNS)
