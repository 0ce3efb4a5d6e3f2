"""Bronze strings to typed, standardised, latest-version rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketlake.config import SILVER_COLUMNS, LakeConfig
from ticketlake.functions.casts import to_bigint, to_double, to_timestamp
from ticketlake.functions.numeric import hours_between, round_half_away
from ticketlake.functions.text import category, postcode, upper_trim
from ticketlake.operators.versions import latest_keyed, latest_versions, newer

# Newest update first, then newest ingest, then the highest batch id.
VERSION_ORDER = ("updated_at", "_ingested_at", "_batch_id")

# Only rows equal in VERSION_ORDER are compared on these; they make the choice reproducible.
TIE_BREAK = (
    "created_at",
    "closed_at",
    "agency",
    "complaint_type",
    "descriptor",
    "status",
    "incident_zip",
    "borough",
    "latitude",
    "longitude",
)


def response_hours(created: Column, closed: Column) -> Column:
    """Hours from creation to closure, four decimals; NULL unless both are known."""
    return round_half_away(hours_between(created, closed), 4)


def typed(bronze: DataFrame, cfg: LakeConfig, keep: tuple[str, ...] = ()) -> DataFrame:
    """One typed row per bronze row, with lineage and any `keep` columns still attached."""
    cols = {
        "unique_key": to_bigint(F.col("unique_key")),
        "created_at": to_timestamp(F.col("created_date")),
        "closed_at": to_timestamp(F.col("closed_date")),
        "updated_at": to_timestamp(F.col("resolution_action_updated_date")),
        "agency": upper_trim(F.col("agency")),
        "complaint_type": F.trim("complaint_type"),
        "descriptor": F.trim("descriptor"),
        "status": F.trim("status"),
        "incident_zip": postcode(F.col("incident_zip")),
        "borough": category(F.col("borough"), cfg.area_aliases),
        "latitude": to_double(F.col("latitude")),
        "longitude": to_double(F.col("longitude")),
        "ingest_date": F.col("ingest_date"),
        "_ingested_at": F.col("_ingested_at"),
        "_batch_id": F.col("_batch_id"),
    }
    return bronze.select(*[c.alias(n) for n, c in cols.items()], *keep)


def newest_rows(typed_rows: DataFrame, row_id: tuple[str, ...] = ()) -> DataFrame:
    return latest_versions(typed_rows, "unique_key", VERSION_ORDER, TIE_BREAK, row_id)


def with_response_hours(rows: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    hours = response_hours(F.col("created_at"), F.col("closed_at"))
    return rows.withColumn("response_hours", hours).select(*SILVER_COLUMNS, *extra)


def staged(
    bronze: DataFrame, cfg: LakeConfig, row_id: tuple[str, ...] = (), extra: tuple[str, ...] = ()
) -> DataFrame:
    """Typed rows with the latest version of every key; rows without a key are all kept."""
    return with_response_hours(newest_rows(typed(bronze, cfg, row_id), row_id), extra)


# Keys that differ only in so many low bits share a bucket: new tickets have neighbouring keys.
KEY_RUN_BITS = 8


def bucket_of(buckets: int) -> Column:
    """The bucket of a staged row: by its key's run or, without a key, by its batch."""
    run = F.xxhash64(F.shiftright("unique_key", KEY_RUN_BITS))
    by = F.when(F.col("unique_key").isNotNull(), run).otherwise(batch_hash())
    return F.pmod(by, F.lit(buckets)).cast("int")


def batch_hash() -> Column:
    return F.xxhash64("ingest_date", "_batch_id")


def merge_staged(
    previous: DataFrame, new_typed: DataFrame, batches: DataFrame, extra: tuple[str, ...] = ()
) -> DataFrame:
    """Fold new bronze rows into an earlier staging result instead of rebuilding from all bronze.

    Keeping the newest version is a maximum over a total order, so newest(previous + new) equals
    newest(all bronze). Rows without a key are not compared, so those of a batch that is read
    again are first taken out of `previous`. `batches` lists the (ingest_date, _batch_id) pairs
    in `new_typed`, one row per batch.
    """
    lineage = ["ingest_date", "_batch_id"]
    keyed = F.col("unique_key").isNotNull()
    columns = new_typed.columns
    earlier = previous.select(*columns)
    unkeyed = earlier.filter(~keyed).join(batches.select(*lineage).distinct(), lineage, "left_anti").select(*columns)
    # only keys that arrived again are compared; with few new keys (Spark checks the size and
    # broadcasts them) the rest of `previous` is passed on without a shuffle, and with many all joins
    # read one shuffle of it and one of the newest new rows, as they start from the same rows
    arrived = new_typed.filter(keyed).select("unique_key").distinct()
    untouched = earlier.filter(keyed).join(arrived, "unique_key", "left_anti").select(*columns)
    touched = earlier.filter(keyed).join(arrived, "unique_key", "left_semi").select(*columns)
    newest = latest_keyed(new_typed, "unique_key", VERSION_ORDER, TIE_BREAK)
    compared = newer(touched, newest, "unique_key", (*VERSION_ORDER, *TIE_BREAK))
    added = newest.join(touched.select("unique_key"), "unique_key", "left_anti").select(*columns)
    parts = (compared, added, untouched, unkeyed, new_typed.filter(~keyed))
    return with_response_hours(reduce(DataFrame.unionByName, parts), extra)
