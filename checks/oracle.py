"""The same results stated in DuckDB SQL over the driver's tables."""

from __future__ import annotations

from ticketlake.config import MART_NAMES as MARTS
from ticketlake.config import RAW_COLUMNS as RAW
from ticketlake.config import SILVER_COLUMNS
from ticketlake.operators.extract import SOURCE_ORDER as FIRST_IN_ORDER
from ticketlake.operators.marts import MART_ORDER
from ticketlake.operators.staging import TIE_BREAK, VERSION_ORDER

# The parameters of this input, the rules in order.
SILVER = SILVER_COLUMNS
AREAS = ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST")
RULES = ("non_null_keys", "valid_borough", "closed_not_before_created", "latlon_in_nyc_bbox")
SINCE, UNTIL = "1996-01-01 00:00:00", "1999-06-30 12:00:00"

RAW_LIST = ", ".join(RAW)
SILVER_LIST = ", ".join(SILVER)
# rows without a key are part of some results; their keys are compared as text, beside the type they have
KEY_TYPE = "lower(typeof(unique_key)) AS key_type"
KEY_TEXT = f"* REPLACE (unique_key::VARCHAR AS unique_key), {KEY_TYPE}"
STAGED_LIST = SILVER_LIST.replace("unique_key", "unique_key::VARCHAR AS unique_key") + f", {KEY_TYPE}"

LINES = """
lines AS (
    SELECT *, o_orderdate + to_seconds(o_orderkey % 86400) AS opened,
           strftime(o_orderdate + to_seconds(o_orderkey % 86400), '%Y-%m-%dT%H:%M:%S.000') AS opened_text,
           (10000 + n_nationkey)::VARCHAR AS zip_text
    FROM lineitem
    JOIN orders ON o_orderkey = l_orderkey
    JOIN customer ON c_custkey = o_custkey
    JOIN nation ON n_nationkey = c_nationkey
    JOIN region ON r_regionkey = n_regionkey
    JOIN part ON p_partkey = l_partkey
),
raw AS (
    SELECT
        if(l_orderkey % 997 = 5, 'n/a', l_orderkey::VARCHAR) AS unique_key,
        opened_text AS created_date,
        if(l_linestatus = 'F',
           strftime(opened + to_hours(if(l_partkey % 200 = 0, -5, (5 * l_quantity)::INT)),
                    '%Y-%m-%dT%H:%M:%S.000'), NULL) AS closed_date,
        strftime(l_shipdate, '%Y-%m-%dT%H:%M:%S.000') AS resolution_action_updated_date,
        if(l_linenumber = 1, ' ' || lower(o_orderpriority) || ' ', o_orderpriority) AS agency,
        p_brand AS complaint_type,
        p_name AS descriptor,
        if(l_linestatus = 'F', 'Closed', 'Open') AS status,
        CASE WHEN o_custkey % 50 = 0 THEN NULL
             WHEN o_custkey % 7 = 0 THEN zip_text || '-1234' ELSE zip_text END AS incident_zip,
        CASE WHEN o_orderkey % 151 = 0 THEN 'Unspecified'
             WHEN r_name = 'MIDDLE EAST' AND l_linenumber = 2 THEN ' Middle E '
             WHEN l_linenumber = 3 THEN lower(r_name) ELSE r_name END AS borough,
        CASE WHEN o_custkey % 33 = 0 THEN NULL WHEN o_orderkey % 499 = 0 THEN '0.000000'
             ELSE '40.' || (50 + o_custkey % 40) END AS latitude,
        CASE WHEN o_custkey % 33 = 0 THEN NULL WHEN o_orderkey % 499 = 0 THEN '0.000000'
             ELSE '-73.' || (70 + o_custkey % 30) END AS longitude,
        'fixture' AS _source,
        TIMESTAMP '2024-01-01' + to_hours(l_linenumber) AS _ingested_at,
        DATE '2024-01-01' + l_linenumber AS ingest_date,
        'b' || lpad(l_partkey::VARCHAR, 8, '0') || lpad(l_suppkey::VARCHAR, 8, '0') AS _batch_id,
        l_linenumber AS line
    FROM lines
)"""

ZIP = "nullif(regexp_extract(trim(incident_zip), '^[0-9]{5}'), '')"
AREA = (
    "CASE WHEN upper(trim(borough)) = 'MIDDLE E' THEN 'MIDDLE EAST' "
    "ELSE nullif(upper(trim(borough)), '') END"
)


def hours(start: str, end: str) -> str:
    return f"date_diff('second', {start}, {end}) / 3600"


def typed(source: str, name: str = "typed") -> str:
    return f"""{name} AS (
    SELECT try_cast(unique_key AS BIGINT) AS unique_key,
           try_cast(created_date AS TIMESTAMP) AS created_at,
           try_cast(closed_date AS TIMESTAMP) AS closed_at,
           try_cast(resolution_action_updated_date AS TIMESTAMP) AS updated_at,
           upper(trim(agency)) AS agency, trim(complaint_type) AS complaint_type,
           trim(descriptor) AS descriptor, trim(status) AS status,
           {ZIP} AS incident_zip, {AREA} AS borough,
           try_cast(latitude AS DOUBLE) AS latitude, try_cast(longitude AS DOUBLE) AS longitude,
           ingest_date, _ingested_at, _batch_id
    FROM {source})"""


def newest(source: str, name: str) -> str:
    order = ", ".join(
        f"{c} DESC NULLS LAST"
        for c in (*VERSION_ORDER, *TIE_BREAK)
    )
    return f"""{name} AS (
    FROM {source} WHERE unique_key IS NULL
    UNION ALL
    (FROM {source} WHERE unique_key IS NOT NULL
     QUALIFY row_number() OVER (PARTITION BY unique_key ORDER BY {order}) = 1))"""


def staged(source: str, name: str = "staged") -> str:
    return f"""{typed(source, name + '_typed')},
{newest(name + '_typed', name + '_newest')},
{name} AS (
    SELECT * EXCLUDE (ingest_date, _ingested_at, _batch_id),
           round({hours('created_at', 'closed_at')}, 4) AS response_hours, ingest_date
    FROM {name}_newest)"""


AREA_LIST = ", ".join(f"'{a}'" for a in AREAS)
BROKEN = {
    "non_null_keys": "(unique_key IS NULL OR created_at IS NULL)",
    "valid_borough": f"coalesce(borough NOT IN ({AREA_LIST}), true)",
    "closed_not_before_created": "coalesce(closed_at < created_at, false)",
    "latlon_in_nyc_bbox": (
        "(coalesce(latitude, longitude) IS NOT NULL AND NOT coalesce("
        "latitude >= 40.45 AND latitude <= 40.95 AND longitude >= -74.30 AND longitude <= -73.65, false))"
    ),
}
TAGS = "concat_ws(',', " + ", ".join(f"CASE WHEN {p} THEN '{n}' END" for n, p in BROKEN.items()) + ")"


def judged(name: str = "staged") -> str:
    return f"""{name}_judged AS (SELECT *, {TAGS} AS failed_rules FROM {name}),
{name}_silver AS (SELECT {SILVER_LIST} FROM {name}_judged WHERE failed_rules = ''),
{name}_quarantine AS (FROM {name}_judged WHERE failed_rules <> '')"""


def marts(silver: str, prefix: str = "", sla: int = 72) -> str:
    """CTEs `<prefix>response`, `<prefix>complaints`, `<prefix>sla`."""
    return f"""{prefix}response AS (
    SELECT date_trunc('month', created_at)::DATE AS month, borough,
           count(*) AS closed_tickets,
           round(quantile_cont(response_hours, 0.5), 2) AS median_response_hours,
           round(quantile_cont(response_hours, 0.9), 2) AS p90_response_hours,
           round(avg(response_hours), 2) AS mean_response_hours
    FROM {silver} WHERE closed_at IS NOT NULL GROUP BY ALL),
{prefix}counts AS (
    SELECT incident_zip, complaint_type, count(*) AS tickets
    FROM {silver} WHERE incident_zip IS NOT NULL GROUP BY ALL),
{prefix}complaints AS (
    SELECT incident_zip,
           row_number() OVER (PARTITION BY incident_zip
                              ORDER BY tickets DESC, complaint_type NULLS LAST) AS rank,
           complaint_type, tickets,
           round(tickets / zip_tickets, 4) AS share_of_zip
    FROM {prefix}counts
    JOIN (SELECT incident_zip, sum(tickets)::BIGINT AS zip_tickets
          FROM {prefix}counts GROUP BY ALL) USING (incident_zip)
    QUALIFY rank <= 5),
{prefix}flagged AS (
    SELECT unique_key, agency, date_trunc('month', created_at)::DATE AS month,
           if(closed_at IS NULL,
              {hours('created_at', f'(SELECT max(created_at) FROM {silver})')} > {sla},
              response_hours > {sla}) AS breached
    FROM {silver}),
{prefix}sla AS (
    SELECT agency, month, count(*) AS tickets,
           count_if(breached)::BIGINT AS breached_tickets,
           round(count_if(breached)::DOUBLE / count(*), 4) AS breach_rate, {sla}::INTEGER AS sla_hours
    FROM {prefix}flagged GROUP BY agency, month)"""


def sql(final: str, *ctes: str) -> str:
    return "WITH " + ",\n".join((LINES.strip(), *ctes)) + "\n" + final


STAGED = staged("raw")
JUDGED = (STAGED, judged())
ALL_MARTS = (*JUDGED, marts("staged_silver"))
MART_CTE = {"response_time_by_borough_month": "response", "top_complaints_by_zip": "complaints",
            "sla_breach_rate": "sla"}


def pulled(name: str, *parts: tuple[str, str]) -> str:
    """Rows of several runs: (filter over raw, ingest time); a run's batch id never decides alone."""
    selects = [
        f"SELECT {RAW_LIST}, TIMESTAMP '{at}' AS _ingested_at, TIMESTAMP '{at}'::DATE AS ingest_date,"
        f" 'b' AS _batch_id FROM raw WHERE {where}"
        for where, at in parts
    ]
    return f"{name} AS ({' UNION ALL '.join(selects)})"


CREATED = "created_date::TIMESTAMP"
IN_WINDOW = f"{CREATED} > TIMESTAMP '{SINCE}' AND {CREATED} <= TIMESTAMP '{UNTIL}'"
SOURCE_ORDER = ", ".join(
    f"coalesce({c}, '')"
    for c in (*FIRST_IN_ORDER, *(c for c in RAW if c not in FIRST_IN_ORDER))
)
DAY_1, DAY_2 = "2024-02-01 00:00:00", "2024-02-02 00:00:00"


def run_line(seq: int, staged_name: str, prefix: str, **fixed: str) -> str:
    columns = ", ".join(f"{v} AS {k}" for k, v in fixed.items())
    per_rule = ", ".join(f"count_if({p})::BIGINT AS {n}" for n, p in BROKEN.items())
    gold = ", ".join(
        f"(SELECT count(*) FROM {prefix}{cte}) AS {mart}" for mart, cte in MART_CTE.items()
    )
    return f"""SELECT {seq}::BIGINT AS seq, 'published' AS status, 'orders' AS source, {columns},
    count(*) AS silver_rows, count_if(failed_rules = '')::BIGINT AS good_rows,
    count_if(failed_rules <> '')::BIGINT AS quarantined,
    count_if(failed_rules <> '')::DOUBLE / count(*) AS fail_rate, 0.05::DOUBLE AS threshold,
    {per_rule}, {gold}
    FROM {staged_name}_judged"""


FIRST_UNTIL = f"{CREATED} <= TIMESTAMP '1998-01-01'"
FIRST_NEWEST = f"(SELECT max({CREATED}) FROM raw WHERE {FIRST_UNTIL})"

GATE = f"""SELECT count(*) AS total, count_if(failed_rules = '')::BIGINT AS good,
    count_if(failed_rules <> '')::BIGINT AS failed,
    count_if(failed_rules <> '')::DOUBLE / count(*) AS fail_rate, 0.05::DOUBLE AS threshold,
    count_if(failed_rules <> '')::DOUBLE / count(*) <= 0.05 AS passed,
    {", ".join(f"count_if({p})::BIGINT AS {n}" for n, p in BROKEN.items())}
    FROM staged_judged"""

BRONZE_STATS = """SELECT count(*) AS bronze_rows, count(DISTINCT unique_key) AS bronze_keys,
    count(DISTINCT _batch_id) AS bronze_batches FROM raw"""
SILVER_STATS = """SELECT count(*) AS silver_rows, min(created_at) AS first_created,
    max(created_at) AS last_created, count(DISTINCT date_trunc('month', created_at)) AS months
    FROM staged_silver"""
RULE_SUMS = ", ".join(f"count_if(list_contains(tags, '{r}'))::BIGINT AS {r}" for r in RULES)
STATS = f"""stats AS (
    SELECT *, silver_rows + quarantined AS staged_rows,
           quarantined::DOUBLE / (silver_rows + quarantined) AS fail_rate,
           0.05::DOUBLE AS threshold, 'orders' AS source
    FROM ({BRONZE_STATS}), ({SILVER_STATS}),
         (SELECT count(*) AS quarantined, {RULE_SUMS}
          FROM (SELECT string_split(failed_rules, ',') AS tags FROM staged_quarantine)),
         (SELECT {", ".join(f"(SELECT count(*) FROM {c}) AS {m}" for m, c in MART_CTE.items())}),
         (SELECT max(sla_hours) AS sla_hours FROM sla))"""
WITH_STATS = (*ALL_MARTS, STATS)

AGENCIES = """agencies AS (
    SELECT agency, sum(breached_tickets)::DOUBLE / sum(tickets)::DOUBLE AS breach_rate,
           sum(tickets)::BIGINT AS tickets FROM sla GROUP BY agency
    ORDER BY tickets DESC, agency LIMIT {n})"""
ZIPS = """zips AS (
    SELECT incident_zip, sum(tickets)::BIGINT AS tickets FROM complaints
    GROUP BY incident_zip ORDER BY tickets DESC, incident_zip LIMIT 6)"""


def row_json() -> str:
    fields = ", ".join(
        f"""CASE WHEN {c} IS NOT NULL THEN '"{c}":' || to_json({c})::VARCHAR END""" for c in sorted(RAW)
    )
    return "'{' || concat_ws(',', " + fields + ") || '}'"


QUARTERS = ", ".join(
    f"sum(('0x' || substr(digest, {1 + 16 * i}, 16))::UBIGINT)::VARCHAR" for i in range(4)
)

LATE_AFTER = f"(SELECT max({CREATED}) FROM raw WHERE line <= 3) - INTERVAL 400 DAY"
FIXED_COLUMNS = {
    "closed_date": "NULL",
    "resolution_action_updated_date": "'2100-01-01T00:00:00.000'",
    "borough": "'ASIA'",
    "latitude": "NULL",
    "longitude": "NULL",
}
RECOVERED = pulled("first_rows", ("true", DAY_1)) + f""",
recovered AS (
    FROM first_rows
    UNION ALL
    SELECT * REPLACE ({", ".join(f"{v} AS {c}" for c, v in FIXED_COLUMNS.items())},
                      TIMESTAMP '{DAY_2}' AS _ingested_at, DATE '2024-02-02' AS ingest_date)
    FROM first_rows
    WHERE borough = 'Unspecified' OR latitude = '0.000000' OR closed_date < created_date)"""

TWO_RUNS = pulled("two_runs", (FIRST_UNTIL, DAY_1), (f"{CREATED} > {FIRST_NEWEST}", DAY_2))
ONE_RUN = pulled("one_run", ("true", DAY_1))
BAD_START = f"(SELECT max({CREATED}) FROM raw WHERE line <= 3 AND {FIRST_UNTIL})"
BAD_RUN = (
    pulled("first_rows", (f"line <= 3 AND {FIRST_UNTIL}", DAY_1)),
    pulled(
        "both_rows",
        (f"line <= 3 AND {FIRST_UNTIL}", DAY_1),
        (f"line > 3 AND {CREATED} > {BAD_START}", DAY_2),
    ),
    staged("first_rows", "first"), judged("first"), staged("both_rows", "later"), judged("later"),
)


def percent(rate: str, digits: int) -> str:
    return f"printf('%.{digits}f', {rate} * 100) || '%'"


def thousands(n: str) -> str:
    return f"format('{{:,}}', ({n})::BIGINT)"


GOLD_SUM = " + ".join(MARTS)

ORACLE: dict[str, str] = {
    "stage_typed": sql(f"SELECT {KEY_TEXT} FROM typed", typed("raw")),
    "zip_normalise": sql(
        f"SELECT unique_key, _ingested_at, _batch_id, incident_zip AS zip_text, {ZIP} AS zip FROM raw"
    ),
    "category_normalise": sql(
        f"SELECT unique_key, _ingested_at, _batch_id, borough AS area_text, {AREA} AS area FROM raw"
    ),
    "elapsed_hours": sql(
        f"""SELECT unique_key::VARCHAR AS unique_key, _ingested_at, _batch_id,
        date_diff('second', created_at, closed_at)::VARCHAR AS seconds,
        round({hours('created_at', 'closed_at')}, 4) AS response_hours FROM typed""",
        typed("raw"),
    ),
    "silver_staged": sql(f"SELECT {STAGED_LIST} FROM staged", STAGED),
    "dedup_latest": sql(
        f"SELECT unique_key::VARCHAR AS unique_key, {KEY_TYPE}, updated_at, _ingested_at, _batch_id, status FROM newest",
        typed("raw"),
        newest("typed", "newest"),
    ),
    "stage_incremental": sql(f"SELECT {STAGED_LIST} FROM staged", STAGED),
    "extract_window": sql(f"SELECT {RAW_LIST} FROM raw WHERE {IN_WINDOW}"),
    "extract_first_n": sql(
        f"SELECT {RAW_LIST} FROM raw WHERE {IN_WINDOW} ORDER BY {SOURCE_ORDER} LIMIT 1000"
    ),
    "extract_page": sql(f"SELECT {RAW_LIST} FROM raw ORDER BY {SOURCE_ORDER} LIMIT 500 OFFSET 1500"),
    "newest_created": sql(f"SELECT max({CREATED}) AS newest FROM raw"),
    "effective_since": sql(
        f"""SELECT area, lookback_days,
        greatest(TIMESTAMP '1996-01-01', watermark - to_days(lookback_days)) AS start,
        TIMESTAMP '1996-01-01' AS start_without_state
        FROM (SELECT {AREA} AS area, max({CREATED}) AS watermark FROM raw GROUP BY area)
        CROSS JOIN (VALUES (0), (7), (2500)) AS l(lookback_days)"""
    ),
    "watermark_advance": sql(
        f"""SELECT {AREA} AS area, max({CREATED}) FILTER (line <= 3) AS old,
        max({CREATED}) FILTER (line > 3) AS seen,
        max({CREATED}) AS watermark FROM raw GROUP BY area"""
    ),
    "rule_keys": sql(f"SELECT {STAGED_LIST} FROM staged WHERE {BROKEN['non_null_keys']}", STAGED),
    "rule_category": sql(f"SELECT {STAGED_LIST} FROM staged WHERE {BROKEN['valid_borough']}", STAGED),
    "rule_time_order": sql(
        f"SELECT {STAGED_LIST} FROM staged WHERE {BROKEN['closed_not_before_created']}", STAGED
    ),
    "rule_bbox": sql(f"SELECT {STAGED_LIST} FROM staged WHERE {BROKEN['latlon_in_nyc_bbox']}", STAGED),
    "gate_tags": sql(
        f"""SELECT unique_key::VARCHAR AS unique_key, {KEY_TYPE}, created_at, updated_at, failed_rules AS failed,
        if(failed_rules = '', 0, len(string_split(failed_rules, ',')))::INTEGER AS n_failed
        FROM staged_judged""",
        *JUDGED,
    ),
    "gate_report": sql(GATE, *JUDGED),
    "quarantine": sql(f"SELECT {KEY_TEXT} FROM staged_quarantine", *JUDGED),
    "silver_published": sql("FROM published_silver", ONE_RUN, staged("one_run", "published"), judged("published")),
    "gate_partition_invariant": sql(
        """SELECT count(*) AS staged, count_if(failed_rules = '')::BIGINT AS good,
        count_if(failed_rules <> '')::BIGINT AS quarantined, 0::BIGINT AS lost, 0::BIGINT AS added
        FROM staged_judged""",
        *JUDGED,
    ),
    "gold_response_time": sql("FROM response", *ALL_MARTS),
    "complaint_counts": sql("FROM counts", *ALL_MARTS),
    "gold_top_complaints": sql("FROM complaints", *ALL_MARTS),
    "sla_flagged": sql("FROM flagged", *ALL_MARTS),
    "gold_sla_breach_72": sql("FROM sla", *ALL_MARTS),
    "gold_sla_breach_24": sql("FROM sla", *JUDGED, marts("staged_silver", sla=24)),
    "gold_row_counts": sql(
        " UNION ALL ".join(
            f"SELECT '{m}' AS table_name, count(*) AS rows FROM {c}" for m, c in MART_CTE.items()
        ),
        *ALL_MARTS,
    ),
    "src_paged_window": sql(f"SELECT {RAW_LIST} FROM raw WHERE {IN_WINDOW}"),
    "src_csv_roundtrip": sql(f"SELECT {RAW_LIST} FROM raw"),
    "landing_jsonl_roundtrip": sql(f"SELECT {RAW_LIST} FROM raw"),
    "batch_fingerprint": sql(
        f"""SELECT 'b' || substr(sha256(concat_ws(':', count(*)::VARCHAR, {QUARTERS})), 1, 16) AS batch_id,
        count(*) AS rows FROM (SELECT sha256({row_json()}) AS digest FROM raw)"""
    ),
    "bronze_ingest": sql(
        f"""SELECT {RAW_LIST}, 'orders' AS _source, TIMESTAMP '{DAY_1}' AS _ingested_at,
        DATE '2024-02-01' AS ingest_date FROM raw"""
    ),
    "bronze_reingest_idempotent": sql(
        """SELECT count(*) AS rows, 1::BIGINT AS batches,
        TIMESTAMP '2024-02-01 06:00:00' AS ingested_at, true AS same_batch FROM raw"""
    ),
    "bronze_scan": sql(
        f"""SELECT if(line <= 3, DATE '2024-02-01', DATE '2024-02-02') AS ingest_date,
        'orders' AS _source,
        if(line <= 3, TIMESTAMP '{DAY_1}', TIMESTAMP '{DAY_2}') AS _ingested_at,
        count(*) AS rows, count(DISTINCT unique_key) AS keys FROM raw GROUP BY ALL"""
    ),
    "stream_available_now": sql(
        f"""SELECT {RAW_LIST}, 'files' AS _source, TIMESTAMP '{DAY_1}' AS _ingested_at,
        DATE '2024-02-01' AS ingest_date FROM raw"""
    ),
    "run_state_roundtrip": sql(
        f"""SELECT 2::BIGINT AS seq, 'r2' AS run_id, TIMESTAMP '1990-01-01' AS since,
        max({CREATED}) AS watermark, 'r2' AS published_run, 2::BIGINT AS fetched FROM raw"""
    ),
    "incremental_two_runs": sql(
        "FROM staged_silver", TWO_RUNS, staged("two_runs"), judged()
    ),
    "run_log": sql(
        run_line(
            1, "first", "f_", run_id="'first'", since="TIMESTAMP '1990-01-01'",
            fetched=f"(SELECT count(*) FROM raw WHERE {FIRST_UNTIL})",
            watermark=FIRST_NEWEST, published_run="'first'",
        )
        + "\nUNION ALL BY NAME\n"
        + run_line(
            2, "second", "s_", run_id="'second'", since=FIRST_NEWEST,
            fetched=f"(SELECT count(*) FROM raw WHERE {CREATED} > {FIRST_NEWEST})",
            watermark=f"(SELECT max({CREATED}) FROM raw)", published_run="'second'",
        ),
        pulled("first_rows", (FIRST_UNTIL, DAY_1)), staged("first_rows", "first"), judged("first"),
        marts("first_silver", "f_"),
        TWO_RUNS, staged("two_runs", "second"), judged("second"), marts("second_silver", "s_"),
    ),
    "late_update_lookback": sql(
        "FROM staged_silver",
        pulled("looked", ("line <= 3", DAY_1), (f"line > 3 AND {CREATED} > {LATE_AFTER}", DAY_2)),
        staged("looked"),
        judged(),
    ),
    "rerun_idempotent": sql(
        f"""SELECT seq::BIGINT AS seq, if(seq = 2, 0, fetched)::BIGINT AS fetched,
        (SELECT count(*) FROM staged_silver) AS good_rows, watermark,
        fetched AS bronze_rows, 1::BIGINT AS batches, 0::BIGINT AS lost, 0::BIGINT AS added
        FROM (SELECT count(*) AS fetched, max({CREATED}) AS watermark FROM raw)
        CROSS JOIN (VALUES (1), (2), (3)) AS s(seq)""",
        *JUDGED,
    ),
    "gate_failure_outcome": sql(
        f"""SELECT seq::BIGINT AS seq, status, fetched, {BAD_START} AS watermark, 'good' AS published_run,
        (SELECT count(*) FROM later_quarantine) AS evidence_rows,
        (SELECT count(*) FROM first_silver) AS visible_rows,
        (SELECT count(*) FROM both_rows) AS bronze_rows
        FROM (SELECT 1 AS seq, 'published' AS status, count(*) AS fetched FROM first_rows
              UNION ALL
              SELECT 2, 'failed', count(*) FROM both_rows WHERE _ingested_at = TIMESTAMP '{DAY_2}')""",
        *BAD_RUN,
    ),
    "gate_recovery": sql(f"SELECT {KEY_TEXT} FROM staged_quarantine", RECOVERED, staged("recovered"), judged()),
    "catalog_tables": sql(
        f"""SELECT 'bronze' AS table_name, 16::INTEGER AS columns, count(*) AS rows FROM raw
        UNION ALL SELECT 'silver', 14, count(*) FROM published_silver
        UNION ALL SELECT 'quarantine', 15, count(*) FROM published_quarantine
        UNION ALL SELECT '{MARTS[0]}', 6, count(*) FROM response
        UNION ALL SELECT '{MARTS[1]}', 5, count(*) FROM complaints
        UNION ALL SELECT '{MARTS[2]}', 6, count(*) FROM sla""",
        ONE_RUN, staged("one_run", "published"), judged("published"), marts("published_silver"),
    ),
    "report_bronze_stats": sql(BRONZE_STATS),
    "report_silver_stats": sql(SILVER_STATS, *JUDGED),
    "report_rule_counts": sql(
        f"""SELECT position::INTEGER AS position, rule,
        (SELECT count(*) FROM staged_quarantine
         WHERE list_contains(string_split(failed_rules, ','), rule)) AS failures
        FROM (VALUES {", ".join(f"({i}, '{r}')" for i, r in enumerate(RULES))}) AS r(position, rule)""",
        *JUDGED,
    ),
    "report_agency_breach": sql("FROM agencies", *ALL_MARTS, AGENCIES.format(n=8)),
    "report_sla_grid": sql(
        """SELECT agency, strftime(month, '%Y-%m') AS label, breach_rate
        FROM (SELECT agency, month FROM (SELECT agency FROM agencies),
              (SELECT DISTINCT month FROM sla SEMI JOIN agencies USING (agency)))
        LEFT JOIN sla USING (agency, month)""",
        *ALL_MARTS,
        AGENCIES.format(n=10),
    ),
    "report_response_series": sql(
        "SELECT strftime(month, '%Y-%m') AS month, "
        + ", ".join(f"""max(median_response_hours) FILTER (borough = '{a}') AS "{a}\"""" for a in AREAS)
        + " FROM response GROUP BY ALL",
        *ALL_MARTS,
    ),
    "report_busiest_zips": sql("FROM zips", *ALL_MARTS, ZIPS),
    "report_zip_complaints": sql("FROM complaints SEMI JOIN zips USING (incident_zip)", *ALL_MARTS, ZIPS),
    "report_stats": sql("FROM stats", *WITH_STATS),
    "report_layer_summary": sql(
        "SELECT 'bronze' AS layer, 'raw rows' AS table_name, bronze_rows AS rows FROM stats"
        " UNION ALL SELECT 'bronze', 'distinct unique_key', bronze_keys FROM stats"
        " UNION ALL SELECT 'silver', 'published requests', silver_rows FROM stats"
        " UNION ALL SELECT 'quarantine', 'rejected requests', quarantined FROM stats"
        + "".join(f" UNION ALL SELECT 'gold', '{m}', {m} FROM stats" for m in MARTS),
        *WITH_STATS,
    ),
    "report_summary_lines": sql(
        f"""SELECT 1::INTEGER AS line, 'created from ' || strftime(first_created, '%Y-%m-%d') || ' to '
            || strftime(last_created, '%Y-%m-%d') || ' in ' || months || ' months' AS text FROM stats
        UNION ALL SELECT 2, {thousands('quarantined')} || ' of ' || {thousands('staged_rows')}
            || ' requests quarantined, ' || {percent('fail_rate', 2)} || ' (allowed '
            || {percent('threshold', 0)} || ')' FROM stats
        UNION ALL SELECT 3, 'requests per broken rule: '
            || concat_ws(', ', {", ".join(f"'{r}: ' || {r}" for r in RULES)}) FROM stats
        UNION ALL SELECT 4, 'SLA of ' || sla_hours || ' hours' FROM stats""",
        *WITH_STATS,
    ),
    "report_gate": sql(
        " UNION ALL ".join(
            f"SELECT {i}::INTEGER AS position, '{r}' AS rule, {r} AS failures, fail_rate, threshold FROM stats"
            for i, r in enumerate(RULES)
        ),
        *WITH_STATS,
    ),
    "report_tiles": sql(
        f"""SELECT 'bronze rows' AS label, {thousands('bronze_rows')} AS value,
            bronze_batches || ' batches' AS note FROM stats
        UNION ALL SELECT 'silver rows', {thousands('silver_rows')}, 'latest version per key' FROM stats
        UNION ALL SELECT 'quarantined', {thousands('quarantined')},
            {percent('fail_rate', 2)} || ' of staged rows' FROM stats
        UNION ALL SELECT 'gold tables', '3', {thousands(GOLD_SUM)} || ' rows total' FROM stats
        UNION ALL SELECT 'quality gate', if(fail_rate <= threshold, 'PASSED', 'FAILED'),
            'fails above ' || {percent('threshold', 0)} FROM stats""",
        *WITH_STATS,
    ),
}

BY_DAY = f"""by_day AS (
    SELECT {RAW_LIST.replace("created_date", "substr(created_date, 1, 10) || 'T00:00:00.000' AS created_date")},
           TIMESTAMP '{DAY_1}' AS _ingested_at, DATE '2024-02-01' AS ingest_date, 'b' AS _batch_id
    FROM raw)"""
REINGESTED = f"""reingested AS (
    SELECT {RAW_LIST}, if(line <= 3, TIMESTAMP '{DAY_1}', TIMESTAMP '{DAY_2}') AS _ingested_at,
           DATE '2024-02-01' AS ingest_date, 'b' AS _batch_id
    FROM raw)"""
PUBLISHED = (ONE_RUN, staged("one_run"), judged(), marts("staged_silver"))


FEW = "(coalesce(try_cast(unique_key AS BIGINT) % 25600 < 256, false) AND line > 3)"


def placed(mart: str) -> str:
    keys = MART_ORDER[mart]
    order = ", ".join(f"{k} NULLS LAST" for k in keys)
    texts = ", ".join(f"{k}::VARCHAR AS key_{i}" for i, k in enumerate(keys))
    return f"SELECT '{mart}' AS mart, row_number() OVER (ORDER BY {order}) - 1 AS position, {texts} FROM {MART_CTE[mart]}"


ORACLE |= {
    "paged_run": sql(
        "FROM staged_silver", pulled("window_rows", (IN_WINDOW, DAY_1)), staged("window_rows"), judged()
    ),
    "csv_run": ORACLE["silver_published"],
    "landing_resume": ORACLE["bronze_ingest"],
    "stream_replay": ORACLE["bronze_ingest"],
    "limited_runs_complete": sql("SELECT * EXCLUDE (ingest_date) FROM staged_silver", BY_DAY, staged("by_day"), judged()),
    "merge_older_reingest": sql("FROM staged_silver", REINGESTED, staged("reingested"), judged()),
    "marts_rebuilt": sql(
        "SELECT *, 2::BIGINT AS records, 'sla-24' AS marts_run, 'only' AS published_run FROM sla",
        ONE_RUN, staged("one_run"), judged(), marts("staged_silver", sla=24),
    ),
    "lake_report": sql("SELECT * EXCLUDE (bronze_batches) FROM stats", *PUBLISHED, STATS),
    "gold_order": sql(" UNION ALL ".join(placed(m) for m in MARTS), *PUBLISHED),
    "merge_few_new": sql("FROM staged_silver", pulled("few_new", (f"NOT {FEW}", DAY_1), (FEW, DAY_2)), staged("few_new"), judged()),
    "bronze_manifest": sql(
        f"""SELECT if(line <= 3, DATE '2024-02-01', DATE '2024-02-02') AS ingest_date,
        if(line <= 3, TIMESTAMP '{DAY_1}', TIMESTAMP '2024-02-02 05:00:00') AS _ingested_at, count(*) AS rows,
        min(try_cast(unique_key AS BIGINT)) AS low_key, max(try_cast(unique_key AS BIGINT)) AS high_key
        FROM raw GROUP BY ALL"""
    ),
}
