"""The registered queries as DuckDB SQL over the same parquet tables.

Written from the definitions of the results, not from the Spark code: each text stands
alone on the test tables.
"""

from __future__ import annotations

AS_OF = "date '2001-08-02'"

TRAIL = """
trail AS (
  SELECT o_custkey AS client_id, o_orderkey AS event_id,
    CASE WHEN o_orderkey % 53 <> 0 THEN c_name END AS name,
    n_name AS country,
    'City ' || (o_custkey % 40) AS city,
    'Street ' || (o_custkey % 97) AS street,
    CASE WHEN o_orderkey % 61 <> 0 THEN CAST(o_custkey % 200 AS varchar) END AS house_no,
    CASE o_orderkey % 8 WHEN 0 THEN NULL WHEN 1 THEN 'n/a'
      ELSE '(' || lpad(CAST(11 + o_custkey % 89 AS varchar), 2, '0') || ')'
        || CASE WHEN o_orderkey % 8 = 2 THEN ' ' ELSE '' END
        || CASE WHEN o_orderkey % 8 = 3 THEN '9999' ELSE '99999' END
        || '-' || lpad(CAST(o_orderkey % 10000 AS varchar), 4, '0') END AS phone,
    date '1880-01-01' + CAST((o_custkey * 37) % 52000 AS integer) AS birth_date,
    o_orderdate AS updated_at,
    CASE o_orderstatus WHEN 'O' THEN 'PF' WHEN 'F' THEN 'PJ' ELSE 'XX' END AS person_type,
    CAST(CASE WHEN o_orderkey % 97 = 0 THEN -o_totalprice
              WHEN o_orderkey % 89 = 0 THEN o_totalprice * 10
              ELSE o_totalprice END AS decimal(10,2)) AS income,
    CASE WHEN o_orderkey % 23 = 0 THEN 'D' ELSE 'U' END AS op,
    CAST(year(o_orderdate) * 10000 + 101 AS varchar) AS load_date
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
)"""


def latest(source: str, order: str = "updated_at DESC, event_id DESC") -> str:
    return (
        f"SELECT * FROM {source} "
        f"QUALIFY row_number() OVER (PARTITION BY client_id ORDER BY {order}) = 1"
    )


def strict_phone(source: str) -> str:
    return (
        f"SELECT * REPLACE (CASE WHEN regexp_matches(phone, '^\\([0-9]{{2}}\\)[0-9]{{5}}-[0-9]{{4}}$')"
        f" THEN phone END AS phone) FROM {source}"
    )


SILVER = f"{TRAIL}, silver AS ({strict_phone('(' + latest('trail') + ')')})"

TIME = "strftime({0}, '%Y-%m-%d %H:%M:%S.%f') AS {0}"
STATE = (
    "client_id, event_id, name, country, city, street, house_no, phone, "
    "CAST(birth_date AS varchar) AS birth_date, "
    + TIME.format("updated_at")
    + ", person_type, CAST(income AS varchar) AS income"
)


def months(born: str) -> str:
    """Months between as-of date and birth: whole months when the days agree or both end
    their month, otherwise with 31sts of a month, to 8 places."""
    a, b = AS_OF, born
    whole = f"(year({a}) - year({b})) * 12 + (month({a}) - month({b}))"
    return (
        f"CASE WHEN day({a}) = day({b}) OR ({a} = last_day({a}) AND {b} = last_day({b})) "
        f"THEN {whole} ELSE round({whole} + (day({a}) - day({b})) / 31.0, 8) END"
    )


AGE = f"CAST(floor(({months('birth_date')}) / 12) AS integer)"


def violations(
    rule: str,
    column: str,
    where: str,
    offender: str,
    params: str = "'{}'",
    source: str = "silver",
    more: str = "",
) -> str:
    return (
        f"SELECT '{rule}' AS rule, '{column}' AS analyzed_column, client_id, "
        f"{offender} AS offender, {params} AS rule_params{more} FROM {source} WHERE {where}"
    )


def nulls(columns: list[str], source: str = "silver", more: str = "") -> str:
    listed = ", ".join(f"CASE WHEN {c} IS NULL THEN '{c}' END" for c in columns)
    params = f"""'{{"null":["' || concat_ws('","', {listed}) || '"]}}'"""
    where = " OR ".join(f"{c} IS NULL" for c in columns)
    return violations(
        "nulls_required", ",".join(columns), where, "CAST(NULL AS varchar)", params, source, more
    )


REQUIRED = (
    "client_id name country city street house_no phone birth_date updated_at person_type income"
).split()
LENIENT = r"'^\([0-9]{2}\)[ \t\n\f\r]?[0-9]{4,5}-[0-9]{4}$'"
# Written in the rule's own notation, JSON-escaped, because it is part of the result.
LENIENT_SHOWN = r"""'{"pattern":"\\A\\(\\d{2}\\)\\s?\\d{4,5}-\\d{4}\\z"}'"""


def category(source: str = "silver", more: str = "") -> str:
    return violations(
        "categorical_domain",
        "person_type",
        "person_type NOT IN ('PF', 'PJ')",
        "person_type",
        """'{"allowed":["PF","PJ"]}'""",
        source,
        more,
    )


def negative(more: str = "") -> str:
    return violations(
        "negative_salary", "income", "income < 0", "CAST(income AS varchar)", more=more
    )


def future(more: str = "") -> str:
    return violations(
        "birth_future_date",
        "birth_date",
        f"birth_date > {AS_OF}",
        "CAST(birth_date AS varchar)",
        more=more,
    )


def age(low: int, high: int, more: str = "") -> str:
    params = f"""'{{"age":' || {AGE} || ',"max":{high},"min":{low}}}'"""
    return violations(
        "birth_incoherent_age",
        "birth_date",
        f"{AGE} < {low} OR {AGE} > {high}",
        "CAST(birth_date AS varchar)",
        params,
        more=more,
    )


def outlier(more: str = "") -> str:
    """In whole cents: value * count > 3 * sum; the threshold shown is 3 * sum / count,
    rounded down to cents."""
    cents = "(SELECT CAST(sum(income) * 100 AS hugeint) FROM silver)"
    n = "(SELECT count(income) FROM silver)"
    limit = f"CAST(CAST(3 * {cents} // {n} AS decimal(38,2)) / 100 AS decimal(38,2))"
    params = f"""'{{"multiplier":3.0,"threshold":"' || {limit} || '"}}'"""
    return violations(
        "salary_discrepant_mean",
        "income",
        f"CAST(income * 100 AS hugeint) * {n} > 3 * {cents}",
        "CAST(income AS varchar)",
        params,
        more=more,
    )


def address(more: str = "") -> str:
    known = (
        "SELECT 1 FROM customer JOIN nation ON c_nationkey = n_nationkey "
        "WHERE c_mktsegment <> 'HOUSEHOLD' AND n_name = country "
        "AND 'City ' || (c_custkey % 40) = city AND 'Street ' || (c_custkey % 97) = street "
        "AND CAST(c_custkey % 200 AS varchar) = house_no"
    )
    return violations(
        "address_not_found",
        "country/city/street/house_no",
        f"NOT EXISTS ({known})",
        "concat_ws(' | ', country, city, street, house_no)",
        more=more,
    )


def phones() -> str:
    return violations(
        "phone_pattern",
        "phone",
        f"NOT regexp_matches(phone, {LENIENT})",
        "phone",
        LENIENT_SHOWN,
        "trail",
    )


def silver_rules(more: str = "") -> str:
    parts = (
        nulls(REQUIRED, more=more),
        category(more=more),
        negative(more),
        outlier(more),
        future(more),
        age(0, 120, more),
        address(more),
    )
    return " UNION ALL ".join(parts)


REPORT = f"{silver_rules()} UNION ALL {phones()}"

AREA_CODES = ", ".join(
    f"'{code}'"
    for code in range(11, 100)
    if code not in (20, 23, 25, 26, 29, 30, 36, 39, 40, 50, 52, 56, 57, 58, 59, 60, 70, 72, 76, 78, 80, 90)
)
AREA = r"regexp_extract(phone, '^\(([0-9]{2})\)', 1)"
VARIETY = "(" + " + ".join(f"CAST(contains(phone, '{d}') AS integer)" for d in range(10)) + ")"
PHONE_EXTRA = violations(
    "phone_extra",
    "phone",
    f"regexp_matches(phone, {LENIENT}) AND ({AREA} NOT IN ({AREA_CODES}) OR {VARIETY} < 4)",
    "phone",
    f"""'{{"area_code":"' || {AREA} || '","digits":' || {VARIETY} || '}}'""",
    "trail",
)

EVENT = (
    "event_id, " + TIME.format("ts") + ", user_id, event_type, value, props, "
    "strftime(ts, '%Y%m%d') AS load_date"
)
LANDED = (
    "SELECT event_id, " + TIME.format("ts") + ", user_id, upper(event_type) AS event_type, value, "
    "props AS properties, strftime(ts, '%Y%m%d') AS load_date FROM events"
)

FAULTY = """
faulty AS (
  SELECT event_id AS k, event_type, ts, user_id, value, props || ', x' AS props,
    strftime(ts, '%Y%m%d') AS load_date,
    strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS t,
    ',"' || replace(props, '"', '""') || ', x"' AS shown_props,
    CASE WHEN event_id % 11 = 0 THEN 'wrong' WHEN event_id % 13 = 0 THEN 'short'
         WHEN event_id % 17 = 0 THEN 'long' WHEN event_id % 19 = 0 THEN 'keyless'
         WHEN event_id % 23 = 0 THEN 'number' END AS fault
  FROM events
)"""
REJECTS = f"""WITH {FAULTY}
  SELECT CASE WHEN fault <> 'keyless' THEN CAST(k AS varchar) END AS event_id,
    CASE WHEN fault <> 'short' THEN event_type END AS event_type,
    CASE WHEN fault NOT IN ('short', 'number') THEN value END AS value,
    CASE WHEN fault <> 'short' THEN props END AS props,
    CASE fault WHEN 'wrong' THEN k || ',' || t || ',zz,' || event_type || ',' || value || shown_props
               WHEN 'short' THEN k || ',' || t
               WHEN 'long' THEN k || ',' || t || ',' || user_id || ',' || event_type || ',' || value
                 || shown_props || ',extra'
               WHEN 'number' THEN k || ',' || t || ',' || user_id || ',' || event_type || ',1.5.2'
                 || shown_props
               END AS line,
    CASE fault WHEN 'keyless' THEN 'null_key' ELSE 'bad_line' END AS reason, load_date
  FROM faulty WHERE fault IS NOT NULL"""
BRONZE_AUDIT = f"""WITH {FAULTY}, runs AS (
    SELECT * FROM (VALUES
      (1, 'full-refresh', '2024-01-31 06:00:00.000000', '00000000', '99999999'),
      (2, 'd-x', '2024-01-31 07:00:00.000000', '20240110', '20240112'),
      (3, 'd-1', '2024-01-31 08:00:00.000000', '20231231', '20231231')
    ) AS r(version, operation, run_ts, low, high))
  SELECT CAST(version AS bigint) AS version, operation, run_ts,
    count(*) FILTER (WHERE k IS NOT NULL AND fault IS NULL) AS rows,
    count(fault) AS rejects,
    coalesce(string_agg(DISTINCT load_date, ',' ORDER BY load_date) FILTER (WHERE fault IS NULL), '')
      AS days
  FROM runs LEFT JOIN faulty ON load_date BETWEEN low AND high
  GROUP BY version, operation, run_ts"""

FIRST = "updated_at < timestamp '1999-01-01'"
SECOND = "updated_at >= timestamp '1997-01-01'"


def batch_counts(old: str, new: str, same: str = "false") -> str:
    """Actions of a batch ``new`` on the state left by ``old``."""
    newer = "(n.updated_at, n.event_id) > (o.updated_at, o.event_id)"
    equal = "(n.updated_at, n.event_id) = (o.updated_at, o.event_id)"
    return f"""
    count(*) FILTER (WHERE o.client_id IS NULL) AS inserted,
    count(*) FILTER (WHERE o.client_id IS NOT NULL AND {newer} AND NOT ({same})) AS updated,
    count(*) FILTER (WHERE o.client_id IS NOT NULL AND ({equal} OR {newer} AND ({same}))) AS unchanged,
    count(*) FILTER (WHERE o.client_id IS NOT NULL AND NOT {equal} AND NOT {newer}) AS stale
    FROM ({latest(f'(SELECT * FROM trail WHERE {new})')}) n
    LEFT JOIN ({latest(f'(SELECT * FROM trail WHERE {old})')}) o ON n.client_id = o.client_id"""


EARLIER = strict_phone("(" + latest(f"(SELECT * FROM trail WHERE {FIRST})") + ")")
INCREMENTAL = f"""
WITH {SILVER},
earlier AS ({EARLIER}),
seen AS ({category('earlier', ', updated_at')}),
found AS ({category('silver', ', updated_at')} UNION ALL {nulls(REQUIRED, 'silver', ', updated_at')})
SELECT * REPLACE ({TIME.format('updated_at')}), '20010802' AS run_date FROM found
WHERE NOT EXISTS (SELECT 1 FROM seen WHERE seen.client_id = found.client_id
  AND seen.updated_at IS NOT DISTINCT FROM found.updated_at AND seen.rule = found.rule)"""
PERSISTED = f"""
WITH {TRAIL}, before AS (
  WITH silver AS ({EARLIER}) {silver_rules(', ' + TIME.format('updated_at'))}
), now AS (
  WITH silver AS ({strict_phone('(' + latest('trail') + ')')})
  {silver_rules(', ' + TIME.format('updated_at'))}
)
SELECT *, '2001-08-02 00:00:00.000000' AS checked_at FROM (
  SELECT *, '20010801' AS run_date FROM before UNION ALL SELECT *, '20010802' AS run_date FROM now)"""

# Two deliveries of the client files: all events, and those from 1996 on once more, some of them
# withdrawn and some with another street.
DELIVERIES = f"""{TRAIL}, first_delivery AS (
  SELECT * REPLACE (upper(name) AS name, updated_at + to_microseconds(event_id) AS updated_at)
  FROM trail
), second_delivery AS (
  SELECT * REPLACE (CASE WHEN event_id % 7 = 0 THEN street || ' B' ELSE street END AS street)
  FROM first_delivery WHERE load_date >= '19960101' AND event_id % 5 <> 0
)"""
ETL_ORDER = "updated_at DESC, load_date DESC, ingest DESC"
ETL_COLUMNS = STATE.replace("event_id, ", "") + ", load_date"
CURRENT = f"WITH {TRAIL} SELECT {STATE} FROM ({latest('trail')})"
LIVING = f"{CURRENT} WHERE op <> 'D'"


def average_age(source: str, tables: str) -> str:
    return (
        f"WITH {tables} SELECT round(avg(({months('birth_date')}) / 12.0), 6) AS avg_age_years "
        f"FROM {source}"
    )


def top(source: str) -> str:
    return (
        f"WITH {TRAIL} SELECT client_id, count(*) AS updates FROM {source} GROUP BY client_id "
        "ORDER BY updates DESC, client_id LIMIT 5"
    )


ORACLES: dict[str, str] = {
    "ingest_csv": (
        f"SELECT *, load_date AS source_day, '2024-01-31 06:00:00.000000' AS ingested_at FROM ({LANDED})"
    ),
    "ingest_rejects": REJECTS,
    "cdc_rejects": REJECTS,
    "ingest_accepted": f"""WITH {FAULTY}
      SELECT k AS event_id, {TIME.format('ts')}, user_id, event_type, value, props, load_date
      FROM faulty WHERE fault IS NULL""",
    "window_d1": f"{LANDED} WHERE CAST(ts AS date) = date '2024-01-30'",
    "window_dx": f"{LANDED} WHERE CAST(ts AS date) BETWEEN date '2024-01-20' AND date '2024-01-31'",
    "window_full": LANDED,
    "bronze_distinct": (
        f"SELECT *, 'a.csv' AS source_file FROM "
        f"(SELECT DISTINCT {EVENT} FROM (SELECT * FROM events UNION ALL SELECT * FROM events))"
    ),
    "bronze_append": f"SELECT {EVENT} FROM events WHERE CAST(ts AS date) <= date '2024-01-30'",
    "bronze_missing_day": f"""SELECT * REPLACE (
        CASE WHEN load_date > '20240110' THEN upper(event_type) ELSE event_type END AS event_type)
      FROM (SELECT {EVENT} FROM events)
      WHERE load_date BETWEEN '20240101' AND '20240131' AND load_date <> '20240120'""",
    "bronze_late_files": f"""WITH daily AS (SELECT {EVENT} FROM events)
      SELECT *, CASE WHEN load_date = '20240120' OR load_date IN (
          SELECT load_date FROM daily WHERE event_id % 7 = 0 AND load_date <= '20240110')
        THEN '2024-02-01' ELSE '2024-01-31' END || ' 00:00:00.000000' AS ingested_at
      FROM daily WHERE load_date <> '20240120' OR event_type <> 'click'""",
    "bronze_forms": (
        "SELECT event_id, user_id, event_type AS channel, "
        "CAST(CAST(event_id % 1000 AS decimal(20,6)) AS varchar) AS amount, "
        "strftime(ts, '%Y%m%d') AS load_date FROM events WHERE CAST(ts AS date) <= date '2024-12-31'"
    ),
    "bronze_audit": BRONZE_AUDIT,
    "bronze_replace_days": f"""SELECT {EVENT} FROM events
      WHERE CAST(ts AS date) NOT BETWEEN date '2024-01-10' AND date '2024-01-12'
      UNION ALL SELECT {EVENT} FROM events
      WHERE CAST(ts AS date) IN (date '2024-01-10', date '2024-01-11') AND event_type = 'click'""",
    "bronze_full_refresh": (
        "SELECT event_id, " + TIME.format("ts") + ", user_id, event_type, "
        "upper(event_type) AS kind, strftime(ts, '%Y%m%d') AS load_date FROM events"
    ),
    "bronze_evolve": (
        f"SELECT {EVENT}, CASE WHEN CAST(ts AS date) >= date '2024-01-16' "
        "THEN upper(event_type) END AS channel FROM events"
    ),
    "bronze_window": (
        f"WITH {TRAIL} SELECT client_id, event_id, load_date FROM trail "
        "WHERE year(updated_at) BETWEEN 1997 AND 1999"
    ),
    "catalog_partitions": (
        f"WITH {TRAIL} SELECT load_date, lower(person_type) AS kind, count(*) AS events FROM trail "
        "WHERE load_date <> '19950101' GROUP BY ALL"
    ),
    "silver_latest": CURRENT,
    "silver_phone_clean": (
        f"WITH {TRAIL} {strict_phone('(SELECT client_id, event_id, phone FROM trail)')}"
    ),
    "silver_upsert": CURRENT,
    "silver_changed_rows": CURRENT,
    "silver_rebuild": f"WITH {TRAIL} SELECT {STATE} FROM ({latest(f'(SELECT * FROM trail WHERE {FIRST})')})",
    "silver_upsert_changed": (
        f"WITH {TRAIL} SELECT 'new' AS batch_id, "
        + batch_counts(
            FIRST,
            SECOND,
            "n.person_type IS NOT DISTINCT FROM o.person_type AND n.phone IS NOT DISTINCT FROM o.phone",
        )
    ),
    "batch_audit": (
        f"WITH {TRAIL} SELECT CAST(2 AS bigint) AS version, 'late' AS batch_id, "
        "'2001-08-02 00:00:00.000000' AS run_ts, 'upsert' AS operation, "
        f"(SELECT count(DISTINCT client_id) FROM trail WHERE {SECOND} AND client_id NOT IN "
        f"(SELECT client_id FROM trail WHERE {FIRST})) AS kept, "
        + batch_counts(SECOND, FIRST)
    ),
    "client_etl": f"""WITH {DELIVERIES}, cleaned AS ({strict_phone(
        '(SELECT *, 1 AS ingest FROM first_delivery UNION ALL SELECT *, 2 FROM second_delivery)')})
      SELECT {ETL_COLUMNS} FROM ({latest('cleaned', ETL_ORDER)})""",
    "client_etl_refresh": f"""WITH {DELIVERIES}, cleaned AS ({strict_phone(
        '(SELECT *, 2 AS ingest FROM second_delivery)')})
      SELECT {ETL_COLUMNS} FROM ({latest('cleaned', ETL_ORDER)})""",
    "dq_category": f"WITH {SILVER} {category()}",
    "dq_negative": f"WITH {SILVER} {negative()}",
    "dq_future_date": f"WITH {SILVER} {future()}",
    "dq_age_range": f"WITH {SILVER} {age(18, 120)}",
    "dq_nulls": f"WITH {SILVER} {nulls(['name', 'house_no', 'phone'])}",
    "dq_pattern": f"WITH {TRAIL} {phones()}",
    "dq_phone_extra": f"WITH {TRAIL} {PHONE_EXTRA}",
    "dq_mean_outlier": f"WITH {SILVER} {outlier()}",
    "dq_reference_missing": f"WITH {SILVER} {address()}",
    "dq_report": f"WITH {SILVER} {REPORT}",
    "dq_incremental": INCREMENTAL,
    "dq_persisted": PERSISTED,
    "dq_mean_kept": f"WITH {SILVER} {outlier()}",
    "dq_mean_outlier_wide": f"WITH {SILVER} SELECT client_id, offender FROM ({outlier()})",
    "top_updated": top("trail"),
    "top_updated_distinct": top(
        "(SELECT DISTINCT * FROM (SELECT * FROM trail UNION ALL SELECT * FROM trail))"
    ),
    "avg_age_per_event": average_age("trail", TRAIL),
    "avg_age_per_client": average_age("silver", SILVER),
    "cdc_apply": LIVING,
    "cdc_purged": f"""WITH {TRAIL}, first_batch AS ({latest(
        "(SELECT * FROM trail WHERE updated_at < timestamp '1999-01-01' AND event_id % 3 <> 0)")})
      SELECT {STATE} FROM ({latest(
        "(SELECT * FROM first_batch WHERE op <> 'D' OR updated_at >= timestamp '1998-01-01' "
        "UNION ALL SELECT * FROM trail WHERE updated_at >= timestamp '1998-01-01')")})
      WHERE op <> 'D'""",
    "cdc_late_events": (
        f"WITH {TRAIL} SELECT client_id, event_id, {TIME.format('updated_at')}, 'too_late' AS reason "
        "FROM trail WHERE updated_at < timestamp '1998-01-01'"
    ),
    "cdc_stream": LIVING,
    "cdc_keyed_stream": LIVING,
    "gold_clients": (
        f"WITH {SILVER} SELECT country, person_type, count(*) AS clients, "
        "CAST(sum(income) AS varchar) AS income FROM silver GROUP BY ALL"
    ),
    "gold_incremental": (
        f"WITH {TRAIL} SELECT country, person_type, count(*) AS clients, "
        f"CAST(sum(income) AS varchar) AS income FROM ({latest('trail')}) WHERE op <> 'D' GROUP BY ALL"
    ),
    "gold_dq_summary": (
        f"WITH {SILVER} SELECT rule, analyzed_column, count(*) AS violations "
        f"FROM ({REPORT}) GROUP BY ALL"
    ),
}
