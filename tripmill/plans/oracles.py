"""An independent SQL statement for every registered query (DuckDB dialect)."""

from __future__ import annotations

# The derived trips, straight from the tables.
_RAW = """
yellow_once AS (
    SELECT l_suppkey % 2 + 1 AS vendorid,
           CASE WHEN l_partkey % 29 = 0 THEN NULL
                ELSE CAST(l_quantity AS BIGINT) % 7 END AS passenger_count,
           l_shipdate + to_hours(CAST((l_orderkey + l_linenumber * 5) % 24 AS INTEGER))
               AS pickup_datetime,
           l_shipdate + to_hours(CAST((l_orderkey + l_linenumber * 5) % 24 AS INTEGER))
               + INTERVAL '15' MINUTE AS dropoff_datetime,
           CASE WHEN l_partkey % 41 = 0 THEN -l_extendedprice
                ELSE l_extendedprice END AS total_amount,
           l_orderkey % 5 + 1 AS file_number,
           l_returnflag
    FROM lineitem
),
yellow_raw AS (
    SELECT * EXCLUDE (l_returnflag) FROM yellow_once
    UNION ALL
    SELECT * EXCLUDE (l_returnflag) FROM yellow_once WHERE l_returnflag = 'R'
),
green_raw AS (
    SELECT o_custkey % 2 + 1 AS vendorid,
           CASE WHEN o_custkey % 29 = 0 THEN NULL
                ELSE o_orderkey % 7 END AS passenger_count,
           o_orderdate + to_hours(CAST(o_orderkey % 24 AS INTEGER)) AS pickup_datetime,
           o_orderdate + to_hours(CAST(o_orderkey % 24 AS INTEGER))
               + INTERVAL '15' MINUTE AS dropoff_datetime,
           CASE WHEN o_custkey % 41 = 0 THEN -o_totalprice
                ELSE o_totalprice END AS total_amount,
           o_orderkey % 5 + 1 AS file_number
    FROM orders
)
"""

_LAYERS = f"""
WITH {_RAW},
typed AS (
    SELECT service_type, CAST(vendorid AS INTEGER) AS vendorid,
           CAST(passenger_count AS INTEGER) AS passenger_count,
           pickup_datetime, dropoff_datetime, CAST(total_amount AS DOUBLE) AS total_amount
    FROM (SELECT 'yellow' AS service_type, * FROM yellow_raw
          UNION ALL
          SELECT 'green' AS service_type, * FROM green_raw)
),
scoped AS (
    SELECT * FROM typed
    WHERE pickup_datetime >= DATE '1997-01-01' AND pickup_datetime < DATE '1997-06-01'
),
silver AS (SELECT DISTINCT * FROM scoped),
consumption AS (
    SELECT vendorid AS "VendorID", passenger_count, total_amount,
           pickup_datetime AS tpep_pickup_datetime, dropoff_datetime AS tpep_dropoff_datetime
    FROM silver WHERE service_type = 'yellow'
),
trips AS (
    SELECT service_type, vendorid AS "VendorID", passenger_count,
           pickup_datetime, dropoff_datetime, total_amount
    FROM silver
)
"""

_MAY = "pickup_datetime >= DATE '1997-05-01' AND pickup_datetime < DATE '1997-06-01'"


def _rounded(expression: str, digits: int) -> str:
    # Half-up on the decimal digits, not on the binary double.
    return f"CAST(round(CAST({expression} AS DECIMAL(38, 10)), {digits}) AS DOUBLE)"


_COMPLETENESS = f"""
WITH {_RAW},
grid AS (
    SELECT service, CAST(DATE '1995-01-01' + to_months(CAST(i AS INTEGER)) AS DATE) AS first_day
    FROM range(0, 84) months(i), (VALUES ('yellow'), ('green')) services(service)
),
found AS (
    SELECT 'yellow' AS service, CAST(date_trunc('month', pickup_datetime) AS DATE) AS first_day,
           count(*) AS n
    FROM yellow_raw GROUP BY ALL
    UNION ALL
    SELECT 'green', CAST(date_trunc('month', pickup_datetime) AS DATE), count(*)
    FROM green_raw GROUP BY ALL
)
SELECT coalesce(g.service, f.service) AS service,
       strftime(coalesce(g.first_day, f.first_day), '%Y-%m') AS month,
       f.n IS NOT NULL AS present, COALESCE(f.n, 0) AS rows_found
FROM grid g FULL JOIN found f ON f.service = g.service AND f.first_day = g.first_day
"""

_DRIFT = """
WITH seen(column_name, files, types, target_type, skipped_file) AS (
    VALUES ('vendorid', 5, 'bigint, int', 'bigint', 0),
           ('passenger_count', 5, 'bigint, double, int', 'double', 0),
           ('airport_fee', 4, 'double, float, int', 'double', 3),
           ('tpep_pickup_datetime', 5, 'timestamp_ntz', 'timestamp_ntz', 0),
           ('tpep_dropoff_datetime', 5, 'timestamp_ntz', 'timestamp_ntz', 0),
           ('total_amount', 5, 'double', 'double', 0)
),
per_file AS (SELECT l_orderkey % 5 + 1 AS file_number, count(*) AS n FROM lineitem GROUP BY 1)
SELECT s.column_name, CAST(s.files AS BIGINT) AS files, CAST(sum(p.n) AS BIGINT) AS rows,
       s.types, s.target_type, FALSE AS fell_back
FROM seen s JOIN per_file p ON p.file_number <> s.skipped_file
GROUP BY s.column_name, s.files, s.types, s.target_type
"""

_CONFORMED = f"""
WITH {_RAW}
SELECT CAST(vendorid AS BIGINT) AS vendorid,
       CAST(passenger_count AS DOUBLE) AS passenger_count,
       pickup_datetime AS tpep_pickup_datetime,
       dropoff_datetime AS tpep_dropoff_datetime,
       CAST(total_amount AS DOUBLE) AS total_amount,
       CAST(CASE file_number WHEN 1 THEN 1.25 WHEN 4 THEN 1.25 WHEN 5 THEN 2 END AS DOUBLE)
           AS airport_fee,
       'yellow_tripdata_1997-0' || CAST(file_number AS VARCHAR) || '.parquet' AS _source_file
FROM yellow_once
"""

_STATUS = """
WITH expected AS (
    SELECT service, CAST(i AS INTEGER) AS month,
           service || '_tripdata_1997-0' || CAST(i AS VARCHAR) || '.parquet' AS file
    FROM range(1, 7) months(i), (VALUES ('yellow'), ('green')) services(service)
),
landed AS (
    SELECT 'yellow' AS service, l_orderkey % 5 + 1 AS month, count(*) AS n
    FROM lineitem GROUP BY 2
    UNION ALL
    SELECT 'green', o_orderkey % 5 + 1, count(*) FROM orders GROUP BY 2
)
SELECT e.service, e.month, e.file, l.n IS NOT NULL AS present,
       COALESCE(CAST(l.n AS BIGINT), 0) AS rows_found
FROM expected e LEFT JOIN landed l ON l.service = e.service AND l.month = e.month
"""

_FOLDER_DRIFT = f"""
WITH {_RAW}
SELECT CAST(vendorid AS BIGINT) AS vendorid, CAST(passenger_count AS DOUBLE) AS passenger_count,
       CAST(total_amount AS DOUBLE) AS total_amount,
       CAST(CASE file_number % 3 WHEN 1 THEN 0.5 WHEN 2 THEN 1.5 END AS DOUBLE) AS tip,
       'yellow_tripdata_1997-01.parquet' AS _source_file
FROM yellow_once
"""

_DRIFT_TYPES = """
SELECT column_name, CAST(2 AS BIGINT) AS files, (SELECT count(*) FROM lineitem) AS rows,
       types, target_type, target_type = 'string' AS fell_back
FROM (VALUES ('vendorid', 'int, tinyint', 'int'), ('amount', 'bigint, float', 'float'),
             ('pickup', 'date, timestamp_ntz', 'string'), ('passengers', 'bigint, string', 'string')
     ) seen(column_name, types, target_type)
"""

_BAD_CASTS = f"""
WITH {_RAW}
SELECT DISTINCT 'green' AS service_type,
       CASE WHEN passenger_count = 3 THEN NULL ELSE CAST(vendorid AS INTEGER) END AS vendorid,
       CASE WHEN total_amount < 0 THEN NULL ELSE CAST(passenger_count AS INTEGER) END
           AS passenger_count,
       pickup_datetime, dropoff_datetime, CAST(total_amount AS DOUBLE) AS total_amount
FROM green_raw
WHERE pickup_datetime >= DATE '1997-01-01' AND pickup_datetime < DATE '1997-06-01'
"""

_MISFITS = f"""
WITH {_RAW},
misfits AS (
    SELECT *, COALESCE(passenger_count = 3, FALSE) AS bad_vendor,
           COALESCE(total_amount < 0, FALSE) AS bad_passengers
    FROM green_raw
)
"""

_REJECTED = f"""
{_MISFITS}
SELECT 'green' AS service_type,
       CASE WHEN bad_vendor THEN '3.0E10' ELSE CAST(CAST(vendorid AS DOUBLE) AS VARCHAR) END AS vendorid,
       CASE WHEN bad_passengers THEN 'abc' ELSE CAST(passenger_count AS VARCHAR) END AS passenger_count,
       CAST(pickup_datetime AS VARCHAR) AS pickup_datetime,
       CAST(dropoff_datetime AS VARCHAR) AS dropoff_datetime,
       CAST(CAST(total_amount AS DOUBLE) AS VARCHAR) AS total_amount,
       concat_ws('; ', CASE WHEN bad_vendor THEN 'vendorid does not fit int' END,
                 CASE WHEN bad_passengers THEN 'passenger_count does not fit int' END) AS reason
FROM misfits WHERE bad_vendor OR bad_passengers
"""

_ROUTED_AUDIT = f"""
{_MISFITS},
fits AS (SELECT * FROM misfits WHERE NOT bad_vendor AND NOT bad_passengers),
inside AS (
    SELECT vendorid, passenger_count, pickup_datetime, dropoff_datetime, total_amount FROM fits
    WHERE pickup_datetime >= DATE '1997-01-01' AND pickup_datetime < DATE '1997-06-01'
),
counts AS (
    SELECT (SELECT count(*) FROM misfits) AS raw,
           (SELECT count(*) FROM fits WHERE pickup_datetime IS NULL) AS null_pickup,
           (SELECT count(*) FROM inside) AS in_scope,
           (SELECT count(*) FROM (SELECT DISTINCT * FROM inside)) AS kept,
           (SELECT count(*) FROM misfits WHERE bad_vendor OR bad_passengers) AS rejected
)
SELECT 'green' AS service_type, *, raw - rejected - in_scope AS out_of_scope,
       in_scope - kept AS duplicates
FROM counts
"""

_FILE_ACCOUNTS = f"""
WITH {_RAW},
arrived AS (
    SELECT 'yellow' AS service_type, * FROM yellow_raw
    UNION ALL
    SELECT 'green', * FROM green_raw
),
inside AS (
    SELECT * FROM arrived
    WHERE pickup_datetime >= DATE '1997-01-01' AND pickup_datetime < DATE '1997-06-01'
),
firsts AS (SELECT * EXCLUDE (file_number), min(file_number) AS file_number FROM inside GROUP BY ALL),
came AS (SELECT service_type, file_number, count(*) AS raw,
                count(*) FILTER (WHERE pickup_datetime IS NULL) AS null_pickup
         FROM arrived GROUP BY ALL),
scoped AS (SELECT service_type, file_number, count(*) AS in_scope FROM inside GROUP BY ALL),
stays AS (SELECT service_type, file_number, count(*) AS kept FROM firsts GROUP BY ALL),
counts AS (
    SELECT service_type, file_number, raw, null_pickup, COALESCE(in_scope, 0) AS in_scope,
           COALESCE(kept, 0) AS kept
    FROM came LEFT JOIN scoped USING (service_type, file_number)
    LEFT JOIN stays USING (service_type, file_number)
)
SELECT service_type,
       service_type || '_tripdata_1997-0' || CAST(file_number AS VARCHAR) || '.parquet' AS _source_file,
       raw, null_pickup, in_scope, kept, raw - in_scope AS out_of_scope, in_scope - kept AS duplicates
FROM counts
"""

_PIPELINE_RUN = f"""
{_LAYERS},
sizes AS (
    SELECT 'yellow' AS service, (SELECT count(*) FROM yellow_raw) AS raw
    UNION ALL SELECT 'green', (SELECT count(*) FROM green_raw)
),
counts AS (
    SELECT service, raw,
           (SELECT count(*) FROM scoped WHERE service_type = service) AS in_scope,
           (SELECT count(*) FROM silver WHERE service_type = service) AS kept
    FROM sizes
)
SELECT 'bronze.' || service || '_tripdata' AS what, raw AS rows FROM counts
UNION ALL SELECT 'silver.' || service || '_trips', kept FROM counts
UNION ALL SELECT 'out of scope, ' || service, raw - in_scope FROM counts
UNION ALL SELECT 'duplicates, ' || service, in_scope - kept FROM counts
UNION ALL SELECT 'gold.yellow_trips_consumption', count(*) FROM consumption
UNION ALL SELECT 'gold.taxi_trips', count(*) FROM trips
"""

_EVENTS = f"""
SELECT CAST(hour(ts) AS INTEGER) AS hour_of_day, {_rounded('avg(value)', 3)} AS avg_value,
       count(*) AS trips
FROM events WHERE ts >= DATE '2024-01-01' AND ts < DATE '2024-02-01'
"""

_SILVER = f"{_LAYERS} SELECT * FROM silver"

_ORACLES = {
    "landing_completeness": _COMPLETENESS,
    "landing_status": _STATUS,
    "drift_report": _DRIFT,
    "bronze_conformed": _CONFORMED,
    "lineage_counts": """
        SELECT 'yellow_tripdata_1997-0' || CAST(l_orderkey % 5 + 1 AS VARCHAR) || '.parquet'
                   AS _source_file,
               count(*) AS count
        FROM lineitem GROUP BY 1
    """,
    "sink_roundtrip": _SILVER,
    "silver_trips": _SILVER,
    "dedupe_trips": f"""
        WITH {_RAW}
        SELECT DISTINCT vendorid, passenger_count, pickup_datetime AS tpep_pickup_datetime,
               dropoff_datetime AS tpep_dropoff_datetime, total_amount
        FROM yellow_raw
    """,
    "silver_audit": f"""
        {_LAYERS},
        came AS (SELECT service_type, count(*) AS raw,
                        count(*) FILTER (WHERE pickup_datetime IS NULL) AS null_pickup
                 FROM typed GROUP BY 1),
        inside AS (SELECT service_type, count(*) AS in_scope FROM scoped GROUP BY 1),
        stays AS (SELECT service_type, count(*) AS kept FROM silver GROUP BY 1)
        SELECT service_type, raw, null_pickup, in_scope, kept,
               raw - in_scope AS out_of_scope, in_scope - kept AS duplicates
        FROM came JOIN inside USING (service_type) JOIN stays USING (service_type)
    """,
    "silver_profile": f"""
        {_LAYERS}
        SELECT service_type, min(pickup_datetime) AS min_pickup, max(pickup_datetime) AS max_pickup,
               count(*) AS rows,
               CAST(sum(CASE WHEN passenger_count IS NULL OR passenger_count = 0
                             THEN 1 ELSE 0 END) AS BIGINT) AS passengers_null_or_zero,
               CAST(sum(CASE WHEN total_amount < 0 THEN 1 ELSE 0 END) AS BIGINT)
                   AS total_amount_negative
        FROM silver GROUP BY service_type
    """,
    "gold_consumption": f"{_LAYERS} SELECT * FROM consumption",
    "gold_taxi_trips": f"{_LAYERS} SELECT * FROM trips",
    "service_row_split": f"""
        {_LAYERS} SELECT service_type, count(*) AS count FROM trips GROUP BY service_type
    """,
    "preview_mandated": f"""
        WITH {_RAW}
        SELECT vendorid, passenger_count, total_amount,
               pickup_datetime AS tpep_pickup_datetime, dropoff_datetime AS tpep_dropoff_datetime
        FROM yellow_raw
        ORDER BY vendorid NULLS FIRST, passenger_count NULLS FIRST, total_amount NULLS FIRST,
                 pickup_datetime NULLS FIRST, dropoff_datetime NULLS FIRST
        LIMIT 10
    """,
    "layer_sizes": f"""
        {_LAYERS}
        SELECT 'bronze.yellow' AS tbl, count(*) AS rows FROM yellow_raw
        UNION ALL SELECT 'bronze.green', count(*) FROM green_raw
        UNION ALL SELECT 'silver.yellow', count(*) FROM silver WHERE service_type = 'yellow'
        UNION ALL SELECT 'silver.green', count(*) FROM silver WHERE service_type = 'green'
        UNION ALL SELECT 'gold.taxi_trips', count(*) FROM trips
    """,
    "quality_amount": f"""
        {_LAYERS}
        SELECT count(*) AS rows,
               CAST(sum(CASE WHEN total_amount < 0 THEN 1 ELSE 0 END) AS BIGINT) AS negative,
               CAST(sum(CASE WHEN total_amount = 0 THEN 1 ELSE 0 END) AS BIGINT) AS zero,
               {_rounded('min(total_amount)', 2)} AS min,
               {_rounded('max(total_amount)', 2)} AS max,
               {_rounded('avg(total_amount)', 2)} AS avg_unfiltered
        FROM consumption
    """,
    "quality_passengers": f"""
        {_LAYERS}
        SELECT count(*) AS month_rows,
               count(*) FILTER (WHERE passenger_count IS NULL) AS passenger_null,
               count(*) FILTER (WHERE passenger_count = 0) AS passenger_zero
        FROM trips WHERE {_MAY}
    """,
    "q1_monthly_avg": f"""
        {_LAYERS}
        SELECT strftime(tpep_pickup_datetime, '%Y-%m') AS month,
               {_rounded('avg(total_amount)', 2)} AS avg_total_amount,
               count(*) AS trips
        FROM consumption WHERE total_amount >= 0 GROUP BY 1
    """,
    "q1_overall_avg": f"""
        {_LAYERS}
        SELECT {_rounded('avg(total_amount)', 2)} AS avg_total_amount_overall
        FROM consumption WHERE total_amount >= 0
    """,
    "q2_hourly_avg": f"""
        {_LAYERS}
        SELECT CAST(hour(pickup_datetime) AS INTEGER) AS hour_of_day,
               {_rounded('avg(passenger_count)', 3)} AS avg_passengers,
               count(*) AS trips
        FROM trips WHERE {_MAY} AND passenger_count >= 1 GROUP BY 1
    """,
    "q2_service_split": f"""
        {_LAYERS}
        SELECT service_type, {_rounded('avg(passenger_count)', 3)} AS avg_passengers,
               count(*) AS trips
        FROM trips WHERE {_MAY} AND passenger_count >= 1 GROUP BY 1
    """,
    "events_hourly": f"{_EVENTS} GROUP BY 1",
    "events_hourly_above": f"{_EVENTS} AND value >= 1 GROUP BY 1",
    "missing_files": f"SELECT service, file FROM ({_STATUS}) WHERE NOT present",
    "bronze_folder_drift": _FOLDER_DRIFT,
    "drift_report_types": _DRIFT_TYPES,
    "bad_casts": _BAD_CASTS,
    "rejected_trips": _REJECTED,
    "routed_audit": _ROUTED_AUDIT,
    "file_accounts": _FILE_ACCOUNTS,
    "pipeline_run": _PIPELINE_RUN,
    "refreshed_month": _SILVER,
    "two_years": f"""
        {_LAYERS.replace("DATE '1997-01-01'", "DATE '1996-11-01'").replace("DATE '1997-06-01'", "DATE '1997-03-01'")}
        SELECT * FROM trips
    """,
    "yellow_hours": f"""
        {_LAYERS}
        SELECT CAST(hour(pickup_datetime) AS INTEGER) AS hour_of_day,
               {_rounded('avg(passenger_count)', 3)} AS avg_passengers,
               count(*) AS trips
        FROM trips WHERE {_MAY} AND passenger_count >= 1 AND service_type = 'yellow' GROUP BY 1
    """,
}


# The same question asked a second way must give the same rows.
_SAME_AS = {
    "bronze_union": "bronze_conformed",
    "q1_monthly_avg_sql": "q1_monthly_avg",
    "q1_overall_avg_sql": "q1_overall_avg",
    "q2_hourly_avg_sql": "q2_hourly_avg",
}


def oracle_sql() -> dict[str, str]:
    return _ORACLES | {name: _ORACLES[other] for name, other in _SAME_AS.items()}
