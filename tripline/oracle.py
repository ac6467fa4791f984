"""DuckDB SQL computing the same answer as each registered query.

Used only as the correctness oracle: the driver runs these next to the Spark
queries on the same Parquet tables (registered as views named after the
tables).  Written from the query semantics, not generated from the Spark
plans; constants come from the same model so both sides agree on them.

* Spark's ``round(double, n)`` is HALF_UP on the shortest decimal text of the
  double; DuckDB's is not, so ``_r`` rounds through that text.
* Money is summed as DECIMAL; DECIMAL -> double goes through text (``_d``),
  which is correctly rounded in both engines.
* Integer results are cast to the Spark type (BIGINT / INTEGER).
"""

from __future__ import annotations

import string

from tripline.model import ORDERS_MODEL as M
from tripline.operators import quality as Q
from tripline.operators.quality import (
    DUPLICATE_MAX_RATE,
    NULL_MAX_RATE,
)
from tripline.plans import catalog
from tripline.sources import tables
from tripline.sources.files import VOLUME_WARNING

LO, HI = M.zone_range


def _r(x: str, n: int) -> str:
    return f"CAST(round(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38,20)), {n}) AS DOUBLE)"


def _d(x: str) -> str:
    return f"CAST(CAST({x} AS VARCHAR) AS DOUBLE)"


def _f(x: str) -> str:
    return f"CAST({x} AS DOUBLE)"


def _exact_avg(x: str) -> str:
    fixed = f"CAST(CAST({x} AS VARCHAR) AS DECIMAL(28,10))"
    return f"{_d(f'SUM({fixed})')} / CAST(NULLIF(COUNT({x}), 0) AS DOUBLE)"


def _avg_dbl(x: str) -> str:
    return (
        f"{_d(f'SUM(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38,18)))')}"
        f" / CAST(NULLIF(COUNT({x}), 0) AS DOUBLE)"
    )


def _minutes_avg(x: str) -> str:
    return (
        f"CAST(SUM(CAST(round({x} * 60) AS BIGINT)) AS DOUBLE)"
        f" / NULLIF(CAST(COUNT({x}) AS DOUBLE) * CAST(60 AS DOUBLE), 0)"
    )


def _pct(cur: str, prev: str) -> str:
    return f"({cur} - {prev}) / NULLIF({prev}, 0) * CAST(100 AS DOUBLE)"


def _lit(text: str) -> str:
    return "'" + str(text).replace("'", "''") + "'"


def _fill(template: str, **parts: str) -> str:
    """SQL concatenation filling a ``{name}`` template with SQL expressions."""
    pieces = []
    for literal, field, _, _ in string.Formatter().parse(template):
        if literal:
            pieces.append(_lit(literal))
        if field is not None:
            pieces.append(parts[field])
    return "(" + " || ".join(pieces) + ")"


def _fmt_count(x: str) -> str:
    return f"format('{{:,}}', CAST({x} AS BIGINT))"


def _fmt_pct4(ratio: str) -> str:
    return f"printf('%.4f', {_r(f'{ratio} * CAST(100 AS DOUBLE)', 4)})"


# --- pipeline CTEs -------------------------------------------------------------------

KEEP_RULES = [
    ("start_present", f"{M.start} IS NOT NULL"),
    ("end_present", f"{M.end} IS NOT NULL"),
    ("order", f"{M.end} > {M.start}"),
    ("duration", f"date_diff('second', {M.start}, {M.end}) <= {M.max_duration_s}"),
    ("party", f"{M.party} IS NOT NULL AND {M.party} > 0"),
    ("distance", f"{M.distance} IS NOT NULL AND {M.distance} > 0 AND NOT isnan({M.distance})"
                 f" AND {M.distance} <= {M.max_distance}"),
    ("fare", f"{M.fare} IS NOT NULL AND {M.fare} > 0 AND NOT isnan({M.fare}) AND {M.fare} <= {M.max_fare}"),
    ("total", f"{M.total} IS NOT NULL AND {M.total} > 0"),
    ("origin", f"{M.origin} BETWEEN {LO} AND {HI}"),
    ("destination", f"{M.dest} BETWEEN {LO} AND {HI}"),
]


def _base(with_copies: bool = False) -> list[str]:
    li = (
        "(SELECT * FROM lineitem UNION ALL SELECT * FROM lineitem WHERE l_linenumber = 1)"
        if with_copies
        else "lineitem"
    )
    keep = " AND ".join(f"({p})" for _, p in KEEP_RULES)
    return [
        f"""raw AS (
  SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, o.o_custkey, o.o_orderdate,
         l.l_shipdate, c.c_nationkey, s.s_nationkey, l.l_quantity, l.l_extendedprice,
         l.l_discount, o.o_orderpriority,
         CAST(CAST(l.l_extendedprice AS DECIMAL(18,2))
              * (CAST(1 AS DECIMAL(4,2)) - CAST(l.l_discount AS DECIMAL(4,2))) AS DECIMAL(18,4))
           AS total_amount
  FROM {li} l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey)""",
        f"cleaned AS (SELECT * FROM raw WHERE {keep})",
        "deduped AS (SELECT DISTINCT * FROM cleaned)",
        """zones AS (
  SELECT n.n_nationkey AS zone_id, n.n_name AS zone, r.r_name AS borough
  FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey  )""",
        f"""attached AS (
  SELECT d.*, pz.borough AS pickup_borough, pz.zone AS pickup_zone,
         dz.borough AS dropoff_borough, dz.zone AS dropoff_zone
  FROM deduped d
  LEFT JOIN zones pz ON d.{M.origin} = pz.zone_id
  LEFT JOIN zones dz ON d.{M.dest} = dz.zone_id)""",
        f"""with_minutes AS (
  SELECT *, date_diff('second', {M.start}, {M.end}) / CAST(60 AS DOUBLE) AS trip_duration_min
  FROM attached)""",
        f"""trips AS (
  SELECT *,
    {_r(f'{M.distance} / NULLIF(trip_duration_min / CAST(60 AS DOUBLE), 0)', 2)} AS avg_speed_mph,
    {_r(f'{_d(M.total)} / NULLIF({M.distance}, 0)', 2)} AS revenue_per_mile,
    CAST({M.start} AS DATE) AS pickup_date,
    CAST(hour({M.start}) AS INTEGER) AS pickup_hour,
    strftime({M.start}, '%a') AS pickup_dow,
    strftime({M.start}, '%Y-%m') AS year_month
  FROM with_minutes)""",
        f"""daily AS (
  SELECT pickup_date, {M.origin}, pickup_borough, pickup_zone,
    COUNT(*) AS trip_count,
    SUM({M.total}) AS total_revenue,
    {_exact_avg(M.fare)} AS avg_fare,
    {_exact_avg(M.distance)} AS avg_distance,
    {_minutes_avg('trip_duration_min')} AS avg_duration_min,
    {_exact_avg('revenue_per_mile')} AS avg_revenue_per_mile
  FROM trips GROUP BY pickup_date, {M.origin}, pickup_borough, pickup_zone)""",
        f"""hourly AS (
  SELECT pickup_hour, pickup_dow, pickup_borough, COUNT(*) AS trip_count,
    {_exact_avg(M.fare)} AS avg_fare,
    {_minutes_avg('trip_duration_min')} AS avg_duration_min,
    {_exact_avg('avg_speed_mph')} AS avg_speed_mph
  FROM trips GROUP BY pickup_hour, pickup_dow, pickup_borough)""",
        f"""events_shaped AS (
  SELECT CAST(hour(ts) AS INTEGER) AS pickup_hour, strftime(ts, '%a') AS pickup_dow,
         event_type AS pickup_borough, value AS fare,
         secs / CAST(60 AS DOUBLE) AS trip_duration_min,
         {_r("distance / NULLIF(secs / CAST(60 AS DOUBLE) / CAST(60 AS DOUBLE), 0)", 2)} AS avg_speed_mph
  FROM (SELECT *, round(value * 60) AS secs,
          TRY_CAST(regexp_extract(props, '"k": *([0-9.]+)', 1) AS DOUBLE) AS distance FROM events))""",
        f"""event_hourly AS (
  SELECT pickup_hour, pickup_dow, pickup_borough, COUNT(*) AS trip_count,
    {_exact_avg('fare')} AS avg_fare,
    {_minutes_avg('trip_duration_min')} AS avg_duration_min,
    {_exact_avg('avg_speed_mph')} AS avg_speed_mph
  FROM events_shaped GROUP BY pickup_hour, pickup_dow, pickup_borough)""",
        """series AS (
  SELECT pickup_date,
    CASE WHEN GROUPING(pickup_borough) = 1 THEN 'citywide' ELSE 'borough' END AS grain_type,
    CASE WHEN GROUPING(pickup_borough) = 1 THEN 'citywide' ELSE pickup_borough END AS grain,
    SUM(trip_count) AS trip_count, SUM(total_revenue) AS total_revenue
  FROM daily
  GROUP BY GROUPING SETS ((pickup_date), (pickup_date, pickup_borough))
  HAVING GROUPING(pickup_borough) = 1 OR pickup_borough IS NOT NULL)""",
        """points AS (
  SELECT pickup_date, grain_type, grain, 'trip_count' AS metric,
         CAST(trip_count AS DECIMAL(38,4)) AS value FROM series
  UNION ALL
  SELECT pickup_date, grain_type, grain, 'total_revenue' AS metric,
         CAST(total_revenue AS DECIMAL(38,4)) AS value FROM series)""",
        """moments AS (
  SELECT pickup_date, grain_type, grain, metric, value,
    COUNT(x) OVER w AS n, SUM(x) OVER w AS s1, SUM(x * x) OVER w AS s2
  FROM (SELECT *, CAST(value * 10000 AS HUGEINT) AS x FROM points)
  WINDOW w AS (PARTITION BY grain_type, grain, metric, isodow(pickup_date)
               ORDER BY pickup_date ROWS BETWEEN 6 PRECEDING AND 1 PRECEDING))""",
        f"""stats AS (
  SELECT pickup_date, grain_type, grain, metric, {_d('value')} AS value, n,
    n * s2 - s1 * s1 AS var_num,
    {_d('s1')} / (CAST(n AS DOUBLE) * CAST(10000 AS DOUBLE)) AS mean,
    sqrt({_d('n * s2 - s1 * s1')} / CAST(n * (n - 1) AS DOUBLE)) / CAST(10000 AS DOUBLE) AS std
  FROM moments)""",
        """flags AS (
  SELECT pickup_date, grain_type, grain, metric, value,
    CASE WHEN n >= 3 THEN mean END AS rolling_mean,
    CASE WHEN n >= 3 THEN std END AS rolling_std,
    CASE WHEN n >= 3 AND var_num > 0 THEN (value - mean) / std END AS z_score
  FROM stats)""",
        """scored AS (
  SELECT *, COALESCE(abs(z_score) >= 3.0, false) AS is_anomalous FROM flags)""",
        f"""kpis AS (
  SELECT pickup_date AS day, SUM(trip_count) AS trips,
    round(SUM(total_revenue), 2) AS revenue,
    {_r(f"{_d('SUM(total_revenue)')} / NULLIF(CAST(SUM(trip_count) AS DOUBLE), 0)", 2)} AS revenue_per_trip,
    {_r(_avg_dbl('avg_distance'), 3)} AS avg_distance,
    {_r(_avg_dbl('avg_duration_min'), 2)} AS avg_duration_min
  FROM daily GROUP BY pickup_date)""",
        """monthly AS (
  SELECT CAST(date_trunc('month', pickup_date) AS DATE) AS month, SUM(trip_count) AS trips,
    round(SUM(total_revenue), 2) AS revenue
  FROM daily GROUP BY 1)""",
        f"""trend AS (
  SELECT month, trips, revenue,
    {_r(_pct(_d('revenue'), _d('LAG(revenue) OVER (ORDER BY month)')), 2)} AS revenue_mom_pct,
    {_r(_pct(_f('trips'), _f('LAG(trips) OVER (ORDER BY month)')), 2)} AS trips_mom_pct
  FROM monthly)""",
        f"""by_zone AS (
  SELECT pickup_zone, pickup_borough, SUM(trip_count) AS trips, SUM(total_revenue) AS rev,
    {_r(_avg_dbl('avg_revenue_per_mile'), 2)} AS avg_revenue_per_mile
  FROM daily WHERE pickup_zone IS NOT NULL GROUP BY pickup_zone, pickup_borough)""",
        """board AS (
  SELECT pickup_zone, pickup_borough, trips, round(rev, 2) AS revenue, avg_revenue_per_mile,
    CAST(rank() OVER (ORDER BY rev DESC) AS INTEGER) AS revenue_rank
  FROM by_zone)""",
        f"""demand AS (
  SELECT pickup_dow, pickup_hour, SUM(trip_count) AS trips,
    {_r(_avg_dbl('avg_fare'), 2)} AS avg_fare, {_r(_avg_dbl('avg_speed_mph'), 2)} AS avg_speed_mph
  FROM event_hourly GROUP BY pickup_dow, pickup_hour)""",
        """overlay AS (
  SELECT pickup_date AS day, grain_type, grain, metric, value, rolling_mean, z_score, is_anomalous
  FROM scored)""",
    ]


def _checks_ctes() -> list[str]:
    trips_cols = [
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "o_custkey", "o_orderdate",
        "l_shipdate", "c_nationkey", "s_nationkey", "l_quantity", "l_extendedprice",
        "l_discount", "o_orderpriority", "total_amount", "pickup_borough", "pickup_zone",
        "dropoff_borough", "dropoff_zone", "trip_duration_min", "avg_speed_mph",
        "revenue_per_mile", "pickup_date", "pickup_hour", "pickup_dow", "year_month",
    ]
    wanted_cols = [
        "l_suppkey", "o_orderdate", "l_shipdate", "l_linenumber", "l_quantity", "c_nationkey", "s_nationkey",
        "o_orderpriority", "l_extendedprice", "total_amount", "pickup_borough", "pickup_zone",
        "dropoff_borough", "dropoff_zone", "trip_duration_min", "avg_speed_mph", "revenue_per_mile",
        "pickup_date", "pickup_hour", "pickup_dow", "year_month",
    ]

    def names(found, others):
        """Those of ``found`` that ``others`` lack, as the text of a list."""
        lists = [", ".join(_lit(n) for n in part) for part in (found, others)]
        left = f"list_sort([chr(39) || x || chr(39) FOR x IN [{lists[0]}] IF NOT list_contains([{lists[1]}], x)])"
        return f"('[' || array_to_string({left}, ', ') || ']')"

    lacking, extra = names(wanted_cols, trips_cols), names(trips_cols, wanted_cols)
    schema_ok = f"{lacking} = '[]'"
    schema_detail = f"'missing=' || {lacking} || ', extra(unexpected)=' || {extra}"
    drift_text = "file_name || ': missing column ' || chr(39) || column_name || chr(39) || ' (filled null)'"
    drift = f"""drift_found AS (SELECT COUNT(*) AS n, list_sort(list(DISTINCT {drift_text})) AS texts
  FROM ({_drift_rows()}))"""
    drift_detail = """n || ' column(s) drifted across source files' || CASE WHEN n > 0
    THEN ': ["' || array_to_string(texts[1:5], '", "') || '"]' ELSE '' END"""
    nulls = ",\n    ".join(
        f"COUNT(*) FILTER (WHERE {c} IS NULL) AS \"nulls:{c}\"" for c in M.null_checked
    )
    ranges = []
    for c, (lo, hi) in ((M.fare, M.fare_range), (M.distance, M.distance_range)):
        ranges.append(f"COUNT(*) FILTER (WHERE {c} < {lo}) AS \"below:{c}\"")
        ranges.append(f"COUNT(*) FILTER (WHERE {c} > {hi} AND NOT isnan({c})) AS \"above:{c}\"")
    keys = ", ".join(M.natural_key)
    bag = f"""bag AS (
  SELECT t.*, k.key_groups, dd.daily_trip_sum, hh.hourly_trip_sum, i.ingest_total_rows,
         rr.raw_rows_read, t.rows AS final_cleaned_rows, t.rows AS physical_rows
  FROM (SELECT COUNT(*) AS rows,
    {nulls},
    {", ".join(ranges)}
    FROM trips) t,
    (SELECT COUNT(*) AS key_groups FROM (SELECT DISTINCT {keys} FROM trips)) k,
    (SELECT COALESCE(SUM(trip_count), 0) AS daily_trip_sum FROM daily) dd,
    (SELECT COALESCE(SUM(trip_count), 0) AS hourly_trip_sum FROM hourly) hh,
    (SELECT COUNT(*) AS ingest_total_rows FROM lineitem) i,
    (SELECT COUNT(*) AS raw_rows_read FROM raw) rr)"""

    def reconcile(label, a, b, a_label, b_label):
        passed = f"(COALESCE({a},0) = COALESCE({b},0))"
        detail = _fill(
            Q.RECONCILE_DETAIL, a_label=_lit(a_label), a=_fmt_count(f"COALESCE({a},0)"),
            b_label=_lit(b_label), b=_fmt_count(f"COALESCE({b},0)"),
            mismatch=f"CASE WHEN {passed} THEN '' ELSE {_lit(Q.MISMATCH_SUFFIX)} END",
        )
        name = _lit(Q.RECONCILE_NAME.format(label=label))
        return f"SELECT {name} AS name, 'error' AS severity, {passed} AS passed, {detail} AS detail FROM bag"

    def null_rate(c):
        rate = f'CAST("nulls:{c}" AS DOUBLE) / NULLIF(CAST(rows AS DOUBLE), 0)'
        detail = _fill(
            Q.NULL_RATE_DETAIL, nulls=_fmt_count(f'"nulls:{c}"'), rows=_fmt_count("rows"),
            rate=_fmt_pct4(rate), threshold=_lit(f"{NULL_MAX_RATE * 100:.2f}"),
        )
        return (
            f"SELECT {_lit(Q.NULL_RATE_NAME.format(column=c))}, 'error', "
            f"CASE WHEN rows = 0 THEN false ELSE {rate} <= {NULL_MAX_RATE} END, "
            f"CASE WHEN rows = 0 THEN {_lit(Q.MISSING_OR_EMPTY)} ELSE {detail} END FROM bag"
        )

    def value_range(c, lo, hi):
        b, a = f'"below:{c}"', f'"above:{c}"'
        detail = _fill(
            Q.RANGE_DETAIL, bad=_fmt_count(f"{b} + {a}"), lo=_lit(lo), hi=_lit(hi),
            below=_fmt_count(b), above=_fmt_count(a),
        )
        return f"SELECT {_lit(Q.RANGE_NAME.format(column=c))}, 'error', ({b} + {a}) = 0, {detail} FROM bag"

    dup_rate = "CASE WHEN rows > 0 THEN CAST(rows - key_groups AS DOUBLE) / CAST(rows AS DOUBLE) ELSE 0.0 END"
    dup_detail = _fill(
        Q.DUPLICATE_DETAIL, dup=_fmt_count("rows - key_groups"), rows=_fmt_count("rows"),
        rate=_fmt_pct4(dup_rate),
    )
    dup = (
        f"SELECT {_lit(Q.DUPLICATE_NAME)}, CASE WHEN {dup_rate} < {DUPLICATE_MAX_RATE} THEN 'warning' "
        f"ELSE 'error' END, {dup_rate} < {DUPLICATE_MAX_RATE}, {dup_detail} FROM bag"
    )
    rows = [
        reconcile("ingest_to_etl_read", "ingest_total_rows", "raw_rows_read",
                  "ingest.total_rows", "etl.raw_rows_read"),
        f"SELECT {_lit(Q.DRIFT_NAME)}, 'warning', n = 0, {drift_detail} FROM drift_found",
        reconcile("etl_manifest_to_physical_parquet", "final_cleaned_rows", "physical_rows",
                  "etl.final_cleaned_rows", "physical rows in trips_cleaned/"),
        f"SELECT {_lit(Q.SCHEMA_NAME)}, 'error', {schema_ok}, {schema_detail}",
        *[null_rate(c) for c in M.null_checked],
        value_range(M.fare, *M.fare_range),
        value_range(M.distance, *M.distance_range),
        dup,
        reconcile("trips_to_daily_zone_agg", "physical_rows", "daily_trip_sum",
                  "physical trips_cleaned rows", "sum(daily_zone_agg.trip_count)"),
        reconcile("trips_to_hourly_profile", "physical_rows", "hourly_trip_sum",
                  "physical trips_cleaned rows", "sum(hourly_profile.trip_count)"),
    ]
    return [bag, drift, "checks AS (\n  " + "\n  UNION ALL ".join(rows) + ")"]


def _with(final: str, with_copies: bool = False, checks: bool = False) -> str:
    ctes = _base(with_copies) + (_checks_ctes() if checks else [])
    return "WITH " + ",\n".join(ctes) + "\n" + final


def _money(cols: list[str]) -> str:
    return ", ".join(f"{_d(c)} AS {c}" for c in cols)


def _drift_rows() -> str:
    parts = []
    for table in tables.DRIFT_TABLES:
        for name, _ in tables.DRIFT_CANONICAL:
            names = (name,) + tables.DRIFT_ALIASES.get(name, ())
            in_list = ", ".join(f"'{n}'" for n in names)
            parts.append(
                f"SELECT '{table}.parquet' AS file_name, '{name}' AS column_name "
                f"WHERE NOT EXISTS (SELECT 1 FROM information_schema.columns "
                f"WHERE table_name = '{table}' AND column_name IN ({in_list}))"
            )
    return "\nUNION ALL ".join(parts)


def _reject_profile() -> str:
    keep_all = " AND ".join(f"({p})" for _, p in KEEP_RULES)
    cols = ["COUNT(*) AS rows_in"] + [
        f"COUNT(*) FILTER (WHERE NOT COALESCE({p}, false)) AS \"{n}\"" for n, p in KEEP_RULES
    ] + [f"COUNT(*) FILTER (WHERE NOT COALESCE({keep_all}, false)) AS any_rule"]
    inputs = {
        "rows_in": [], "start_present": [M.start], "end_present": [M.end], "order": [M.start, M.end],
        "duration": [M.start, M.end], "party": [M.party], "distance": [M.distance], "fare": [M.fare],
        "total": [M.total], "origin": [M.origin], "destination": [M.dest],
        "any_rule": [M.start, M.end, M.party, M.distance, M.fare, M.total, M.origin, M.dest],
    }
    for n, columns in inputs.items():
        null = " OR ".join(f"{c} IS NULL" for c in columns) or "false"
        cols.append(f"COUNT(*) FILTER (WHERE {null}) AS \"null:{n}\"")
    unions = "\nUNION ALL ".join(
        f"SELECT '{n}' AS rule, \"{n}\" AS rejected, \"null:{n}\" AS missing FROM prof" for n in inputs
    )
    return _with(f", prof AS (SELECT {', '.join(cols)} FROM raw)\n{unions}")


def _step_counts(with_copies: bool) -> str:
    return _with(
        """SELECT CAST(r.n AS BIGINT) AS raw_rows_read, CAST(r.n - c.n AS BIGINT) AS invalid_rows_dropped,
  CAST(c.n - t.n AS BIGINT) AS duplicate_rows_dropped, CAST(t.n AS BIGINT) AS final_cleaned_rows,
  CAST(d.n AS BIGINT) AS daily_zone_agg_rows, CAST(h.n AS BIGINT) AS hourly_profile_rows
FROM (SELECT COUNT(*) AS n FROM raw) r, (SELECT COUNT(*) AS n FROM cleaned) c,
     (SELECT COUNT(*) AS n FROM trips) t, (SELECT COUNT(*) AS n FROM daily) d,
     (SELECT COUNT(*) AS n FROM hourly) h""",
        with_copies=with_copies,
    )


def oracle_queries() -> dict[str, str]:
    k = M.natural_key
    key_cols = ", ".join(k)
    q: dict[str, str] = {}
    # sources
    q["src_align_union"] = """
SELECT CAST(c_custkey AS BIGINT) AS key, c_name AS name, CAST(c_nationkey AS BIGINT) AS nationkey,
       CAST(c_acctbal AS DOUBLE) AS acctbal, c_mktsegment AS mktsegment FROM customer
UNION ALL
SELECT CAST(s_suppkey AS BIGINT), s_name, CAST(s_nationkey AS BIGINT), CAST(s_acctbal AS DOUBLE),
       CAST(NULL AS VARCHAR) FROM supplier"""
    q["src_schema_drift"] = _drift_rows()
    q["src_partition_roundtrip"] = _with(
        "SELECT year_month, COUNT(*) AS rows FROM trips GROUP BY year_month"
    )
    warning = _fill(VOLUME_WARNING, file="file_name", rows=_fmt_count("rows"))
    q["ingest_manifest"] = f"SELECT *, CASE WHEN NOT in_bounds THEN {warning} END AS warning, true AS has_bytes FROM (" + \
        "\nUNION ALL ".join(
            f"SELECT '{t}.parquet' AS file_name, COUNT(*) AS rows, "
            f"COUNT(*) BETWEEN 500000 AND 10000000 AS in_bounds FROM {t}"
            for t in ("lineitem", "orders", "customer", "supplier")
        ) + ")"
    # cleaning
    q["clean_trips"] = _with(f"SELECT * REPLACE ({_d('total_amount')} AS total_amount) FROM cleaned")
    q["clean_trips_year"] = _with(
        f"SELECT * REPLACE ({_d('total_amount')} AS total_amount) FROM cleaned WHERE year({M.start}) = 1997"
    )
    q["clean_reject_profile"] = _reject_profile()
    q["dedupe_exact"] = _with(
        f"SELECT * REPLACE ({_d('total_amount')} AS total_amount) FROM deduped", with_copies=True
    )
    q["etl_step_counts"] = _step_counts(with_copies=True)
    q["etl_manifest_steps"] = _step_counts(with_copies=False)
    q["src_zone_csv"] = _with("SELECT CAST(zone_id AS INTEGER) AS zone_id, borough, zone FROM zones")
    q["etl_report"] = _with("SELECT * FROM checks", checks=True)
    # enrichment
    q["enrich_zones"] = _with(f"SELECT * REPLACE ({_d('total_amount')} AS total_amount) FROM attached")
    q["derive_trip_metrics"] = _with(
        f"SELECT {key_cols}, {M.start}, {M.end}, {M.distance}, {_d(M.total)} AS {M.total}, "
        "trip_duration_min, avg_speed_mph, revenue_per_mile FROM trips"
    )
    q["derive_calendar"] = _with(
        f"SELECT {key_cols}, {M.start}, pickup_date, pickup_hour, pickup_dow, year_month FROM trips"
    )
    q["derive_event_calendar"] = (
        "SELECT event_id, ts, CAST(ts AS DATE) AS pickup_date, CAST(hour(ts) AS INTEGER) AS pickup_hour, "
        "strftime(ts, '%a') AS pickup_dow, strftime(ts, '%Y-%m') AS year_month FROM events"
    )
    # aggregates
    q["agg_daily_zone"] = _with(f"SELECT * REPLACE ({_d('total_revenue')} AS total_revenue) FROM daily")
    q["agg_hourly_profile"] = _with("SELECT * FROM event_hourly")
    q["agg_daily_incremental"] = q["agg_daily_zone"]
    q["agg_hourly_incremental"] = _with("SELECT * FROM hourly")
    q["agg_active_zones"] = _with(
        "SELECT CAST(pickup_date - CAST(dayofweek(pickup_date) AS INTEGER) AS DATE) AS week, "
        "COUNT(DISTINCT pickup_zone) AS active_zones FROM trips WHERE pickup_zone IS NOT NULL GROUP BY 1"
    )
    q["load_months"] = _with(
        "SELECT year_month, COUNT(*) AS table_rows, COUNT(*) AS rows_loaded, CAST(0 AS BIGINT) AS rows_loaded_again "
        "FROM trips GROUP BY year_month"
    )
    q["agg_citywide_borough"] = _with(
        f"SELECT pickup_date, grain_type, grain, CAST(trip_count AS BIGINT) AS trip_count, "
        f"{_d('total_revenue')} AS total_revenue FROM series"
    )
    # views
    q["view_daily_kpis"] = _with(
        f"SELECT day, CAST(trips AS BIGINT) AS trips, {_d('revenue')} AS revenue, revenue_per_trip, "
        "avg_distance, avg_duration_min FROM kpis"
    )
    q["view_monthly_trend"] = _with(
        f"SELECT month, CAST(trips AS BIGINT) AS trips, {_d('revenue')} AS revenue, revenue_mom_pct, "
        "trips_mom_pct FROM trend"
    )
    q["view_zone_leaderboard"] = _with(
        f"SELECT pickup_zone, pickup_borough, CAST(trips AS BIGINT) AS trips, {_d('revenue')} AS revenue, "
        "avg_revenue_per_mile, revenue_rank FROM board"
    )
    q["view_borough_share"] = _with(
        f""", by_month AS (
  SELECT CAST(date_trunc('month', pickup_date) AS DATE) AS month, pickup_borough AS borough,
         SUM(total_revenue) AS rev
  FROM daily WHERE pickup_borough IS NOT NULL GROUP BY 1, 2)
SELECT month, borough, {_d('round(rev, 2)')} AS revenue,
  {_r(f"{_d('rev')} / NULLIF({_d('SUM(rev) OVER (PARTITION BY month)')}, 0) * CAST(100 AS DOUBLE)", 2)}
    AS revenue_share_pct
FROM by_month"""
    )
    q["view_hourly_demand"] = _with(
        "SELECT pickup_dow, pickup_hour, CAST(trips AS BIGINT) AS trips, avg_fare, avg_speed_mph FROM demand"
    )
    q["view_anomaly_overlay"] = _with("SELECT * FROM overlay")
    q["view_zone_weekly_cohort"] = _with(
        f""", weekly AS (
  SELECT pickup_zone, pickup_date - CAST(dayofweek(pickup_date) AS INTEGER) AS week,
         SUM(total_revenue) AS revenue
  FROM daily WHERE pickup_zone IS NOT NULL GROUP BY 1, 2),
cohorts AS (SELECT *, MIN(week) OVER (PARTITION BY pickup_zone) AS cohort_week FROM weekly)
SELECT cohort_week, CAST(date_diff('day', cohort_week, week) // 7 AS BIGINT) AS weeks_since_first,
  COUNT(DISTINCT pickup_zone) AS active_zones, {_d('round(SUM(revenue), 2)')} AS revenue
FROM cohorts GROUP BY 1, 2"""
    )
    q["view_data_quality"] = _with("SELECT * FROM checks", checks=True)
    # anomaly
    q["anomaly_zscore"] = _with(
        "SELECT pickup_date, grain_type, grain, metric, value, rolling_mean, rolling_std, z_score, "
        "is_anomalous FROM scored"
    )
    q["anomaly_flagged"] = _with(
        f"SELECT pickup_date AS date, grain, metric, {_r('value', 2)} AS value, "
        f"{_r('rolling_mean', 2)} AS rolling_mean, {_r('z_score', 2)} AS z_score, is_anomalous "
        "FROM scored WHERE is_anomalous"
    )
    q["anomaly_top50"] = _with(
        f"""SELECT pickup_date, grain, metric, value, rolling_mean, z_score,
  printf('| %s | %s | %s | %.0f | %.0f | %.2f |', CAST(pickup_date AS VARCHAR), grain, metric,
         {_r('value', 0)}, {_r('rolling_mean', 0)}, {_r('z_score', 2)}) AS line
FROM scored WHERE is_anomalous
ORDER BY abs(z_score) DESC, pickup_date, grain, metric LIMIT 50"""
    )
    q["anomaly_counts"] = _with(
        "SELECT COUNT(*) AS points_scored, COUNT(*) FILTER (WHERE is_anomalous) AS points_flagged FROM scored"
    )
    # quality
    q["dq_null_rate"] = _with("SELECT * FROM checks WHERE name LIKE 'null_rate[%'", checks=True)
    q["dq_value_range"] = _with("SELECT * FROM checks WHERE name LIKE 'value_range[%'", checks=True)
    q["dq_schema"] = _with(
        "SELECT * FROM checks WHERE name IN ('schema_drift', 'etl_schema_drift')", checks=True
    )
    q["dq_duplicate_keys"] = _with("SELECT * FROM checks WHERE name = 'duplicate_rows'", checks=True)
    q["dq_reconcile"] = _with(
        "SELECT * FROM checks WHERE name LIKE 'row_count_reconciliation[%'", checks=True
    )
    q["dq_results"] = _with("SELECT * FROM checks", checks=True)
    q["dq_summary"] = _with(
        """SELECT COUNT(*) AS total, COUNT(*) FILTER (WHERE passed) AS passed,
  COUNT(*) FILTER (WHERE NOT passed AND severity = 'error') AS failed_errors,
  COUNT(*) FILTER (WHERE NOT passed AND severity = 'warning') AS failed_warnings
FROM checks""",
        checks=True,
    )
    # dashboard
    q["dash_totals"] = _with(
        f"SELECT CAST(SUM(trips) AS BIGINT) AS trips, {_d('SUM(revenue)')} AS revenue, "
        f"{_d('SUM(revenue)')} / NULLIF(CAST(SUM(trips) AS DOUBLE), 0) AS rpt FROM kpis"
    )
    q["dash_failing_checks"] = _with(
        "SELECT COUNT(*) FILTER (WHERE NOT passed AND severity = 'error') AS failing FROM checks",
        checks=True,
    )
    q["dash_daily_series"] = _with(
        f"SELECT CAST(day AS TIMESTAMP) AS time, {_d('revenue')} AS revenue, CAST(trips AS BIGINT) AS trips "
        "FROM kpis ORDER BY day"
    )
    q["dash_monthly"] = _with(
        f"SELECT strftime(month, '%Y-%m') AS month, {_d('revenue')} AS revenue, revenue_mom_pct "
        "FROM trend ORDER BY month"
    )
    q["dash_top_zones"] = _with(
        f"SELECT revenue_rank, pickup_zone, pickup_borough, CAST(trips AS BIGINT) AS trips, "
        f"{_d('revenue')} AS revenue, avg_revenue_per_mile FROM board "
        "ORDER BY revenue_rank, pickup_zone, pickup_borough LIMIT 15"
    )
    q["dash_heatmap"] = _with(
        "SELECT pickup_dow, pickup_hour, CAST(trips AS BIGINT) AS trips FROM demand "
        "ORDER BY pickup_dow, pickup_hour"
    )
    q["dash_anomaly_overlay"] = _with(
        "SELECT CAST(day AS TIMESTAMP) AS time, value AS trips, "
        "CASE WHEN is_anomalous THEN value END AS anomaly FROM overlay "
        "WHERE grain_type = 'citywide' AND metric = 'trip_count' ORDER BY day"
    )
    # report
    q["report_summary"] = _with(
        f"""SELECT s.date_from, s.date_to, s.total_trips, s.total_revenue, s.distinct_pickup_zones,
  st.raw_rows_read, st.final_cleaned_rows, st.invalid_rows_dropped, st.duplicate_rows_dropped,
  ck.checks_passed, ck.checks_total, an.anomalies_flagged,
  CASE WHEN s.total_trips > 0 THEN s.total_revenue / CAST(s.total_trips AS DOUBLE) ELSE 0.0 END
    AS avg_revenue_per_trip,
  CASE WHEN st.raw_rows_read > 0 THEN CAST(st.final_cleaned_rows AS DOUBLE) * CAST(100 AS DOUBLE)
    / CAST(st.raw_rows_read AS DOUBLE) END AS clean_rate_pct,
  CAST(NULL AS DOUBLE) AS bytes_scanned_reduction_pct, CAST(NULL AS DOUBLE) AS wall_clock_speedup_x
FROM (SELECT MIN(pickup_date) AS date_from, MAX(pickup_date) AS date_to,
        CAST(SUM(trip_count) AS BIGINT) AS total_trips, {_d('SUM(total_revenue)')} AS total_revenue,
        COUNT(DISTINCT {M.origin}) AS distinct_pickup_zones FROM daily) s,
     (SELECT r.n AS raw_rows_read, t.n AS final_cleaned_rows, r.n - c.n AS invalid_rows_dropped,
             c.n - t.n AS duplicate_rows_dropped
      FROM (SELECT COUNT(*) AS n FROM raw) r, (SELECT COUNT(*) AS n FROM cleaned) c,
           (SELECT COUNT(*) AS n FROM trips) t) st,
     (SELECT COUNT(*) FILTER (WHERE passed) AS checks_passed, COUNT(*) AS checks_total FROM checks) ck,
     (SELECT COUNT(*) FILTER (WHERE is_anomalous) AS anomalies_flagged FROM scored) an""",
        checks=True,
    )
    q["report_daily"] = _with(
        f"""SELECT pickup_date, CAST(SUM(trip_count) AS BIGINT) AS trips,
  {_d('SUM(total_revenue)')} AS revenue,
  {_r(f"{_d('SUM(total_revenue)')} / NULLIF(CAST(SUM(trip_count) AS DOUBLE), 0)", 2)} AS revenue_per_trip,
  {_r(_avg_dbl('avg_distance'), 6)} AS avg_distance, {_r(_avg_dbl('avg_duration_min'), 6)} AS avg_duration_min
FROM daily GROUP BY pickup_date"""
    )
    q["report_monthly"] = _with(
        f""", m AS (
  SELECT CAST(date_trunc('month', pickup_date) AS DATE) AS month, SUM(trip_count) AS trips,
         SUM(total_revenue) AS rev FROM daily GROUP BY 1)
SELECT month, CAST(trips AS BIGINT) AS trips, {_d('rev')} AS revenue,
  {_r(_pct(_d('rev'), _d('LAG(rev) OVER (ORDER BY month)')), 2)} AS revenue_mom_pct,
  {_r(_pct(_f('trips'), _f('LAG(trips) OVER (ORDER BY month)')), 2)} AS trips_mom_pct
FROM m"""
    )
    q["report_zone_top25"] = _with(
        f""", z AS (
  SELECT pickup_zone, pickup_borough, SUM(trip_count) AS trips, SUM(total_revenue) AS rev,
    {_r(_avg_dbl('avg_revenue_per_mile'), 2)} AS avg_revenue_per_mile
  FROM daily WHERE pickup_zone IS NOT NULL AND pickup_borough IS NOT NULL
  GROUP BY pickup_zone, pickup_borough)
SELECT CAST(row_number() OVER (ORDER BY rev DESC, pickup_zone, pickup_borough) AS INTEGER) AS rank,
  pickup_zone, pickup_borough, CAST(trips AS BIGINT) AS trips, {_d('rev')} AS revenue,
  avg_revenue_per_mile
FROM z ORDER BY rev DESC, pickup_zone, pickup_borough LIMIT 25"""
    )
    days = ("Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun")
    q["report_hourly_matrix"] = _with(
        "SELECT pickup_hour AS hour, "
        + ", ".join(
            f"CAST(COALESCE(SUM(trip_count) FILTER (WHERE pickup_dow = '{d}'), 0) AS BIGINT) AS {d}"
            for d in days
        )
        + " FROM event_hourly GROUP BY pickup_hour"
    )
    # ad hoc
    q["weekly_kpis"] = _with(
        f"SELECT day, CAST(trips AS BIGINT) AS trips, {_d('revenue')} AS revenue, revenue_per_trip, "
        "avg_distance, avg_duration_min FROM kpis ORDER BY day DESC LIMIT 7"
    )
    q["weekly_anomalies"] = _with(
        "SELECT day, grain, metric, value, rolling_mean, z_score FROM overlay WHERE is_anomalous "
        "ORDER BY day DESC, grain, metric LIMIT 20"
    )
    q["guarded_query"] = _with(
        f"SELECT day, CAST(trips AS BIGINT) AS trips, {_d('revenue')} AS revenue FROM kpis "
        "WHERE revenue > (SELECT AVG(revenue) FROM kpis) ORDER BY revenue DESC, day LIMIT 200"
    )
    # layout
    layout_sql = _with(
        f"""SELECT pickup_date AS day, COUNT(*) AS trips,
  {_d(f'round(SUM({M.total}), 2)')} AS revenue,
  {_r(_exact_avg(M.distance), 3)} AS avg_distance
FROM trips
WHERE pickup_date BETWEEN DATE '{catalog.LAYOUT_START}' AND DATE '{catalog.LAYOUT_END}'
  AND {M.origin} = {catalog.LAYOUT_ZONE}
GROUP BY pickup_date"""
    )
    q["layout_clustered_query"] = layout_sql
    q["layout_naive_query"] = q["layout_interleaved_query"] = layout_sql
    q["agg_zone_cohorts"] = q["view_zone_weekly_cohort"]
    q["views_published"] = " UNION ALL ".join(
        f"SELECT 'vw_{key[5:]}' AS view_name, COUNT(*) AS rows FROM ({q[key]})"
        for key in list(q) if key.startswith("view_")
    )
    q["etl_written_daily"], q["etl_written_flags"] = q["agg_daily_zone"], q["anomaly_zscore"]
    return q
