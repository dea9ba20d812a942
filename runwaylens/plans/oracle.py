"""SQL text of the input views, used to state each query a second time in plain SQL."""

from __future__ import annotations

from runwaylens.schema import MISSING_TOKENS, NUMBER_COLUMNS

FLIGHTS = """
  WITH b AS (
    SELECT l.l_orderkey AS ok, l.l_partkey AS pk, l.l_suppkey AS sk, l.l_linenumber AS ln,
           CASE WHEN l.l_returnflag = 'A' AND month(CAST(l.l_shipdate AS DATE)) = 2
             THEN CAST(CAST(l.l_shipdate AS DATE) - INTERVAL 1 MONTH AS DATE)
           WHEN l.l_returnflag = 'A' AND month(CAST(l.l_shipdate AS DATE)) = 7
             THEN CAST(CAST(l.l_shipdate AS DATE) + INTERVAL 1 MONTH AS DATE)
           ELSE CAST(l.l_shipdate AS DATE) END AS d, l.l_returnflag AS rf, l.l_linestatus AS ls,
           n.n_name AS org, n.n_nationkey AS nk, l.l_orderkey * 7 + l.l_linenumber AS k
    FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey JOIN nation n ON s.s_nationkey = n.n_nationkey
  ), c AS (
    SELECT b.*, CASE WHEN k % 53 = 0 OR (nk % 11 = 3 AND rf = 'N') THEN 1 ELSE 0 END AS cx,
           (pk * 37 + ok * 11 + ln * 13) % 200 - 40 AS dd
    FROM b
  ), e AS (
    SELECT c.*, nk % 11 AS g, CASE WHEN cx = 1 THEN NULL ELSE dd END AS dep,
           CASE WHEN cx = 1 OR k % 59 = 0 THEN NULL ELSE dd - 6 + (sk * 5 + ln) % 13 END AS arr FROM c
  )
  SELECT CAST(d AS STRING) AS fl_date, CAST(year(d) AS INT) AS year, CAST(month(d) AS INT) AS month,
    CASE WHEN pk % 97 = 0 THEN NULL ELSE concat(rf, ls) END AS op_unique_carrier,
    CASE WHEN k % 101 = 0 THEN NULL ELSE org END AS origin,
    concat('NATION_', CAST((nk + ln) % 25 AS STRING)) AS dest,
    CAST(dep AS DOUBLE) AS dep_delay, CAST(arr AS DOUBLE) AS arr_delay, CAST(cx AS DOUBLE) AS cancelled,
    CASE WHEN cx = 1 THEN substr('ABCD', CAST(pk % 4 AS INT) + 1, 1) END AS cancellation_code,
    CASE WHEN arr >= 15 THEN CAST(CASE WHEN g = 7 THEN 0 ELSE pk % 40 END AS DOUBLE) END AS carrier_delay,
    CASE WHEN arr >= 15 THEN CAST(CASE WHEN sk % 7 = 0 AND g <> 5 AND g <> 7 THEN ok % 60 ELSE 0 END AS DOUBLE) END
      AS weather_delay,
    CASE WHEN arr >= 15 THEN CAST(CASE WHEN g = 5 OR g = 7 THEN 0 ELSE (ok + ln) % 35 END AS DOUBLE) END AS nas_delay,
    CASE WHEN arr >= 15 THEN CAST(CASE WHEN k % 211 = 0 AND g <> 5 AND g <> 7 THEN 9 ELSE 0 END AS DOUBLE) END
      AS security_delay,
    CASE WHEN arr >= 15 THEN CAST(CASE WHEN g = 5 OR g = 7 THEN 0 ELSE (pk + sk) % 50 END AS DOUBLE) END
      AS late_aircraft_delay
  FROM e
"""

RAW = """
  WITH f AS (
    SELECT flights.*,
      CAST(abs(coalesce(dep_delay, 3) * 7 + month * 13 + coalesce(arr_delay, 5) * 3) AS INT) AS h
    FROM flights
  ), g AS (
    SELECT * FROM f UNION ALL SELECT * FROM f WHERE h % 29 = 0
  )
  SELECT CASE WHEN h % 37 = 0 THEN 'not a date' ELSE fl_date END AS fl_date,
    CAST(year AS STRING) AS year, CAST(month AS STRING) AS month,
    CASE h % 5 WHEN 0 THEN lower(op_unique_carrier) WHEN 1 THEN '  ' || op_unique_carrier
      ELSE op_unique_carrier END AS op_unique_carrier,
    CASE WHEN h % 71 = 0 THEN chr(9) || ' ' WHEN h % 5 = 2 THEN chr(9) || origin || chr(10) ELSE origin END AS origin,
    dest,
    CASE WHEN h % 41 = 0 THEN 'NA' WHEN h % 43 = 0 THEN 'nan' WHEN h % 61 = 0 THEN '1500' WHEN h % 67 = 0 THEN '-121'
         WHEN h % 73 = 0 THEN '1440' WHEN h % 79 = 0 THEN '-120' ELSE CAST(CAST(dep_delay AS INT) AS STRING) END
      AS dep_delay,
    CASE WHEN h % 47 = 0 THEN '' WHEN h % 83 = 0 THEN '2000' ELSE CAST(CAST(arr_delay AS INT) AS STRING) END
      AS arr_delay,
    CASE WHEN h % 53 = 0 THEN NULL ELSE CAST(CAST(cancelled AS INT) AS STRING) END AS cancelled,
    lower(cancellation_code) AS cancellation_code,
    CAST(CAST(carrier_delay AS INT) AS STRING) AS carrier_delay,
    CAST(CAST(weather_delay AS INT) AS STRING) AS weather_delay,
    CAST(CAST(nas_delay AS INT) AS STRING) AS nas_delay,
    CAST(CAST(security_delay AS INT) AS STRING) AS security_delay,
    CAST(CAST(late_aircraft_delay AS INT) AS STRING) AS late_aircraft_delay
  FROM g
"""

RUNS = """
  WITH e AS (
    SELECT event_id, ts, event_type AS analysis,
      CASE WHEN event_type = 'error' AND user_id % 4 = 3 AND CAST(floor(event_id / 6) AS BIGINT) % 2 = 0 THEN 'tech_2'
        ELSE concat('tech_', CAST(user_id % 4 AS STRING)) END AS technology,
      CASE WHEN CAST(floor(event_id / 6) AS BIGINT) % 2 = 0 THEN 'local' ELSE 'cluster' END AS environment,
      event_id % 6 AS sz, CAST(ROUND(value * 100) AS DOUBLE) + 1 AS elapsed_sec
    FROM events
  ), r AS (
    SELECT e.*, row_number() OVER (PARTITION BY analysis, technology, environment, sz ORDER BY event_id) AS rn FROM e
  )
  SELECT ts AS timestamp, analysis, technology, environment,
    concat('data/sample_', CAST(sz AS STRING), CASE WHEN technology = 'tech_0' THEN '.csv' ELSE '.parquet' END)
      AS input_file,
    CAST(CASE WHEN technology = 'tech_0' THEN (sz + 1) * 80 ELSE (sz + 1) * 10 END AS DOUBLE) AS input_size_mb,
    (sz + 1) * 100000 AS input_rows, elapsed_sec, 0 AS exit_code,
    CASE WHEN sz = 3 THEN NULL ELSE concat('sample_', CAST(sz AS STRING)) END AS notes
  FROM r WHERE rn = 1
"""


def rounded(x: str, digits: int) -> str:
    """Half-up rounding of the decimal text of a double, as Spark rounds."""
    return f"CAST(ROUND(CAST(CAST(({x}) AS VARCHAR) AS DECIMAL(38,18)), {digits}) AS DOUBLE)"


def missing(c: str) -> str:
    tokens = ", ".join(f"'{t}'" for t in MISSING_TOKENS)
    return f"CASE WHEN {c} NOT IN ({tokens}) THEN {c} END"


def number(c: str) -> str:
    return f"CASE WHEN NOT isnan(TRY_CAST({c} AS DOUBLE)) THEN TRY_CAST({c} AS DOUBLE) END"


def stripped(c: str) -> str:
    """Text without white space at either end."""
    return f"regexp_replace({c}, '^\\s+|\\s+$', '', 'g')"


def code(c: str) -> str:
    return f"upper(regexp_replace({c}, '^\\s+|\\s+$', '', 'g'))"


TEXT_COLUMNS = ["fl_date", "year", "month", "op_unique_carrier", "origin", "dest", "cancelled", "cancellation_code"]

# The raw view with missing tokens removed and cells typed; the source table is called "raw".
TYPED = f"""
  SELECT strftime(try_strptime(fl_date, '%Y-%m-%d'), '%Y-%m-%d') AS fl_date,
    TRY_CAST(year AS INT) AS year, TRY_CAST(month AS INT) AS month, op_unique_carrier, origin, dest,
    {number("dep_delay")} AS dep_delay, {number("arr_delay")} AS arr_delay,
    CAST(coalesce({number("cancelled")}, 0) AS INT) AS cancelled, cancellation_code,
    {", ".join(f"{number(c)} AS {c}" for c in NUMBER_COLUMNS[2:])}
  FROM (SELECT {", ".join(f"{missing(c)} AS {c}" for c in TEXT_COLUMNS + NUMBER_COLUMNS)} FROM raw)
"""

HAS_KEYS = "fl_date IS NOT NULL AND op_unique_carrier IS NOT NULL AND origin IS NOT NULL"
DEP_OK = "(dep_delay IS NULL OR dep_delay BETWEEN -120 AND 1440)"
ARR_OK = "(arr_delay IS NULL OR arr_delay BETWEEN -120 AND 1440)"
NORMALISED = f"""
    fl_date, year, month, {code("op_unique_carrier")} AS op_unique_carrier, {code("origin")} AS origin,
    {code("dest")} AS dest, dep_delay, arr_delay, cancelled, {code("cancellation_code")} AS cancellation_code,
    {", ".join(NUMBER_COLUMNS[2:])}
"""
CLEANED = f"SELECT DISTINCT {NORMALISED} FROM typed WHERE {HAS_KEYS} AND {DEP_OK} AND {ARR_OK}"

VIEWS = {"flights": FLIGHTS, "raw": RAW, "typed": TYPED, "cleaned": CLEANED, "runs_log": RUNS}
NEEDS = {
    "flights": ["flights"],
    "raw": ["flights", "raw"],
    "typed": ["flights", "raw", "typed"],
    "cleaned": ["flights", "raw", "typed", "cleaned"],
    "runs": ["runs_log", "runs"],
}
VIEWS["runs"] = "SELECT * REPLACE (coalesce(notes, 'full_dataset') AS notes) FROM runs_log"


def over(view: str, body: str, **steps: str) -> str:
    """``body`` with the named view and any further steps in front of it."""
    ctes = {v: VIEWS[v] for v in NEEDS[view]} | steps
    return "WITH " + ", ".join(f"{name} AS ({sql})" for name, sql in ctes.items()) + "\n" + body
