"""DuckDB twins of the queries in ``starmart.plans.catalog``.

Only the driver's raw tables are registered in DuckDB, so the bindings of
FIXTURES.md section 3 and every intermediate table are repeated as CTEs.
Spark sorts NULLs first in ascending order; DuckDB needs ``NULLS FIRST``.
"""

from __future__ import annotations


def title(s: str) -> str:
    """Python str.title on letter / non-letter runs, in DuckDB."""
    return (f"array_to_string(list_transform(regexp_extract_all(lower({s}), "
            f"'\\p{{L}}+|\\P{{L}}+'), lambda w: upper(w[1]) || w[2:]), '')")


def sas_date(x: str) -> str:
    day = (f"(trunc({x}) + floor(round_even(({x} - trunc({x})) * 86400000000.0, 0) "
           f"/ 86400000000.0))")
    return (f"CASE WHEN {x} >= -715509 AND {x} < 2936550 AND NOT isnan({x}) AND {x} <> 0 "
            f"AND {day} BETWEEN -715509 AND 2936549 "
            f"THEN DATE '1960-01-01' + CAST({day} AS INTEGER) END")


def present(x: str, kind: str) -> str:
    """Not missing for dropna: NULL, and NaN for doubles."""
    return f"({x} IS NOT NULL AND NOT isnan({x}))" if kind == "d" else f"({x} IS NOT NULL)"


def missing(x: str, kind: str) -> str:
    if kind == "d":
        return f"({x} IS NULL OR isnan({x}))"
    if kind == "s":
        return f"({x} IS NULL OR coalesce(isnan(TRY_CAST({x} AS DOUBLE)), false))"
    return f"({x} IS NULL)"


# Column name, kind (d double, s string, i integer/long) and Spark type name.
ARRIVAL_COLS = [("cicid", "d"), ("i94yr", "d"), ("i94mon", "d"), ("i94res", "d"),
                ("arrdate", "d"), ("visatype", "s"), ("i94addr", "s"), ("count", "d"),
                ("occup", "s"), ("entdepu", "s"), ("insnum", "s")]
DEMO_COLS = [("City", "s"), ("State", "s"), ("Median Age", "d"), ("Male Population", "i"),
             ("Female Population", "i"), ("Total Population", "i"), ("Number of Veterans", "i"),
             ("Foreign-born", "i"), ("Average Household Size", "d"), ("State Code", "s"),
             ("Race", "s"), ("Count", "i"), ("c_custkey", "i")]
SPARK_TYPE = {"d": "double", "s": "string"}

CTE = {
    "arrivals": """arrivals AS (
  SELECT * EXCLUDE (k, e) REPLACE (
      if(e, NULL, cicid) AS cicid, if(e, NULL, i94yr) AS i94yr, if(e, NULL, i94mon) AS i94mon,
      if(e, NULL, i94res) AS i94res, if(e, NULL, arrdate) AS arrdate,
      if(e, NULL, visatype) AS visatype, if(e, NULL, i94addr) AS i94addr,
      if(e, NULL, "count") AS "count", if(e, NULL, occup) AS occup,
      if(e, NULL, entdepu) AS entdepu)
  FROM (SELECT o_orderkey AS k, o_orderkey % 211 = 0 AS e,
         CAST(CASE WHEN o_orderkey % 109 = 0 THEN NULL WHEN o_orderkey % 113 = 0 THEN o_orderkey - 1
                   ELSE o_orderkey END AS DOUBLE) AS cicid,
         CAST(year(o_orderdate) AS DOUBLE) AS i94yr,
         CAST(month(o_orderdate) AS DOUBLE) AS i94mon,
         CASE WHEN o_orderkey % 103 = 0 THEN CAST(99 AS DOUBLE)
              WHEN o_orderkey % 107 = 0 THEN NULL
              WHEN o_orderkey % 131 = 0 THEN CAST('nan' AS DOUBLE)
              ELSE CAST(c_nationkey AS DOUBLE) END AS i94res,
         CASE WHEN o_orderkey % 101 = 0 THEN NULL
              WHEN o_orderkey % 127 = 0 THEN CAST('nan' AS DOUBLE)
              WHEN o_orderkey % 139 = 0 THEN CAST(0 AS DOUBLE)
              WHEN o_orderkey % 7 = 0 THEN CAST(
                date_diff('day', DATE '1960-01-01', CAST(o_orderdate AS DATE)) AS DOUBLE) + 0.75
              ELSE CAST(date_diff('day', DATE '1960-01-01', CAST(o_orderdate AS DATE)) AS DOUBLE)
         END AS arrdate,
         CASE WHEN o_orderkey % 97 = 0 THEN NULL WHEN o_orderkey % 137 = 0 THEN 'NaN'
              ELSE o_orderpriority END AS visatype,
         substr(c_mktsegment, 1, 2) AS i94addr,
         CAST(1 AS DOUBLE) AS "count",
         CASE WHEN o_orderkey % 20 = 0 THEN 'STU' END AS occup,
         CASE WHEN o_orderkey % 11 = 0 THEN 'U' END AS entdepu,
         CAST(NULL AS VARCHAR) AS insnum
  FROM orders LEFT JOIN customer ON o_custkey = c_custkey))""",
    "mapping": """mapping AS (SELECT n_nationkey AS code, n_name AS "Name" FROM nation)""",
    "temperatures": f"""temperatures AS (
  SELECT CAST(l_shipdate AS DATE) AS dt, s_name AS City,
         CASE WHEN l_linenumber % 3 = 0 THEN n_name ELSE {title('n_name')} END AS Country,
         CASE WHEN l_linenumber = 7 THEN NULL WHEN l_partkey % 53 = 0 THEN CAST('nan' AS DOUBLE)
              ELSE l_quantity - 10 END AS AverageTemperature,
         l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice
  FROM lineitem LEFT JOIN supplier ON l_suppkey = s_suppkey
  LEFT JOIN nation ON s_nationkey = n_nationkey)""",
    "demographics": """demographics AS (
  SELECT concat('City_', c_nationkey) AS "City", c_mktsegment AS "State",
         CAST(35.5 AS DOUBLE) AS "Median Age",
         CASE WHEN c_acctbal < 0 THEN NULL ELSE 30000 END AS "Male Population",
         CASE WHEN c_custkey % 29 <> 0 THEN 35000 END AS "Female Population", 65000 + c_nationkey * 1000 AS "Total Population",
         CASE WHEN c_custkey % 31 <> 0 THEN 5000 END AS "Number of Veterans",
         CASE WHEN c_custkey % 37 <> 0 THEN 10000 END AS "Foreign-born",
         CASE WHEN c_custkey % 41 = 0 THEN CAST('nan' AS DOUBLE)
              WHEN c_custkey % 43 <> 0 THEN CAST(2.5 AS DOUBLE) END AS "Average Household Size",
         substr(c_mktsegment, 1, 2) AS "State Code", concat('Race_', c_custkey % 5) AS "Race",
         1000 AS "Count", c_custkey
  FROM customer)""",
    "clean_arrivals": f"""clean_arrivals AS (
  SELECT * EXCLUDE (occup, entdepu, insnum) FROM arrivals
  WHERE {' OR '.join(present(f'"{c}"', k) for c, k in ARRIVAL_COLS
                     if c not in ('occup', 'entdepu', 'insnum'))})""",
    "clean_temperatures": f"""clean_temperatures AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY dt, City, Country
      ORDER BY l_orderkey NULLS FIRST, l_linenumber NULLS FIRST, l_partkey NULLS FIRST,
      l_suppkey NULLS FIRST, l_quantity NULLS FIRST, l_extendedprice NULLS FIRST) AS rn
    FROM temperatures WHERE {present('AverageTemperature', 'd')}) WHERE rn = 1)""",
    "clean_demographics": f"""clean_demographics AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY "City", "State", "State Code", "Race"
      ORDER BY c_custkey NULLS FIRST) AS rn
    FROM demographics
    WHERE {present('"Number of Veterans"', 'i')} AND {present('"Male Population"', 'i')}
      AND {present('"Female Population"', 'i')} AND {present('"Foreign-born"', 'i')}
      AND {present('"Average Household Size"', 'd')}) WHERE rn = 1)""",
    "visa_dim": """visa_dim AS (
  SELECT visatype, row_number() OVER (ORDER BY visatype NULLS FIRST) - 1 AS visa_type_key
  FROM (SELECT DISTINCT visatype FROM clean_arrivals))""",
    "calendar_dim": f"""calendar_dim AS (
  SELECT arrdate,
         CAST(dayofweek(arrdate) + 1 AS INTEGER) AS arrival_weekday,
         CAST(day(arrdate) AS INTEGER) AS arrival_day,
         CAST(weekofyear(arrdate) AS INTEGER) AS arrival_week,
         CAST(month(arrdate) AS INTEGER) AS arrival_month,
         CAST(year(arrdate) AS INTEGER) AS arrival_year,
         row_number() OVER (ORDER BY arrdate NULLS FIRST) - 1 AS id
  FROM (SELECT DISTINCT {sas_date('arrdate')} AS arrdate FROM clean_arrivals))""",
    "mnames": f"""mnames AS (
  SELECT CAST(code AS DOUBLE) AS country_code, {title('"Name"')} AS country_name FROM mapping)""",
    "avgs": f"""avgs AS (
  SELECT {title('Country')} AS country_name, avg(AverageTemperature) AS average_temperature
  FROM clean_temperatures GROUP BY 1)""",
    "country_dim": """country_dim AS (
  SELECT DISTINCT c.country_code, m.country_name, a.average_temperature
  FROM (SELECT DISTINCT i94res AS country_code FROM clean_arrivals) c
  LEFT JOIN mnames m ON c.country_code = m.country_code
  LEFT JOIN avgs a ON m.country_name = a.country_name)""",
    "fact": f"""fact AS (
  SELECT a.cicid AS record_id, a.i94yr, a.i94mon, a.i94res AS country_residence_code,
         {sas_date('a.arrdate')} AS arrdate, a.i94addr AS state_code, a."count",
         v.visa_type_key
  FROM clean_arrivals a LEFT JOIN visa_dim v ON a.visatype = v.visatype)""",
    "demographics_dim": """demographics_dim AS (
  SELECT "City", "State", "Median Age" AS median_age, "Male Population" AS male_population,
         "Female Population" AS female_population, "Total Population" AS total_population,
         "Number of Veterans" AS number_of_veterans, "Foreign-born" AS foreign_born,
         "Average Household Size" AS average_household_size, "State Code" AS state_code,
         "Race", "Count", c_custkey,
         row_number() OVER (ORDER BY "City" NULLS FIRST, "State" NULLS FIRST,
                            "State Code" NULLS FIRST, "Race" NULLS FIRST) - 1 AS id
  FROM clean_demographics)""",
    "state_pop": """state_pop AS (
  SELECT state_code, CAST(sum(city_population) AS BIGINT) AS population
  FROM (SELECT state_code, "City", "State", max(total_population) AS city_population
        FROM demographics_dim GROUP BY state_code, "City", "State")
  GROUP BY state_code)""",
}

# CTEs each CTE reads, so a query lists only its leaves.
DEPS = {
    "arrivals": [], "mapping": [], "temperatures": [], "demographics": [],
    "clean_arrivals": ["arrivals"], "clean_temperatures": ["temperatures"],
    "clean_demographics": ["demographics"], "visa_dim": ["clean_arrivals"],
    "calendar_dim": ["clean_arrivals"], "mnames": ["mapping"], "avgs": ["clean_temperatures"],
    "country_dim": ["clean_arrivals", "mnames", "avgs"],
    "fact": ["clean_arrivals", "visa_dim"], "demographics_dim": ["clean_demographics"],
    "state_pop": ["demographics_dim"],
}


def with_(needs: list[str], body: str) -> str:
    order: list[str] = []

    def visit(n):
        for d in DEPS[n]:
            visit(d)
        if n not in order:
            order.append(n)

    for n in needs:
        visit(n)
    return "WITH " + ",\n".join(CTE[n] for n in order) + "\n" + body


def _missing_profile(table: str, cols) -> str:
    aggs = ", ".join(f"CAST(count_if({missing(f'\"{c}\"', k)}) AS BIGINT) AS m{i}" for i, (c, k) in enumerate(cols))
    rows = " UNION ALL ".join(f"SELECT '{c}' AS cols, m{i} AS \"values\", total FROM t"
                              for i, (c, _) in enumerate(cols))
    return with_([table], f""", t AS (SELECT count(*) AS total, {aggs} FROM {table})
SELECT cols, "values", CASE WHEN total = 0 THEN NULL ELSE 100 * "values" / total END AS pct_missing
FROM ({rows})""")


def _count_union(parts: list[tuple[str, str]]) -> str:
    return " UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS n_rows FROM {t}"
                              for n, t in parts)


STAR = [("immigration_fact", "fact"), ("visatype", "visa_dim"),
        ("immigration_calendar", "calendar_dim"), ("country", "country_dim"),
        ("demographics", "demographics_dim")]


def _schema_report() -> str:
    aggs = ", ".join(f"CAST(count_if(\"{c}\" IS NULL) AS BIGINT) AS n{i}" for i, (c, _) in enumerate(ARRIVAL_COLS))
    rows = " UNION ALL ".join(
        f"SELECT {i} AS position, '{c}' AS column_name, '{SPARK_TYPE[k]}' AS data_type, "
        f"total AS n_rows, n{i} AS n_nulls FROM t" for i, (c, k) in enumerate(ARRIVAL_COLS))
    return with_(["arrivals"], f", t AS (SELECT count(*) AS total, {aggs} FROM arrivals)\n{rows}")


def _by_state(monthly: bool) -> str:
    m_sel = ", CAST(month(arrdate) AS INTEGER) AS arrival_month" if monthly else ""
    m_out = ", f.arrival_month" if monthly else ""
    grp = "1, 2, 3" if monthly else "1, 2"
    return with_(["fact", "state_pop"], f"""
SELECT f.state_code, f.arrival_year{m_out}, p.population, f.arrivals,
       CASE WHEN p.population = 0 THEN NULL ELSE f.arrivals * 100000.0 / p.population END
         AS arrivals_per_100k
FROM (SELECT state_code, CAST(year(arrdate) AS INTEGER) AS arrival_year{m_sel},
             sum("count") AS arrivals FROM fact GROUP BY {grp}) f
LEFT JOIN state_pop p ON f.state_code = p.state_code""")


def _referential() -> str:
    def one(check, dim, key, fkey):
        return (f"SELECT '{check}' AS check_name, count(*) FILTER (f.{fkey} IS NOT NULL AND NOT EXISTS "
                f"(SELECT 1 FROM {dim} d WHERE d.{key} = f.{fkey})) AS orphans, "
                f"count(*) FILTER (f.{fkey} IS NULL) AS null_keys FROM fact f")
    parts = " UNION ALL ".join([
        one("fact_country", "country_dim", "country_code", "country_residence_code"),
        one("fact_visatype", "visa_dim", "visa_type_key", "visa_type_key"),
        one("fact_calendar", "calendar_dim", "arrdate", "arrdate")])
    return with_(["fact", "country_dim", "visa_dim", "calendar_dim"],
                 f"SELECT *, orphans = 0 AS passed FROM ({parts})")


ORACLE: dict[str, str] = {
    "src_arrivals": with_(["arrivals"], "SELECT * FROM arrivals"),
    "src_csv_mapping": with_(["mapping"], "SELECT * FROM mapping"),
    "src_csv_semicolon": with_(["demographics"], "SELECT * FROM demographics"),
    "sink_parquet_overwrite": with_(["visa_dim"], "SELECT * FROM visa_dim"),
    "sink_parquet_partitioned": with_(["calendar_dim"], "SELECT * FROM calendar_dim"),
    "prj_drop_columns": with_(["arrivals"],
                              "SELECT * EXCLUDE (occup, entdepu, insnum) FROM arrivals"),
    "prj_rename": with_(["arrivals"], """SELECT * EXCLUDE (cicid, i94res, i94addr),
  cicid AS record_id, i94res AS country_residence_code, i94addr AS state_code FROM arrivals"""),
    "prj_select": with_(["arrivals"], "SELECT cicid, visatype, arrdate FROM arrivals"),
    "fn_cast_string": with_(["temperatures"], """SELECT CAST(dt AS VARCHAR) AS dt, City,
  CAST(l_orderkey AS VARCHAR) AS l_orderkey, l_linenumber,
  CASE WHEN isnan(AverageTemperature) THEN 'NaN' ELSE CAST(AverageTemperature AS VARCHAR) END
    AS average_temperature FROM temperatures"""),
    "flt_dropna_all": with_(["arrivals"], f"""SELECT cicid, i94res, arrdate, visatype
FROM arrivals WHERE {present('i94res', 'd')} OR {present('arrdate', 'd')}
  OR {present('visatype', 's')}"""),
    "flt_dropna_key": with_(["arrivals"], f"SELECT * FROM arrivals WHERE {present('cicid', 'd')}"),
    "flt_dropna_one": with_(["temperatures"],
                            f"SELECT * FROM temperatures WHERE {present('AverageTemperature', 'd')}"),
    "flt_dropna_any": with_(["demographics"], f"""SELECT * FROM demographics
WHERE {present('"Number of Veterans"', 'i')} AND {present('"Male Population"', 'i')}
  AND {present('"Female Population"', 'i')} AND {present('"Foreign-born"', 'i')}
  AND {present('"Average Household Size"', 'd')}"""),
    "profile_missing": _missing_profile("arrivals", ARRIVAL_COLS),
    "profile_missing_nonzero": "SELECT * FROM (" + _missing_profile("demographics", DEMO_COLS)
                               + ") WHERE pct_missing > 0",
    "profile_sparse_columns": "SELECT cols, pct_missing FROM ("
                              + _missing_profile("arrivals", ARRIVAL_COLS)
                              + ") WHERE pct_missing > 90.0",
    "profile_duplicates": with_(["arrivals"], """SELECT n_rows, n_distinct,
  n_rows - n_distinct AS n_duplicates FROM (
  SELECT count(*) AS n_rows,
         count(DISTINCT cicid) + CASE WHEN count(*) > count(cicid) THEN 1 ELSE 0 END AS n_distinct
  FROM arrivals)"""),
    "agg_row_count": with_(["arrivals", "temperatures", "demographics", "mapping"], _count_union(
        [("arrivals", "arrivals"), ("temperatures", "temperatures"),
         ("demographics", "demographics"), ("country_mapping", "mapping")])),
    "agg_distinct": with_(["temperatures"], "SELECT DISTINCT Country, City FROM temperatures"),
    "agg_dedup_keys": with_(["temperatures"], """SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY dt, City, Country
    ORDER BY l_orderkey NULLS FIRST, l_linenumber NULLS FIRST, l_partkey NULLS FIRST,
      l_suppkey NULLS FIRST, l_quantity NULLS FIRST, l_extendedprice NULLS FIRST) AS rn
  FROM temperatures) WHERE rn = 1"""),
    "agg_avg_by_country": with_(["clean_temperatures"], """SELECT Country,
  avg(AverageTemperature) AS average_temperature FROM clean_temperatures GROUP BY Country"""),
    "clean_arrivals": with_(["clean_arrivals"], "SELECT * FROM clean_arrivals"),
    "stream_ingest_arrivals": with_(["clean_arrivals"], "SELECT * FROM clean_arrivals"),
    "clean_temperatures": with_(["clean_temperatures"], "SELECT * FROM clean_temperatures"),
    "clean_demographics": with_(["clean_demographics"], "SELECT * FROM clean_demographics"),
    "clean_report": with_(["arrivals", "temperatures", "demographics", "clean_arrivals",
                           "clean_temperatures", "clean_demographics"], f"""
, nt AS (SELECT count(*) AS n FROM temperatures WHERE {present('AverageTemperature', 'd')}),
  nd AS (SELECT count(*) AS n FROM demographics
         WHERE {present('"Number of Veterans"', 'i')} AND {present('"Male Population"', 'i')}
           AND {present('"Female Population"', 'i')} AND {present('"Foreign-born"', 'i')}
           AND {present('"Average Household Size"', 'd')})
SELECT 'arrivals' AS table_name, 1 AS step_no, 'dropna_all' AS step,
       (SELECT count(*) FROM arrivals) AS rows_in, (SELECT count(*) FROM clean_arrivals) AS rows_out
UNION ALL SELECT 'temperatures', 1, 'dropna_temperature', (SELECT count(*) FROM temperatures),
       (SELECT n FROM nt)
UNION ALL SELECT 'temperatures', 2, 'dedup', (SELECT n FROM nt),
       (SELECT count(*) FROM clean_temperatures)
UNION ALL SELECT 'demographics', 1, 'dropna_measures', (SELECT count(*) FROM demographics),
       (SELECT n FROM nd)
UNION ALL SELECT 'demographics', 2, 'dedup', (SELECT n FROM nd),
       (SELECT count(*) FROM clean_demographics)""").replace(
        "\nSELECT 'arrivals'", "\nSELECT *, rows_in - rows_out AS removed FROM (\nSELECT 'arrivals'")
        + ")",
    "fn_sas_date": with_(["arrivals"],
                         f"SELECT cicid, arrdate, {sas_date('arrdate')} AS arrival_date FROM arrivals"),
    "fn_calendar_parts": with_(["arrivals"], f"""SELECT cicid, d AS arrival_date,
  CAST(dayofweek(d) + 1 AS INTEGER) AS arrival_weekday, CAST(day(d) AS INTEGER) AS arrival_day,
  CAST(weekofyear(d) AS INTEGER) AS arrival_week, CAST(month(d) AS INTEGER) AS arrival_month,
  CAST(year(d) AS INTEGER) AS arrival_year
FROM (SELECT cicid, {sas_date('arrdate')} AS d FROM arrivals)"""),
    "fn_title_case": with_(["mapping"],
                           f"""SELECT code, "Name", {title('"Name"')} AS country_name FROM mapping"""),
    "key_surrogate": with_(["arrivals"], """SELECT cicid,
  row_number() OVER (ORDER BY cicid NULLS FIRST) - 1 AS id FROM arrivals"""),
    "join_left_visa_key": with_(["clean_arrivals", "visa_dim"], """SELECT a.cicid, a.visatype,
  v.visa_type_key FROM clean_arrivals a LEFT JOIN visa_dim v ON a.visatype = v.visatype"""),
    "join_left_mapping": with_(["arrivals", "mapping"], """SELECT DISTINCT c.country_code,
  m."Name" AS country_name
FROM (SELECT DISTINCT i94res AS country_code FROM arrivals) c
LEFT JOIN mapping m ON c.country_code = CAST(m.code AS DOUBLE)"""),
    "join_left_name": with_(["mnames", "avgs"], """SELECT m.country_code, m.country_name,
  a.average_temperature FROM mnames m LEFT JOIN avgs a ON m.country_name = a.country_name"""),
    "join_left_anti_orphans": with_(["arrivals", "mapping"], """SELECT cicid, i94res FROM arrivals a
WHERE NOT EXISTS (SELECT 1 FROM mapping m WHERE CAST(m.code AS DOUBLE) = a.i94res)"""),
    "dim_visa_type": with_(["visa_dim"], "SELECT * FROM visa_dim"),
    "dim_calendar": with_(["calendar_dim"], "SELECT * FROM calendar_dim"),
    "dim_country": with_(["country_dim"], "SELECT * FROM country_dim"),
    "dim_demographics": with_(["demographics_dim"], "SELECT * FROM demographics_dim"),
    "fact_arrivals": with_(["fact"], "SELECT * FROM fact"),
    "star_from_files": with_([t for _, t in STAR], """
SELECT 'fact' AS part, f.record_id, f.state_code, f."count", f.arrdate, k.id AS calendar_id,
       k.arrival_week, v.visatype, c.country_name, c.average_temperature, NULL AS city, NULL AS race,
       CAST(NULL AS BIGINT) AS demographics_id
FROM fact f LEFT JOIN visa_dim v ON f.visa_type_key = v.visa_type_key
LEFT JOIN calendar_dim k ON f.arrdate IS NOT DISTINCT FROM k.arrdate
LEFT JOIN country_dim c ON f.country_residence_code = c.country_code
UNION ALL
SELECT 'demographics', NULL, state_code, CAST("Count" AS DOUBLE), NULL, NULL, NULL, NULL, NULL,
       average_household_size, "City", "Race", id FROM demographics_dim"""),
    "sql_star_view": with_(["fact", "visa_dim", "country_dim"], """
SELECT c.*, t.visatype, count(*) AS n_events, sum(f."count") AS arrivals
FROM fact f
LEFT JOIN visa_dim t ON f.visa_type_key = t.visa_type_key
LEFT JOIN country_dim c ON f.country_residence_code = c.country_code
GROUP BY c.country_code, c.country_name, c.average_temperature, t.visatype"""),
    "preview_rows": with_(["arrivals"], """SELECT * FROM arrivals WHERE cicid IS NOT NULL
ORDER BY cicid, arrdate NULLS FIRST, visatype NULLS FIRST, i94addr LIMIT 5"""),
    "src_csv_reordered": with_(["mapping"], "SELECT * FROM mapping"),
    "src_events_extra_column": with_(["clean_arrivals"], """SELECT *, CASE WHEN cicid % 2 = 0
  THEN 'even' END AS extra FROM clean_arrivals"""),
    "schema_report": _schema_report(),
    "qc_row_counts": with_([t for _, t in STAR], "SELECT *, n_rows > 0 AS passed FROM ("
                           + _count_union(STAR) + ")"),
    "qc_referential": _referential(),
    "an_arrivals_by_climate": with_(["fact", "country_dim"], """
SELECT CASE WHEN c.average_temperature IS NULL THEN 'unknown'
            WHEN c.average_temperature >= 15.5 THEN 'warm' ELSE 'cold' END AS climate,
       sum(p.arrivals) AS arrivals, count(DISTINCT p.country_residence_code) AS countries
FROM (SELECT country_residence_code, sum("count") AS arrivals FROM fact GROUP BY 1) p
LEFT JOIN country_dim c ON p.country_residence_code = c.country_code
GROUP BY 1"""),
    "an_arrivals_by_state": _by_state(True),
    "an_arrivals_by_state_year": _by_state(False),
    "join_asof_reading": with_(["clean_arrivals", "clean_temperatures", "mnames"], f"""
SELECT record_id, arrdate, country_code, country_name, reading_date, reading_city, temperature
FROM (SELECT a.cicid AS record_id, {sas_date('a.arrdate')} AS arrdate, a.i94res AS country_code,
             m.country_name
      FROM clean_arrivals a LEFT JOIN mnames m ON a.i94res = m.country_code) e
ASOF LEFT JOIN (
  SELECT {title('Country')} AS country, dt AS reading_date, City AS reading_city,
         AverageTemperature AS temperature
  FROM clean_temperatures
  QUALIFY row_number() OVER (PARTITION BY {title('Country')}, dt
    ORDER BY City DESC, Country DESC, l_orderkey DESC, l_linenumber DESC) = 1) r
ON e.country_name = r.country AND e.arrdate >= r.reading_date"""),
    "star_incremental": with_(["clean_arrivals", "mnames", "avgs"], f"""
SELECT CASE WHEN ld = 1 THEN DATE '2016-04-01' ELSE DATE '2016-04-02' END AS load_day,
       cicid AS record_id, i94addr AS state_code, "count", e.day AS arrdate, visa_type_key,
       v.visatype, calendar_id, CAST(weekofyear(e.day) AS INTEGER) AS arrival_week,
       m.country_name, a.average_temperature
FROM (SELECT *, CASE WHEN coalesce(i94mon <= 6, true) THEN 1 ELSE 2 END AS ld,
             {sas_date('arrdate')} AS day FROM clean_arrivals) e
LEFT JOIN (SELECT visatype, row_number() OVER (ORDER BY ld, visatype NULLS FIRST) - 1 AS visa_type_key
           FROM (SELECT visatype, min(CASE WHEN coalesce(i94mon <= 6, true) THEN 1 ELSE 2 END) AS ld
                 FROM clean_arrivals GROUP BY visatype)) v ON e.visatype = v.visatype
LEFT JOIN (SELECT day, row_number() OVER (ORDER BY ld, day NULLS FIRST) - 1 AS calendar_id
           FROM (SELECT {sas_date('arrdate')} AS day,
                        min(CASE WHEN coalesce(i94mon <= 6, true) THEN 1 ELSE 2 END) AS ld
                 FROM clean_arrivals GROUP BY 1)) c ON e.day IS NOT DISTINCT FROM c.day
LEFT JOIN mnames m ON e.i94res = m.country_code
LEFT JOIN avgs a ON m.country_name = a.country_name"""),
    "stream_dedup_late": """
WITH e AS (SELECT event_id, ts,
                  least(2, date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) // 8) AS d FROM events),
l AS (SELECT event_id, ts, unnest(list_filter(
        [d + if(event_id % 17 = 0, 1, 0), if(event_id % 10 = 0, d + 1, NULL),
         if(event_id % 13 = 0, d + if(event_id % 17 = 0, 1, 0), NULL)], lambda x: x IS NOT NULL)) AS d
      FROM e),
m AS (SELECT d, max(max(ts)) OVER (ORDER BY d ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
               - INTERVAL 2 DAY AS mark FROM l GROUP BY d),
o AS (SELECT event_id, ts, coalesce(ts <= mark, false) AS late FROM l JOIN m USING (d)),
c AS (SELECT event_id, ts, late, count(*) AS n FROM o GROUP BY ALL)
SELECT event_id, ts, 'kept' AS outcome, CAST(1 AS BIGINT) AS n FROM c WHERE NOT late
UNION ALL SELECT event_id, ts, 'repeated', n - 1 FROM c WHERE NOT late AND n > 1
UNION ALL SELECT event_id, ts, 'late', n FROM c WHERE late""",
    "stream_weekly_upsert": with_(["clean_arrivals"], f"""
SELECT CAST(date_trunc('week', day) AS DATE) AS week, i94addr AS state_code, count(*) AS arrivals
FROM (SELECT {sas_date('arrdate')} AS day, i94addr FROM clean_arrivals)
WHERE day IS NOT NULL GROUP BY ALL"""),
    "src_csv_inferred": with_(["mapping"], "SELECT * FROM mapping"),
    "join_interval_transit": """
WITH t AS (SELECT l_orderkey, l_linenumber, o_custkey AS owner, CAST(l_shipdate AS DATE) AS shipped,
                  CAST(l_shipdate AS DATE) + CAST(l_quantity AS INTEGER) AS arrived
           FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
o AS (SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS opened,
             CAST(o_orderdate AS DATE) + CASE WHEN o_orderkey % 500 = 0 THEN 1095 ELSE 30 END AS closed
      FROM orders)
SELECT l_orderkey, l_linenumber, o_orderkey, o_custkey, shipped, arrived, opened, closed
FROM t JOIN o ON owner = o_custkey AND shipped <= closed AND opened <= arrived""",
    "an_presence_by_day": with_(["clean_arrivals"], f"""
, s AS (SELECT i94addr AS state_code, {sas_date('arrdate')} AS day,
               {sas_date('arrdate')} + CAST(coalesce(CAST(cicid AS INTEGER) % 45, 0) AS INTEGER) + 1
                 AS off FROM clean_arrivals),
c AS (SELECT state_code, day, 1 AS change FROM s WHERE day IS NOT NULL
      UNION ALL SELECT state_code, off, -1 FROM s WHERE day IS NOT NULL),
e AS (SELECT state_code, CAST(unnest(generate_series(min(day), max(day), INTERVAL 1 DAY)) AS DATE) AS day,
             0 AS change FROM c GROUP BY state_code),
g AS (SELECT state_code, day, sum(change) AS change FROM (SELECT * FROM c UNION ALL SELECT * FROM e)
      GROUP BY ALL)
SELECT state_code, day, CAST(sum(change) OVER (PARTITION BY state_code ORDER BY day) AS BIGINT) AS present
FROM g"""),
    "an_arrivals_rollup": with_(["clean_arrivals"], f"""
, f AS (SELECT i94addr AS state_code, visatype,
               CAST(date_trunc('month', {sas_date('arrdate')}) AS DATE) AS month, i94res
        FROM clean_arrivals)
SELECT state_code, visatype, month, CAST(GROUPING(state_code, visatype, month) AS BIGINT) AS grouping,
       count(*) AS n_events, count(DISTINCT i94res) AS n_countries
FROM f GROUP BY GROUPING SETS ((state_code, visatype, month), (state_code, visatype), (state_code), ())"""),
    "dim_demographics_history": with_(["clean_demographics"], """
, a AS (SELECT "City", "State", "State Code" AS state_code, "Race", "Foreign-born" AS foreign_born,
               "Total Population" AS total_population FROM clean_demographics WHERE c_custkey % 13 <> 0),
b AS (SELECT "City", "State", "State Code" AS state_code, "Race",
             "Foreign-born" + CASE WHEN c_custkey % 7 = 0 THEN 1 ELSE 0 END AS foreign_born,
             "Total Population" AS total_population FROM clean_demographics WHERE c_custkey % 11 <> 0)
SELECT *, DATE '2016-04-01' AS valid_from, CAST(NULL AS DATE) AS valid_to
FROM (SELECT * FROM a INTERSECT SELECT * FROM b)
UNION ALL SELECT *, DATE '2016-04-01', DATE '2016-05-01' FROM (SELECT * FROM a EXCEPT SELECT * FROM b)
UNION ALL SELECT *, DATE '2016-05-01', NULL FROM (SELECT * FROM b EXCEPT SELECT * FROM a)"""),
    "qc_reconcile_loads": with_(["clean_arrivals"], """
, a AS (SELECT *, coalesce(CAST(cicid AS BIGINT), 1) AS k FROM clean_arrivals),
b AS (SELECT * EXCLUDE (k) REPLACE (CASE WHEN k % 83 = 0 THEN 2.0 ELSE "count" END AS "count"),
             unnest(range(CASE WHEN k % 97 = 0 THEN 0 WHEN k % 89 = 0 THEN 2 ELSE 1 END)) AS u FROM a),
u AS (SELECT * EXCLUDE (k), 1 AS l, 0 AS r FROM a UNION ALL SELECT * EXCLUDE (u), 0, 1 FROM b)
SELECT * EXCLUDE (l, r), CAST(sum(l) AS BIGINT) AS n_left, CAST(sum(r) AS BIGINT) AS n_right
FROM u GROUP BY ALL HAVING sum(l) <> sum(r)"""),
    "src_nested_payloads": """
WITH e AS (SELECT event_id, CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS BIGINT) AS k,
                  CASE WHEN event_id % 19 = 0 THEN 'malformed' WHEN event_id % 29 = 0 THEN 'missing k'
                       WHEN event_id % 23 = 0 THEN 'empty' END AS reason FROM events),
n AS (SELECT *, CASE WHEN reason IS NOT NULL OR event_id % 4 = 0 THEN 0 ELSE event_id % 3 + 1 END AS size
      FROM e)
SELECT event_id, reason, CASE WHEN reason IS NULL THEN k END AS k, CAST(NULL AS INTEGER) AS tag_no,
       CAST(NULL AS VARCHAR) AS tag FROM n WHERE size = 0
UNION ALL
SELECT event_id, reason, k, CAST(i AS INTEGER), 't' || i
FROM (SELECT *, unnest(range(size)) AS i FROM n WHERE size > 0)""",
    "agg_merged_states": """
SELECT CAST(date_trunc('week', ts) AS DATE) AS period_start, count(*) AS n_rows,
       count(DISTINCT user_id) AS n_exact, true AS within_bound
FROM events GROUP BY 1""",
}
