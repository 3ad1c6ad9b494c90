"""Reference SQL for every registered query, runnable by DuckDB on the driver's
tables (``region nation customer supplier part orders lineitem events ...``).

The derived inputs of :mod:`arrivals_mart.plans.derived` are restated as
CTEs; each query is then written the way an analyst would write it in SQL
(global ``row_number`` instead of the distributed dense key, and so on).
DuckDB specifics: double -> int rounds in DuckDB, so Spark's truncation is
written as ``trunc``; DuckDB sorts nulls last, so ``NULLS FIRST`` is explicit.
"""

from __future__ import annotations

from arrivals_mart.schemas import RECORD_KEY_TABLES, TABLE_KEYS, TARGETS

CTES = {
    "arrivals_base": """
    SELECT o.*, CASE WHEN o_orderpriority = '5-LOW' THEN NULL
                     ELSE CAST(date_diff('day', DATE '1960-01-01', CAST(o_orderdate AS DATE)) AS DOUBLE) END AS arr_day,
           CASE WHEN o_custkey % 11 = 0 THEN NULL ELSE CAST(o_custkey % 90 AS DOUBLE) + 0.5 END AS age_val
    FROM orders o""",
    "arrivals": """
    SELECT CAST(o_orderkey AS DOUBLE) AS cicid,
           CAST(year(o_orderdate) AS DOUBLE) AS i94yr,
           CAST(month(o_orderdate) AS DOUBLE) AS i94mon,
           CAST(o_custkey % 30 AS DOUBLE) AS i94cit,
           CAST((o_custkey + o_orderkey) % 27 AS DOUBLE) AS i94res,
           CASE WHEN o_orderkey % 2 = 0 THEN 'p' ELSE 'P' END || CAST(o_custkey % 27 AS VARCHAR) AS i94port,
           arr_day AS arrdate,
           CAST(CASE o_orderkey % 6 WHEN 0 THEN 1 WHEN 1 THEN 2 WHEN 2 THEN 3 WHEN 3 THEN 9 WHEN 4 THEN 5 END AS DOUBLE) AS i94mode,
           CASE WHEN o_orderstatus = 'O' AND o_orderkey % 3 = 0 THEN 'ZZ' END AS i94addr,
           CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE arr_day + CAST(o_orderkey % 30 AS DOUBLE) END AS depdate,
           age_val AS i94bir,
           CAST(o_orderkey % 5 AS DOUBLE) AS i94visa,
           CASE WHEN age_val IS NOT NULL THEN CAST(year(o_orderdate) - o_custkey % 90 AS DOUBLE) END AS biryear,
           CASE o_custkey % 4 WHEN 0 THEN 'M' WHEN 1 THEN 'F' WHEN 2 THEN 'X' END AS gender,
           substr(o_orderpriority, 3, 20) AS airline,
           CASE o_orderstatus WHEN 'O' THEN 'B1' WHEN 'F' THEN 'B2' ELSE 'WT' END AS visatype,
           o_orderstatus AS visapost
    FROM arrivals_base""",
    "ports": """
    SELECT CASE WHEN n_nationkey % 2 = 1 THEN 'p' ELSE 'P' END || CAST(n_nationkey AS VARCHAR) AS code,
           n_name AS city,
           CASE WHEN r_name = 'MIDDLE EAST' THEN NULL ELSE upper(substr(r_name, 1, 2)) END AS state
    FROM nation LEFT JOIN region ON n_regionkey = r_regionkey""",
    "countries": """
    SELECT lpad(CAST(n_nationkey AS VARCHAR), 3, ' ') AS code, n_name AS country FROM nation""",
    "temperatures": """
    SELECT CASE WHEN l_linenumber = 7 THEN 'not a date'
                WHEN l_linenumber = 5
                THEN strftime(date_trunc('month', CAST(l_shipdate AS DATE)) - INTERVAL 204 MONTH, '%Y-%m-%d')
                ELSE strftime(date_trunc('month', CAST(l_shipdate AS DATE)), '%Y-%m-%d') END AS dt,
           CASE WHEN l_linenumber = 6 THEN '' ELSE CAST(l_quantity AS VARCHAR) END AS averagetemperature,
           CAST(l_linenumber AS VARCHAR) || '.' || CASE WHEN l_returnflag = 'A' THEN '25'
                WHEN l_returnflag = 'N' THEN '5' ELSE '75' END AS averagetemperatureuncertainty,
           n_name AS city,
           CASE WHEN l_returnflag = 'R' THEN 'Mexico' ELSE 'United States' END AS country
    FROM lineitem JOIN supplier ON l_suppkey = s_suppkey LEFT JOIN nation ON s_nationkey = n_nationkey""",
    "demographics": """
    SELECT CASE WHEN c_custkey % 10 = 3 THEN lower(n_name) ELSE n_name END AS city,
           CASE WHEN r_name = 'MIDDLE EAST' THEN NULL ELSE upper(substr(r_name, 1, 2)) END AS state_code,
           c_mktsegment || ' ' || CAST(c_custkey AS VARCHAR) AS race,
           TRY_CAST(CAST(c_acctbal / 100 AS VARCHAR) AS DOUBLE) AS median_age,
           CAST(c_custkey % 1000 AS INTEGER) AS male_population,
           CASE WHEN c_mktsegment = 'BUILDING' THEN NULL ELSE CAST(c_custkey % 777 AS INTEGER) END AS female_population,
           CAST(n_nationkey * 1000 + n_regionkey + 100000 + CASE WHEN c_custkey % 7 = 2 THEN 1 ELSE 0 END AS INTEGER)
               AS total_population,
           CAST(c_nationkey * 10 AS INTEGER) AS number_of_veterans,
           CASE WHEN c_acctbal < 0 THEN NULL ELSE CAST(c_custkey % 500 AS INTEGER) END AS foreign_born,
           TRY_CAST(CAST(c_acctbal / 1000 AS VARCHAR) AS DOUBLE) AS avg_household_size
    FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey""",
    "fact": """
    SELECT CAST(CAST(trunc(a.cicid) AS BIGINT) AS VARCHAR) AS immigration_id,
           TRY_CAST(trunc(a.i94yr) AS INTEGER) AS imm_year,
           TRY_CAST(trunc(a.i94mon) AS INTEGER) AS imm_month,
           CASE WHEN a.i94mode = 1 THEN 'Air' WHEN a.i94mode = 2 THEN 'Sea'
                WHEN a.i94mode = 3 THEN 'Land' WHEN a.i94mode = 9 THEN 'Not reported' END AS transport_mode,
           a.i94port AS arrival_city_code,
           p.city AS arrival_city,
           coalesce(a.i94addr, p.state) AS arrival_state,
           DATE '1960-01-01' + CAST(trunc(a.arrdate) AS INTEGER) AS arrival_date,
           DATE '1960-01-01' + CAST(trunc(a.depdate) AS INTEGER) AS departure_date,
           CASE WHEN a.i94visa = 1 THEN 'Business' WHEN a.i94visa = 2 THEN 'Pleasure'
                WHEN a.i94visa = 3 THEN 'Student' END AS travel_purpose,
           a.visatype AS visa_type,
           a.visapost AS visa_issued_state,
           a.airline AS airline
    FROM arrivals a LEFT JOIN ports p ON lower(a.i94port) = lower(p.code)
    WHERE p.city IS NOT NULL AND a.arrdate IS NOT NULL""",
    "person": """
    SELECT CAST(CAST(trunc(a.cicid) AS BIGINT) AS VARCHAR) AS immigration_id,
           c1.country AS citizenship_country,
           c2.country AS residence_country,
           CAST(trunc(a.i94bir) AS INTEGER) AS age,
           CAST(trunc(a.biryear) AS INTEGER) AS birthyear,
           a.gender AS gender
    FROM arrivals a
    LEFT JOIN countries c1 ON CAST(trunc(a.i94cit) AS INTEGER) = TRY_CAST(trunc(TRY_CAST(c1.code AS DOUBLE)) AS INTEGER)
    LEFT JOIN countries c2 ON CAST(trunc(a.i94res) AS INTEGER) = TRY_CAST(trunc(TRY_CAST(c2.code AS DOUBLE)) AS INTEGER)
    WHERE a.gender IN ('M', 'F') AND a.i94bir IS NOT NULL""",
    "monthly_temps": """
    SELECT temp_report_month, city, country,
           avg(t) AS avg_temp, avg(u) AS avg_temp_uncertainty
    FROM (SELECT TRY_CAST(dt AS DATE) AS temp_report_month, city, country,
                 TRY_CAST(averagetemperature AS DOUBLE) AS t,
                 TRY_CAST(averagetemperatureuncertainty AS DOUBLE) AS u
          FROM temperatures)
    WHERE country = 'United States' AND temp_report_month >= DATE '1980-01-01'
    GROUP BY 1, 2, 3""",
    "temp_dim": """
    SELECT CAST(row_number() OVER (ORDER BY temp_report_month NULLS FIRST, city NULLS FIRST) AS INTEGER) AS temp_id,
           temp_report_month, city, country, avg_temp, avg_temp_uncertainty
    FROM monthly_temps""",
    "demo_dim": """
    SELECT CAST(row_number() OVER (ORDER BY city NULLS FIRST, state_code NULLS FIRST, race NULLS FIRST) AS INTEGER) AS demo_id,
           city, state_code, race, median_age, male_population, female_population, total_population,
           number_of_veterans, foreign_born, avg_household_size
    FROM demographics""",
    "top_cities": """
    SELECT city, state_code, total_population
    FROM (SELECT DISTINCT city, state_code, total_population FROM demo_dim)
    ORDER BY total_population DESC NULLS LAST, city NULLS FIRST, state_code NULLS FIRST
    LIMIT 10""",
    "events_l": """
    SELECT p_brand AS artist,
           'First' || CAST(l_suppkey AS VARCHAR) AS firstname,
           CASE WHEN l_suppkey % 2 = 0 THEN 'M' ELSE 'F' END AS gender,
           'Last' || CAST(l_suppkey % 13 AS VARCHAR) AS lastname,
           CASE WHEN l_linenumber = 7 THEN NULL ELSE p_retailprice END AS length,
           CASE WHEN l_linestatus = 'O' THEN 'paid' ELSE 'free' END AS level,
           'Region ' || CAST(l_suppkey % 7 AS VARCHAR) AS location,
           CASE WHEN l_returnflag = 'A' THEN 'NextSong' ELSE 'Home' END AS page,
           l_orderkey AS sessionid,
           p_name AS song,
           epoch_ms(l_shipdate) + l_linenumber * 1234 + l_partkey % 1000 AS ts,
           'agent/' || l_linestatus AS useragent,
           l_suppkey AS userid
    FROM lineitem JOIN part ON l_partkey = p_partkey""",
    "songs_l": """
    SELECT 'AR' || replace(p_brand, 'Brand#', '') AS artist_id,
           p_brand AS artist_name,
           CAST(p_size AS DOUBLE) AS artist_latitude,
           -CAST(p_size AS DOUBLE) AS artist_longitude,
           p_type AS artist_location,
           'SO' || CAST(p_partkey AS VARCHAR) || CASE WHEN copy > 0 THEN '-' || CAST(copy AS VARCHAR) ELSE '' END AS song_id,
           p_name AS title,
           p_retailprice AS duration,
           CAST(p_size + 1990 AS BIGINT) AS year
    FROM part JOIN range(0, 24) AS r(copy) ON copy = 0 OR p_partkey % 500 = 1""",
    "songplays": """
    SELECT md5(CAST(e.sessionid AS VARCHAR) || CAST(e.start_time AS VARCHAR)) AS songplay_id,
           e.start_time, e.userid, e.level, s.song_id, s.artist_id, e.sessionid, e.location, e.useragent
    FROM (SELECT TIMESTAMP '1970-01-01 00:00:00' + to_seconds(ts // 1000) AS start_time, *
          FROM events_l WHERE page = 'NextSong') e
    LEFT JOIN songs_l s ON e.song = s.title AND e.artist = s.artist_name AND e.length = s.duration""",
}

# which CTEs each CTE reads (closure is taken automatically)
DEPENDS = {
    "arrivals": ["arrivals_base"],
    "fact": ["arrivals", "ports"],
    "person": ["arrivals", "countries"],
    "monthly_temps": ["temperatures"],
    "temp_dim": ["monthly_temps"],
    "demo_dim": ["demographics"],
    "top_cities": ["demo_dim"],
    "songplays": ["events_l", "songs_l"],
}


def _closure(names):
    out: list[str] = []

    def visit(n):
        for d in DEPENDS.get(n, []):
            visit(d)
        if n not in out:
            out.append(n)

    for n in names:
        visit(n)
    return out


def with_ctes(names, body: str) -> str:
    names = _closure(names)
    if not names:
        return body
    parts = ",\n".join(f"{n} AS ({CTES[n]})" for n in names)
    return f"WITH {parts}\n{body}"


def _round(c: str, alias: str | None = None) -> str:
    return f"round({c}, 4) AS {alias or c}"


TRAILING_TEMPS = """
    SELECT city, month, avg_temp,
           avg(avg_temp) OVER (PARTITION BY city ORDER BY year(month) * 12 + month(month) - 1
                               RANGE BETWEEN 2 PRECEDING AND CURRENT ROW) AS trailing_avg_temp
    FROM (SELECT lower(city) AS city, CAST(date_trunc('month', temp_report_month) AS DATE) AS month,
                 avg(avg_temp) AS avg_temp
          FROM temp_dim GROUP BY 1, 2)"""

LABEL_ROWS = """
    SELECT 'custl' AS block, CAST(c_custkey AS VARCHAR) AS code,
           CASE WHEN c_custkey % 50 = 11 THEN c_name || ' /* keep */ B'
                WHEN c_custkey % 50 = 13 THEN c_name || ' "x" it''s'
                WHEN c_custkey % 50 = 23 THEN c_name || ' TAIL'
                WHEN c_custkey % 500 = 7 THEN rpad(c_name, 5000, 'x')
                WHEN c_mktsegment = 'BUILDING' THEN 'No Country Code (' || CAST(c_custkey AS VARCHAR) || ')'
                WHEN c_mktsegment = 'MACHINERY' THEN c_name || ' O''NEIL'
                ELSE c_name END AS label,
           c_custkey % 50 IN (11, 13, 23) OR c_custkey % 500 = 7 OR c_mktsegment <> 'BUILDING' AS is_valid
    FROM customer
    UNION ALL
    SELECT '$portl', 'S' || CAST(s_suppkey AS VARCHAR),
           CASE WHEN s_suppkey % 9 = 0 THEN 'No PORT Code (S' || CAST(s_suppkey AS VARCHAR) || ')'
                WHEN n_regionkey = 4 THEN town || ', MX'
                WHEN s_suppkey % 4 = 1 THEN town || ', ' || upper(substr(r_name, 1, 2)) || ' (BPS)'
                WHEN s_suppkey % 4 = 2 THEN town || ', ' || upper(substr(r_name, 1, 2)) || ' #ARPT'
                WHEN s_suppkey % 8 = 3 THEN town || ' ' || upper(substr(r_name, 1, 2))
                WHEN s_suppkey % 8 = 7 THEN town
                ELSE town || ', ' || upper(substr(r_name, 1, 2)) END,
           s_suppkey % 9 <> 0
    FROM (SELECT *, CASE WHEN s_suppkey % 5 = 0 THEN s_name || ' O''HARE' ELSE s_name END AS town
          FROM supplier) JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
    UNION ALL
    SELECT 'stcodes', upper(substr(r_name, 1, 2)), r_name, true FROM region WHERE r_regionkey <> 4
    UNION ALL
    SELECT 'numl', CAST(r_regionkey AS VARCHAR), r_name, true FROM region"""

LABEL_PORTS = """
    SELECT 'S' || CAST(s_suppkey AS VARCHAR) AS code,
           CASE WHEN n_regionkey = 4 THEN town || ', MX' ELSE town END AS city,
           CASE WHEN n_regionkey = 4 OR s_suppkey % 8 = 7 THEN NULL ELSE upper(substr(r_name, 1, 2)) END AS state
    FROM (SELECT *, CASE WHEN s_suppkey % 5 = 0 THEN s_name || ' O''HARE' ELSE s_name END AS town
          FROM supplier) JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
    WHERE s_suppkey % 9 <> 0"""

LABEL_COUNTRIES = f"SELECT code, label AS country FROM ({LABEL_ROWS}) WHERE block = 'custl' AND is_valid"


def content_sql(table: str, columns: list[tuple[str, str]]) -> str:
    """What a table holds, as one row: the sums of both halves of the MD5s of its rows' texts, as exact numbers."""
    texts = [
        f"coalesce(CAST(CAST(round({c} * 1000) AS BIGINT) AS VARCHAR), '~')" if kind == "double"
        else f"coalesce(CAST({c} AS VARCHAR), '~')" for c, kind in columns
    ]
    text = " || '|' || ".join(texts)
    sums = ", ".join(
        f"CAST(coalesce(sum(CAST(CAST('0x' || substr(m, {at}, 16) AS UBIGINT) AS HUGEINT)), 0) AS VARCHAR) AS {n}"
        for n, at in (("rows_high", 1), ("rows_low", 17)))
    return f"SELECT {sums} FROM (SELECT md5({text}) AS m FROM {table})"


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["scan_parquet"] = "SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_totalprice > 0"
    q["scan_csv_header"] = "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier"
    q["scan_csv_semicolon"] = with_ctes(["demographics"], "SELECT * FROM demographics")
    q["label_dictionary"] = LABEL_ROWS
    q["label_port_lookup"] = LABEL_PORTS
    q["label_country_lookup"] = LABEL_COUNTRIES
    q["sink_parquet_overwrite"] = "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer"
    q["truncate_and_load"] = with_ctes(["fact"], "SELECT * FROM fact")
    q["load_catalog_table"] = with_ctes(["fact"], "SELECT * FROM fact")
    q["schema_contract"] = (
        "SELECT l_orderkey, l_linenumber, CAST(l_shipdate AS DATE) AS l_shipdate, l_extendedprice, l_returnflag "
        "FROM lineitem"
    )
    q["key_cast"] = (
        "SELECT CAST(CAST(trunc(CAST(o_orderkey AS DOUBLE)) AS BIGINT) AS VARCHAR) AS order_id, "
        "CAST(CAST(trunc(CAST(o_orderkey AS DOUBLE) + 0.7) AS BIGINT) AS VARCHAR) AS shifted_id, "
        "CAST(9007199254740992 + o_orderkey AS VARCHAR) AS large_id, "
        "CAST(9007199254740992 + o_orderkey AS VARCHAR) AS large_text_id, "
        "o_custkey FROM orders"
    )
    q["tolerant_casts"] = """
    SELECT p_partkey,
           TRY_CAST(trunc(TRY_CAST(p_name AS DOUBLE)) AS INTEGER) AS name_int,
           TRY_CAST(trunc(TRY_CAST(CAST(p_retailprice AS VARCHAR) AS DOUBLE)) AS INTEGER) AS price_int,
           TRY_CAST(CAST(p_retailprice AS VARCHAR) AS DOUBLE) AS price_double,
           TRY_CAST(trunc(TRY_CAST(CAST(p_size AS VARCHAR) || '.0' AS DOUBLE)) AS INTEGER) AS size_int,
           TRY_CAST(trunc(TRY_CAST('  ' || CAST(p_size AS VARCHAR) || ' ' AS DOUBLE)) AS INTEGER) AS padded_int,
           CAST(NULL AS INTEGER) AS suffix_int, CAST(NULL AS INTEGER) AS exponent_int,
           p_size AS signed_int,
           TRY_CAST(p_type AS DOUBLE) AS type_double,
           TRY_CAST('2001-' || CASE WHEN p_size % 5 = 0 THEN '13' ELSE '01' END || '-'
                    || lpad(CAST(p_size % 28 + 1 AS VARCHAR), 2, '0') AS DATE) AS ship_date
    FROM part"""
    q["decode_codes"] = """
    SELECT l_orderkey, l_linenumber,
           CASE WHEN l_linenumber = 1 THEN 'Air' WHEN l_linenumber = 2 THEN 'Sea'
                WHEN l_linenumber = 3 THEN 'Land' WHEN l_linenumber = 9 THEN 'Not reported' END AS transport_mode,
           CASE WHEN l_quantity = 1 THEN 'Business' WHEN l_quantity = 2 THEN 'Pleasure'
                WHEN l_quantity = 3 THEN 'Student' END AS travel_purpose
    FROM lineitem"""
    q["lookup_coalesce"] = """
    SELECT c_custkey, coalesce(nullif(c_mktsegment, 'BUILDING'), r_name) AS segment_or_region
    FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey"""
    q["case_insensitive_join"] = """
    SELECT c_custkey, n_name, n_nationkey
    FROM customer LEFT JOIN nation ON lower('nation_' || CAST(c_nationkey AS VARCHAR)) = lower(n_name)"""
    q["role_playing_lookup"] = """
    SELECT cn.n_name AS customer_nation, sn.n_name AS supplier_nation, count(*) AS line_count
    FROM lineitem
    JOIN orders ON l_orderkey = o_orderkey
    JOIN customer ON o_custkey = c_custkey
    JOIN supplier ON l_suppkey = s_suppkey
    LEFT JOIN nation cn ON c_nationkey = cn.n_nationkey
    LEFT JOIN nation sn ON s_nationkey = sn.n_nationkey
    GROUP BY 1, 2"""
    q["day_number_dates"] = """
    SELECT o_orderkey,
           CAST(date_diff('day', DATE '1960-01-01', CAST(o_orderdate AS DATE)) AS INTEGER) AS day_number,
           CAST(o_orderdate AS DATE) AS order_date
    FROM orders"""
    q["hash_key"] = "SELECT event_id, md5(CAST(user_id AS VARCHAR) || event_type) AS user_event_hash FROM events"
    q["epoch_to_timestamp"] = "SELECT event_id, date_trunc('second', ts) AS start_time FROM events"
    q["time_dimension"] = with_ctes(
        ["songplays"],
        """SELECT start_time,
           CAST(extract(hour FROM start_time) AS INTEGER) AS hour,
           CAST(extract(day FROM start_time) AS INTEGER) AS day,
           CAST(extract(week FROM start_time) AS INTEGER) AS week,
           CAST(extract(month FROM start_time) AS INTEGER) AS month,
           CAST(extract(year FROM start_time) AS INTEGER) AS year,
           CAST(extract(dow FROM start_time) AS INTEGER) AS weekday
    FROM songplays""",
    )
    q["fact_build"] = with_ctes(["fact"], "SELECT * FROM fact")
    q["incremental_fact"] = with_ctes(["fact"], """SELECT * REPLACE (nullif(immigration_id, without) AS immigration_id),
           count(without) OVER () AS null_keys_counted
    FROM (SELECT *, CASE WHEN CAST(immigration_id AS BIGINT) % 97 = 0 THEN immigration_id END AS without FROM fact)""").replace(
        "SELECT * REPLACE", "SELECT * EXCLUDE (without) REPLACE")
    q["dynamic_partition_overwrite"] = q["published_deliveries"] = with_ctes(["fact"], "SELECT * FROM fact")
    q["publication_after_failure"] = with_ctes(["fact"], "SELECT * FROM fact WHERE imm_year < 1998")
    q["warm_month_arrivals"] = with_ctes(["fact", "monthly_temps"], """SELECT imm_year, imm_month, count(*) AS arrivals FROM fact
    WHERE (imm_year, imm_month) IN (SELECT (CAST(year(temp_report_month) AS INTEGER), CAST(month(temp_report_month) AS INTEGER))
                                    FROM monthly_temps WHERE avg_temp >= 28)
    GROUP BY ALL""")
    q["stable_keys_two_deliveries"] = with_ctes(["demographics"], """SELECT city, state_code, race,
           row_number() OVER (ORDER BY male_population % 2, city NULLS FIRST, state_code NULLS FIRST, race NULLS FIRST) AS demo_key,
           male_population
    FROM demographics""")
    q["reconciled_deliveries"] = with_ctes(["arrivals"], """SELECT cicid, i94yr,
           CASE WHEN i94yr >= 1997 THEN CAST(CAST(i94mon AS INTEGER) AS VARCHAR) ELSE CAST(i94mon AS VARCHAR) END AS i94mon,
           i94port, i94visa, CASE WHEN i94yr >= 1994 THEN visapost END AS visapost,
           CASE WHEN i94yr >= 1994 AND i94yr < 1997 THEN 'M' END AS matflag,
           CASE WHEN i94yr < 1994 THEN 'old' WHEN i94yr < 1997 THEN 'middle' ELSE 'new' END AS delivery
    FROM arrivals""")
    q["repeated_keys"] = """
    SELECT o_orderkey, o_custkey, CAST(CASE WHEN o_custkey % 5 = 0 THEN 3 ELSE 2 END AS BIGINT) AS n
    FROM orders WHERE o_orderkey % 97 = 0"""
    q["decode_dictionary_codes"] = """
    SELECT l_orderkey, l_linenumber, r_name AS label FROM lineitem LEFT JOIN region ON l_linenumber = r_regionkey"""
    q["dim_person_build"] = with_ctes(["person"], "SELECT * FROM person")
    q["star_join"] = with_ctes(
        ["fact", "person"],
        """SELECT f.immigration_id, f.arrival_city, f.arrival_date, f.transport_mode,
           p.citizenship_country, p.residence_country, p.age, p.gender
    FROM fact f LEFT JOIN person p ON f.immigration_id = p.immigration_id""",
    )
    q["monthly_average_build"] = with_ctes(
        ["temperatures"],
        """SELECT temp_report_month, city, country, avg(t) AS avg_temp, avg(u) AS avg_temp_uncertainty
    FROM (SELECT TRY_CAST(dt AS DATE) AS temp_report_month, city, country,
                 TRY_CAST(averagetemperature AS DOUBLE) AS t,
                 TRY_CAST(averagetemperatureuncertainty AS DOUBLE) AS u
          FROM temperatures)
    WHERE country = 'United States' AND temp_report_month >= DATE '1980-01-01'
    GROUP BY 1, 2, 3""",
    )
    q["surrogate_key_two_level"] = with_ctes(
        ["temp_dim"],
        "SELECT * FROM temp_dim",
    )
    q["surrogate_key_three_level"] = with_ctes(["demo_dim"], "SELECT * FROM demo_dim")
    q["trailing_average"] = with_ctes(
        ["temp_dim"],
        f"SELECT city, month, {_round('avg_temp')}, {_round('trailing_avg_temp')} FROM ({TRAILING_TEMPS})",
    )
    q["top_k"] = with_ctes(["top_cities"], "SELECT * FROM top_cities")
    q["dedup_group"] = with_ctes(["demo_dim"], "SELECT DISTINCT city, state_code, total_population FROM demo_dim")
    q["top_city_arrivals"] = with_ctes(
        ["fact", "top_cities"],
        """SELECT i.arrival_city, c.total_population, count(i.immigration_id) AS immigration_count
    FROM fact i JOIN (SELECT DISTINCT lower(city) AS city, lower(state_code) AS state, total_population FROM top_cities) c
      ON lower(i.arrival_city) = c.city AND lower(i.arrival_state) = c.state
    GROUP BY 1, 2
    ORDER BY 3 DESC, 1, 2""",
    )
    q["top_city_share"] = with_ctes(
        ["fact", "top_cities"],
        """SELECT total_arrivals, covered_arrivals,
           round(CAST(covered_arrivals AS DOUBLE) * 100.0 / total_arrivals, 4) AS share_pct
    FROM (SELECT count(immigration_id) AS total_arrivals,
                 count(CASE WHEN EXISTS (SELECT 1 FROM top_cities c WHERE lower(i.arrival_city) = lower(c.city)
                                         AND lower(i.arrival_state) = lower(c.state_code))
                       THEN immigration_id END) AS covered_arrivals
          FROM fact i)""",
    )
    q["trailing_temperature_vs_arrivals"] = with_ctes(
        ["fact", "temp_dim"],
        f"""SELECT a.city, a.month, a.arrivals, round(t.trailing_avg_temp, 4) AS trailing_avg_temp
    FROM (SELECT lower(arrival_city) AS city, CAST(date_trunc('month', arrival_date) AS DATE) AS month,
                 count(immigration_id) AS arrivals
          FROM fact GROUP BY 1, 2) a
    LEFT JOIN ({TRAILING_TEMPS}) t ON a.city = t.city AND a.month = t.month""",
    )
    q["trailing_temperature_as_of"] = with_ctes(
        ["fact", "temp_dim"],
        f"""SELECT a.city, a.month, a.arrivals, round(t.trailing_avg_temp, 4) AS trailing_avg_temp,
           t.month AS temp_month
    FROM (SELECT lower(arrival_city) AS city, CAST(date_trunc('month', arrival_date) AS DATE) AS month,
                 count(immigration_id) AS arrivals
          FROM fact GROUP BY 1, 2) a
    ASOF LEFT JOIN ({TRAILING_TEMPS}) t ON a.city = t.city AND a.month >= t.month""",
    )
    q["songplays"] = with_ctes(["songplays"], "SELECT * FROM songplays")
    q["distinct_users"] = with_ctes(
        ["events_l"],
        "SELECT DISTINCT userid, firstname, lastname, gender, level FROM events_l WHERE page = 'NextSong'",
    )
    q["distinct_songs"] = with_ctes(["songs_l"], "SELECT DISTINCT song_id, title, artist_id, year, duration FROM songs_l")
    q["distinct_artists"] = with_ctes(
        ["songs_l"],
        "SELECT DISTINCT artist_id, artist_name, artist_location, artist_latitude, artist_longitude FROM songs_l",
    )
    tables = {"fact_immigration": "fact", "dim_immigrant": "person", "dim_temperature": "temp_dim", "dim_demographics": "demo_dim"}

    def table_report(table: str, cte: str) -> str:
        k = TABLE_KEYS[table]
        content = content_sql(cte, [(f.name, f.dataType.simpleString()) for f in TARGETS[table].fields])
        return f"""SELECT '{table}' AS table_name, '{k}' AS key_column, count(*) AS row_count,
           CAST(count_if({k} IS NULL) AS BIGINT) AS null_keys, count({k}) - count(DISTINCT {k}) AS duplicate_keys,
           count(*) > 0 AND count_if({k} IS NULL) = 0 AND count({k}) = count(DISTINCT {k}) AS passed,
           any_value(rows_high) AS rows_high, any_value(rows_low) AS rows_low
    FROM {cte}, ({content})"""

    q["pipeline_run"] = with_ctes(list(tables.values()), "\nUNION ALL\n".join(table_report(t, c) for t, c in tables.items()))
    q["pipeline_null_keys"] = with_ctes(list(tables.values()), "\nUNION ALL\n".join(
        f"""SELECT '{table}' AS table_name, '{TABLE_KEYS[table]}' AS key_column, count(*) AS row_count,
           CAST(count_if({k} IS NULL) AS BIGINT) AS null_keys, CAST(0 AS BIGINT) AS duplicate_keys,
           count(*) > 0 AND count_if({k} IS NULL) = 0 AS passed FROM {cte}"""
        for table, cte in tables.items()
        for k in [f"(CASE WHEN CAST({TABLE_KEYS[table]} AS BIGINT) % 97 = 0 THEN NULL ELSE {TABLE_KEYS[table]} END)"
                  if table in RECORD_KEY_TABLES else TABLE_KEYS[table]]
    ))
    checks = []
    for table, key in QUALITY_TABLES.items():
        checks.append(
            f"""SELECT '{table}' AS table_name, '{key}' AS key_column, count(*) AS row_count,
           CAST(count_if({key} IS NULL) AS BIGINT) AS null_keys,
           count({key}) - count(DISTINCT {key}) AS duplicate_keys,
           count(*) > 0 AND count_if({key} IS NULL) = 0 AND count({key}) = count(DISTINCT {key}) AS passed
    FROM {table}"""
        )
    q["quality_report"] = "\nUNION ALL\n".join(checks)
    q["quality_duplicates"] = """
    SELECT l_orderkey, l_linenumber, count(*) AS n
    FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1"""
    return q


# tables and keys checked by the quality_report query
QUALITY_TABLES = {
    "orders": "o_orderkey",
    "customer": "c_custkey",
    "supplier": "s_suppkey",
    "part": "p_partkey",
    "lineitem": "l_orderkey",
}
