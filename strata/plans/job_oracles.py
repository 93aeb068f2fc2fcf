"""DuckDB SQL for ``strata.plans.job_queries``: what the made pages say, taken from the tables."""

from __future__ import annotations

from strata.plans import job_queries as J


def _url_id(url: str) -> str:
    return f"sha1({url})"


def _hash5(x: str) -> str:
    """First 12 hex digits of SHA-1, modulo 100000, five digits."""
    return f"lpad(CAST(CAST('0x' || substr(sha1({x}), 1, 12) AS BIGINT) % 100000 AS VARCHAR), 5, '0')"


_MEASURES = ("sig_str", "sig_str_pct", "head", "body", "leg", "distance", "clinch", "ground")


def _stats(side: int) -> str:
    n = f"(q + {side})"
    values = (f"{n} || ' of ' || ({n} + 10)", f"{n} || '%'", f"(l_partkey + {side}) || ' of 9'", f"l_suppkey || ' of {side}'", "l_linenumber || ' of 1'",
              f"({n} + 1) || ' of 2'", f"({n} + 2) || ' of 3'", f"({n} + 3) || ' of 4'")
    return ", ".join(f"{v} AS {m}" for v, m in zip(values, _MEASURES))


FIGHT_DOCUMENTS = f"""
WITH l AS (
  SELECT *, CAST(l_quantity AS INT) AS q,
         row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice, CAST(l_quantity AS INT),
                            l_returnflag, l_tax) AS nth,
         count(*) OVER (PARTITION BY l_orderkey) AS n
  FROM lineitem),
counted AS (  -- the last full row of a round counts
  SELECT * FROM l WHERE l_returnflag <> 'R' QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY nth DESC) = 1),
stats AS (
  SELECT l_orderkey, 0 AS side, l_linenumber::VARCHAR AS round, {_stats(0)} FROM counted
  UNION ALL SELECT l_orderkey, 1, l_linenumber::VARCHAR, {_stats(1)} FROM counted),
o AS (
  SELECT *, 'Customer ' || o_custkey AS red, CASE WHEN o_orderpriority = '5-LOW' THEN 'Customer ' || o_custkey ELSE 'Rival ' || o_orderkey END AS blue,
         '{J.SITE}/fighter-details/' || o_custkey AS red_url, '{J.SITE}/fighter-details/r' || o_orderkey AS blue_url,
         coalesce((SELECT max(n) FROM l WHERE l_orderkey = o_orderkey), 0) AS n
  FROM orders),
person AS (
  -- opponents of one name have the rounds of the second
  SELECT *, 0 AS side, red AS name, 'W' AS result, red_url AS url, CASE WHEN red = blue THEN 1 ELSE 0 END AS of_side FROM o
  UNION ALL SELECT *, 1, blue, 'L', blue_url, 1 FROM o)
SELECT sha1(o_custkey || '|' || red_url || '|' || blue_url || '|1') AS fight_id, '{J.SITE}/fight-details/' || o_orderkey AS fight_url,
       {_hash5("o_custkey::VARCHAR")} AS event_id_hash5, 'normal' AS bout, o_orderpriority AS method, n::VARCHAR AS last_round,
       CAST(NULL AS VARCHAR) AS time, 'Ref' AS referee, p.side, name, result, sha1(url) AS fighter_id, round, {", ".join(_MEASURES)}
FROM person p LEFT JOIN stats s ON s.l_orderkey = o_orderkey AND s.side = of_side"""

EVENT_LISTINGS = f"""
WITH o AS (
  SELECT *, '{J.SITE}/event-details/' || o_orderkey AS url,
         row_number() OVER (PARTITION BY o_custkey, o_orderstatus ORDER BY o_orderkey) AS page_pos,
         CASE WHEN o_orderpriority <> '5-LOW' THEN CAST(o_orderdate AS DATE) END AS day
  FROM orders WHERE o_orderstatus IN ('F', 'O'))
SELECT sha1(url) AS event_id, {_hash5("sha1(url)")} AS event_id_hash5, 'Night ' || o_orderkey AS name, url AS event_url,
       strftime(day, '%Y-%m-%d') AS event_date, 'Town, ' || o_orderpriority AS location,
       CASE o_orderstatus WHEN 'F' THEN 'completed' ELSE 'upcoming' END AS status, page_pos,
       CASE o_orderstatus WHEN 'F' THEN 0 ELSE 1 END AS _src, coalesce(-datediff('day', DATE '1970-01-01', day), 2147483647) AS _late
FROM o WHERE o_orderstatus = 'O' OR day >= DATE '{J.LIST_ANCHOR}' - INTERVAL {J.LIST_DAYS} DAY"""

FIGHTER_DOCUMENTS = f"""
WITH o AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS pos FROM orders)
SELECT sha1('{J.SITE}/fighter-details/' || c_custkey) AS fighter_id, CASE WHEN o_orderkey IS NULL THEN 'nobody' ELSE c_name END AS name,
       CASE WHEN o_orderkey IS NOT NULL THEN c_nationkey || '-0-0' END AS record,
       CASE WHEN o_orderkey IS NOT NULL THEN (c_nationkey + 100) || ' lbs.' END AS weight,
       CASE WHEN o_orderkey IS NOT NULL THEN c_mktsegment END AS stance, CASE WHEN o_orderkey IS NOT NULL THEN '--' END AS dob,
       CASE WHEN o_orderkey IS NOT NULL THEN c_custkey::VARCHAR END AS slpm, CASE WHEN o_orderkey IS NOT NULL THEN '55%' END AS str_def_pct, pos,
       CASE o_orderstatus WHEN 'F' THEN 'win' WHEN NULL THEN NULL ELSE CASE WHEN o_orderkey IS NOT NULL THEN 'loss' END END AS f_result,
       CASE WHEN o_orderstatus = 'O' THEN '{J.SITE}/next/' || o_orderkey ELSE '{J.SITE}/fight-details/' || o_orderkey END AS f_fight_url,
       'Customer ' || o_custkey AS f_fighter, 'Rival ' || o_orderkey AS f_opponent, '{J.SITE}/fighter-details/r' || o_orderkey AS f_opponent_profile_url,
       o_orderkey::VARCHAR AS f_str, 'Night ' || o_orderkey AS f_event_name, strftime(o_orderdate, '%b %-d, %Y') AS f_event_date,
       o_orderpriority = '1-URGENT' AS f_title_bout, o_orderpriority AS f_method_short,
       CASE WHEN o_orderkey IS NOT NULL THEN '3' END AS f_round, CASE WHEN o_orderkey IS NOT NULL THEN '4:35' END AS f_time
FROM customer LEFT JOIN o ON o_custkey = c_custkey"""

BAD_LINES = """
WITH e AS (SELECT *, event_type IN ('error', 'signup') AS bad, strftime(ts, '%Y-%m-%d') AS dt_particao FROM events)
SELECT 'good' AS kind, event_id, event_type, user_id, CAST(NULL AS VARCHAR) AS line, dt_particao,
       (SELECT count(*) FROM e WHERE NOT bad) AS of_kind FROM e WHERE NOT bad
UNION ALL
SELECT 'bad', NULL, NULL, NULL, '{"event_id": ' || event_id || ', "event_type": "' || event_type || '"'
       || CASE event_type WHEN 'signup' THEN ', "user_id": "n/a"}' ELSE '' END, dt_particao, (SELECT count(*) FROM e WHERE bad) FROM e WHERE bad"""

STORED_EVOLVE = f"""
SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderdate < DATE '{J.SPLIT_DATE}' THEN 'store'
       WHEN o_orderpriority <> '1-URGENT' THEN lower(o_orderpriority) END AS channel FROM orders"""

STREAM_MERGE = f"""
WITH e AS (SELECT *, strftime(ts, '%Y-%m-%d') AS dt_particao FROM events)
SELECT event_id, ts, user_id, event_type, CASE WHEN dt_particao >= '{J.STREAM_AGAIN}' THEN value * 2 ELSE value END AS value, props,
       CASE WHEN dt_particao >= '{J.STREAM_AGAIN}' THEN 2 ELSE 1 END AS version, dt_particao FROM e"""

MISSING_PAGES = r"""
WITH p AS (SELECT sha1(regexp_replace(url, '^[\s\x{00A0}]+|[\s\x{00A0}]+$', '', 'g')) AS page_key, url, contains(url, '?') AS asked,
                  starts_with(url, 'https') AS secure FROM pages WHERE url <> ''),
landed AS (SELECT page_key FROM p WHERE NOT asked OR NOT secure)
SELECT 'page' AS kind, page_key, min(url) AS url FROM p WHERE page_key NOT IN (SELECT page_key FROM landed) GROUP BY page_key"""

MANAGED_TABLES = "SELECT c_custkey AS id_lutador, c_name AS nome_lutador, 'dim_lutador' AS of_table FROM customer"

LANDED_PAGES = """
WITH p AS (SELECT CASE WHEN starts_with(url, 'https') THEN 'fight' ELSE 'event' END AS kind, page_id::VARCHAR AS page_key, url, html,
                  CASE WHEN contains(url, '?') THEN '2024-01-02' ELSE '2024-01-01' END AS dt FROM pages),
now AS (SELECT * REPLACE (CASE WHEN kind = 'fight' AND dt = '2024-01-02' THEN 'again ' || html ELSE html END AS html) FROM p)
SELECT kind, dt, page_key, url, length(html) AS n_chars, md5(html) AS md5 FROM now"""

ORACLES = {
    "fight_documents": FIGHT_DOCUMENTS,
    "event_listings": EVENT_LISTINGS,
    "fighter_documents": FIGHTER_DOCUMENTS,
    "bad_lines": BAD_LINES,
    "stored_evolve": STORED_EVOLVE,
    "stream_merge": STREAM_MERGE,
    "missing_pages": MISSING_PAGES,
    "managed_tables": MANAGED_TABLES,
    "landed_pages": LANDED_PAGES,
}
