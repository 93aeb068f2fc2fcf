"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

Each string runs on views named after the driver tables. Column names and
types follow the Spark query. Whitespace uses the explicit Unicode class of
``strata.functions.text`` because RE2's ``\\s`` misses NBSP; half-even
rounding is ``round_even``; DuckDB's ``regexp_replace`` needs ``'g'``.
"""

from __future__ import annotations

from strata.functions.text import WS_CLASS
from strata.operators.extract import H1_RE, LINK_RE, TITLE_RE
from strata.plans import catalog as C

WS = WS_CLASS + "+"


def clean(x: str) -> str:
    return f"NULLIF(regexp_replace(regexp_replace({x}, '{WS}', ' ', 'g'), '^ | $', '', 'g'), '')"


def ustrip(x: str) -> str:
    return f"regexp_replace({x}, '^{WS}|{WS}$', '', 'g')"


def hash5(x: str) -> str:
    return f"lpad(CAST(CAST(('0x' || substr(sha1({x}), 1, 12)) AS BIGINT) % 100000 AS VARCHAR), 5, '0')"


def url_id(x: str) -> str:
    return f"CASE WHEN {x} IS NOT NULL AND {x} <> '' THEN sha1({ustrip(x)}) END"


def short_id(x: str) -> str:
    return f"CASE WHEN {x} IS NOT NULL AND {x} <> '' THEN {hash5(ustrip(x))} END"


def q(s: str) -> str:
    return s.replace("'", "''")


LINK = q(LINK_RE)
TITLE = q(TITLE_RE)
H1 = q(H1_RE)

EVENT_STATUS = ("CASE event_type WHEN 'signup' THEN 'upcoming' WHEN 'purchase' THEN 'completed' "
                "WHEN 'view' THEN 'Completed' WHEN 'click' THEN NULL ELSE 'other' END")

STORED_ORDERS = f"""
  SELECT o_orderkey AS id_evento,
         CASE WHEN o_orderstatus = 'O' THEN 'upcoming' ELSE 'completed' END AS status,
         CASE WHEN o_orderpriority IN ('1-URGENT', '3-MEDIUM') THEN strftime(o_orderdate, '%d/%m/%Y')
              ELSE strftime(o_orderdate, '%Y-%m-%d') END AS data_evento,
         o_orderpriority, o_custkey, o_orderstatus
  FROM orders"""

SCOPE = f"""
  SELECT DISTINCT id_evento FROM ({STORED_ORDERS}) s
  WHERE id_evento IS NOT NULL AND (
        COALESCE(status = 'upcoming', false)
     OR COALESCE(COALESCE(try_strptime(data_evento, '%d/%m/%Y'), try_strptime(data_evento, '%Y-%m-%d'))::DATE
                 >= DATE '{C.ANCHOR_ORDERS}' - INTERVAL {C.SCOPE_DAYS} DAY, false))"""

BATCH_IDS = f"SELECT DISTINCT id_evento FROM ({STORED_ORDERS}) s WHERE o_orderpriority = '2-HIGH'"

LINE_DEDUP = """
  SELECT * FROM lineitem
  QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
      ORDER BY l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC, l_discount DESC,
               l_tax DESC, l_returnflag DESC, l_linestatus DESC, l_shipdate DESC) = 1"""

PAGE_PATH = "regexp_extract(url, '^[a-z]+://[^/]+(/[^?#]*)', 1)"

JSON_TEXT = """CASE WHEN event_type = 'error' AND value > 100 THEN '[' || props || '] x'
      WHEN event_type = 'error' AND value > 50 THEN '[{''k'':1}]'
      WHEN event_type = 'view' AND value > 100 THEN chr(160) || '[' || props || ']' || chr(160)
      WHEN event_type = 'view' AND value > 50 THEN '["{x", "{\\"k\\":9}", ' || props || ']'
      WHEN event_type = 'error' THEN 'nope' WHEN event_type = 'view' THEN props
      WHEN event_type = 'click' THEN '[' || props || ', 5, "x"]' WHEN event_type = 'signup' THEN '  '
      ELSE '[' || props || ',' || props || ']' END"""

DATE_TEXT = """CASE WHEN o_orderpriority = '1-URGENT' THEN strftime(o_orderdate, '%B %-d, %Y')
      WHEN o_orderpriority = '2-HIGH' THEN strftime(o_orderdate, '%d/%m/%Y')
      WHEN o_orderpriority = '3-MEDIUM' THEN strftime(o_orderdate, '%b %-d, %Y')
      WHEN o_orderpriority = '4-NOT SPECIFIED' THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')
      WHEN o_orderstatus = 'F' AND day(o_orderdate) <= 5 THEN strftime(o_orderdate, '%-m/%-d/%Y')
      WHEN o_orderstatus = 'F' AND day(o_orderdate) <= 10 THEN strftime(o_orderdate, '%-d %b %Y')
      WHEN o_orderstatus = 'F' AND day(o_orderdate) > 25 THEN strftime(o_orderdate, '%d-%m-%Y')
      WHEN o_orderstatus = 'F' THEN '30/02/' || CAST(year(o_orderdate) AS VARCHAR)
      WHEN o_orderstatus = 'O' THEN strftime(o_orderdate, '%Y-%m-%d')
      ELSE '--' END"""


def multi_date(t: str) -> str:
    return f"""CASE WHEN regexp_full_match({t}, '\\d{{2}}/\\d{{2}}/\\d{{4}}') THEN try_strptime({t}, '%d/%m/%Y')::DATE
      WHEN regexp_full_match({t}, '\\d{{4}}-\\d{{2}}-\\d{{2}}') THEN try_strptime({t}, '%Y-%m-%d')::DATE
      ELSE COALESCE(try_cast({t} AS TIMESTAMP)::DATE, try_strptime({t}, '%b %d, %Y')::DATE,
                    try_strptime({t}, '%B %d, %Y')::DATE, try_strptime({t}, '%m/%d/%Y')::DATE,
                    try_strptime({t}, '%m-%d-%Y')::DATE, try_strptime({t}, '%d %b %Y')::DATE,
                    try_strptime({t}, '%d-%m-%Y')::DATE) END"""


HEIGHT_TEXT = """CASE WHEN p_type IN ('ECONOMY', 'PROMO')
        THEN CAST(floor((p_size + 48) / 12) AS BIGINT)::VARCHAR || ''' ' || ((p_size + 48) % 12)::VARCHAR || '"'
      WHEN p_type = 'SMALL' THEN (p_size + 150)::VARCHAR || ',5 cm'
      WHEN p_type = 'LARGE' THEN (p_size + 150)::VARCHAR || ' CM' ELSE '--' END"""
WEIGHT_TEXT = """CASE WHEN p_type IN ('ECONOMY', 'PROMO') THEN (p_size * 3 + 100)::VARCHAR || ' lbs.'
      WHEN p_type = 'SMALL' THEN (p_size * 3 + 100)::VARCHAR || '.5 LB'
      WHEN p_type = 'LARGE' THEN (p_size + 40)::VARCHAR || ',5 kg' ELSE 'n/a' END"""
REACH_TEXT = """CASE WHEN p_type IN ('ECONOMY', 'PROMO') THEN (p_size + 50)::VARCHAR || '"'
      WHEN p_type = 'SMALL' THEN (p_size + 50)::VARCHAR || '.5"'
      WHEN p_type = 'LARGE' THEN (p_size + 170)::VARCHAR || ' cm' ELSE NULL END"""


def num(t: str, pat: str) -> str:
    return f"TRY_CAST(replace(NULLIF(regexp_extract({t}, '{pat}', 1), ''), ',', '.') AS DOUBLE)"


NUM = "(\\d+(?:[.,]\\d+)?)"


def height_cm(t: str) -> str:
    tv = f"NULLIF({ustrip(t)}, '')"
    ft = f"NULLIF(regexp_extract({tv}, '(\\d+)\\s*''\\s*(\\d+)', 1), '')"
    inch = f"NULLIF(regexp_extract({tv}, '(\\d+)\\s*''\\s*(\\d+)', 2), '')"
    metric = num(f"lower({tv})", NUM + "\\s*cm")
    return (f"CAST(round_even(CASE WHEN {ft} IS NOT NULL THEN (CAST({ft} AS DOUBLE) * 12 + CAST({inch} AS DOUBLE))"
            f" * 2.54::DOUBLE ELSE {metric} END, 0) AS INTEGER)")


def weight_kg(t: str) -> str:
    low = f"lower(NULLIF({ustrip(t)}, ''))"
    lbs = num(low, NUM + "\\s*lbs?")
    kg = num(low, NUM + "\\s*kg")
    return f"CASE WHEN {lbs} IS NOT NULL THEN round({lbs} * 0.45359237::DOUBLE, 1) ELSE round({kg}, 1) END"


def reach_cm(t: str) -> str:
    tv = f"NULLIF({ustrip(t)}, '')"
    inch = num(tv, NUM + '\\s*"')
    metric = num(f"lower({tv})", NUM + "\\s*cm")
    return (f"CAST(round_even(CASE WHEN {inch} IS NOT NULL THEN {inch} * 2.54::DOUBLE ELSE {metric} END, 0)"
            f" AS INTEGER)")


STANCE_TEXT = """CASE c_mktsegment WHEN 'BUILDING' THEN 'Orthodox' WHEN 'MACHINERY' THEN ' SOUTHPAW' || chr(160)
      WHEN 'HOUSEHOLD' THEN 'switch' WHEN 'AUTOMOBILE' THEN 'Open' ELSE NULL END"""


def stance(t: str) -> str:
    v = f"lower(NULLIF({ustrip(t)}, ''))"
    return f"CASE {v} WHEN 'orthodox' THEN 'Destro' WHEN 'southpaw' THEN 'Canhoto' WHEN 'switch' THEN 'Ambidestro' END"


IMAGES = """CASE event_type WHEN 'purchase' THEN ['/i/perf.png', '/i/ko.png'] WHEN 'click' THEN ['/i/KO.PNG']
      WHEN 'view' THEN ['/i/belt.png'] WHEN 'signup' THEN ['/img/FIGHT.png', 'sub.png', 'belt.PNG']
      ELSE []::VARCHAR[] END"""


def has(m: str) -> str:
    return f"len(list_filter(imgs, lambda s: contains(lower(COALESCE(s, '')), '{m}'))) > 0"


def dim_part_sql(mode: str) -> str:
    cur = f"""cur AS (SELECT row_number() OVER (ORDER BY p_partkey) AS id, p_partkey AS part_key, p_name AS name,
                  p_brand AS url, TIMESTAMP '{C.OLD}' AS criado_em, TIMESTAMP '{C.OLD}' AS atualizado_em
             FROM part WHERE p_type <> 'PROMO')"""
    cand = """cand AS (SELECT p_partkey AS part_key,
               CASE WHEN p_size > 45 THEN upper(p_name) WHEN p_size < 5 THEN NULL
                    WHEN p_size BETWEEN 13 AND 15 THEN p_name || chr(160)
                    WHEN p_size BETWEEN 10 AND 12 THEN '  ' || p_name || ' ' ELSE p_name END AS n_name,
               CASE WHEN p_size BETWEEN 20 AND 22 THEN p_brand || '/x' WHEN p_size = 30 THEN ''
                    ELSE p_brand END AS n_url
             FROM part WHERE p_type <> 'SMALL')"""
    if mode == "changed":
        chg = ("((c.n_name IS NOT NULL AND c.n_name <> '' AND " + ustrip("COALESCE(k.name, '')") + " <> " + ustrip("c.n_name") + ") OR "
               "(c.n_url IS NOT NULL AND c.n_url <> '' AND COALESCE(k.url, '') <> c.n_url))")
        upd = f"(c.part_key IS NOT NULL AND {chg})"
        name = f"CASE WHEN {upd} THEN COALESCE(c.n_name, k.name) ELSE k.name END"
        url = f"CASE WHEN {upd} THEN COALESCE(c.n_url, k.url) ELSE k.url END"
    else:
        upd = "(c.part_key IS NOT NULL)"
        name = "CASE WHEN c.part_key IS NOT NULL THEN c.n_name ELSE k.name END"
        url = "CASE WHEN c.part_key IS NOT NULL THEN c.n_url ELSE k.url END"
    return f"""WITH {cur}, {cand}
SELECT k.id, k.part_key, {name} AS name, {url} AS url,
       strftime(k.criado_em, '%Y-%m-%d %H:%M:%S') AS criado_em,
       strftime(CASE WHEN {upd} THEN TIMESTAMP '{C.NOW}' ELSE k.atualizado_em END, '%Y-%m-%d %H:%M:%S') AS atualizado_em
FROM cur k LEFT JOIN cand c ON k.part_key = c.part_key
UNION ALL
SELECT (SELECT max(id) FROM cur) + row_number() OVER (ORDER BY c.part_key) AS id, c.part_key, c.n_name, c.n_url,
       '{C.NOW}', '{C.NOW}'
FROM cand c WHERE c.part_key NOT IN (SELECT part_key FROM cur)"""


def load_state(full: bool) -> str:
    stored = f"""
  s_ev AS (SELECT id_evento, status, data_evento, 'old' AS tag FROM ({STORED_ORDERS}) x),
  s_lu AS (SELECT CASE WHEN year(l_shipdate) = 1995 THEN NULL ELSE l_orderkey END AS id_evento,
                  CAST(l_linenumber AS BIGINT) AS item, 'old' AS tag FROM lineitem),
  s_hi AS (SELECT l_orderkey AS id_evento, l_partkey AS item, 'old' AS tag FROM lineitem),
  s_fi AS (SELECT c_custkey AS id_lutador, 'old' AS tag FROM customer)"""
    batch = f"""
  bo AS (SELECT * FROM ({STORED_ORDERS}) x WHERE o_orderpriority = '2-HIGH'),
  b_ev AS (SELECT id_evento, 'completed' AS status, data_evento, 'new' AS tag FROM bo),
  b_lu AS (SELECT l_orderkey AS id_evento, CAST(l_linenumber AS BIGINT) AS item, 'new' AS tag
           FROM lineitem WHERE l_orderkey IN (SELECT id_evento FROM bo)),
  b_hi AS (SELECT l_orderkey AS id_evento, l_partkey AS item, 'new' AS tag
           FROM lineitem WHERE l_orderkey IN (SELECT id_evento FROM bo)),
  b_fi AS (SELECT c_custkey AS id_lutador, 'new' AS tag FROM customer WHERE c_custkey IN (SELECT o_custkey FROM bo))"""
    flat = """
SELECT 'eventos' AS table_name, id_evento, CAST(NULL AS BIGINT) AS item, tag, status FROM f_ev
UNION ALL SELECT 'lutas', id_evento, item, tag, CAST(NULL AS VARCHAR) FROM f_lu
UNION ALL SELECT 'historico_lutas', id_evento, item, tag, CAST(NULL AS VARCHAR) FROM f_hi
UNION ALL SELECT 'lutadores', id_lutador, CAST(NULL AS BIGINT), tag, CAST(NULL AS VARCHAR) FROM f_fi"""
    if full:
        replaced = ", ".join(f"f_{t} AS (SELECT * REPLACE ('full' AS tag) FROM s_{t})" for t in ("ev", "lu", "hi", "fi"))
        return f"WITH {stored}, {replaced} {flat}"
    return f"""WITH {stored}, {batch},
  cur_ids AS (SELECT DISTINCT id_evento FROM b_ev WHERE id_evento IS NOT NULL),
  scope AS (SELECT DISTINCT id_evento FROM s_ev WHERE id_evento IS NOT NULL AND (COALESCE(status = 'upcoming', false)
      OR COALESCE(COALESCE(try_strptime(data_evento, '%d/%m/%Y'), try_strptime(data_evento, '%Y-%m-%d'))::DATE
                  >= DATE '{C.ANCHOR_ORDERS}' - INTERVAL {C.SCOPE_DAYS} DAY, false))),
  del AS (SELECT id_evento FROM cur_ids UNION SELECT id_evento FROM scope WHERE id_evento NOT IN (SELECT id_evento FROM cur_ids)),
  f_ev AS (SELECT * FROM s_ev WHERE id_evento IS NULL OR id_evento NOT IN (SELECT id_evento FROM del)
           UNION ALL SELECT * FROM b_ev),
  f_lu AS (SELECT * FROM s_lu WHERE id_evento IS NULL OR id_evento NOT IN (SELECT id_evento FROM del)
           UNION ALL SELECT * FROM b_lu),
  f_hi AS (SELECT * FROM s_hi WHERE id_evento IS NULL OR id_evento NOT IN (SELECT id_evento FROM del)
           UNION ALL SELECT * FROM b_hi),
  f_fi AS (SELECT * FROM s_fi WHERE id_lutador NOT IN (SELECT id_lutador FROM b_fi) UNION ALL SELECT * FROM b_fi)
{flat}"""


def unescape(x: str) -> str:
    """The character references present in the data, with the optional ';' of legacy HTML5 names.

    ``&amp`` goes last so that ``&amp;lt;`` decodes once, as the parser does.
    """
    for ent, ch in (("lt", "<"), ("gt", ">"), ("quot", '"'), ("#39", "''"), ("nbsp", "' || chr(160) || '"),
                    ("copy", "' || chr(169) || '"), ("middot", "' || chr(183) || '"), ("amp", "&")):
        x = f"regexp_replace({x}, '&{ent};?', '{ch}', 'g')"
    return x


# Flat list items of every <nav> (the regex form of the DOM rule; nested lists excluded).
NAV_ITEMS = """flatten(list_transform(regexp_extract_all(html, '(?s)<nav[^>]*>(.*?)</nav>', 1),
                                   lambda n: regexp_extract_all(n, '(?s)<li[^>]*>(.*?)</li>', 1)))"""

ORACLES: dict[str, str] = {
    "page_link_fact": f"""
WITH p AS (SELECT page_id, html, {url_id('url')} AS page_key FROM pages),
latest AS (SELECT * FROM p WHERE page_key IS NOT NULL
           QUALIFY row_number() OVER (PARTITION BY page_key ORDER BY page_id) = 1),
dim AS (SELECT page_key, row_number() OVER (ORDER BY page_key) AS page_sk FROM latest),
links AS (SELECT page_key, unnest(regexp_extract_all(html, '{LINK}', 1)) AS href,
                 unnest(regexp_extract_all(html, '{LINK}', 2)) AS link_text,
                 unnest(range(1, len(regexp_extract_all(html, '{LINK}', 1)) + 1)) AS link_pos FROM latest)
SELECT d.page_sk, l.page_key, l.link_pos, l.href, l.link_text, {short_id('l.page_key')} AS page_hash5
FROM links l LEFT JOIN dim d USING (page_key)""",

    "page_extract": f"""
SELECT page_id, {clean(f"regexp_extract(html, '{TITLE}', 1)")} AS title,
       {clean(f"regexp_extract(html, '{H1}', 1)")} AS h1,
       CAST(len(regexp_extract_all(html, '{LINK}', 1)) AS BIGINT) AS n_links,
       regexp_extract_all(html, '{LINK}', 1)[1] AS first_href
FROM pages""",

    "page_links": f"""
WITH l AS (SELECT page_id, unnest(regexp_extract_all(html, '{LINK}', 1)) AS href,
                  unnest(regexp_extract_all(html, '{LINK}', 2)) AS link_text,
                  unnest(range(1, len(regexp_extract_all(html, '{LINK}', 1)) + 1)) AS link_pos FROM pages)
SELECT page_id, link_pos, href, {clean('link_text')} AS link_text, regexp_extract(href, '([^/]*)/*$', 1) AS slug
FROM l""",

    "page_table_extract": f"""
WITH it AS (SELECT page_id, {NAV_ITEMS} AS items FROM pages),
u AS (SELECT page_id, unnest(items) AS li, generate_subscripts(items, 1) AS item_pos FROM it)
SELECT page_id, CAST(item_pos AS BIGINT) AS item_pos,
       {unescape("NULLIF(regexp_extract(li, '<a[^>]*href=\"([^\"]*)\"', 1), '')")} AS href,
       {clean(unescape("regexp_replace(li, '<[^>]*>', '', 'g')"))} AS item_text
FROM u""",

    "fight_page_extract": f"""
WITH a AS (SELECT page_id, regexp_extract_all(html, '(?s)<article[^>]*>(.*?)</article>', 1) AS arts FROM pages),
s AS (SELECT page_id, flatten(list_transform(arts, lambda x: string_split_regex(x, '<p(?:\\s[^>]*)?>')[2:])) AS segs
      FROM a),
u AS (SELECT page_id, unnest(segs) AS seg, generate_subscripts(segs, 1) AS para_pos FROM s),
t AS (SELECT page_id, para_pos,
             {clean(unescape("regexp_replace(regexp_extract(seg, '(?s)^(.*?)(?:</p>|$)', 1), '<[^>]*>', '', 'g')"))}
             AS para_text FROM u)
SELECT page_id, CAST(para_pos AS BIGINT) AS para_pos, para_text,
       CAST(COALESCE(len(string_split(para_text, ' ')), 0) AS BIGINT) AS n_words FROM t""",

    "profile_page_extract": f"""
SELECT page_id,
       {clean(unescape("regexp_replace(regexp_extract(html, '(?s)<title[^>]*>(.*?)</title>', 1), '<[^>]*>', '', 'g')"))} AS title,
       {clean(unescape("regexp_replace(regexp_extract(html, '(?s)<h1[^>]*>(.*?)</h1>', 1), '<[^>]*>', '', 'g')"))} AS h1,
       CAST(len(regexp_extract_all(html, '(?i)<p[\\s>/]', 0)) AS BIGINT) AS n_paragraphs,
       CAST(len(regexp_extract_all(html, '(?i)<a[\\s>/]', 0)) AS BIGINT) AS n_links,
       {clean(unescape("regexp_replace(regexp_extract(html, '(?s)<div class=\"ad\">(.*?)</div>', 1), '<[^>]*>', '', 'g')"))} AS ad_text,
       {clean(unescape("regexp_replace(regexp_extract(html, '(?s)<footer[^>]*>(.*?)</footer>', 1), '<[^>]*>', '', 'g')"))} AS footer,
       NULLIF(regexp_extract(html, '<html[^>]*\\slang="([^"]*)"', 1), '') AS lang
FROM pages""",

    "label_value_pivot": f"""
WITH it AS (SELECT c_custkey, ['Name: ' || c_name, 'SEGMENT :' || c_mktsegment,
                               'Nation:' || chr(160) || CAST(c_nationkey AS VARCHAR), 'no label here',
                               'Other: ' || CAST(c_custkey AS VARCHAR),
                               CASE WHEN c_acctbal < 0 THEN 'segment:: ' || lower(c_mktsegment) ELSE 'Unknown: 1' END
                              ] AS items FROM customer),
u AS (SELECT c_custkey, unnest(items) AS item, generate_subscripts(items, 1) AS pos FROM it),
p AS (SELECT c_custkey, pos, item, regexp_extract(item, '^([^:]*:+)', 1) AS lr FROM u),
v AS (SELECT c_custkey, pos, upper(regexp_replace({clean('lr')}, ':+$', '')) AS label,
             {clean("replace(item, lr, '')")} AS value FROM p)
SELECT c_custkey, arg_max_null(value, pos) FILTER (WHERE label = 'NAME') AS name,
       arg_max_null(value, pos) FILTER (WHERE label = 'SEGMENT') AS segment,
       arg_max_null(value, pos) FILTER (WHERE label = 'NATION') AS nation
FROM v GROUP BY c_custkey""",

    "latest_page": f"""
SELECT {PAGE_PATH} AS page_path, page_id, {clean(f"regexp_extract(html, '{TITLE}', 1)")} AS title FROM pages
QUALIFY row_number() OVER (PARTITION BY {PAGE_PATH} ORDER BY page_id DESC) = 1""",

    "page_join": f"""
SELECT page_id, {clean(f"regexp_extract(html, '{TITLE}', 1)")} AS title,
       {clean(f"regexp_extract(html, '{H1}', 1)")} AS h1,
       CAST(len(regexp_extract_all(html, '{LINK}', 1)) AS BIGINT) AS n_links,
       regexp_extract_all(html, '{LINK}', 1)[1] AS first_href
FROM pages WHERE page_id IN (SELECT user_id FROM events)""",

    "fetch_frontier": "SELECT CAST(page_id AS VARCHAR) AS page_key FROM pages WHERE contains(url, '?')",

    "bronze_cards": f"""
WITH it AS (SELECT page_id, url, {NAV_ITEMS} AS items FROM pages),
u AS (SELECT page_id, unnest(items) AS li, generate_subscripts(items, 1) AS item_pos FROM it),
idx AS (SELECT page_id, 'completed' AS event_status FROM pages
        UNION ALL SELECT page_id, 'upcoming' FROM pages WHERE contains(url, '?'))
SELECT CAST(page_id AS VARCHAR) AS event_id, event_status, CAST(item_pos AS BIGINT) AS item_pos,
       {unescape("NULLIF(regexp_extract(li, '<a[^>]*href=\"([^\"]*)\"', 1), '')")} AS href
FROM u JOIN idx USING (page_id)""",

    "fighter_candidates": """
WITH prof AS (SELECT CAST(c_custkey AS VARCHAR) AS id, CASE WHEN c_acctbal > 0 THEN c_name END AS n,
                     CASE WHEN c_mktsegment <> 'BUILDING' THEN 'http://p/' || CAST(c_custkey AS VARCHAR) END AS u
              FROM customer),
fight AS (SELECT CAST(o_custkey AS VARCHAR) AS id, CASE WHEN o_orderstatus = 'F' THEN 'F' || CAST(o_orderkey AS VARCHAR) END AS n,
                 'http://o/' || CAST(o_orderkey AS VARCHAR) AS u FROM orders
          QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY CAST(o_orderkey AS VARCHAR)) = 1)
SELECT COALESCE(prof.id, fight.id) AS fighter_id, COALESCE(prof.n, fight.n) AS nome_lutador,
       COALESCE(prof.u, fight.u) AS url_perfil
FROM prof FULL OUTER JOIN fight ON prof.id = fight.id""",

    "read_partition": f"""
SELECT event_id, ts, user_id, event_type, value, props, '{C.ONE_DAY}' AS dt_particao FROM events
WHERE strftime(ts, '%Y-%m-%d') = '{C.ONE_DAY}'""",

    "read_all_partitions": """
SELECT event_id, ts, user_id, event_type, value, props, strftime(ts, '%Y-%m-%d') AS dt_particao FROM events""",

    "partition_overwrite": f"""
SELECT event_id, ts, user_id, event_type,
       CASE WHEN strftime(ts, '%Y-%m-%d') = '{C.REWRITE_DAY}' THEN value * 2 ELSE value END AS value,
       props, strftime(ts, '%Y-%m-%d') AS dt_particao FROM events""",

    "schema_evolve": f"""
SELECT event_id, ts, user_id, event_type, value, props, strftime(ts, '%Y-%m-%d') AS dt_particao,
       CASE WHEN strftime(ts, '%Y-%m-%d') >= '{C.EVOLVE_FROM}' THEN upper(event_type) END AS channel FROM events""",

    "stage_counts": "\nUNION ALL ".join(
        f"SELECT '{t}' AS stage, CAST(count(*) AS BIGINT) AS n_rows FROM {t}" for t in C.ALL_TABLES) + f"""
UNION ALL SELECT 'pages_keyed', count(*) FROM pages WHERE {url_id('url')} IS NOT NULL
UNION ALL SELECT 'links', CAST(sum(len(regexp_extract_all(html, '{LINK}', 1))) AS BIGINT) FROM pages
  WHERE {url_id('url')} IS NOT NULL""",

    "lookback_filter": f"""
WITH e AS (SELECT event_id, {EVENT_STATUS} AS status,
                  CASE WHEN event_type = 'error' AND value < 50 THEN NULL ELSE CAST(ts AS DATE) END AS event_date
           FROM events)
SELECT * FROM e WHERE lower(COALESCE(status, '')) = 'upcoming'
   OR COALESCE(event_date >= DATE '{C.ANCHOR_EVENTS}' - INTERVAL {C.LOOKBACK_DAYS} DAY, false)""",

    "scope_keys": SCOPE,
    "stale_keys": f"SELECT id_evento FROM ({SCOPE}) s WHERE id_evento NOT IN ({BATCH_IDS})",

    "ordered_union_limit": f"""
SELECT * FROM (
  SELECT 0 AS src_rank, o_orderkey, CAST(o_orderdate AS DATE) AS event_date FROM orders WHERE o_orderstatus = 'F'
  UNION ALL
  SELECT 1, o_orderkey, CAST(o_orderdate AS DATE) FROM orders WHERE o_orderstatus = 'O')
ORDER BY src_rank, event_date DESC NULLS LAST, o_orderkey LIMIT {C.UNION_LIMIT}""",

    "latest_per_key": """
WITH e AS (SELECT event_id, event_type,
                  CASE WHEN event_type = 'signup' AND value < 30 THEN NULL ELSE user_id END AS user_key,
                  CASE WHEN event_type = 'error' THEN NULL ELSE ts END AS ts FROM events)
SELECT * FROM e QUALIFY row_number() OVER (PARTITION BY user_key ORDER BY ts DESC NULLS LAST, event_id) = 1""",

    "distinct_first": """
SELECT * FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey,
    l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) = 1""",

    "first_non_null": """
WITH c AS (
  SELECT c_nationkey AS nation, CASE WHEN c_acctbal < 0 THEN NULL ELSE c_name END AS name,
         CASE WHEN c_acctbal > 9000 THEN NULL ELSE c_acctbal END AS acctbal, 0 AS src_rank, c_custkey AS member_id
  FROM customer
  UNION ALL
  SELECT s_nationkey, s_name, s_acctbal, 1, s_suppkey FROM supplier)
SELECT nation, arg_min(name, [src_rank, member_id]) FILTER (WHERE name IS NOT NULL) AS name,
       arg_min(acctbal, [src_rank, member_id]) FILTER (WHERE acctbal IS NOT NULL) AS acctbal
FROM c GROUP BY nation""",

    "top_n_per_group": f"""
SELECT conv_id, turn, role FROM conversations
QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn) <= {C.TOP_TURNS}""",

    "position_in_group": """
SELECT conv_id, turn, unnest(string_split(text, chr(10))) AS line,
       unnest(range(1, len(string_split(text, chr(10))) + 1)) AS line_pos FROM conversations""",

    "surrogate_keys": """
WITH cur AS (SELECT c_name, row_number() OVER (ORDER BY c_name) AS sk
             FROM (SELECT DISTINCT c_name FROM customer WHERE c_mktsegment IN ('BUILDING', 'AUTOMOBILE'))),
new AS (SELECT c_name, (SELECT max(sk) FROM cur) + row_number() OVER (ORDER BY c_name) AS sk
        FROM (SELECT DISTINCT c_name FROM customer) WHERE c_name NOT IN (SELECT c_name FROM cur))
SELECT sk, c_name FROM cur UNION ALL SELECT sk, c_name FROM new""",

    "dim_insert_missing": """
WITH cur AS (SELECT c_name, row_number() OVER (ORDER BY c_name) AS sk
             FROM (SELECT DISTINCT c_name FROM customer WHERE c_mktsegment IN ('BUILDING', 'AUTOMOBILE')))
SELECT (SELECT max(sk) FROM cur) + row_number() OVER (ORDER BY c_name) AS sk, c_name
FROM (SELECT DISTINCT c_name FROM customer) WHERE c_name NOT IN (SELECT c_name FROM cur)""",

    "dim_upsert_changed": dim_part_sql("changed"),
    "dim_upsert_always": dim_part_sql("always"),

    "code_dimension": f"""
WITH codes AS (SELECT DISTINCT CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS codigo_bonus FROM orders
               UNION SELECT unnest([1, 2, 3, 4]))
SELECT codigo_bonus,
       CASE codigo_bonus WHEN 1 THEN 'Luta da Noite' WHEN 2 THEN 'Performance da Noite'
            WHEN 3 THEN 'Finalizacao da Noite' WHEN 4 THEN 'Nocaute da Noite'
            ELSE 'Bonus ' || CAST(codigo_bonus AS VARCHAR) END AS descricao_bonus,
       '{C.NOW}' AS criado_em, '{C.NOW}' AS atualizado_em
FROM codes WHERE codigo_bonus IS NOT NULL""",

    "attach_ids": """
WITH dc AS (SELECT c_custkey, c_nationkey, row_number() OVER (ORDER BY c_custkey) AS cust_sk FROM customer),
dn AS (SELECT n_nationkey, row_number() OVER (ORDER BY n_name) AS nation_sk FROM nation)
SELECT dc.cust_sk, dn.nation_sk, o.o_orderkey, o.o_custkey AS c_custkey, o.o_orderstatus, o.o_totalprice
FROM orders o LEFT JOIN dc ON o.o_custkey = dc.c_custkey LEFT JOIN dn ON dc.c_nationkey = dn.n_nationkey""",

    "nested_collect": f"""
SELECT l_orderkey AS o_orderkey, CAST(count(*) AS BIGINT) AS n_lines,
       string_agg(CAST(l_linenumber AS VARCHAR), ',' ORDER BY l_linenumber) AS line_keys,
       CAST(sum(l_quantity) AS BIGINT) AS qty_total
FROM ({LINE_DEDUP}) d GROUP BY l_orderkey""",

    "nested_fact": f"""
WITH d AS ({LINE_DEDUP}),
dim_o AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS id_luta, o_custkey AS id_evento
          FROM orders WHERE year(o_orderdate) <> 2001),
dim_c AS (SELECT c_custkey, row_number() OVER (ORDER BY c_custkey) AS cust_sk FROM customer),
o AS (SELECT o.*, CASE WHEN o_orderpriority LIKE '5%' THEN 'x' ELSE substr(o_orderpriority, 1, 1) END AS round_total,
             TRY_CAST(trim(CASE WHEN o_orderpriority LIKE '5%' THEN 'x' ELSE substr(o_orderpriority, 1, 1) END)
                      AS INTEGER) AS n
      FROM orders o),
m1_lines AS (SELECT o.o_orderkey, 'cust-' || CAST(o.o_custkey AS VARCHAR) AS nome, o.o_custkey AS mk,
                    o.o_orderstatus AS resultado, CAST(d.l_linenumber AS BIGINT) AS round_num,
                    d.l_quantity AS qty, d.l_extendedprice AS price
             FROM o JOIN d ON d.l_orderkey = o.o_orderkey),
m1_fb AS (SELECT o.o_orderkey, 'cust-' || CAST(o.o_custkey AS VARCHAR) AS nome, o.o_custkey AS mk,
                 o.o_orderstatus AS resultado,
                 unnest(CASE WHEN n > 0 THEN range(1, n + 1) ELSE [NULL::BIGINT] END) AS round_num,
                 NULL::DOUBLE AS qty, NULL::DOUBLE AS price
          FROM o WHERE o.o_orderkey NOT IN (SELECT l_orderkey FROM d)),
m2 AS (SELECT o.o_orderkey, 'clerk-' || o.o_orderpriority AS nome, NULL::BIGINT AS mk, NULL::VARCHAR AS resultado,
              unnest(CASE WHEN n > 0 THEN range(1, n + 1) ELSE [NULL::BIGINT] END) AS round_num,
              NULL::DOUBLE AS qty, NULL::DOUBLE AS price FROM o),
m AS (SELECT * FROM m1_lines UNION ALL SELECT * FROM m1_fb UNION ALL SELECT * FROM m2)
SELECT dim_c.cust_sk, dim_o.id_luta, dim_o.id_evento, m.nome, m.resultado, o.o_orderpriority,
       o.round_total AS round_final, m.round_num, m.qty, m.price
FROM m JOIN dim_o ON dim_o.o_orderkey = m.o_orderkey JOIN o ON o.o_orderkey = m.o_orderkey
LEFT JOIN dim_c ON dim_c.c_custkey = m.mk""",

    "sequence_fallback": """
SELECT l_orderkey, l_linenumber, l_partkey,
       unnest(CASE WHEN l_linenumber - 1 > 0 THEN range(1, l_linenumber) ELSE [NULL::BIGINT] END) AS round_num
FROM lineitem""",

    "map_lookup": """
SELECT l_orderkey, l_linenumber, l_returnflag,
       CASE l_returnflag WHEN 'R' THEN l_quantity WHEN 'A' THEN l_tax ELSE NULL END AS looked_up FROM lineitem""",

    "natural_sort": """
WITH r AS (SELECT row_number() OVER () AS rid, l_orderkey, l_linenumber, l_returnflag FROM lineitem),
k AS (SELECT rid, l_orderkey, l_linenumber,
             unnest([CAST(l_linenumber AS VARCHAR), CAST(l_linenumber * 5 AS VARCHAR), 'x' || l_returnflag,
                     CAST(l_linenumber + 7 AS VARCHAR)]) AS round_key FROM r)
SELECT l_orderkey, l_linenumber,
       row_number() OVER (PARTITION BY rid ORDER BY CASE WHEN regexp_full_match(round_key, '[0-9]+') THEN 0 ELSE 1 END,
                          TRY_CAST(round_key AS INTEGER), round_key) AS key_pos,
       round_key,
       CASE WHEN regexp_full_match(round_key, '[0-9]+') THEN CAST(round_key AS BIGINT) END AS round_num
FROM k""",

    "parse_json_array": f"""
WITH t AS (SELECT event_id, {ustrip(JSON_TEXT)} AS js FROM events),
items AS (SELECT event_id, unnest(json_extract(js, '$[*]')) AS item FROM t
          WHERE json_valid(js) AND json_type(js) = 'ARRAY'),
objs AS (SELECT event_id, count(*) AS n, sum(CAST(json_extract(item, '$.k') AS INTEGER)) AS s FROM items
         WHERE json_type(item) = 'OBJECT' GROUP BY event_id)
SELECT e.event_id, CAST(COALESCE(objs.n, 0) AS BIGINT) AS n_objects, CAST(COALESCE(objs.s, 0) AS BIGINT) AS sum_k
FROM events e LEFT JOIN objs USING (event_id)""",

    "to_json_text": """
SELECT event_id, CAST(CAST(json_extract(props, '$.k') AS INTEGER) AS BIGINT) AS k,
       CASE WHEN value > 100 THEN NULL ELSE event_type END AS tag, true AS has_tag_key FROM events""",

    "hash_keys": f"""
WITH p AS (SELECT page_id, CASE WHEN contains(url, '?') THEN ' ' || url || chr(160) ELSE url END AS url FROM pages)
SELECT page_id, {url_id('url')} AS url_id, {short_id(url_id('url'))} AS url_hash5, sha1(url) AS raw_sha1,
       {hash5('CAST(page_id AS VARCHAR)')} AS page_hash5 FROM p""",

    "composite_key": f"""
WITH l AS (SELECT l_orderkey, l_linenumber, l_partkey,
                  sha1(concat_ws('|', CAST(l_orderkey AS VARCHAR),
                       COALESCE(CAST(CASE WHEN l_returnflag = 'R' THEN NULL ELSE l_partkey END AS VARCHAR), ''),
                       CAST(l_suppkey AS VARCHAR), CAST(l_linenumber AS VARCHAR))) AS fid FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, fid, {short_id('fid')} AS fid_hash5 FROM l""",

    "url_slug": """
SELECT page_id, regexp_extract(url, '([^/]*)/*$', 1) AS slug,
       regexp_extract(regexp_replace(url, '\\?.*$', '') || '//', '([^/]*)/*$', 1) AS path_slug FROM pages""",

    "clean_text": f"""
SELECT doc_id, {clean('text')} AS clean_text, CAST(length({clean('text')}) AS BIGINT) AS n_clean,
       NULLIF({ustrip('lang')}, '') AS lang FROM documents""",

    "prefix_strip": f"""
WITH d AS (SELECT doc_id, {clean("(CASE lang WHEN 'en' THEN 'Record: ' WHEN 'de' THEN 'RECORD:' ELSE '' END || text)")}
                  AS c FROM documents)
SELECT doc_id, CASE WHEN starts_with(lower(c), 'record:') THEN {ustrip('substr(c, 8)')} END AS record FROM d""",

    "parse_date_long": f"""
WITH t AS (SELECT o_orderkey, {DATE_TEXT} AS txt FROM orders)
SELECT o_orderkey, txt,
       strftime(CASE WHEN txt IS NOT NULL AND txt <> '' THEN try_strptime({ustrip('txt')}, '%B %d, %Y') END,
                '%Y-%m-%d') AS iso FROM t""",

    "parse_date_multi": f"""
WITH t AS (SELECT o_orderkey, {DATE_TEXT} AS txt FROM orders),
v AS (SELECT o_orderkey, txt, NULLIF({ustrip('txt')}, '') AS tv FROM t)
SELECT o_orderkey, txt, strftime({multi_date('tv')}, '%d/%m/%Y') AS ddmmyyyy FROM v""",

    "unit_height": f"SELECT p_partkey, {HEIGHT_TEXT} AS txt, {height_cm(HEIGHT_TEXT)} AS cm FROM part",
    "unit_weight": f"SELECT p_partkey, {WEIGHT_TEXT} AS txt, {weight_kg(WEIGHT_TEXT)} AS kg FROM part",
    "unit_reach": f"SELECT p_partkey, {REACH_TEXT} AS txt, {reach_cm(REACH_TEXT)} AS cm FROM part",

    "vocab_map": f"SELECT c_custkey, {STANCE_TEXT} AS txt, {stance(STANCE_TEXT)} AS stance FROM customer",

    "flag_from_text": """
WITH e AS (SELECT event_id, CASE event_type WHEN 'purchase' THEN 'Title Bout' WHEN 'view' THEN 'title bout'
                  WHEN 'click' THEN NULL ELSE 'normal' END AS bout FROM events)
SELECT event_id, bout, CAST(lower(COALESCE(bout, '')) = 'title bout' AS INTEGER) AS luta_titulo FROM e""",

    "priority_case": f"""
WITH e AS (SELECT event_id, {IMAGES} AS imgs FROM events)
SELECT event_id,
       CASE WHEN {has('fight.png')} THEN 1 WHEN {has('perf.png')} THEN 2 WHEN {has('sub.png')} THEN 3
            WHEN {has('ko.png')} THEN 4 END AS bonus_code,
       CASE WHEN {has('belt.png')} THEN 'title bout' ELSE 'normal' END AS bout FROM e""",

    "default_value": f"""
WITH e AS (SELECT event_id, CASE WHEN event_type = 'signup' THEN NULL WHEN event_type = 'error' THEN ''
                                 ELSE event_type END AS st,
                  CASE WHEN event_type = 'view' THEN NULL ELSE CAST(event_id AS VARCHAR) END AS sid,
                  'http://x/e/' || CAST(user_id AS VARCHAR) AS url FROM events)
SELECT event_id, COALESCE(NULLIF(st, ''), 'completed') AS status,
       COALESCE(NULLIF(sid, ''), {url_id('url')}) AS entity_key FROM e""",

    "prepare_flat": f"""
SELECT user_id AS event_id, 'http://x/u/' || CAST(user_id AS VARCHAR) AS event_url, event_type AS nome,
       strftime(ts, '%Y-%m-%d') AS data_evento, event_type AS local, 'completed' AS status,
       strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS ingerido_em, '{C.ONE_DAY}' AS dt_particao
FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS LAST, event_id) = 1""",

    "prepare_optional_col": f"""
SELECT CAST(o_custkey AS VARCHAR) AS fight_id, CAST(o_orderkey AS VARCHAR) AS event_id, NULL::VARCHAR AS fight_url,
       o_orderpriority AS nome_evento, NULL::VARCHAR AS status_evento, CAST(o_orderkey AS VARCHAR) AS ordem_luta,
       NULL::INTEGER AS codigo_bonus, 'normal' AS tipo_luta, o_orderstatus AS metodo, '3' AS round,
       NULL::VARCHAR AS tempo, NULL::VARCHAR AS formato_tempo, NULL::VARCHAR AS arbitro,
       strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') AS ingerido_em, '{C.ONE_DAY}' AS dt_particao
FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC NULLS LAST, o_orderkey) = 1""",

    "prepare_nested": f"""
WITH b AS (
  SELECT CAST(c_custkey AS VARCHAR) AS fighter_id, c_name AS nome, CAST(c_nationkey AS VARCHAR) || '-1-0' AS cartel,
         CASE WHEN c_mktsegment = 'FURNITURE' THEN '--'
              ELSE CAST(floor((c_nationkey + 60) / 12) AS BIGINT)::VARCHAR || ''' ' || ((c_nationkey + 60) % 12)::VARCHAR
                   || '"' END AS h,
         (c_nationkey * 4 + 115)::VARCHAR || ' lbs.' AS w, (c_nationkey + 60)::VARCHAR || '"' AS r,
         {STANCE_TEXT} AS s,
         CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN '--'
              ELSE strftime(DATE '1980-01-01' + CAST(c_custkey AS INTEGER), '%b %-d, %Y') END AS dob
  FROM customer)
SELECT fighter_id, nome, cartel, {height_cm('h')} AS altura, {weight_kg('w')} AS peso, {reach_cm('r')} AS alcance,
       {stance('s')} AS stance, strftime({multi_date(f"NULLIF({ustrip('dob')}, '')")}, '%d/%m/%Y') AS data_nascimento
FROM b""",

    "output_contract": """
SELECT TRY_CAST(CASE WHEN o_orderstatus = 'P' THEN 'x' ELSE CAST(o_orderkey + 3000000000 AS VARCHAR) END AS BIGINT) AS id_evento,
       o_orderpriority AS nome, strftime(o_orderdate, '%Y-%m-%d') AS data_evento,
       CAST(o_orderstatus = 'F' AS INTEGER) AS luta_titulo, strftime(o_orderdate, '%d/%m/%Y') AS ingerido_em,
       strftime(o_orderdate, '%d/%m/%Y') AS dt_particao, NULL::VARCHAR AS arbitro FROM orders""",

    "key_not_null": """
SELECT k, l_linenumber, l_partkey FROM (
  SELECT CASE WHEN l_returnflag = 'N' AND l_linestatus = 'O' THEN NULL ELSE l_orderkey END AS k, l_linenumber, l_partkey
  FROM lineitem) WHERE k IS NOT NULL""",

    "dq_violations": """
SELECT 'unique' AS rule, 'l_orderkey,l_linenumber' AS column_name,
       CAST(l_orderkey AS VARCHAR) || '|' || CAST(l_linenumber AS VARCHAR) AS key_value, CAST(count(*) AS VARCHAR) AS detail
FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
UNION ALL
SELECT 'not_null', 'c_name', CAST(c_custkey AS VARCHAR), NULL FROM customer WHERE c_acctbal < 0
UNION ALL
SELECT 'max_len', 'c_mktsegment', CAST(c_custkey AS VARCHAR), CAST(length(c_mktsegment) AS VARCHAR)
FROM customer WHERE length(c_mktsegment) > 9""",

    "full_load": load_state(full=True),
    "incremental_merge": load_state(full=False),

    "latest_run": f"""
WITH r AS (SELECT CAST(event_id AS VARCHAR) AS run_id, strftime(ts, '%Y-%m-%d') AS dt,
                  CASE WHEN value > 100 THEN 'initial' ELSE 'incremental' END AS tipo_carga,
                  CASE WHEN event_type = 'purchase' THEN 'concluido' ELSE event_type END AS status,
                  ts AS iniciado_em FROM events)
(SELECT NULL::VARCHAR AS for_dt, run_id, tipo_carga, iniciado_em FROM r WHERE status = 'concluido'
 ORDER BY iniciado_em DESC, run_id DESC LIMIT 1)
UNION ALL
(SELECT '{C.ONE_DAY}', run_id, tipo_carga, iniciado_em FROM r WHERE status = 'concluido' AND dt = '{C.ONE_DAY}'
 ORDER BY iniciado_em DESC, run_id DESC LIMIT 1)""",
}

from strata.plans import job_oracles  # noqa: E402

ORACLES.update(job_oracles.ORACLES)
