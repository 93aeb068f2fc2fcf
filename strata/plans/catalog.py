"""Registered queries: each operator of the engine run over the driver tables.

Every function takes ``(spark, sf_dir)`` and returns a DataFrame over whole
tables (no id subsets, no row caps; a ``limit`` appears only where the limit
is the operator). Operators that write intermediate tables (numbering, loads,
landed partitions) run those jobs when the query is built; the rest is lazy. Null and malformed cases that the tables do not
contain are derived from existing columns with ``CASE``-style expressions,
identically in the SQL oracle (``strata.plans.oracles``).
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (DoubleType, LongType, StringType, StructField, StructType,
                               TimestampNTZType)

from strata.functions import codes, dates, keys, nested, text, units
from strata.operators import dedupe, dims, extract, facts, loads, page_rules, quality
from strata.operators import keys as sk
from strata.session import apply_runtime_conf, workspace_path
from strata.sources import ledger, partitions, tables

# Fixed parameters of the registered queries (shared with the oracles).
ANCHOR_EVENTS = "2024-01-31"
ANCHOR_ORDERS = "2001-08-01"
LOOKBACK_DAYS = 7
SCOPE_DAYS = 30
NOW = "2024-01-31 00:00:00"
OLD = "2024-01-01 00:00:00"
ONE_DAY = "2024-01-15"
REWRITE_DAY = "2024-01-10"
EVOLVE_FROM = "2024-01-15"
UNION_LIMIT = 50
TOP_TURNS = 2


def tbl(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf, f"{name}.parquet"))


# --------------------------------------------------------------------------
# pages: keys, links, extraction
# --------------------------------------------------------------------------

def q_page_link_fact(spark, sf):
    """Flagship slice: pages -> keys -> latest per key -> surrogate ids -> link fact."""
    pages = tbl(spark, sf, "pages").select("page_id", "url", "html")
    keyed = pages.withColumn("page_key", keys.id_from_url("url")).where(F.col("page_key").isNotNull())
    # links are extracted before the dedupe, so the shuffle moves link lists, not whole pages;
    # ids are numbered from the key column alone
    latest = dedupe.first_per_key(keyed.select("page_id", "page_key", extract.link_array("html").alias("links")),
                                  "page_key", ["page_id"])
    dim = sk.assign_new_ids(keyed.select("page_key").distinct(), None, "page_key", "page_sk")
    links = extract.explode_links(latest, "links", keep=("page_key",))
    fact = facts.attach_ids(links, [(dim, "page_key", ["page_sk"])])
    return fact.withColumn("page_hash5", keys.short_id("page_key"))


def q_page_extract(spark, sf):
    return extract.page_summary(tbl(spark, sf, "pages"))


def q_page_links(spark, sf):
    links = extract.page_links(tbl(spark, sf, "pages"))
    return links.withColumn("link_text", text.clean("link_text")).withColumn("slug", keys.url_slug("href"))


def q_page_table_extract(spark, sf):
    return page_rules.extract_list_items(tbl(spark, sf, "pages"), container="nav")


def q_fight_page_extract(spark, sf):
    return page_rules.extract_paragraphs(tbl(spark, sf, "pages"), container="article")


def q_profile_page_extract(spark, sf):
    return page_rules.extract_page_document(tbl(spark, sf, "pages"))


def _label_items(customer: DataFrame) -> DataFrame:
    return customer.select(
        "c_custkey",
        F.array(
            F.concat(F.lit("Name: "), F.col("c_name")),
            F.concat(F.lit("SEGMENT :"), F.col("c_mktsegment")),
            F.concat(F.lit("Nation:\u00a0"), F.col("c_nationkey").cast("string")),
            F.lit("no label here"),
            F.concat(F.lit("Other: "), F.col("c_custkey").cast("string")),
            F.when(F.col("c_acctbal") < 0, F.concat(F.lit("segment:: "), F.lower("c_mktsegment")))
             .otherwise(F.lit("Unknown: 1")),
        ).alias("items"))


def q_label_value_pivot(spark, sf):
    """``Label: value`` items -> columns, last occurrence wins, unknown labels ignored."""
    from strata.operators.pivot import pivot_label_items
    items = _label_items(tbl(spark, sf, "customer"))
    return pivot_label_items(items, "items", {"NAME": "name", "SEGMENT": "segment", "NATION": "nation"},
                             keep=["c_custkey"])


def _landed(spark, sf) -> DataFrame:
    """Pages as landed versions of a canonical path (later page_id = later landing)."""
    pages = tbl(spark, sf, "pages")
    return pages.select("page_id", "html",
                        F.regexp_extract("url", "^[a-z]+://[^/]+(/[^?#]*)", 1).alias("page_path"))


def q_latest_page(spark, sf):
    # extract before the dedupe so only small columns cross the shuffle, not whole pages
    landed = _landed(spark, sf).select("page_path", "page_id",
                                       extract.first_match("html", extract.TITLE_RE).alias("title"))
    return dedupe.first_per_key(landed, "page_path", [F.col("page_id").desc()])


def _index_users(spark, sf) -> DataFrame:
    return tbl(spark, sf, "events").select(F.col("user_id").alias("page_id")).distinct()


def q_page_join(spark, sf):
    idx = _index_users(spark, sf)
    landed = tbl(spark, sf, "pages").join(idx, "page_id", "left_semi")
    return extract.page_summary(landed)


def q_fetch_frontier(spark, sf):
    """All pages are wanted; those with a query string in their address have not landed."""
    from strata.plans import bronze
    pages = tbl(spark, sf, "pages").select(F.col("page_id").cast("string").alias("page_key"), "url")
    landed = pages.where(~F.col("url").contains("?")).select("page_key", F.lit("fight").alias("kind"), F.lit(ONE_DAY).alias("dt"))
    return bronze.fetch_frontier(pages, landed, "fight", "page_key", dt=ONE_DAY)


def q_bronze_cards(spark, sf):
    """Every page is an event of the completed list, those with a query string also of the upcoming one; cards are list items."""
    from strata.plans import bronze
    pages = tbl(spark, sf, "pages")
    listed = pages.select(F.col("page_id").cast("string").alias("event_id"), "url")
    index = listed.select("event_id", F.when(F.col("url").startswith("https"), "completed").alias("status")).unionByName(
        listed.where(F.col("url").contains("?")).select("event_id", F.lit("upcoming").alias("status")))
    items = page_rules.extract_list_items(pages).withColumn("event_id", F.col("page_id").cast("string")).drop("page_id")
    return bronze.card_rows(index, items).select("event_id", "event_status", "item_pos", "href")


def q_fighter_candidates(spark, sf):
    """Customers as profiles, the people of orders as those named in fights."""
    from strata.plans import silver
    c = tbl(spark, sf, "customer")
    profiles = c.select(F.col("c_custkey").cast("string").alias("fighter_id"),
                        F.when(F.col("c_acctbal") > 0, F.col("c_name")).alias("nome"),
                        F.when(F.col("c_mktsegment") != "BUILDING", F.concat(F.lit("http://p/"), F.col("c_custkey").cast("string")))
                        .alias("url_perfil"))
    o = tbl(spark, sf, "orders")
    who = F.col("o_custkey").cast("string")
    person = lambda name, url: F.struct(who.alias("fighter_id"), name.alias("name"), url.alias("profile_url"))
    fights = o.select(F.col("o_orderkey").cast("string").alias("fight_id"), F.array(
        person(F.when(F.col("o_orderstatus") == "F", F.concat(F.lit("F"), F.col("o_orderkey").cast("string"))),
               F.concat(F.lit("http://o/"), F.col("o_orderkey").cast("string"))),
        person(F.lit("second"), F.lit("http://second")),
        F.struct(F.lit("").alias("fighter_id"), F.lit("nobody").alias("name"), F.lit(None).cast("string").alias("profile_url")),
    ).alias("fighters"))
    return silver.fighter_candidates(profiles, fights)


# --------------------------------------------------------------------------
# dated JSONL partitions (written to the shared scratch folder, read back)
# --------------------------------------------------------------------------

EVENT_SCHEMA = StructType([
    StructField("event_id", LongType()), StructField("ts", TimestampNTZType()),
    StructField("user_id", LongType()), StructField("event_type", StringType()),
    StructField("value", DoubleType()), StructField("props", StringType()),
])


def _land_events(spark, sf, name: str) -> str:
    apply_runtime_conf(spark)
    base = workspace_path(spark, name)
    ev = tbl(spark, sf, "events").withColumn("dt", F.date_format("ts", "yyyy-MM-dd"))
    partitions.write_partitions(ev, base)
    return base


def q_read_partition(spark, sf):
    base = _land_events(spark, sf, "events-jsonl")
    return partitions.read_partition(spark, base, ONE_DAY, EVENT_SCHEMA)


def q_read_all_partitions(spark, sf):
    base = _land_events(spark, sf, "events-jsonl")
    return partitions.read_all_partitions(spark, base, EVENT_SCHEMA)


def q_partition_overwrite(spark, sf):
    base = _land_events(spark, sf, "events-jsonl")
    day = partitions.read_partition(spark, base, REWRITE_DAY, EVENT_SCHEMA).drop("dt_particao")
    rewritten = day.withColumn("value", F.col("value") * 2).withColumn("dt", F.lit(REWRITE_DAY))
    staged = workspace_path(spark, "rewrite-stage")
    rewritten.write.parquet(staged)  # materialise before overwriting the partition it came from
    partitions.write_partitions(spark.read.parquet(staged), base)
    return partitions.read_all_partitions(spark, base, EVENT_SCHEMA)


def q_schema_evolve(spark, sf):
    apply_runtime_conf(spark)
    base = workspace_path(spark, "events-evolve")
    ev = tbl(spark, sf, "events").withColumn("dt", F.date_format("ts", "yyyy-MM-dd"))
    partitions.write_partitions(ev.where(F.col("dt") < EVOLVE_FROM), base)
    partitions.write_partitions(ev.where(F.col("dt") >= EVOLVE_FROM)
                                .withColumn("channel", F.upper("event_type")), base)
    old = partitions.read_all_partitions(spark, base, EVENT_SCHEMA).where(F.col("dt_particao") < EVOLVE_FROM)
    new_schema = StructType([*EVENT_SCHEMA.fields, StructField("channel", StringType())])
    new = partitions.read_all_partitions(spark, base, new_schema).where(F.col("dt_particao") >= EVOLVE_FROM)
    return tables.evolve_union(old, new)


# The driver's tables.
ALL_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
              "pages", "benchmark", "labels", "conversations")


def q_stage_counts(spark, sf):
    """Row counts per stage, observed during the writes themselves, from the audit table they are appended to."""
    pages = tbl(spark, sf, "pages")
    keyed = pages.withColumn("page_key", keys.id_from_url("url")).where(F.col("page_key").isNotNull())
    stages = {name: tbl(spark, sf, name) for name in ALL_TABLES}
    stages = {name: df.select(df.columns[0]) for name, df in stages.items()}
    stages["pages_keyed"] = keyed.select("page_key", "url")
    stages["links"] = extract.page_links(keyed, keep=("page_key",))
    counts = {name: tables.observed_write(df, name, workspace_path(spark, f"stage-{name}"))["rows"] for name, df in stages.items()}
    audit = workspace_path(spark, "audit")
    ledger.record_audit(spark, audit, "run", ONE_DAY, counts)
    return spark.read.schema(ledger.AUDIT_SCHEMA).parquet(audit).select("stage", "n_rows")


# --------------------------------------------------------------------------
# filters, scope, ordering
# --------------------------------------------------------------------------

def _event_status(c: Column) -> Column:
    return (F.when(c == "signup", "upcoming").when(c == "purchase", "completed")
            .when(c == "view", "Completed").when(c == "click", F.lit(None)).otherwise("other"))


def q_lookback_filter(spark, sf):
    ev = tbl(spark, sf, "events").select(
        "event_id", _event_status(F.col("event_type")).alias("status"),
        F.when((F.col("event_type") == "error") & (F.col("value") < 50), F.lit(None).cast("date"))
         .otherwise(F.to_date("ts")).alias("event_date"))
    return loads.lookback_filter(ev, "status", "event_date", ANCHOR_EVENTS, LOOKBACK_DAYS)


def _stored_orders(spark, sf) -> DataFrame:
    o = tbl(spark, sf, "orders")
    return o.select(
        F.col("o_orderkey").alias("id_evento"),
        F.when(F.col("o_orderstatus") == "O", "upcoming").otherwise("completed").alias("status"),
        F.when(F.col("o_orderpriority").isin("1-URGENT", "3-MEDIUM"), F.date_format("o_orderdate", "dd/MM/yyyy"))
         .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("data_evento"),
        "o_orderpriority", "o_custkey", "o_orderstatus")


def _batch_ids(stored: DataFrame) -> DataFrame:
    return loads.distinct_ids(stored.where(F.col("o_orderpriority") == "2-HIGH"), "id_evento")


def q_scope_keys(spark, sf):
    stored = _stored_orders(spark, sf)
    return loads.scope_ids(stored, "id_evento", "status", "data_evento", ANCHOR_ORDERS, SCOPE_DAYS)


def q_stale_keys(spark, sf):
    stored = _stored_orders(spark, sf)
    scope = loads.scope_ids(stored, "id_evento", "status", "data_evento", ANCHOR_ORDERS, SCOPE_DAYS)
    return loads.stale_ids(scope, _batch_ids(stored), "id_evento")


def q_ordered_union_limit(spark, sf):
    o = tbl(spark, sf, "orders")
    listing = lambda st, rank: o.where(F.col("o_orderstatus") == st).select(
        F.lit(rank).alias("src_rank"), "o_orderkey", F.to_date("o_orderdate").alias("event_date"))
    both = listing("F", 0).unionByName(listing("O", 1))
    return both.orderBy("src_rank", F.col("event_date").desc_nulls_last(), "o_orderkey").limit(UNION_LIMIT)


def q_latest_per_key(spark, sf):
    ev = tbl(spark, sf, "events").select(
        "event_id", "event_type",
        F.when((F.col("event_type") == "signup") & (F.col("value") < 30), F.lit(None).cast("bigint"))
         .otherwise(F.col("user_id")).alias("user_key"),
        F.when(F.col("event_type") == "error", F.lit(None).cast("timestamp_ntz")).otherwise(F.col("ts")).alias("ts"))
    return dedupe.latest_per_key(ev, "user_key", "ts", ["event_id"])


LINE_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount",
              "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]


def q_distinct_first(spark, sf):
    return dedupe.first_per_key(tbl(spark, sf, "lineitem"), "l_orderkey", LINE_ORDER)


def q_first_non_null(spark, sf):
    c = tbl(spark, sf, "customer").select(
        F.col("c_nationkey").alias("nation"),
        F.when(F.col("c_acctbal") < 0, F.lit(None)).otherwise(F.col("c_name")).alias("name"),
        F.when(F.col("c_acctbal") > 9000, F.lit(None)).otherwise(F.col("c_acctbal")).alias("acctbal"),
        F.lit(0).alias("src_rank"), F.col("c_custkey").alias("member_id"))
    s = tbl(spark, sf, "supplier").select(
        F.col("s_nationkey").alias("nation"), F.col("s_name").alias("name"),
        F.col("s_acctbal").alias("acctbal"), F.lit(1).alias("src_rank"), F.col("s_suppkey").alias("member_id"))
    return dedupe.first_non_null(c.unionByName(s), "nation", ["name", "acctbal"], ["src_rank", "member_id"])


def q_top_n_per_group(spark, sf):
    conv = tbl(spark, sf, "conversations").select("conv_id", "turn", "role")
    return dedupe.top_n_per_key(conv, "conv_id", ["turn"], TOP_TURNS)


def q_position_in_group(spark, sf):
    conv = tbl(spark, sf, "conversations").select("conv_id", "turn", F.split("text", "\n").alias("lines"))
    out = dedupe.explode_with_position(conv, "lines", "line_pos", "line", keep=["conv_id", "turn"])
    return out.withColumn("line_pos", F.col("line_pos").cast("bigint"))


# --------------------------------------------------------------------------
# dimensions and ids
# --------------------------------------------------------------------------

CURRENT_SEGMENTS = ["BUILDING", "AUTOMOBILE"]


def _customer_dims(spark, sf):
    cust = tbl(spark, sf, "customer").select("c_name", "c_mktsegment")
    current = sk.number_rows(cust.where(F.col("c_mktsegment").isin(CURRENT_SEGMENTS)).select("c_name").distinct(),
                             ["c_name"], "sk")
    candidates = cust.select("c_name").distinct()
    return current, candidates


def q_dim_insert_missing(spark, sf):
    current, candidates = _customer_dims(spark, sf)
    return sk.assign_new_ids(candidates, current, "c_name", "sk")


def q_surrogate_keys(spark, sf):
    current, candidates = _customer_dims(spark, sf)
    new = sk.assign_new_ids(candidates, current, "c_name", "sk")
    return current.select("sk", "c_name").unionByName(new.select("sk", "c_name"))


def _part_dims(spark, sf):
    p = tbl(spark, sf, "part")
    cur = p.where(F.col("p_type") != "PROMO").select(F.col("p_partkey").alias("part_key"),
                                                      F.col("p_name").alias("name"),
                                                      F.col("p_brand").alias("url"))
    current = (sk.number_rows(cur, ["part_key"], "id")
               .withColumn("criado_em", F.lit(OLD).cast("timestamp"))
               .withColumn("atualizado_em", F.lit(OLD).cast("timestamp")))
    size = F.col("p_size")
    cand = p.where(F.col("p_type") != "SMALL").select(
        F.col("p_partkey").alias("part_key"),
        F.when(size > 45, F.upper("p_name")).when(size < 5, F.lit(None))
          .when(size.between(13, 15), F.concat(F.col("p_name"), F.lit("\u00a0")))
         .when(size.between(10, 12), F.concat(F.lit("  "), F.col("p_name"), F.lit(" ")))
         .otherwise(F.col("p_name")).alias("name"),
        F.when(size.between(20, 22), F.concat(F.col("p_brand"), F.lit("/x"))).when(size == 30, F.lit(""))
         .otherwise(F.col("p_brand")).alias("url"))
    return current, cand


def _ts_out(df: DataFrame) -> DataFrame:
    return (df.withColumn("criado_em", F.date_format("criado_em", "yyyy-MM-dd HH:mm:ss"))
              .withColumn("atualizado_em", F.date_format("atualizado_em", "yyyy-MM-dd HH:mm:ss")))


def q_dim_upsert_changed(spark, sf):
    apply_runtime_conf(spark)
    current, cand = _part_dims(spark, sf)
    out = dims.upsert_dimension(current, cand, "part_key", "id", ["name", "url"], "changed", NOW,
                                trim_compare={"name": True, "url": False})
    return _ts_out(out)


def q_dim_upsert_always(spark, sf):
    apply_runtime_conf(spark)
    current, cand = _part_dims(spark, sf)
    out = dims.upsert_dimension(current, cand, "part_key", "id", ["name", "url"], "always", NOW)
    return _ts_out(out)


def q_code_dimension(spark, sf):
    apply_runtime_conf(spark)
    o = tbl(spark, sf, "orders").select(F.substring("o_orderpriority", 1, 1).alias("codigo_bonus"))
    empty = spark.createDataFrame([], "codigo_bonus int, descricao_bonus string, criado_em timestamp, "
                                      "atualizado_em timestamp")
    out = dims.upsert_code_dimension(empty, o, "codigo_bonus", NOW)
    return _ts_out(out)


def q_attach_ids(spark, sf):
    cust = tbl(spark, sf, "customer").select("c_custkey", F.col("c_nationkey").alias("n_nationkey"))
    dim_c = sk.number_rows(cust, ["c_custkey"], "cust_sk")
    dim_n = sk.number_rows(tbl(spark, sf, "nation").select("n_nationkey", "n_name"), ["n_name"], "nation_sk")
    o = tbl(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").alias("c_custkey"),
                                        "o_orderstatus", "o_totalprice")
    with_c = facts.attach_ids(o, [(dim_c, "c_custkey", ["cust_sk", "n_nationkey"])])
    return facts.attach_ids(with_c, [(dim_n, "n_nationkey", ["nation_sk"])]).drop("n_nationkey")


# --------------------------------------------------------------------------
# nested collect / nested fact
# --------------------------------------------------------------------------

STAT_FIELDS = ["qty", "price"]


def _line_maps(spark, sf) -> DataFrame:
    li = tbl(spark, sf, "lineitem")
    return facts.collect_nested(li, ["l_orderkey"], "l_linenumber",
                                F.struct(F.col("l_quantity").alias("qty"), F.col("l_extendedprice").alias("price")),
                                LINE_ORDER[1:], "rounds")


def q_nested_collect(spark, sf):
    m = _line_maps(spark, sf)
    return m.select(
        F.col("l_orderkey").alias("o_orderkey"),
        F.size("rounds").cast("bigint").alias("n_lines"),
        F.array_join(nested.natural_key_order(F.map_keys("rounds")), ",").alias("line_keys"),
        F.aggregate(F.map_values("rounds"), F.lit(0.0), lambda acc, x: acc + x["qty"]).cast("bigint")
         .alias("qty_total"))


def q_nested_fact(spark, sf):
    o = tbl(spark, sf, "orders")
    maps = _line_maps(spark, sf).withColumnRenamed("l_orderkey", "o_orderkey")
    empty = F.create_map().cast("map<string,struct<qty:double,price:double>>")
    docs = o.join(maps, "o_orderkey", "left").select(
        "o_orderkey", "o_orderpriority",
        F.when(F.col("o_orderpriority").startswith("5"), F.lit("x"))
         .otherwise(F.substring("o_orderpriority", 1, 1)).alias("round_total"),
        F.array(
            F.struct(F.concat(F.lit("cust-"), F.col("o_custkey").cast("string")).alias("name"),
                     F.col("o_custkey").alias("member_key"), F.col("o_orderstatus").alias("result"),
                     F.coalesce(F.col("rounds"), empty).alias("rounds")),
            F.struct(F.concat(F.lit("clerk-"), F.col("o_orderpriority")).alias("name"),
                     F.lit(None).cast("bigint").alias("member_key"), F.lit(None).cast("string").alias("result"),
                     empty.alias("rounds")),
        ).alias("members"))
    dim_parent = sk.number_rows(o.where(F.year("o_orderdate") != 2001).select("o_orderkey", "o_custkey"),
                                ["o_orderkey"], "id_luta").withColumnRenamed("o_custkey", "id_evento")
    dim_member = sk.number_rows(tbl(spark, sf, "customer").select(F.col("c_custkey").alias("member_key")),
                                ["member_key"], "cust_sk")
    out = facts.nested_fact(docs, "o_orderkey", dim_parent, ["id_luta", "id_evento"], "members", "member_key",
                            dim_member, "cust_sk", "rounds", "round_total",
                            parent_cols=[("o_orderpriority", "o_orderpriority")],
                            member_cols=[("name", "nome"), ("result", "resultado")], stat_fields=STAT_FIELDS)
    return out.withColumn("round_num", F.col("round_num").cast("bigint"))


def q_sequence_fallback(spark, sf):
    li = tbl(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    empty = F.create_map().cast("map<string,string>")
    ks = nested.round_keys(empty, (F.col("l_linenumber") - 1).cast("string"))
    out = li.select("*", F.explode(ks).alias("round_key"))
    return out.select("l_orderkey", "l_linenumber", "l_partkey",
                      codes.digits_to_int("round_key").cast("bigint").alias("round_num"))


def q_map_lookup(spark, sf):
    li = tbl(spark, sf, "lineitem")
    m = F.create_map(F.lit("qty"), F.col("l_quantity"), F.lit("tax"), F.col("l_tax"),
                     F.lit("disc"), F.col("l_discount"))
    k = F.when(F.col("l_returnflag") == "R", "qty").when(F.col("l_returnflag") == "A", "tax").otherwise("missing")
    return li.select("l_orderkey", "l_linenumber", "l_returnflag", F.try_element_at(m, k).alias("looked_up"))


def q_natural_sort(spark, sf):
    li = tbl(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag")
    ks = F.array(F.col("l_linenumber").cast("string"), (F.col("l_linenumber") * 5).cast("string"),
                 F.concat(F.lit("x"), F.col("l_returnflag")), (F.col("l_linenumber") + 7).cast("string"))
    out = li.select("l_orderkey", "l_linenumber", F.posexplode(nested.natural_key_order(ks)).alias("p", "round_key"))
    return out.select("l_orderkey", "l_linenumber", (F.col("p") + 1).cast("bigint").alias("key_pos"),
                      "round_key", codes.digits_to_int("round_key").cast("bigint").alias("round_num"))


# --------------------------------------------------------------------------
# JSON
# --------------------------------------------------------------------------

def _json_texts(ev: DataFrame) -> Column:
    t = F.col("event_type")
    v = F.col("value")
    return (F.when((t == "error") & (v > 100), F.concat(F.lit("["), F.col("props"), F.lit("] x")))
            .when((t == "error") & (v > 50), F.lit("[{'k':1}]"))
            .when((t == "view") & (v > 100), F.concat(F.lit("\u00a0["), F.col("props"), F.lit("]\u00a0")))
            .when((t == "view") & (v > 50), F.concat(F.lit('["{x", "{\\"k\\":9}", '), F.col("props"), F.lit("]")))
            .when(t == "error", F.lit("nope")).when(t == "view", F.col("props"))
            .when(t == "click", F.concat(F.lit("["), F.col("props"), F.lit(', 5, "x"]')))
            .when(t == "signup", F.lit("  "))
            .otherwise(F.concat(F.lit("["), F.col("props"), F.lit(","), F.col("props"), F.lit("]"))))


def q_parse_json_array(spark, sf):
    ev = tbl(spark, sf, "events")
    arr = nested.parse_object_array(_json_texts(ev), "struct<k:int>")
    return ev.select("event_id", F.size(arr).cast("bigint").alias("n_objects"),
                     F.aggregate(arr, F.lit(0).cast("bigint"), lambda a, x: a + x["k"]).alias("sum_k"))


def q_to_json_text(spark, sf):
    ev = tbl(spark, sf, "events")
    k = F.from_json("props", "struct<k:int>")["k"]
    doc = F.struct(k.alias("k"), F.when(F.col("value") > 100, F.lit(None)).otherwise(F.col("event_type")).alias("tag"))
    js = nested.to_json_text(doc)
    back = F.from_json(js, "struct<k:int,tag:string>")
    return ev.select("event_id", back["k"].cast("bigint").alias("k"), back["tag"].alias("tag"),
                     js.contains('"tag":').alias("has_tag_key"))


# --------------------------------------------------------------------------
# scalar functions
# --------------------------------------------------------------------------

def _padded_url(c: Column) -> Column:
    return F.when(c.contains("?"), F.concat(F.lit(" "), c, F.lit("\u00a0"))).otherwise(c)


def q_hash_keys(spark, sf):
    p = tbl(spark, sf, "pages").select("page_id", _padded_url(F.col("url")).alias("url"))
    uid = keys.id_from_url("url")
    return p.select("page_id", uid.alias("url_id"), keys.short_id(uid).alias("url_hash5"),
                    keys.sha1_hex("url").alias("raw_sha1"), keys.hash5("page_id").alias("page_hash5"))


def q_composite_key(spark, sf):
    li = tbl(spark, sf, "lineitem")
    part = F.when(F.col("l_returnflag") == "R", F.lit(None)).otherwise(F.col("l_partkey"))
    fid = keys.composite_id("l_orderkey", part, "l_suppkey", "l_linenumber")
    return li.select("l_orderkey", "l_linenumber", "l_partkey", fid.alias("fid"), keys.short_id(fid).alias("fid_hash5"))


def q_url_slug(spark, sf):
    p = tbl(spark, sf, "pages")
    return p.select("page_id", keys.url_slug("url").alias("slug"),
                    keys.url_slug(F.concat(F.regexp_replace("url", "\\?.*$", ""), F.lit("//"))).alias("path_slug"))


def q_clean_text(spark, sf):
    d = tbl(spark, sf, "documents").select("doc_id", text.clean("text").alias("clean_text"), "lang")
    return d.select("doc_id", "clean_text", F.length("clean_text").cast("bigint").alias("n_clean"),
                    text.text_value("lang").alias("lang"))


def q_prefix_strip(spark, sf):
    d = tbl(spark, sf, "documents")
    rec = F.concat(F.when(F.col("lang") == "en", F.lit("Record: ")).when(F.col("lang") == "de", F.lit("RECORD:"))
                   .otherwise(F.lit("")), F.col("text"))
    cleaned = d.select("doc_id", text.clean(rec).alias("c"))
    return cleaned.select("doc_id", text.after_prefix("c", "record:").alias("record"))


def _date_texts(o: DataFrame) -> Column:
    d = F.col("o_orderdate")
    p = F.col("o_orderpriority")
    return (F.when(p == "1-URGENT", F.date_format(d, "MMMM d, yyyy"))
            .when(p == "2-HIGH", F.date_format(d, "dd/MM/yyyy"))
            .when(p == "3-MEDIUM", F.date_format(d, "MMM d, yyyy"))
            .when(p == "4-NOT SPECIFIED", F.date_format(d, "yyyy-MM-dd HH:mm:ss"))
            .when((F.col("o_orderstatus") == "F") & (F.dayofmonth(d) <= 5), F.date_format(d, "M/d/yyyy"))
            .when((F.col("o_orderstatus") == "F") & (F.dayofmonth(d) <= 10), F.date_format(d, "d MMM yyyy"))
            .when((F.col("o_orderstatus") == "F") & (F.dayofmonth(d) > 25), F.date_format(d, "dd-MM-yyyy"))
            .when(F.col("o_orderstatus") == "F", F.concat(F.lit("30/02/"), F.year(d).cast("string")))
            .when(F.col("o_orderstatus") == "O", F.date_format(d, "yyyy-MM-dd"))
            .otherwise(F.lit("--")))


def q_parse_date_long(spark, sf):
    o = tbl(spark, sf, "orders")
    txt = _date_texts(o)
    return o.select("o_orderkey", txt.alias("txt"), dates.iso_date(dates.parse_long_date(txt)).alias("iso"))


def q_parse_date_multi(spark, sf):
    o = tbl(spark, sf, "orders")
    txt = _date_texts(o)
    return o.select("o_orderkey", txt.alias("txt"), dates.to_ddmmyyyy(txt).alias("ddmmyyyy"))


def _height_text(p: DataFrame) -> Column:
    inches = F.col("p_size") + 48
    t = F.col("p_type")
    return (F.when(t.isin("ECONOMY", "PROMO"),
                   F.concat(F.floor(inches / 12).cast("string"), F.lit("' "), (inches % 12).cast("string"), F.lit('"')))
            .when(t == "SMALL", F.concat((F.col("p_size") + 150).cast("string"), F.lit(",5 cm")))
            .when(t == "LARGE", F.concat((F.col("p_size") + 150).cast("string"), F.lit(" CM")))
            .otherwise(F.lit("--")))


def _weight_text(p: DataFrame) -> Column:
    t = F.col("p_type")
    return (F.when(t.isin("ECONOMY", "PROMO"), F.concat((F.col("p_size") * 3 + 100).cast("string"), F.lit(" lbs.")))
            .when(t == "SMALL", F.concat((F.col("p_size") * 3 + 100).cast("string"), F.lit(".5 LB")))
            .when(t == "LARGE", F.concat((F.col("p_size") + 40).cast("string"), F.lit(",5 kg")))
            .otherwise(F.lit("n/a")))


def _reach_text(p: DataFrame) -> Column:
    t = F.col("p_type")
    return (F.when(t.isin("ECONOMY", "PROMO"), F.concat((F.col("p_size") + 50).cast("string"), F.lit('"')))
            .when(t == "SMALL", F.concat((F.col("p_size") + 50).cast("string"), F.lit('.5"')))
            .when(t == "LARGE", F.concat((F.col("p_size") + 170).cast("string"), F.lit(" cm")))
            .otherwise(F.lit(None)))


def q_unit_height(spark, sf):
    p = tbl(spark, sf, "part")
    return p.select("p_partkey", _height_text(p).alias("txt"), units.height_cm(_height_text(p)).alias("cm"))


def q_unit_weight(spark, sf):
    p = tbl(spark, sf, "part")
    return p.select("p_partkey", _weight_text(p).alias("txt"), units.weight_kg(_weight_text(p)).alias("kg"))


def q_unit_reach(spark, sf):
    p = tbl(spark, sf, "part")
    return p.select("p_partkey", _reach_text(p).alias("txt"), units.reach_cm(_reach_text(p)).alias("cm"))


def _stance_text() -> Column:
    s = F.col("c_mktsegment")
    return (F.when(s == "BUILDING", F.lit("Orthodox")).when(s == "MACHINERY", F.lit(" SOUTHPAW\u00a0"))
            .when(s == "HOUSEHOLD", F.lit("switch")).when(s == "AUTOMOBILE", F.lit("Open")).otherwise(F.lit(None)))


def q_vocab_map(spark, sf):
    c = tbl(spark, sf, "customer")
    return c.select("c_custkey", _stance_text().alias("txt"), codes.translate_stance(_stance_text()).alias("stance"))


def q_flag_from_text(spark, sf):
    ev = tbl(spark, sf, "events")
    t = F.col("event_type")
    bout = (F.when(t == "purchase", F.lit("Title Bout")).when(t == "view", F.lit("title bout"))
            .when(t == "click", F.lit(None)).otherwise(F.lit("normal")))
    return ev.select("event_id", bout.alias("bout"), codes.title_flag(bout).alias("luta_titulo"))


def _image_lists() -> Column:
    t = F.col("event_type")
    return (F.when(t == "purchase", F.array(F.lit("/i/perf.png"), F.lit("/i/ko.png")))
            .when(t == "click", F.array(F.lit("/i/KO.PNG")))
            .when(t == "view", F.array(F.lit("/i/belt.png")))
            .when(t == "signup", F.array(F.lit("/img/FIGHT.png"), F.lit("sub.png"), F.lit("belt.PNG")))
            .otherwise(F.array().cast("array<string>")))


def q_priority_case(spark, sf):
    ev = tbl(spark, sf, "events")
    imgs = _image_lists()
    return ev.select("event_id", codes.bonus_from_images(imgs).alias("bonus_code"),
                     codes.bout_type_from_images(imgs).alias("bout"))


def q_default_value(spark, sf):
    ev = tbl(spark, sf, "events")
    t = F.col("event_type")
    status = F.when(t == "signup", F.lit(None)).when(t == "error", F.lit("")).otherwise(t)
    stored = F.when(t == "view", F.lit(None)).otherwise(F.col("event_id").cast("string"))
    url = F.concat(F.lit("http://x/e/"), F.col("user_id").cast("string"))
    return ev.select("event_id", text.default_if_blank(status, "completed").alias("status"),
                     keys.key_or_url_id(stored, url).alias("entity_key"))


# --------------------------------------------------------------------------
# preparation (dedupe + rename + flatten)
# --------------------------------------------------------------------------

def q_prepare_flat(spark, sf):
    from strata.plans import silver
    ev = tbl(spark, sf, "events").select(
        F.col("user_id").alias("event_id"), F.col("event_type").alias("name"), "props",
        F.date_format("ts", "yyyy-MM-dd").alias("event_date"), F.col("event_type").alias("location"),
        F.lit("completed").alias("status"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("ingested_at"),
        F.col("event_id").alias("_read_order"), F.lit(ONE_DAY).alias("dt_particao"),
        F.concat(F.lit("http://x/u/"), F.col("user_id").cast("string")).alias("event_url"))
    return silver.prepare_events(ev)


def q_prepare_optional_col(spark, sf):
    from strata.plans import silver
    o = tbl(spark, sf, "orders").select(
        F.col("o_custkey").cast("string").alias("fight_id"), F.col("o_orderkey").cast("string").alias("event_id"),
        F.lit(None).cast("string").alias("fight_url"), F.col("o_orderpriority").alias("event_name"),
        F.col("o_orderkey").cast("string").alias("bout_order"), F.lit(None).cast("int").alias("bonus_code"),
        F.lit("normal").alias("bout"), F.col("o_orderstatus").alias("method"), F.lit("3").alias("round"),
        F.lit(None).cast("string").alias("time"), F.lit(None).cast("string").alias("time_format"),
        F.lit(None).cast("string").alias("referee"),
        F.array().cast("array<struct<name:string>>").alias("fighters"),
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss").alias("ingested_at"),
        F.col("o_orderkey").alias("_read_order"), F.lit(ONE_DAY).alias("dt_particao"))
    return silver.prepare_fights(o).drop("fighters")


def _bio(c: DataFrame) -> Column:
    s = F.col("c_mktsegment")
    inches = (F.col("c_nationkey") + 60)
    return F.struct(
        F.concat(F.col("c_nationkey").cast("string"), F.lit("-1-0")).alias("record"),
        F.when(s == "FURNITURE", F.lit("--")).otherwise(
            F.concat(F.floor(inches / 12).cast("string"), F.lit("' "), (inches % 12).cast("string"), F.lit('"')))
         .alias("height"),
        F.concat((F.col("c_nationkey") * 4 + 115).cast("string"), F.lit(" lbs.")).alias("weight"),
        F.concat((F.col("c_nationkey") + 60).cast("string"), F.lit('"')).alias("reach"),
        _stance_text().alias("stance"),
        F.when(s == "HOUSEHOLD", F.lit("--")).otherwise(F.date_format(
            F.date_add(F.lit("1980-01-01").cast("date"), F.col("c_custkey").cast("int")), "MMM d, yyyy")).alias("dob"))


def q_prepare_nested(spark, sf):
    from strata.plans import silver
    c = tbl(spark, sf, "customer")
    bronze = c.select(
        F.col("c_custkey").cast("string").alias("fighter_id"), F.col("c_name").alias("name"),
        F.lit(None).cast("string").alias("profile_url"), _bio(c).alias("bio"),
        F.struct(F.format_number("c_acctbal", 2).alias("slpm"), F.lit("48%").alias("str_acc_pct"))
         .alias("career_stats"),
        F.lit("2024-01-31T00:00:00").alias("ingested_at"), F.col("c_custkey").alias("_read_order"),
        F.lit(ONE_DAY).alias("dt_particao"))
    out = silver.prepare_fighters(bronze)
    return out.select("fighter_id", "nome", "cartel", "altura", "peso", "alcance", "stance", "data_nascimento")


def q_output_contract(spark, sf):
    o = tbl(spark, sf, "orders").select(
        F.when(F.col("o_orderstatus") == "P", F.lit("x")).otherwise((F.col("o_orderkey") + 3_000_000_000).cast("string")).alias("id_evento"),
        F.col("o_orderpriority").alias("nome"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("data_evento"),
        F.col("o_orderdate").alias("ingerido_em"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("dt_particao"),
        (F.col("o_orderstatus") == "F").alias("luta_titulo"), "o_custkey", "o_totalprice")
    contract = [("id_evento", "bigint"), ("nome", "string"), ("data_evento", "string"), ("luta_titulo", "int"),
                ("ingerido_em", "string"), ("dt_particao", "string"), ("arbitro", "string")]
    return tables.to_contract(o, contract, drop=["o_custkey", "not_there"])


# --------------------------------------------------------------------------
# quality
# --------------------------------------------------------------------------

def q_key_not_null(spark, sf):
    li = tbl(spark, sf, "lineitem").select(
        F.when((F.col("l_returnflag") == "N") & (F.col("l_linestatus") == "O"), F.lit(None))
         .otherwise(F.col("l_orderkey")).alias("k"), "l_linenumber", "l_partkey")
    return quality.key_not_null(li, "k")


def q_dq_violations(spark, sf):
    li = tbl(spark, sf, "lineitem")
    c = tbl(spark, sf, "customer").withColumn(
        "c_name", F.when(F.col("c_acctbal") < 0, F.lit(None)).otherwise(F.col("c_name")))
    v1 = quality.violations(li, key=["l_orderkey", "l_linenumber"], unique=[["l_orderkey", "l_linenumber"]])
    v2 = quality.violations(c, key=["c_custkey"], not_null=["c_name"], max_len={"c_mktsegment": 9})
    return v1.unionByName(v2)


# --------------------------------------------------------------------------
# loads and ledger
# --------------------------------------------------------------------------

def _load_tables(spark, sf):
    o = _stored_orders(spark, sf)
    li = tbl(spark, sf, "lineitem")
    c = tbl(spark, sf, "customer")
    batch_orders = o.where(F.col("o_orderpriority") == "2-HIGH")
    stored = {
        "eventos": o.select("id_evento", "status", "data_evento", F.lit("old").alias("tag")),
        "lutas": li.select(F.when(F.year("l_shipdate") == 1995, F.lit(None)).otherwise(F.col("l_orderkey"))
                           .alias("id_evento"), F.col("l_linenumber").cast("bigint").alias("item"),
                           F.lit("old").alias("tag")),
        "historico_lutas": li.select(F.col("l_orderkey").alias("id_evento"), F.col("l_partkey").alias("item"),
                                     F.lit("old").alias("tag")),
        "lutadores": c.select(F.col("c_custkey").alias("id_lutador"), F.col("c_name").alias("nome"),
                              F.lit("old").alias("tag")),
    }
    bid = batch_orders.select("id_evento")
    bl = li.join(bid.withColumnRenamed("id_evento", "l_orderkey"), "l_orderkey", "left_semi")
    batch = {
        "eventos": batch_orders.select("id_evento", F.lit("completed").alias("status"), "data_evento",
                                       F.lit("new").alias("tag")),
        "lutas": bl.select(F.col("l_orderkey").alias("id_evento"), F.col("l_linenumber").cast("bigint").alias("item"),
                           F.lit("new").alias("tag")),
        "historico_lutas": bl.select(F.col("l_orderkey").alias("id_evento"), F.col("l_partkey").alias("item"),
                                     F.lit("new").alias("tag")),
        "lutadores": c.join(batch_orders.select(F.col("o_custkey").alias("c_custkey")), "c_custkey", "left_semi")
                      .select(F.col("c_custkey").alias("id_lutador"), F.col("c_name").alias("nome"),
                              F.lit("new").alias("tag")),
    }
    return stored, batch


def _flatten_state(state) -> DataFrame:
    parts = [
        state["eventos"].select(F.lit("eventos").alias("table_name"), "id_evento",
                                F.lit(None).cast("bigint").alias("item"), "tag", "status"),
        state["lutas"].select(F.lit("lutas").alias("table_name"), "id_evento", "item", "tag",
                              F.lit(None).cast("string").alias("status")),
        state["historico_lutas"].select(F.lit("historico_lutas").alias("table_name"), "id_evento", "item", "tag",
                                        F.lit(None).cast("string").alias("status")),
        state["lutadores"].select(F.lit("lutadores").alias("table_name"), F.col("id_lutador").alias("id_evento"),
                                  F.lit(None).cast("bigint").alias("item"), "tag",
                                  F.lit(None).cast("string").alias("status")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# Ids by partition in the load queries: some tens of ranges at the scale of the given tables.
ID_RANGE = 1 << 14


def _store(spark, name: str) -> tables.PartitionedTables:
    return tables.PartitionedTables(spark, workspace_path(spark, name), width=ID_RANGE)


def _run(load_type: str) -> dict:
    batch = ledger.new_batch()
    return {"run_id": batch["run_id"], "dt": batch["dt"], "tipo_carga": load_type, "iniciado_em": batch["started_at"]}


def q_full_load(spark, sf):
    """A full load of all rows replaces what an earlier load stored."""
    stored, _ = _load_tables(spark, sf)
    store = _store(spark, "silver-full")
    loads.load(store, stored, _run("initial"), full=True, anchor=ANCHOR_ORDERS)
    batch = {name: df.withColumn("tag", F.lit("full")) for name, df in stored.items()}
    loads.load(store, batch, _run("initial"), full=True, anchor=ANCHOR_ORDERS)
    return _flatten_state({name: store.read(name, df.schema) for name, df in batch.items()})


def q_incremental_merge(spark, sf):
    """The batch's scope replaces stored and stale rows in the id ranges that hold them."""
    stored, batch = _load_tables(spark, sf)
    store = _store(spark, "silver-incr")
    loads.load(store, stored, _run("initial"), full=True, anchor=ANCHOR_ORDERS)
    loads.load(store, batch, _run("incremental"), full=False, anchor=ANCHOR_ORDERS, days=SCOPE_DAYS)
    return _flatten_state({name: store.read(name, df.schema) for name, df in batch.items()})


def _runs(spark, sf) -> DataFrame:
    ev = tbl(spark, sf, "events")
    return ev.select(
        F.col("event_id").cast("string").alias("run_id"), F.date_format("ts", "yyyy-MM-dd").alias("dt"),
        F.when(F.col("value") > 100, "initial").otherwise("incremental").alias("tipo_carga"),
        F.col("event_type").alias("estagio"),
        F.when(F.col("event_type") == "purchase", F.lit(ledger.DONE)).otherwise(F.col("event_type")).alias("status"),
        F.col("ts").alias("iniciado_em"))


def q_latest_run(spark, sf):
    runs = _runs(spark, sf)
    overall = ledger.latest_completed(runs).select(F.lit(None).cast("string").alias("for_dt"), "run_id",
                                                    "tipo_carga", "iniciado_em")
    one = ledger.latest_completed(runs, ONE_DAY).select(F.lit(ONE_DAY).alias("for_dt"), "run_id", "tipo_carga",
                                                         "iniciado_em")
    return overall.unionByName(one)


QUERIES = {
    "page_link_fact": q_page_link_fact,
    "page_extract": q_page_extract,
    "page_links": q_page_links,
    "page_table_extract": q_page_table_extract,
    "fight_page_extract": q_fight_page_extract,
    "profile_page_extract": q_profile_page_extract,
    "label_value_pivot": q_label_value_pivot,
    "page_join": q_page_join,
    "latest_page": q_latest_page,
    "fetch_frontier": q_fetch_frontier,
    "bronze_cards": q_bronze_cards,
    "fighter_candidates": q_fighter_candidates,
    "read_partition": q_read_partition,
    "read_all_partitions": q_read_all_partitions,
    "partition_overwrite": q_partition_overwrite,
    "schema_evolve": q_schema_evolve,
    "stage_counts": q_stage_counts,
    "lookback_filter": q_lookback_filter,
    "scope_keys": q_scope_keys,
    "stale_keys": q_stale_keys,
    "ordered_union_limit": q_ordered_union_limit,
    "latest_per_key": q_latest_per_key,
    "distinct_first": q_distinct_first,
    "first_non_null": q_first_non_null,
    "top_n_per_group": q_top_n_per_group,
    "position_in_group": q_position_in_group,
    "surrogate_keys": q_surrogate_keys,
    "dim_insert_missing": q_dim_insert_missing,
    "dim_upsert_changed": q_dim_upsert_changed,
    "dim_upsert_always": q_dim_upsert_always,
    "code_dimension": q_code_dimension,
    "attach_ids": q_attach_ids,
    "nested_collect": q_nested_collect,
    "nested_fact": q_nested_fact,
    "sequence_fallback": q_sequence_fallback,
    "map_lookup": q_map_lookup,
    "natural_sort": q_natural_sort,
    "to_json_text": q_to_json_text,
    "parse_json_array": q_parse_json_array,
    "hash_keys": q_hash_keys,
    "composite_key": q_composite_key,
    "url_slug": q_url_slug,
    "clean_text": q_clean_text,
    "prefix_strip": q_prefix_strip,
    "parse_date_long": q_parse_date_long,
    "parse_date_multi": q_parse_date_multi,
    "unit_height": q_unit_height,
    "unit_weight": q_unit_weight,
    "unit_reach": q_unit_reach,
    "vocab_map": q_vocab_map,
    "flag_from_text": q_flag_from_text,
    "priority_case": q_priority_case,
    "default_value": q_default_value,
    "prepare_flat": q_prepare_flat,
    "prepare_optional_col": q_prepare_optional_col,
    "prepare_nested": q_prepare_nested,
    "output_contract": q_output_contract,
    "key_not_null": q_key_not_null,
    "dq_violations": q_dq_violations,
    "full_load": q_full_load,
    "incremental_merge": q_incremental_merge,
    "latest_run": q_latest_run,
}

from strata.plans import job_queries  # noqa: E402  (needs tbl and the parameters above)

QUERIES.update(job_queries.QUERIES)
