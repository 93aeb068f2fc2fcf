"""Bronze job: landed pages -> event index, bronze events, fights, fighters.

Input is a ``pages`` table ``(kind, page_key, url, html, dt)``; fetching is
outside the engine. Kinds: ``events_completed`` / ``events_upcoming``
(listing pages), ``event`` (keyed by event id), ``fight`` (keyed by the last
URL segment) and ``fighter`` (keyed by fighter id). Every step is a join or a
column expression; pages that are referenced but not landed go to a
``missing`` frame (the fetch frontier) instead of a log line.
"""

from __future__ import annotations

import os
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions import codes, keys
from strata.functions.text import default_if_blank
from strata.operators import dedupe, loads, page_rules
from strata.sources import ledger, partitions, tables

KIND_COMPLETED = "events_completed"
KIND_UPCOMING = "events_upcoming"


@dataclass
class BronzeResult:
    index: DataFrame
    events: DataFrame
    fights: DataFrame
    fighter_index: DataFrame
    fighters: DataFrame
    missing: DataFrame
    counts: dict = field(default_factory=dict)


# Order of the index: completed listing first, each by date descending (missing dates last), then page order.
INDEX_ORDER = ["_src", "_late", "page_pos"]


def _positioned_index(pages: DataFrame, *, full_load: bool, anchor: str, lookback_days: int) -> DataFrame:
    """Rows of both listings, lookback-filtered, with the columns that order them."""
    lists = pages.where(F.col("kind").isin(KIND_COMPLETED, KIND_UPCOMING)).select(
        "html", F.when(F.col("kind") == KIND_COMPLETED, "completed").otherwise("upcoming").alias("status"))
    rows = page_rules.extract_events(lists)
    rows = loads.lookback_filter(rows, "status", F.col("event_date").try_cast("date"), anchor, lookback_days,
                                 full_load=full_load)
    days = F.datediff(F.col("event_date").try_cast("date"), F.lit("1970-01-01").cast("date"))
    return rows.withColumn("_src", F.when(F.col("status") == "completed", 0).otherwise(1)).withColumn(
        "_late", F.coalesce(-days, F.lit(2 ** 31 - 1)))


def event_index(pages: DataFrame, *, full_load: bool, anchor: str, lookback_days: int,
                limit: int = 0) -> DataFrame:
    """Both listings -> completed-then-upcoming, date desc, lookback-filtered, first ``limit`` (0 = all)."""
    ordered = _positioned_index(pages, full_load=full_load, anchor=anchor, lookback_days=lookback_days).orderBy(*INDEX_ORDER)
    return (ordered.limit(limit) if limit else ordered).drop(*INDEX_ORDER)


def latest_pages(pages: DataFrame, kind: str, dt: str | None = None) -> DataFrame:
    """Newest landed page per key (later ``dt`` wins); optionally one ``dt`` only.

    The winner is chosen on the key, the day and the page's hash; the pages themselves move once.
    """
    p = pages.where(F.col("kind") == kind)
    if dt is not None:
        p = p.where(F.col("dt") == dt)
    # latest day; of several landings on it, the smallest hash
    p = p.select("page_key", "html", F.struct("dt", F.bitwise_not(F.xxhash64("html"))).alias("_at"))
    last = p.groupBy(F.col("page_key").alias("_key")).agg(F.max("_at").alias("_last"))
    # the key is the only equality, so that both sides and the pages kept are partitioned by it
    won = p.join(last, (F.col("page_key") == F.col("_key")) & (F.col("_at") >= F.col("_last")), "left_semi")
    return won.dropDuplicates(["page_key"]).select("page_key", "html")


def card_rows(index: DataFrame, cards: DataFrame, key: str = "event_id") -> DataFrame:
    """Every listing row with the cards of its event: an event on both lists has its cards once for each."""
    status = default_if_blank("status", "completed").alias("event_status")
    listed = index.where(F.col(key).isNotNull() & (F.col(key) != ""))
    others = [c for c in index.columns if c not in (key, "status")]
    return listed.select(key, status, *others).join(cards, key)


def land_pages(pages: DataFrame, root: str) -> None:
    """Land fetched pages ``(kind, page_key, url, html, dt)`` as a table by kind and day.

    A later landing of a day's kind replaces the earlier one.
    """
    (pages.select("page_key", "url", "html", "kind", "dt").write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("kind", "dt").parquet(os.path.join(root, "pages")))


def read_pages(spark: SparkSession, root: str) -> DataFrame:
    """Landed pages."""
    schema = "page_key string, url string, html string, kind string, dt string"
    return spark.read.schema(schema).parquet(os.path.join(root, "pages"))


def run_bronze(spark: SparkSession, pages: DataFrame, out_root: str, *, dt: str, ingested_at: str,
               full_load: bool, anchor: str, lookback_days: int = 30, limit: int = 0,
               max_fights_per_event: int = 0, max_fighters: int = 0) -> BronzeResult:
    """Build and write all bronze sets for one ``dt``; returns the frames written and their row counts.

    Every page is read once: what is read of it is written, and downstream steps read that back.
    The limits (0 = none) are for trial runs of a full load; in an incremental load
    the merge would take what they leave out for stale and delete it, so they are refused there.
    """
    if not full_load and (limit or max_fights_per_event or max_fighters):
        raise ValueError("limits need full_load=True: an incremental load would delete what they leave out")
    counts: dict = {}

    def land(name: str, df: DataFrame) -> DataFrame:
        base = os.path.join(out_root, "bronze", name)
        counts[name] = tables.observed(df, name, lambda out: partitions.write_partition(out, base, dt))["rows"]
        return partitions.read_partition(spark, base, dt, df.schema).drop("dt_particao")

    positioned = _positioned_index(pages, full_load=full_load, anchor=anchor, lookback_days=lookback_days)
    if limit:
        positioned = positioned.orderBy(*INDEX_ORDER).limit(limit)
    positioned = loads.materialize(positioned, "bronze-index")
    index = positioned.orderBy(*INDEX_ORDER).drop(*INDEX_ORDER)
    raw_index = os.path.join(out_root, "raw_index")
    partitions.write_partition(index, raw_index, dt)
    index = partitions.read_partition(spark, raw_index, dt, index.schema).drop("dt_particao")
    events = land("eventos", index.withColumn("ingested_at", F.lit(ingested_at)))

    # event cards: each event page read once, then one row per listing row and fight link
    ev_pages = latest_pages(pages, "event", dt).withColumnRenamed("page_key", "event_id")
    cards = page_rules.extract_cards(ev_pages.join(positioned.select("event_id").distinct(), "event_id", "left_semi"))
    if max_fights_per_event:
        cards = dedupe.top_n_per_key(cards, "event_id", [F.col("bout_order").cast("int")], max_fights_per_event)
    tasks = loads.materialize(card_rows(positioned.select("event_id", "status", *INDEX_ORDER), cards).select(
        "*", codes.bonus_from_images("images").alias("bonus_code"), codes.bout_type_from_images("images").alias("bout"),
        keys.url_slug("fight_url").alias("page_key")).drop("images"), "bronze-cards")

    fight_pages = latest_pages(pages, "fight", dt).join(tasks.select("page_key").distinct(), "page_key", "left_semi")
    read = loads.materialize(page_rules.fight_pages(fight_pages), "bronze-fight-pages")
    # pages and what is read of them are many times their compressed size: not to be broadcast
    joined = loads.materialize(tasks.join(read.hint("merge"), "page_key"), "bronze-fights")
    fights = land("lutas", page_rules.fight_records(joined.withColumn("ingested_at", F.lit(ingested_at))))
    missing_fights = tasks.join(read.select("page_key"), "page_key", "left_anti").select(
        F.lit("fight").alias("kind"), "page_key", F.col("fight_url").alias("url"))

    # people in order of first appearance
    people = (joined.select(*INDEX_ORDER, F.col("bout_order").cast("int").alias("_bout"),
                            F.posexplode("fighters").alias("_pos", "_f"))
              .select(*INDEX_ORDER, "_bout", "_pos", "_f.fighter_id", "_f.fighter_id_hash5", "_f.name", "_f.profile_url")
              .where((F.coalesce("fighter_id", F.lit("")) != "") & (F.coalesce("profile_url", F.lit("")) != "")))
    fighter_index = land("lutadores_index", dedupe.first_keys(people, "fighter_id", [*INDEX_ORDER, "_bout", "_pos"], max_fighters)
                         .select("fighter_id", "fighter_id_hash5", "name", "profile_url",
                                 F.lit(ingested_at).alias("ingested_at")))

    fighter_pages = latest_pages(pages, "fighter").withColumnRenamed("page_key", "fighter_id")  # any dt: newest landing wins
    fighters = land("lutadores", page_rules.extract_fighters(
        fighter_index.join(fighter_pages.hint("merge"), "fighter_id").select("html", "profile_url", "ingested_at")))
    missing_fighters = (fighter_index.join(fighter_pages.select("fighter_id"), "fighter_id", "left_anti")
                        .select(F.lit("fighter").alias("kind"), F.col("fighter_id").alias("page_key"),
                                F.col("profile_url").alias("url")))
    missing = missing_fights.unionByName(missing_fighters)
    return BronzeResult(index, events, fights, fighter_index, fighters, missing, counts)


def run_job(spark: SparkSession, pages: DataFrame, out_root: str, ledger_path: str, *, full_load: bool,
            dt: str | None = None, anchor: str | None = None, **options) -> tuple[dict, BronzeResult]:
    """The whole bronze stage: a new batch, the bronze sets, the list of missing pages, audit rows, a ledger row at the end.

    Returns (batch, result). ``silver.load`` takes it from the ledger row.
    """
    batch = ledger.new_batch(dt)
    result = run_bronze(spark, pages, out_root, dt=batch["dt"], ingested_at=batch["started_at"].isoformat() + "Z",
                        full_load=full_load, anchor=anchor or batch["dt"], **options)
    result.missing = keep_missing(spark, out_root, result.missing, pages)
    ledger.record_audit(spark, os.path.join(out_root, "_audit"), batch["run_id"], batch["dt"],
                        {f"bronze_{name}": n for name, n in result.counts.items()})
    ledger.record_run(spark, ledger_path, batch["run_id"], batch["dt"], "initial" if full_load else "incremental",
                      "bronze", batch["started_at"])
    return batch, result


def fetch_frontier(index_keys: DataFrame, pages: DataFrame, kind: str, key: str, *, use_cache: bool = True,
                   dt: str | None = None) -> DataFrame:
    """Keys that still need a page: the whole index when the cache is off."""
    if not use_cache:
        return index_keys.select(key)
    landed = pages.where(F.col("kind") == kind)
    if dt is not None:
        landed = landed.where(F.col("dt") == dt)
    return index_keys.select(key).join(landed.select(F.col("page_key").alias(key)), key, "left_anti")


MISSING_SCHEMA = "kind string, page_key string, url string"


def keep_missing(spark: SparkSession, root: str, missing: DataFrame, pages: DataFrame) -> DataFrame:
    """The stored list of pages that were wanted and have not landed, after one more run; returns it.

    What earlier runs missed stays on the list until it lands on any day; what this run missed is added.
    """
    path = os.path.join(root, "missing_pages")
    wanted = missing.select("kind", "page_key", "url")
    if tables.path_exists(spark, path):
        wanted = spark.read.schema(MISSING_SCHEMA).parquet(path).unionByName(wanted)
    listed = dedupe.first_per_key(wanted.withColumn("_key", F.struct("kind", "page_key")), "_key", ["url"]).drop("_key")
    open_ = loads.materialize(listed.join(pages.select("kind", "page_key"), ["kind", "page_key"], "left_anti"), "missing-pages")
    open_.write.mode("overwrite").parquet(path)
    return spark.read.schema(MISSING_SCHEMA).parquet(path)


def read_bronze(spark: SparkSession, out_root: str, dt: str | None = None) -> dict[str, DataFrame]:
    """Bronze sets for one ``dt`` (``None`` = every partition) with ``dt_particao``."""
    from strata.schemas import BRONZE_EVENTS, BRONZE_FIGHTERS, BRONZE_FIGHTS
    out = {}
    for name, schema in (("eventos", BRONZE_EVENTS), ("lutas", BRONZE_FIGHTS), ("lutadores", BRONZE_FIGHTERS)):
        base = os.path.join(out_root, "bronze", name)
        out[name] = (partitions.read_partition(spark, base, dt, schema) if dt
                     else partitions.read_all_partitions(spark, base, schema))
    return out


def import_page_files(spark: SparkSession, path_glob: str, kind: str, dt: str) -> DataFrame:
    """Land ``<key>.html`` files as ``pages`` rows (key = file stem)."""
    raw = spark.read.text(path_glob, wholetext=True).select(F.col("value").alias("html"),
                                                            F.col("_metadata.file_path").alias("_path"))
    return raw.select(F.lit(kind).alias("kind"),
                      F.regexp_extract("_path", "([^/]+)\\.html?$", 1).alias("page_key"),
                      F.lit(None).cast("string").alias("url"), "html", F.lit(dt).alias("dt"))
