"""Silver job: bronze sets -> prepared tables -> dimensions -> ids -> facts -> load.

Preparation (dedupe + rename + flatten) is lazy; dimension upserts are
actions whose results are staged *before* the facts read their ids. All
tables of a load are staged, checked, and then put in place as one run of
the ledger (``PartitionedTables``).
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions import codes, dates, units
from strata.functions.codes import title_flag
from strata.operators import dedupe, dims, facts, loads, quality
from strata.schemas import (BIO, CAREER, CONTRACT_EVENTS, CONTRACT_FIGHTERS, CONTRACT_FIGHTS, CONTRACT_HISTORY,
                            DIM_BONUS, DIM_EVENT, DIM_FIGHT, DIM_FIGHTER, STAT_FIELDS)
from strata.session import workspace_path
from strata.sources import ledger, tables


# Constraints of the silver tables (keys, NOT NULL, text lengths), checked before each commit.
_DAYS = {"ingerido_em": 10, "dt_particao": 10}
_STAMPS = ["criado_em", "atualizado_em"]
TABLE_RULES = {
    "dim_bonus": {"key": ["codigo_bonus"], "unique": [["codigo_bonus"]],
                  "not_null": ["codigo_bonus", "descricao_bonus", *_STAMPS], "max_len": {"descricao_bonus": 120}},
    "dim_evento": {"key": ["event_id"], "unique": [["id_evento"], ["event_id"]],
                   "not_null": ["id_evento", "event_id", *_STAMPS],
                   "max_len": {"event_id": 40, "nome_evento": 300, "event_url": 300}},
    "dim_luta": {"key": ["fight_id"], "unique": [["id_luta"], ["fight_id"]], "not_null": ["id_luta", "fight_id", *_STAMPS],
                 "max_len": {"fight_id": 40, "fight_url": 300, "nome_evento": 300}},
    "dim_lutador": {"key": ["fighter_id"], "unique": [["id_lutador"], ["fighter_id"]],
                    "not_null": ["id_lutador", "fighter_id", *_STAMPS],
                    "max_len": {"fighter_id": 40, "nome_lutador": 200, "url_perfil": 300}},
    "eventos": {"key": ["id_evento"], "flag_null": ["id_evento"],
                "max_len": {"nome": 300, "data_evento": 10, "local": 300, "status": 100, **_DAYS}},
    "lutas": {"key": ["id_luta"], "flag_null": ["id_evento"],
              "max_len": {"nome_evento": 300, "status_evento": 100, "ordem_luta": 20, "tipo_luta": 40, "metodo": 120,
                          "round": 20, "tempo": 20, "formato_tempo": 80, "arbitro": 120, **_DAYS}},
    "lutadores": {"key": ["id_lutador"], "flag_null": ["id_lutador"],
                  "max_len": {"nome": 200, "cartel": 50, "stance": 50, "data_nascimento": 40, "str_acc_pct": 20,
                              "str_def_pct": 20, "td_acc_pct": 20, **_DAYS}},
    "historico_lutas": {"key": ["id_luta", "id_lutador"], "flag_null": ["id_evento"],
                        "max_len": {"nome_lutador": 200, "resultado": 20, "nome_evento": 300, "ordem_luta": 20,
                                    "tipo_luta": 40, "metodo": 120, "round_final": 20, "tempo": 20, "formato_tempo": 80,
                                    "arbitro": 120, "sig_str": 40, "sig_str_pct": 20, "head": 40, "body": 40, "leg": 40,
                                    "distance": 40, "clinch": 40, "ground": 40, **_DAYS}},
}


def _check(store: tables.PartitionedTables, frames: dict) -> None:
    """Check what is staged of each table; all violations are kept, and raise if one blocks."""
    path = os.path.join(store.root, "_violations", uuid.uuid4().hex[:12])
    quality.enforce(frames, {t: TABLE_RULES[t] for t in frames}, path)


def _tiebreak(df: DataFrame) -> list:
    """Read order: partition date, then the line position when it is known."""
    out = [c for c in ("dt_particao", "_read_order") if c in df.columns]
    return out


def dedupe_latest(df: DataFrame, key: str) -> DataFrame:
    """Latest version per key by ``ingested_at`` (bad/missing last), read order on ties.

    Without a recorded line position, identical (key, time, partition) rows
    are ordered by a content hash so the choice is deterministic.
    """
    ties = _tiebreak(df)
    if "_read_order" not in df.columns:
        ties = [*ties, dedupe.content_hash(df)]
    if "ingested_at" in df.columns:
        return dedupe.latest_per_key(df, key, "ingested_at", ties)
    return dedupe.first_per_key(df, key, ties)


def prepare_events(bronze: DataFrame) -> DataFrame:
    d = dedupe_latest(bronze, "event_id")
    return d.select("event_id", "event_url", F.col("name").alias("nome"), F.col("event_date").alias("data_evento"),
                    F.col("location").alias("local"), "status", F.col("ingested_at").alias("ingerido_em"),
                    "dt_particao")


def prepare_fights(bronze: DataFrame) -> DataFrame:
    """Fights; ``status_evento`` is emitted only when the input has ``event_status``."""
    d = dedupe_latest(bronze, "fight_id")
    cols = [F.col("fight_id"), F.col("event_id"), F.col("fight_url"), F.col("event_name").alias("nome_evento")]
    if "event_status" in d.columns:
        cols.append(F.col("event_status").alias("status_evento"))
    else:
        cols.append(F.lit(None).cast("string").alias("status_evento"))
    cols += [F.col("bout_order").alias("ordem_luta"), F.col("bonus_code").alias("codigo_bonus"),
             F.col("bout").alias("tipo_luta"), F.col("method").alias("metodo"), F.col("round"),
             F.col("time").alias("tempo"), F.col("time_format").alias("formato_tempo"),
             F.col("referee").alias("arbitro"), F.col("fighters"), F.col("ingested_at").alias("ingerido_em"),
             F.col("dt_particao")]
    return d.select(*cols)


def prepare_fighters(bronze: DataFrame) -> DataFrame:
    """Fighters: flatten ``bio``/``career_stats`` and convert units, dates, stance."""
    for c, t in (("name", "string"), ("profile_url", "string"), ("ingested_at", "string"),
                 ("dt_particao", "string"), ("bio", BIO), ("career_stats", CAREER)):
        if c not in bronze.columns:
            bronze = bronze.withColumn(c, F.lit(None).cast(t))
    d = dedupe_latest(bronze, "fighter_id")
    bio = lambda f: F.col(f"bio.{f}")
    cs = lambda f: F.col(f"career_stats.{f}") if f in _fields(d, "career_stats") else F.lit(None).cast("string")
    return d.select(
        "fighter_id", F.col("name").alias("nome"), F.col("profile_url").alias("url_perfil"),
        bio("record").alias("cartel"), units.height_cm(bio("height")).alias("altura"),
        units.weight_kg(bio("weight")).alias("peso"), units.reach_cm(bio("reach")).alias("alcance"),
        codes.translate_stance(bio("stance")).alias("stance"),
        dates.to_ddmmyyyy(bio("dob")).alias("data_nascimento"),
        *[cs(f).alias(f) for f in ("slpm", "str_acc_pct", "sapm", "str_def_pct", "td_avg_15min", "td_acc_pct",
                                  "td_def_pct", "sub_avg_15min")],
        F.col("ingested_at").alias("ingerido_em"), "dt_particao")


def _fields(df: DataFrame, struct_col: str) -> set:
    t = df.schema[struct_col].dataType
    return set(t.fieldNames()) if hasattr(t, "fieldNames") else set()


def fighter_candidates(fighters: DataFrame, fights: DataFrame) -> DataFrame:
    """Profile rows first, then people named inside fights; first non-null value per id.

    Of the people named in fights only the first of each id counts (by fight, then position),
    whatever later ones could add.
    """
    prof = fighters.where(F.coalesce("fighter_id", F.lit("")) != "").select(
        "fighter_id", F.col("nome").alias("nome_lutador"), "url_perfil", F.lit(0).alias("_src"))
    people = (fights.select("fight_id", F.posexplode("fighters").alias("_pos", "_f"))
              .select(F.col("_f.fighter_id").alias("fighter_id"), F.col("_f.name").alias("nome_lutador"),
                      F.col("_f.profile_url").alias("url_perfil"), "fight_id", "_pos")
              .where(F.coalesce("fighter_id", F.lit("")) != ""))
    named = dedupe.first_per_key(people, "fighter_id", ["fight_id", "_pos"]).select(
        "fighter_id", "nome_lutador", "url_perfil", F.lit(1).alias("_src"))
    return dedupe.first_non_null(prof.unionByName(named), "fighter_id", ["nome_lutador", "url_perfil"], ["_src"])


def build_dimensions(store: tables.PartitionedTables, run_id: str, events: DataFrame,
                     fights: DataFrame, fighters: DataFrame, now) -> dict[str, DataFrame]:
    """Upsert the four dimensions into the run's staging folder (facts then read the staged ids)."""
    out = {}

    def stage(name: str, df: DataFrame) -> DataFrame:
        out[name] = store.stage(run_id, name, df)
        return out[name]

    stage("dim_bonus", dims.upsert_code_dimension(store.read("dim_bonus", DIM_BONUS), fights.select("codigo_bonus"),
                                                  "codigo_bonus", now))
    ev_cand = dedupe.first_per_key(quality.key_not_null(events, "event_id"), "event_id", _tiebreak(events) or ["event_id"])
    ev_cand = ev_cand.select("event_id", F.col("nome").alias("nome_evento"), "event_url")
    dim_event = stage("dim_evento", dims.upsert_dimension(
        store.read("dim_evento", DIM_EVENT), ev_cand, "event_id", "id_evento", ["nome_evento", "event_url"],
        "changed", now, trim_compare={"nome_evento": True, "event_url": False}))

    f_cand = dedupe.first_per_key(quality.key_not_null(fights, "fight_id"), "fight_id", _tiebreak(fights) or ["fight_id"])
    f_cand = facts.attach_ids(f_cand.select("fight_id", "event_id", "fight_url", "nome_evento"),
                              [(dim_event, "event_id", ["id_evento"])]).drop("event_id")
    stage("dim_luta", dims.upsert_dimension(store.read("dim_luta", DIM_FIGHT), f_cand, "fight_id", "id_luta",
                                            ["id_evento", "fight_url", "nome_evento"], "always", now))
    stage("dim_lutador", dims.upsert_dimension(
        store.read("dim_lutador", DIM_FIGHTER), fighter_candidates(fighters, fights), "fighter_id", "id_lutador",
        ["nome_lutador", "url_perfil"], "changed", now, trim_compare={"nome_lutador": True, "url_perfil": False}))
    return out


def history_fact(fights_ids: DataFrame, dim_fight: DataFrame, dim_fighter: DataFrame) -> DataFrame:
    """Fight x fighter x round rows (26 columns)."""
    out = facts.nested_fact(
        fights_ids, "fight_id", dim_fight.select("fight_id", "id_luta", "id_evento"), ["id_luta", "id_evento"],
        "fighters", "fighter_id", dim_fighter, "id_lutador", "rounds_sig_strikes", "round",
        parent_cols=[("nome_evento", "nome_evento"), ("ordem_luta", "ordem_luta"), ("codigo_bonus", "codigo_bonus"),
                     ("tipo_luta", "tipo_luta"), ("metodo", "metodo"), ("tempo", "tempo"),
                     ("formato_tempo", "formato_tempo"), ("arbitro", "arbitro"), ("ingerido_em", "ingerido_em"),
                     ("dt_particao", "dt_particao")],
        member_cols=[("name", "nome_lutador"), ("result", "resultado")], stat_fields=STAT_FIELDS)
    return out.withColumn("luta_titulo", title_flag("tipo_luta"))


def run_silver(spark: SparkSession, bronze_events: DataFrame, bronze_fights: DataFrame,
               bronze_fighters: DataFrame, store: tables.PartitionedTables, *, full: bool,
               anchor: str, now, scope_days: int = 30, run_id: str | None = None, dt: str = "") -> dict[str, int]:
    """Prepare, upsert dimensions, attach ids, build the fact and load; returns the batch's rows by table.

    A load that an earlier run left unfinished is finished first.
    """
    store.recover()
    run = {"run_id": run_id or ledger.new_batch()["run_id"], "dt": dt, "iniciado_em": now,
           "tipo_carga": "initial" if full else "incremental"}
    events = prepare_events(bronze_events)
    fights = loads.materialize(prepare_fights(bronze_fights), "silver-fights")  # feeds four dimension/fact branches
    fighters = prepare_fighters(bronze_fighters)
    d = build_dimensions(store, run["run_id"], events, fights, fighters, now)

    events_ids = facts.attach_ids(events, [(d["dim_evento"], "event_id", ["id_evento"])])
    fights_ids = facts.attach_ids(fights, [(d["dim_evento"], "event_id", ["id_evento"]),
                                           (d["dim_luta"].select("fight_id", "id_luta"), "fight_id", ["id_luta"])])
    fighters_ids = facts.attach_ids(fighters, [(d["dim_lutador"], "fighter_id", ["id_lutador"])])
    history = history_fact(fights, d["dim_luta"], d["dim_lutador"])

    frames = {
        "eventos": tables.to_contract(events_ids, CONTRACT_EVENTS),
        "lutas": tables.to_contract(fights_ids, CONTRACT_FIGHTS),
        "lutadores": tables.to_contract(fighters_ids, CONTRACT_FIGHTERS),
        "historico_lutas": tables.to_contract(history, CONTRACT_HISTORY),
    }
    batch, counts = {}, {}
    for name, df in frames.items():
        path = workspace_path(spark, f"silver-{name}")
        counts[name] = tables.observed_write(df, name, path)["rows"]
        batch[name] = spark.read.schema(df.schema).parquet(path)
    loads.load(store, batch, run, full=full, anchor=anchor, days=scope_days,
               more={name: ("plain", df.schema) for name, df in d.items()}, check=lambda staged: _check(store, {**d, **staged}))
    return counts


def load(spark: SparkSession, bronze_root: str, store: tables.PartitionedTables, ledger_path: str, *,
         dt: str | None, anchor: str, now, run_id: str, force: bool = False) -> dict[str, int]:
    """Silver job driven by the run ledger.

    The newest completed bronze run for ``dt`` decides the load: ``initial``
    -> full rebuild, otherwise incremental scope-replace. Loading a ``dt``
    older than the newest completed silver load would treat newer in-scope
    events as stale and delete them, so it is refused unless ``force``.
    """
    from strata.plans.bronze import read_bronze
    runs = spark.read.parquet(ledger_path)
    if not force:
        ledger.refuse_older(runs, dt)
    load_type = ledger.load_type_for(runs.where(F.col("estagio") != "silver"), dt)
    bronze = read_bronze(spark, bronze_root, dt)
    counts = run_silver(spark, bronze["eventos"], bronze["lutas"], bronze["lutadores"], store,
                        full=(load_type == "initial"), anchor=anchor, now=now, run_id=run_id, dt=dt or "")
    ledger.record_audit(spark, os.path.join(bronze_root, "_audit"), run_id, dt or "",
                        {f"silver_{name}": n for name, n in counts.items()})
    if store.ledger_path != ledger_path:  # the tables' own ledger is not the jobs'
        ledger.record_run(spark, ledger_path, run_id, dt or "", load_type, "silver", now)
    return counts
