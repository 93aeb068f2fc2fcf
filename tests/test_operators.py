"""Operator fixtures: small frames in, the rule's expected rows out."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from conftest import rows
from strata.operators import dedupe, dims, facts, keys, loads, quality
from strata.schemas import DIM_BONUS
from strata.sources import ledger, tables


def test_latest_per_key_and_null_key(spark):
    df = spark.createDataFrame([("a", "2024-01-02T00:00:00Z", "1", 1), ("a", "2024-01-01T00:00:00Z", "1", 2),
                                ("a", None, "1", 3), (None, "2024-01-01T00:00:00Z", "1", 4),
                                (None, "2024-01-03T00:00:00Z", "1", 5), ("b", "garbage", "1", 6)],
                               "k string, ingested_at string, dt string, pos int")
    out = {r["k"]: r["pos"] for r in rows(dedupe.latest_per_key(df, "k", "ingested_at", ["dt", "pos"]))}
    assert out == {"a": 1, None: 5, "b": 6}


def test_latest_per_key_tie_keeps_read_order(spark):
    df = spark.createDataFrame([("a", "t1", "2", 1), ("a", "t1", "1", 2)], "k string, ingested_at string, dt string, p int")
    assert rows(dedupe.latest_per_key(df, "k", "ingested_at", ["dt", "p"]))[0]["dt"] == "1"


def test_first_non_null_by_source_rank(spark):
    df = spark.createDataFrame([("x", None, "u1", 0), ("x", "N", "u2", 1)], "k string, name string, url string, r int")
    assert rows(dedupe.first_non_null(df, "k", ["name", "url"], ["r"])) == [{"k": "x", "name": "N", "url": "u1"}]


def test_surrogate_keys_stable(spark):
    cur = spark.createDataFrame([(1, "a"), (2, "c")], "id bigint, k string")
    cand = spark.createDataFrame([("b",), ("c",), ("d",), (None,)], "k string")
    new = keys.assign_new_ids(cand, cur, "k", "id")
    assert sorted((r["k"], r["id"]) for r in rows(new)) == [("b", 3), ("d", 4)]


def test_number_rows_independent_of_partitions(spark):
    df = spark.range(0, 500).select(F.format_string("k%05d", (F.col("id") * 7919) % 500).alias("k"))
    a = {r["k"]: r["n"] for r in rows(keys.number_rows(df, ["k"], "n", 10, num_partitions=7))}
    b = {r["k"]: r["n"] for r in rows(keys.number_rows(df.repartition(3), ["k"], "n", 10, num_partitions=2))}
    assert a == b and sorted(a.values()) == list(range(11, 511)) and a["k00000"] == 11


def _dim(spark):
    return spark.createDataFrame(
        [(1, "e1", "Name", "http://old", dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 1)),
         (2, "e2", " Same ", "http://u2", dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 1)),
         (3, "e3", "Keep", "http://u3", dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 1))],
        "id long, k string, name string, url string, criado_em timestamp, atualizado_em timestamp")


def test_upsert_changed(spark):
    cand = spark.createDataFrame([("e1", None, "http://new"), ("e2", "Same", "http://u2"), ("e4", "New", None)],
                                 "k string, name string, url string")
    out = {r["k"]: r for r in rows(dims.upsert_dimension(_dim(spark), cand, "k", "id", ["name", "url"], "changed",
                                                          "2024-02-01 00:00:00", trim_compare={"name": True}))}
    assert out["e1"]["name"] == "Name" and out["e1"]["url"] == "http://new"
    assert out["e1"]["atualizado_em"] == dt.datetime(2024, 2, 1)
    assert out["e2"]["name"] == " Same " and out["e2"]["atualizado_em"] == dt.datetime(2024, 1, 1)
    assert out["e3"]["name"] == "Keep"
    assert out["e4"]["id"] == 4 and out["e4"]["criado_em"] == dt.datetime(2024, 2, 1)


def test_upsert_always(spark):
    cand = spark.createDataFrame([("e1", None, "http://new")], "k string, name string, url string")
    out = {r["k"]: r for r in rows(dims.upsert_dimension(_dim(spark), cand, "k", "id", ["name", "url"], "always",
                                                          "2024-02-01 00:00:00"))}
    assert out["e1"]["name"] is None and out["e1"]["atualizado_em"] == dt.datetime(2024, 2, 1)
    assert out["e2"]["atualizado_em"] == dt.datetime(2024, 1, 1)


def test_code_dimension(spark):
    empty = spark.createDataFrame([], DIM_BONUS)
    obs = spark.createDataFrame([(2,), (9,), (None,)], "codigo_bonus int")
    out = {r["codigo_bonus"]: r["descricao_bonus"] for r in rows(dims.upsert_code_dimension(empty, obs, "codigo_bonus",
                                                                                               "2024-01-01 00:00:00"))}
    assert sorted(out) == [1, 2, 3, 4, 9] and out[9] == "Bonus 9" and out[2] == "Performance da Noite"
    cur = spark.createDataFrame([(1, " Luta da Noite ", dt.datetime(2020, 1, 1), dt.datetime(2020, 1, 1)),
                                 (2, "old", dt.datetime(2020, 1, 1), dt.datetime(2020, 1, 1))], DIM_BONUS)
    out = {r["codigo_bonus"]: r for r in rows(dims.upsert_code_dimension(cur, obs, "codigo_bonus", "2024-01-01 00:00:00"))}
    assert out[1]["atualizado_em"] == dt.datetime(2020, 1, 1)
    assert out[2]["descricao_bonus"] == "Performance da Noite" and out[2]["atualizado_em"] == dt.datetime(2024, 1, 1)


STATS = "struct<sig_str:string>"


def test_nested_fact(spark):
    fights = spark.createDataFrame(
        [("f1", "3", "title bout", [("A", "a", "W", {"10": ("3 of 5",), "2": ("1 of 2",)}), ("B", "b", "L", {})]),
         ("f2", None, "normal", [("C", "c", "W", {})]),
         ("fx", "3", "normal", [("A", "a", "W", {})]),
         ("f3", "3", "normal", [])],
        f"fight_id string, round string, bout string, fighters array<struct<name:string, fighter_id:string, "
        f"result:string, rounds:map<string,{STATS}>>>")
    dim_f = spark.createDataFrame([("f1", 10, 100), ("f2", 11, 100), ("f3", 12, 100)], "fight_id string, id_luta int, id_evento int")
    dim_p = spark.createDataFrame([("a", 1), ("b", 2)], "fighter_id string, id_lutador int")
    out = facts.nested_fact(fights, "fight_id", dim_f, ["id_luta", "id_evento"], "fighters", "fighter_id", dim_p,
                            "id_lutador", "rounds", "round", parent_cols=[("bout", "tipo_luta")],
                            member_cols=[("name", "nome")], stat_fields=["sig_str"])
    got = sorted((r["id_luta"], r["nome"], r["id_lutador"], r["round_num"], r["sig_str"]) for r in rows(out))
    assert got == sorted([(10, "A", 1, 2, "1 of 2"), (10, "A", 1, 10, "3 of 5"), (10, "B", 2, 1, None),
                          (10, "B", 2, 2, None), (10, "B", 2, 3, None), (11, "C", None, None, None)])


def test_collect_nested_last_wins(spark):
    df = spark.createDataFrame([(1, 1, 5.0, 1), (1, 1, 7.0, 2), (1, 2, 3.0, 1)], "o int, line int, q double, ord int")
    out = rows(facts.collect_nested(df, ["o"], "line", F.col("q"), ["ord"], "m"))
    assert out == [{"o": 1, "m": {"1": 7.0, "2": 3.0}}]


def test_lookback_filter(spark):
    df = spark.createDataFrame([("completed", "2026-03-21"), ("completed", "2026-03-20"), ("completed", None),
                                ("upcoming", None), (None, "2026-04-01")], "status string, d string")
    df = df.withColumn("d", F.col("d").cast("date"))
    out = rows(loads.lookback_filter(df, "status", "d", "2026-04-20", 30))
    assert [(r["status"], str(r["d"])) for r in out] == [("completed", "2026-03-21"), ("upcoming", "None"),
                                                         (None, "2026-04-01")]
    assert loads.lookback_filter(df, "status", "d", "2026-04-20", 30, full_load=True).count() == 5


EV = "id_evento long, status string, data_evento string, tag string"


def scope_case(spark):
    stored = {"eventos": spark.createDataFrame([(1, "completed", "01/01/2020", "old"), (2, "upcoming", None, "old"),
                                                (3, "completed", "15/04/2026", "old"), (None, "x", None, "old")], EV),
              "lutas": spark.createDataFrame([(1, "old"), (2, "old"), (3, "old"), (None, "old")], "id_evento long, tag string"),
              "historico_lutas": spark.createDataFrame([(2, "old")], "id_evento long, tag string"),
              "lutadores": spark.createDataFrame([(7, "old"), (8, "old")], "id_lutador long, tag string")}
    batch = {"eventos": spark.createDataFrame([(3, "completed", "2026-04-15", "new")], EV),
             "lutas": spark.createDataFrame([(3, "new"), (None, "new")], "id_evento long, tag string"),
             "historico_lutas": spark.createDataFrame([(3, "new")], "id_evento long, tag string"),
             "lutadores": spark.createDataFrame([(8, "new")], "id_lutador long, tag string")}
    return stored, batch


def tags(df, col):
    return sorted((r[col] or 0, r["tag"]) for r in rows(df))


def a_run(kind):
    b = ledger.new_batch()
    return {"run_id": b["run_id"], "dt": b["dt"], "tipo_carga": kind, "iniciado_em": b["started_at"]}


def stored_store(spark, path, stored, width=1 << 16):
    store = tables.PartitionedTables(spark, str(path), width=width)
    loads.load(store, stored, a_run("initial"), full=True, anchor="2026-04-20")
    return store


def merged(store):
    return {t: tags(store.read(t), c) for t, c in loads.TABLE_IDS.items()}


MERGED = {"eventos": [(0, "old"), (1, "old"), (3, "new")], "lutas": [(0, "new"), (0, "old"), (1, "old"), (3, "new")],
          "historico_lutas": [(3, "new")], "lutadores": [(7, "old"), (8, "new")]}


@pytest.mark.parametrize("width", [1, 1 << 16])
def test_incremental_scope_replace(spark, tmp_path, width):
    stored, batch = scope_case(spark)
    store = stored_store(spark, tmp_path, stored, width)
    loads.load(store, batch, a_run("incremental"), full=False, anchor="2026-04-20", days=30)
    assert merged(store) == MERGED
    assert [r["status"] for r in store.runs().orderBy("concluido_em").collect()] == ["preparado", "concluido"] * 2
    # a full load after it leaves nothing of either
    loads.load(store, batch, a_run("initial"), full=True, anchor="2026-04-20")
    assert tags(store.read("eventos"), "id_evento") == [(3, "new")]


def part_files(store, table):
    out = {}
    for folder, _, names in os.walk(store.path(table)):
        if "=" in os.path.basename(folder):
            out[int(folder.rsplit("=")[1])] = sorted(n for n in names if n.endswith(".parquet"))
    return out


def test_merge_leaves_ranges_without_deleted_ids_alone(spark, tmp_path):
    stored, batch = scope_case(spark)
    store = stored_store(spark, tmp_path, stored, width=1)
    before = {t: part_files(store, t) for t in stored}
    loads.load(store, batch, a_run("incremental"), full=False, anchor="2026-04-20", days=30)
    for t, kept, gone in (("eventos", (1, -1), (2, 3)), ("lutas", (1, -1), (2, 3)), ("lutadores", (7,), (8,))):
        after = part_files(store, t)
        assert all(after[p] == before[t][p] for p in kept) and not any(after[p] == before[t][p] for p in gone)
    assert -2 in part_files(store, "lutas")  # the batch's rows without an id: a partition of their own


@pytest.mark.parametrize("dies_at", ["between", "after", "second_try"])
def test_a_load_that_died_is_finished_by_the_next(spark, tmp_path, monkeypatch, dies_at):
    """Died between tables, before the last ledger row, or again while being finished."""
    stored, batch = scope_case(spark)
    store = stored_store(spark, tmp_path, stored, width=1)
    apply, record = tables.PartitionedTables._apply, tables.PartitionedTables._record
    calls = []

    def dying_apply(self, run_id, table, *rest):
        calls.append(table)
        if dies_at != "after" and len(calls) > 2:
            raise RuntimeError("lost")
        apply(self, run_id, table, *rest)

    def dying_record(self, run, status):
        if dies_at == "after" and status == ledger.DONE:
            raise RuntimeError("lost")
        record(self, run, status)

    monkeypatch.setattr(tables.PartitionedTables, "_apply", dying_apply)
    monkeypatch.setattr(tables.PartitionedTables, "_record", dying_record)
    run = a_run("incremental")
    with pytest.raises(RuntimeError, match="lost"):
        loads.load(store, batch, run, full=False, anchor="2026-04-20", days=30)
    if dies_at == "second_try":
        calls.clear()
        with pytest.raises(RuntimeError, match="lost"):
            store.recover()
    monkeypatch.undo()
    again = tables.PartitionedTables(spark, str(tmp_path), width=1)  # a new process
    assert again.recover() == [run["run_id"]] and again.recover() == []
    assert merged(again) == MERGED
    loads.load(again, {t: df.where(f"{loads.TABLE_IDS[t]} is not null") for t, df in batch.items()}, a_run("incremental"),
               full=False, anchor="2026-04-20", days=30)
    assert merged(again) == MERGED


def test_only_touched_partitions_are_read(spark, tmp_path):
    stored, batch = scope_case(spark)
    store = stored_store(spark, tmp_path, stored, width=1)
    touched = loads.materialize(store.ranges(batch["eventos"], "id_evento"), "touched")
    got = store.read_ranges("eventos", touched, batch["eventos"].schema)
    assert [r["id_evento"] for r in got.collect()] == [3]
    assert "dynamicpruning" in got._jdf.queryExecution().executedPlan().toString().lower()
    scans = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(faixa_id" in scans or "dynamicpruningexpression(faixa_id" in scans


def test_contract_keeps_large_ids_and_refuses_to_lose_any(spark):
    df = spark.createDataFrame([(3_000_000_000, "7"), (None, "x")], "id_evento long, n string")
    got = rows(tables.to_contract(df, [("id_evento", "bigint"), ("n", "int")]))
    assert got == [{"id_evento": 3_000_000_000, "n": 7}, {"id_evento": None, "n": None}]
    with pytest.raises(Exception, match="CAST_OVERFLOW"):
        tables.to_contract(df, [("id_evento", "int")]).collect()


def test_first_keys_in_order_of_appearance(spark):
    df = spark.createDataFrame([("b", 2), ("a", 3), ("b", 1), ("c", 9)], "k string, pos int")
    assert [(r["k"], r["pos"]) for r in dedupe.first_keys(df, "k", ["pos"], 2).collect()] == [("b", 1), ("a", 3)]
    assert dedupe.first_keys(df, "k", ["pos"]).count() == 3


def test_shared_scratch_is_required_on_a_cluster():
    from strata.session import ensure_checkpoint_dir, is_local

    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "spark://host:7077"
        getCheckpointDir = staticmethod(lambda: None)
        getConf = staticmethod(Conf)

    class Session:
        sparkContext = Context

    assert is_local("local") and is_local("local[8]") and not is_local("local-cluster[2,1,1024]")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session)


def test_latest_run(spark):
    runs = spark.createDataFrame([("r1", "d", "initial", "s", "concluido", dt.datetime(2024, 1, 1)),
                                  ("r2", "d", "incremental", "s", "concluido", dt.datetime(2024, 1, 2)),
                                  ("r3", "d", "initial", "s", "falhou", dt.datetime(2024, 1, 3))],
                                 "run_id string, dt string, tipo_carga string, estagio string, status string, "
                                 "iniciado_em timestamp")
    assert ledger.load_type_for(runs) == "incremental"
    with pytest.raises(RuntimeError):
        ledger.load_type_for(runs, "other-day")


def test_latest_run_has_a_total_order(spark):
    at = dt.datetime(2024, 1, 1)
    runs = spark.createDataFrame([(r, "d", "initial", "s", "concluido", at, at) for r in ("r1", "r3", "r2")], ledger.LEDGER_SCHEMA)
    assert ledger.latest_completed(runs).first()["run_id"] == "r3"


def test_quality_violations(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (1, "bbbb"), (2, None), (None, "c")], "k int, v string")
    out = rows(quality.violations(df, key=["k"], unique=[["k"]], not_null=["v"], max_len={"v": 3}, flag_null=["k"]))
    assert sorted((r["rule"], r["key_value"]) for r in out) == [("max_len", "1"), ("not_null", "2"), ("null_id", "<null>"), ("unique", "1")]
    rules = {"t": {"key": ["k"], "unique": [["k"]], "max_len": {"v": 3}, "flag_null": ["k"]}}
    with pytest.raises(ValueError, match="2 data-quality violations"):
        quality.enforce({"t": df}, rules, f"{tmp_path}/v")
    assert spark.read.parquet(f"{tmp_path}/v").count() == 3  # all of them are kept
    quality.enforce({"t": df.where("v = 'c'")}, rules, f"{tmp_path}/w")
    assert [r["rule"] for r in rows(spark.read.parquet(f"{tmp_path}/w"))] == ["null_id"]


def test_key_guard_drops_empty_text(spark):
    df = spark.createDataFrame([("a",), ("",), (None,)], "k string")
    assert [r["k"] for r in rows(quality.key_not_null(df, "k"))] == ["a"]


def test_validate_name():
    from strata.sources.tables import validate_name
    assert validate_name("silver_1") == "silver_1"
    with pytest.raises(ValueError):
        validate_name("bad-name; drop")


def test_prepare_fighters_fills_missing_inputs(spark):
    from strata.plans.silver import prepare_fighters
    df = spark.createDataFrame([("a", "2024-01-01T00:00:00Z")], "fighter_id string, ingested_at string")
    out = rows(prepare_fighters(df))
    assert out[0]["fighter_id"] == "a" and out[0]["altura"] is None and out[0]["slpm"] is None


def test_bad_lines_are_kept_apart_and_counted(spark, tmp_path):
    from pyspark.sql.types import StructType
    from strata.sources import partitions
    part = tmp_path / "in" / "dt=2024-01-01"
    part.mkdir(parents=True)
    (part / "a.jsonl").write_text('{"a": 1, "b": "x"}\n\n{"a": 2\n{"a": "no number"}\n{"b": null}\n', encoding="utf-8")
    schema = StructType.fromDDL("a long, b string")
    for dt_, out in (("2024-01-01", "one"), (None, "all")):
        good, bad, counts = partitions.read_quarantined(spark, str(tmp_path / "in"), schema, str(tmp_path / out), dt_)
        assert counts == {"good": 2, "bad": 2}
        assert sorted(map(str, rows(good))) == sorted(map(str, [{"a": 1, "b": "x", "dt_particao": "2024-01-01"},
                                                                {"a": None, "b": None, "dt_particao": "2024-01-01"}]))
        assert sorted(r["line"] for r in bad.collect()) == ['{"a": "no number"}', '{"a": 2']


def test_old_files_have_the_default_of_a_later_column(spark, tmp_path):
    from pyspark.sql.types import StringType, StructType
    store = tables.PartitionedTables(spark, str(tmp_path), width=10)
    schema = StructType([*StructType.fromDDL("id long").fields, tables.with_default("kind", StringType(), "'old'")])
    loads_ = [(spark.createDataFrame([(1,), (25,)], "id long"), "table"), (spark.createDataFrame([(2, None), (3, "new")], "id long, kind string"), "ranges")]
    for df, how in loads_:
        run = a_run("incremental")
        touched = store.ranges(df, "id") if how == "ranges" else None
        out = df if touched is None else store.read_ranges("t", touched, schema).select("id", "kind").unionByName(df)
        store.stage(run["run_id"], "t", out, "id", touched)
        store.commit(run, {"t": (how, out.schema)})
    assert sorted((r["id"], r["kind"]) for r in store.read("t", schema).collect()) == [(1, "old"), (2, None), (3, "new"), (25, "old")]
