"""End-to-end: landed golden pages -> bronze JSONL -> silver tables (full, then incremental)."""

import datetime as dt
import os
import tempfile

import pytest

from conftest import rows
from test_pages import sha1
from strata.plans import bronze, silver
from strata.sources import ledger, tables

GOLD = os.path.join(os.path.dirname(__file__), "golden")


def page(name):
    with open(os.path.join(GOLD, name), encoding="utf-8") as f:
        return f.read()


def landed(spark, dt_value="2024-06-02"):
    aaa = sha1("http://stats.example/event-details/aaa")
    data = [("events_completed", "list", page("event_list.html"), dt_value),
            ("events_upcoming", "list", page("event_upcoming.html"), dt_value),
            ("event", aaa, page("event_card.html"), dt_value),
            ("fight", "f1", page("fight.html"), dt_value),
            ("fight", "f2", page("fight_no_rounds.html"), dt_value),
            ("fighter", sha1("http://stats.example/fighter-details/a"), "<html>stale copy</html>", "2024-01-01"),
            ("fighter", sha1("http://stats.example/fighter-details/a"), page("fighter.html"), "2024-05-01")]
    return spark.createDataFrame(data, "kind string, page_key string, html string, dt string")


@pytest.fixture(scope="module")
def root():
    return tempfile.mkdtemp(prefix="strata-job-")


@pytest.fixture(scope="module")
def bronze_result(spark, root):
    return bronze.run_bronze(spark, landed(spark), root, dt="2024-06-02", ingested_at="2024-06-02T10:00:00Z",
                             full_load=True, anchor="2024-06-02")


def test_bronze(spark, bronze_result):
    res = bronze_result
    idx = [(r["name"], r["status"]) for r in res.index.collect()]
    assert idx == [("Night Three", "completed"), ("Night One", "completed"), ("Night Two", "completed"),
                   ("Future Night", "upcoming")]
    fights = {r["bout_order"]: r for r in rows(res.fights)}
    assert (fights["1"]["bonus_code"], fights["1"]["bout"], fights["2"]["bonus_code"], fights["2"]["bout"]) == \
        (2, "title bout", 4, "normal")
    assert fights["1"]["fighters"][0]["rounds_sig_strikes"]["2"]["sig_str"] == "10 of 20"
    aaa = sha1("http://stats.example/event-details/aaa")
    red, blue = "http://stats.example/fighter-details/a", "http://stats.example/fighter-details/b"
    assert fights["1"]["fight_id"] == sha1(f"{aaa}|{red}|{blue}|1") and len(fights["1"]["fight_id_hash5"]) == 5
    assert fights["1"]["fighters"][0]["fighter_id"] == sha1(red)
    assert fights["1"]["event_status"] == "completed" and fights["1"]["method"] == "KO/TKO"
    assert sorted(r["name"] for r in res.fighter_index.collect()) == ["Alpha One", "Beta Two"]
    f = rows(res.fighters)
    assert len(f) == 1 and f[0]["career_stats"]["slpm"] == "4.60"
    assert [(r["kind"], r["page_key"]) for r in res.missing.collect()] == [("fighter", sha1(blue))]
    assert res.counts == {"eventos": 4, "lutas": 2, "lutadores_index": 2, "lutadores": 1}
    # lookback filter in incremental mode keeps upcoming and recent events only
    inc = bronze.event_index(landed(spark), full_load=False, anchor="2024-06-02", lookback_days=7)
    assert [r["name"] for r in inc.collect()] == ["Night Three", "Future Night"]
    assert [r["name"] for r in bronze.event_index(landed(spark), full_load=True, anchor="x", lookback_days=0,
                                                  limit=2).collect()] == ["Night Three", "Night One"]


def _silver(spark, root, store, full):
    b = bronze.read_bronze(spark, root, "2024-06-02")
    return silver.run_silver(spark, b["eventos"], b["lutas"], b["lutadores"], store, full=full,
                             anchor="2024-06-02", now=dt.datetime(2024, 6, 2, 12))


def test_silver_full_then_incremental(spark, root, bronze_result):
    store = tables.PartitionedTables(spark, os.path.join(root, "silver"))
    counts = _silver(spark, root, store, full=True)
    assert counts == {"eventos": 4, "lutas": 2, "lutadores": 1, "historico_lutas": 10}
    hist = rows(store.read("historico_lutas"))
    f1 = sorted((r["nome_lutador"], r["round_num"], r["sig_str"], r["luta_titulo"]) for r in hist if r["ordem_luta"] == "1")
    assert f1 == [("Alpha One", 1, "3 of 5", 1), ("Alpha One", 2, "10 of 20", 1),
                  ("Beta Two", 1, "1 of 2", 1), ("Beta Two", 2, "4 of 9", 1)]
    f2 = sorted((r["nome_lutador"], r["round_num"], r["sig_str"]) for r in hist if r["ordem_luta"] == "2")
    assert f2 == [("Alpha One", n, None) for n in (1, 2, 3)] + [("Beta Two", n, None) for n in (1, 2, 3)]
    fighters = rows(store.read("lutadores"))
    assert (fighters[0]["altura"], fighters[0]["peso"], fighters[0]["alcance"], fighters[0]["stance"],
            fighters[0]["data_nascimento"], fighters[0]["slpm"]) == (190, 70.3, 190, "Canhoto", "14/07/1988", 4.6)
    ev = {r["nome"]: r for r in rows(store.read("eventos"))}
    assert ev["Night One"]["ingerido_em"] == "02/06/2024" and ev["Night One"]["dt_particao"] == "02/06/2024"
    dim_ev = {r["event_id"]: r["id_evento"] for r in rows(store.read("dim_evento"))}
    assert sorted(dim_ev.values()) == [1, 2, 3, 4]
    dim_f = {r["fighter_id"]: r for r in rows(store.read("dim_lutador"))}
    assert dim_f[sha1("http://stats.example/fighter-details/a")]["nome_lutador"] == "Alpha One"
    assert sorted(r["codigo_bonus"] for r in rows(store.read("dim_bonus"))) == [1, 2, 3, 4]

    before = {t: sorted(map(str, rows(store.read(t)))) for t in ("eventos", "lutas", "historico_lutas", "lutadores")}
    counts2 = _silver(spark, root, store, full=False)  # same batch again: idempotent
    assert counts2 == counts
    after = {t: sorted(map(str, rows(store.read(t)))) for t in before}
    assert after == before
    assert {r["event_id"]: r["id_evento"] for r in rows(store.read("dim_evento"))} == dim_ev
    # an incremental load reports its batch, not the stored tables
    b = bronze.read_bronze(spark, root, "2024-06-02")
    one = b["eventos"].where("name = 'Night One'")
    counts3 = silver.run_silver(spark, one, b["lutas"], b["lutadores"], store, full=False, anchor="2024-06-02",
                                now=dt.datetime(2024, 6, 2, 12))
    assert counts3["eventos"] == 1 and store.read("eventos").count() == 2  # older events stay, the others of the scope were stale


def test_event_on_both_lists_and_no_fighter_pages(spark):
    """One fight row per listing row; a set without rows is an empty partition, also over an earlier one."""
    root = tempfile.mkdtemp(prefix="strata-both-")
    both = page("event_upcoming.html").replace("event-details/ddd", "event-details/aaa")
    pages = landed(spark).where("kind not in ('events_upcoming', 'fighter')").unionByName(spark.createDataFrame(
        [("events_upcoming", "list", both, "2024-06-02")], "kind string, page_key string, html string, dt string"))
    run = dict(dt="2024-06-02", ingested_at="2024-06-02T10:00:00Z", full_load=True, anchor="2024-06-02")
    bronze.run_bronze(spark, landed(spark), root, **run)
    res = bronze.run_bronze(spark, pages, root, **run)
    got = sorted((r["bout_order"], r["event_status"]) for r in rows(res.fights))
    assert got == [("1", "completed"), ("1", "upcoming"), ("2", "completed"), ("2", "upcoming")]
    assert res.fighters.count() == 0 and bronze.read_bronze(spark, root, "2024-06-02")["lutadores"].count() == 0


def test_limits_are_for_full_loads_only(spark):
    root = tempfile.mkdtemp(prefix="strata-limits-")
    run = dict(dt="2024-06-02", ingested_at="t", anchor="2024-06-02")
    for limit in ("limit", "max_fights_per_event", "max_fighters"):
        with pytest.raises(ValueError, match="full_load"):
            bronze.run_bronze(spark, landed(spark), root, full_load=False, **run, **{limit: 1})
    res = bronze.run_bronze(spark, landed(spark), root, full_load=True, max_fighters=1, **run)
    assert [r["name"] for r in res.fighter_index.collect()] == ["Alpha One"]


def test_duplicate_natural_key_blocks_the_commit(spark):
    store = tables.PartitionedTables(spark, tempfile.mkdtemp(prefix="strata-dup-"))
    now = dt.datetime(2024, 1, 1)
    dup = spark.createDataFrame([(1, "e", "a", "u", now, now), (2, "e", "b", "u", now, now)], silver.DIM_EVENT)
    with pytest.raises(ValueError, match="dim_evento"):
        silver._check(store, {"dim_evento": store.stage("r1", "dim_evento", dup)})
    assert store.read("dim_evento", silver.DIM_EVENT).count() == 0 and store.recover() == []
    ok = store.stage("r2", "dim_evento", spark.createDataFrame([(1, "e", "x" * 300, "u", now, now)], silver.DIM_EVENT))
    silver._check(store, {"dim_evento": ok})
    store.commit({"run_id": "r2", "dt": "", "tipo_carga": "initial", "iniciado_em": now}, {"dim_evento": ("plain", ok.schema)})
    assert store.read("dim_evento").count() == 1 and not os.path.exists(os.path.join(store.root, "_staging", "run=r2"))


def test_land_pages_and_run_job_feed_silver(spark):
    root = tempfile.mkdtemp(prefix="strata-run-")
    pages = landed(spark).selectExpr("kind", "page_key", "'' as url", "html", "dt")
    bronze.land_pages(pages, root)
    bronze.land_pages(pages.where("kind = 'fight'"), root)  # again: replaced, not doubled
    assert bronze.read_pages(spark, root).count() == pages.count()
    path = os.path.join(root, "runs")
    batch, res = bronze.run_job(spark, bronze.read_pages(spark, root), root, path, full_load=True, dt="2024-06-02")
    store = tables.PartitionedTables(spark, os.path.join(root, "silver"))
    counts = silver.load(spark, root, store, path, dt=batch["dt"], anchor=batch["dt"], now=dt.datetime(2024, 6, 2, 12),
                         run_id=ledger.new_batch()["run_id"])
    assert counts["historico_lutas"] == 10
    audit = {r["stage"]: r["n_rows"] for r in rows(spark.read.parquet(os.path.join(root, "_audit")))}
    assert audit["bronze_lutas"] == 2 and audit["silver_historico_lutas"] == 10
    assert sorted((r["estagio"], r["tipo_carga"]) for r in rows(spark.read.parquet(path))) == [("bronze", "initial"), ("silver", "initial")]


def test_ledger_decides_load_type(spark, root):
    path = os.path.join(root, "ledger")
    ledger.record_run(spark, path, "r1", "2024-06-02", "initial", "bronze", dt.datetime(2024, 6, 2, 10))
    ledger.record_run(spark, path, "r2", "2024-06-03", "incremental", "bronze", dt.datetime(2024, 6, 3, 10))
    runs = spark.read.parquet(path)
    assert ledger.load_type_for(runs) == "incremental"
    assert ledger.load_type_for(runs, "2024-06-02") == "initial"


def test_missing_partition_is_an_error(spark, root, bronze_result):
    from strata.schemas import BRONZE_EVENTS
    from strata.sources import partitions
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        partitions.read_partition(spark, os.path.join(root, "bronze", "eventos"), "1999-01-01", BRONZE_EVENTS).count()


def test_import_page_files_and_frontier(spark, root):
    folder = os.path.join(root, "landing", "lutas")
    os.makedirs(folder, exist_ok=True)
    for key, name in (("f1", "fight.html"), ("f2", "fight_no_rounds.html")):
        with open(os.path.join(folder, f"{key}.html"), "w", encoding="utf-8") as f:
            f.write(page(name))
    pages = bronze.import_page_files(spark, os.path.join(folder, "*.html"), "fight", "2024-06-02")
    got = {r["page_key"]: r["html"] for r in pages.collect()}
    assert sorted(got) == ["f1", "f2"] and got["f1"] == page("fight.html")
    idx = spark.createDataFrame([("f1",), ("f2",), ("f3",)], "page_key string")
    assert [r[0] for r in bronze.fetch_frontier(idx, pages, "fight", "page_key").collect()] == ["f3"]
    assert bronze.fetch_frontier(idx, pages, "fight", "page_key", use_cache=False).count() == 3
    assert bronze.fetch_frontier(idx, pages, "fight", "page_key", dt="1999-01-01").count() == 3


def test_drop_obsolete_tables(spark):
    from strata.sources.tables import drop_tables, ensure_database
    ensure_database(spark, "silver_test")
    spark.range(3).write.mode("overwrite").saveAsTable("silver_test.obsolete_history")
    drop_tables(spark, "silver_test", ["obsolete_history", "never_existed"])
    assert not spark.catalog.tableExists("silver_test.obsolete_history")


def test_ledger_driven_silver_load(spark):
    root = tempfile.mkdtemp(prefix="strata-ledger-")
    bronze.run_bronze(spark, landed(spark), root, dt="2024-06-02", ingested_at="2024-06-02T10:00:00Z",
                      full_load=True, anchor="2024-06-02")
    path = os.path.join(root, "ledger2")
    ledger.record_run(spark, path, "b1", "2024-06-02", "initial", "bronze", dt.datetime(2024, 6, 2, 9))
    store = tables.PartitionedTables(spark, os.path.join(root, "silver2"))
    now = dt.datetime(2024, 6, 2, 12)
    counts = silver.load(spark, root, store, path, dt="2024-06-02", anchor="2024-06-02", now=now, run_id="s1")
    assert counts["historico_lutas"] == 10
    runs = spark.read.parquet(path)
    assert runs.where("estagio = 'silver' AND tipo_carga = 'initial'").count() == 1
    with pytest.raises(ValueError, match="older than the last silver load"):
        silver.load(spark, root, store, path, dt="2024-06-01", anchor="2024-06-02", now=now, run_id="s2")


def test_jsonl_blank_lines_skipped_bad_lines_fail(spark, tmp_path):
    from strata.schemas import BRONZE_EVENTS
    from strata.sources import partitions
    part = tmp_path / "dt=2024-01-01"
    part.mkdir()
    (part / "eventos.jsonl").write_text('{"event_id": "e1", "name": "A"}\n\n{"event_id": "e2"}\n', encoding="utf-8")
    got = partitions.read_partition(spark, str(tmp_path), "2024-01-01", BRONZE_EVENTS)
    assert sorted(r["event_id"] for r in got.collect()) == ["e1", "e2"]
    (part / "eventos.jsonl").write_text('{"event_id": "e1"}\n{not json\n', encoding="utf-8")
    with pytest.raises(Exception, match="(?i)malformed|FAILFAST|parse"):
        partitions.read_partition(spark, str(tmp_path), "2024-01-01", BRONZE_EVENTS).collect()


def test_new_batch_identity():
    b = ledger.new_batch()
    assert len(b["run_id"]) == 12 and int(b["run_id"], 16) >= 0 and len(b["dt"]) == 10
    assert ledger.new_batch("2024-06-02")["dt"] == "2024-06-02"
