"""A full load is written once and moved into place; finishing it again changes nothing."""

from __future__ import annotations

import os

from strata.sources import ledger, tables


def test_whole_table_is_moved_into_place(spark, tmp_path):
    store = tables.PartitionedTables(spark, str(tmp_path / "silver"), width=10)

    def load(df):
        batch = ledger.new_batch()
        run = {"run_id": batch["run_id"], "dt": batch["dt"], "tipo_carga": "initial", "iniciado_em": batch["started_at"]}
        store.stage(run["run_id"], "t", df, "id")
        written = {f for _, _, files in os.walk(store._staging(run["run_id"], "t")) for f in files if f.startswith("part-")}
        store.commit(run, {"t": ("table", df.schema)})
        store._apply(run["run_id"], "t", "table", df.schema)  # as recovery would after a crash
        return written

    load(spark.range(50).selectExpr("id", "'old' tag"))
    new = spark.range(25).selectExpr("if(id < 5, null, id) id", "'new' tag")
    written = load(new)
    stored = {f for _, _, files in os.walk(store.path("t")) for f in files if f.startswith("part-")}
    assert stored == written
    rows = sorted((r["id"] is None, r["id"] or 0, r["tag"]) for r in store.read("t", new.schema).collect())
    assert rows == sorted([(True, 0, "new")] * 5 + [(False, i, "new") for i in range(5, 25)])
