"""Window filters, scope/stale key sets, and full vs incremental loads.

An incremental load replaces a *scope*: every event in the batch plus every
stored event that was in scope (upcoming, or dated within the window) but is
missing from the batch ("stale"). Deleting is a ``left_anti`` join of the
stored id ranges that hold such ids; rows with a null event id are in ranges of
their own and survive, exactly as a SQL ``DELETE ... WHERE id IN (...)``
leaves them.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.dates import parse_either_date


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def lookback_filter(df: DataFrame, status, event_date, anchor: str, lookback_days: int,
                    full_load: bool = False) -> DataFrame:
    """Keep upcoming rows always; others only when dated on/after anchor - n days.

    Null dates fail the date test. No filter at all for a full load or n <= 0.
    """
    if full_load or lookback_days <= 0:
        return df
    cut = F.date_sub(F.lit(anchor).cast("date"), lookback_days)
    upcoming = F.lower(F.coalesce(_c(status), F.lit(""))) == "upcoming"
    recent = F.coalesce(_c(event_date).cast("date") >= cut, F.lit(False))
    return df.where(upcoming | recent)


def distinct_ids(df: DataFrame, id_col: str) -> DataFrame:
    return df.select(id_col).where(F.col(id_col).isNotNull()).distinct()


def scope_ids(stored_events: DataFrame, id_col: str, status_col: str, date_col: str,
              anchor: str, days: int) -> DataFrame:
    """Stored ids in scope: upcoming, or dated (dd/MM/yyyy or ISO) within ``days``."""
    cut = F.date_sub(F.lit(anchor).cast("date"), days)
    in_scope = (F.coalesce(F.col(status_col) == "upcoming", F.lit(False))
                | F.coalesce(parse_either_date(F.col(date_col)) >= cut, F.lit(False)))
    return distinct_ids(stored_events.where(in_scope), id_col)


def stale_ids(scope: DataFrame, current: DataFrame, id_col: str) -> DataFrame:
    """In scope but absent from the batch."""
    return scope.join(current, id_col, "left_anti")


# The event-keyed tables, the person table, and their ids.
EVENT_TABLES = ("eventos", "lutas", "historico_lutas")
PERSON_TABLE = "lutadores"
EVENT_ID, PERSON_ID = "id_evento", "id_lutador"
TABLE_IDS = {**dict.fromkeys(EVENT_TABLES, EVENT_ID), PERSON_TABLE: PERSON_ID}


def deleted_ids(stored_events: DataFrame, batch_events: DataFrame, *, anchor: str, days: int,
                status_col: str = "status", date_col: str = "data_evento") -> DataFrame:
    """Event ids whose stored rows go: the batch's and the stale ones of the scope."""
    current = distinct_ids(batch_events, EVENT_ID)
    scope = scope_ids(stored_events, EVENT_ID, status_col, date_col, anchor, days)
    return current.union(stale_ids(scope, current, EVENT_ID)).distinct()


def merge_frames(store, batch: Mapping[str, DataFrame], *, anchor: str, days: int = 30) -> dict[str, tuple]:
    """What replacing the batch's scope makes of the stored tables: {table: (rows, touched ranges)}.

    Event-keyed tables lose the deleted event ids, the person table the batch's person ids; the
    batch is added. A range is touched if it holds a deleted id or gets a row. Only touched ranges
    are read (the partitions of others are pruned); rows without an id are never deleted, so the
    batch's are only added.
    """
    deleted = materialize(deleted_ids(store.read("eventos", batch["eventos"].schema), batch["eventos"],
                                      anchor=anchor, days=days), "delete-ids")
    people = materialize(distinct_ids(batch[PERSON_TABLE], PERSON_ID), "delete-people")
    gone = {**dict.fromkeys(EVENT_TABLES, deleted), PERSON_TABLE: people}
    out = {}
    for table, id_col in TABLE_IDS.items():
        new = batch[table]
        touched = materialize(store.ranges(gone[table].unionByName(new.select(id_col)), id_col), f"ranges-{table}")
        stored = store.read_ranges(table, touched, new.schema)
        out[table] = (stored.join(gone[table], id_col, "left_anti").select(*new.columns).unionByName(new), touched)
    return out


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared checkpoint folder and read it back.

    Used for the delete-id sets, which several joins read: each is computed
    once, and a retried task sees exactly the same set.
    """
    from strata.session import workspace_path
    path = workspace_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def load(store, batch: Mapping[str, DataFrame], run: Mapping[str, object], *, full: bool, anchor: str, days: int = 30,
         more: Mapping[str, tuple] | None = None, check=None) -> None:
    """Load a batch as the run ``run``: the tables replaced by it (``full``), or its scope replaced in them.

    ``more``: further staged tables of the same run, as ``commit`` takes them. ``check`` gets the
    staged rows by table before anything stored is touched, and may raise.
    """
    staged, frames = dict(more or {}), {}
    if full:
        for table, df in batch.items():
            frames[table] = store.stage(run["run_id"], table, df, TABLE_IDS[table])
            staged[table] = ("table", df.schema)
    else:
        for table, (df, touched) in merge_frames(store, batch, anchor=anchor, days=days).items():
            frames[table] = store.stage(run["run_id"], table, df, TABLE_IDS[table], touched)
            staged[table] = ("ranges", df.schema)
    if check:
        check(frames)
    store.commit(run, staged)
