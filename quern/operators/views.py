"""Filtered views of a stored table: create, refresh, list, drop."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.operators.filters import SUMMARY_BBOX_PCT, dedup_clause, spec_filter
from quern.sources.store import APPEND, COLUMNS, CREATE, TableStore

# The standing views, without and with the person-area column.
ANNOTATION_VIEWS = {
    f"{spec}_{split}": f"{spec_filter(spec)} AND split = '{split}'"
    for spec in ("nighttime_person", "rider", "nighttime_rider")
    for split in ("train", "val")
}
PERSON_VIEWS = {
    f"distant_person_{split}": (
        f"{spec_filter('distant_person', SUMMARY_BBOX_PCT)} AND split = '{split}'"
    )
    for split in ("train", "val")
}
EXPECTED_VIEWS = [
    f"{spec}_{split}"
    for spec in ("rider", "nighttime_person", "distant_person")
    for split in ("train", "val")
]


def create_view(store: TableStore, name: str, source: str, condition: str) -> None:
    """Materialize a filter under a name; an existing view is rebuilt with this filter.

    Train views also leave out flagged copies.
    """
    table = store.read(source)
    full = condition + dedup_clause(table, name)
    store.create(
        name, table.where(full), store.key(source), True, source, full, store.version(source)
    )


def create_views(store: TableStore, source: str, views: dict[str, str]) -> None:
    """Materialize several filters in one scan of the source.

    Each row is written once per view it belongs to, into the folder of that view.
    """
    table = store.read(source)
    full = {name: sql + dedup_clause(table, name) for name, sql in views.items()}
    # Folders are named by numbers, so a view's name may hold any character.
    names = F.array(*[F.when(F.expr(sql), F.lit(number)) for number, sql in enumerate(full.values())])
    path = store.part_path("_views")
    marked = table.withColumn("_view", F.explode(F.array_compact(names)))
    marked.write.partitionBy("_view").parquet(path)
    stored = store.spark.read.schema(marked.schema).parquet(path)
    counts = {r["_view"]: r["count"] for r in stored.groupBy("_view").count().collect()}
    key, version = store.key(source), store.version(source)
    for number, (name, sql) in enumerate(full.items()):
        if number in counts:
            part = f"{path}/_view={number}"
            store.adopt(name, part, counts[number], table.schema, key, source, sql, version)
        else:
            store.create(name, table.where("false"), key, True, source, sql, version)


def materialize_spec(
    store: TableStore, source: str, spec: str, name: str | None = None,
    bbox_pct: float = SUMMARY_BBOX_PCT,
) -> str:
    """View of a named filter; refreshed with its stored filter if it exists."""
    name = name or f"{source}_{spec}"
    if store.exists(name):
        refresh_view(store, name)
    else:
        create_view(store, name, source, spec_filter(spec, bbox_pct))
    return name


def refresh_view(store: TableStore, name: str, full: bool = False) -> tuple[int, int]:
    """Apply the stored filter to the source's current rows; returns rows before, after.

    Rows appended to the source since the last refresh are filtered and added, read
    from the files written since. The view is rewritten if anything else happened to
    the source: a column that the view lacks, a value filled or computed anew for a row
    that was there at the last refresh, or rows removed; or if ``full``.
    """
    live = store._live(name)
    rows = [c for c in live if c.kind in (CREATE, APPEND)]
    definition, before = live[0], sum(c.rows for c in rows)
    source = definition.source
    seen = max(c.source_version for c in rows)
    source_version = store.version(source)
    if source_version == seen and not full:
        return before, before
    if full or not _only_new_rows(store, source, seen, store.read_base(name).columns):
        matching = store.read(source).where(definition.filter)
        commit = store.create(
            name, matching, definition.key, True, source, definition.filter, source_version
        )
        return before, commit.rows
    added = store.read(source, since=seen).where(definition.filter)
    commit = store.append(name, added, source_version=source_version)
    return before, before + commit.rows


def _only_new_rows(store: TableStore, source: str, seen: int, columns: list[str]) -> bool:
    """Whether all changes after a version concern rows appended after it."""
    changes = [c for c in store._commits(source) if c.version > seen]
    if any(c.kind not in (APPEND, COLUMNS) for c in changes):
        return False
    if set(store.read(source).columns) != set(columns):
        return False
    filled = [c for c in changes if c.kind == COLUMNS]
    if not filled:
        return True
    # Only the files written since are read: keys that got values but are not new.
    key = store.key(source)
    new_keys = store.read_base(source, since=seen).select(key)
    for commit in filled:
        keys = store._parts([commit]).select(key)
        if not keys.join(new_keys, key, "left_anti").isEmpty():
            return False
    return True


def refresh_views(store: TableStore, full: bool = False) -> DataFrame:
    """Refresh every view; (name, before, after, delta)."""
    rows = []
    for name in store.views():
        before, after = refresh_view(store, name, full)
        rows.append((name, before, after, after - before))
    return store.spark.createDataFrame(
        rows, "name string, before bigint, after bigint, delta bigint"
    )


def view_status(store: TableStore, source: str) -> DataFrame:
    """(name, rows, version, is_source) of the source and its views."""
    counts = store.row_counts()
    names = [source, *store.views()]
    rows = [(n, counts[n][0], counts[n][1], n == source) for n in names if n in counts]
    return store.spark.createDataFrame(
        rows, "name string, rows bigint, version bigint, is_source boolean"
    )


def drop_views(store: TableStore) -> list[str]:
    """Drop every view; the source stays."""
    dropped = store.views()
    for name in dropped:
        store.drop(name)
    return dropped
