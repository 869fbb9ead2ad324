"""Fills that resume where they stopped: a ledger of key ranges, each noted when it is written.

A fill cuts the keys it has to compute into ranges of about ``checkpoint_rows`` rows and notes them
in the ledger before it starts. A range is written to a folder of its own and then noted as done, so
a run that dies leaves at most one range to compute again, and a later run goes on with the ranges
that are not done. When all are, one commit makes the whole folder a part of the table; readers
never see half a fill, and the table's log grows by one row however many ranges there were.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.sources.store import Commit, TableStore

LEDGER_SCHEMA = (
    "fill string, table string, columns string, version bigint, path string, number int, "
    "lower string, upper string, done boolean, rows bigint"
)


@dataclass(frozen=True)
class Fill:
    """A fill that was begun: its folder, the version it covers, its ranges and which are done."""

    id: str
    version: int
    path: str
    ranges: tuple[tuple[int, str | None, str | None], ...]
    done: dict[int, int]


def _ledger(store: TableStore) -> str:
    return f"{store.root}/_fills"


def ledger(store: TableStore) -> DataFrame:
    """All notes, a row for each range that was planned and each that was done."""
    store.spark.createDataFrame([], LEDGER_SCHEMA).write.mode("append").parquet(_ledger(store))
    return store.spark.read.schema(LEDGER_SCHEMA).parquet(_ledger(store))


def _note(store: TableStore, rows: list[tuple]) -> None:
    store.spark.createDataFrame(rows, LEDGER_SCHEMA).coalesce(1).write.mode("append").parquet(_ledger(store))


def open_fill(store: TableStore, table: str, columns: list[str]) -> Fill | None:
    """The fill of these columns that was begun and not committed, if there is one."""
    name = ",".join(sorted(columns))
    notes = ledger(store).where((F.col("table") == table) & (F.col("columns") == name)).collect()  # one per range
    committed = {c.path for c in store._live(table)}
    for fill in sorted({n["fill"] for n in notes}):
        own = [n for n in notes if n["fill"] == fill]
        if own[0]["path"] not in committed and own[0]["version"] >= store._live(table)[0].version:
            plan = sorted(((n["number"], n["lower"], n["upper"]) for n in own if not n["done"]), key=lambda r: r[0])
            return Fill(fill, own[0]["version"], own[0]["path"], tuple(plan), {n["number"]: n["rows"] for n in own if n["done"]})
    return None


def begin_fill(store: TableStore, table: str, columns: list[str], rows: DataFrame, checkpoint_rows: int) -> Fill | None:
    """Cuts the keys of ``rows`` into ranges and notes them; None if there are no rows."""
    key = store.key(table)
    total = rows.count()
    if not total:
        return None
    count = -(-total // checkpoint_rows)
    keys = rows.select(key).repartitionByRange(count, key)
    lows = keys.groupBy(F.spark_partition_id().alias("number")).agg(F.min(key).alias("low"))
    starts = [r["low"] for r in lows.orderBy("low").select(F.col("low").cast("string")).collect()]  # one per range
    # The first range has no lower end and the last no upper one.
    ends = [None, *starts[1:], None]
    fill = Fill(uuid.uuid4().hex[:12], store.version(table), store.part_path(table),
                tuple((i, ends[i], ends[i + 1]) for i in range(len(starts))), {})
    name = ",".join(sorted(columns))
    _note(store, [(fill.id, table, name, fill.version, fill.path, n, low, high, False, None) for n, low, high in fill.ranges])
    return fill


def in_range(key: str, kind: str, low: str | None, high: str | None) -> Column:
    """Whether a key lies in a range; plain comparisons, so the files' statistics rule out the rest."""
    inside = F.lit(True)
    if low is not None:
        inside = inside & (F.col(key) >= F.lit(low).cast(kind))
    if high is not None:
        inside = inside & (F.col(key) < F.lit(high).cast(kind))
    return inside


def run_fill(
    store: TableStore,
    table: str,
    columns: list[str],
    pending: Callable[[int | None], DataFrame],
    compute: Callable[[DataFrame], DataFrame],
    checkpoint_rows: int,
    task_rows: int | None = None,
    most_ranges: int | None = None,
) -> tuple[Commit | None, int]:
    """Goes on with the open fill of ``columns``, or begins one; (its commit, rows computed now).

    ``pending`` gives the rows to compute as of a version, ``compute`` their values. With
    ``most_ranges`` a run stops after so many ranges and leaves the rest to the next; there is no
    commit before the last range is done.
    """
    fill = open_fill(store, table, columns) or begin_fill(store, table, columns, pending(None), checkpoint_rows)
    if fill is None:
        return None, 0
    rows = pending(fill.version)
    key = store.key(table)
    kind = rows.schema[key].dataType.simpleString()
    todo = [r for r in fill.ranges if r[0] not in fill.done]
    now, done = 0, dict(fill.done)
    name = ",".join(sorted(columns))
    for number, low, high in todo[:most_ranges]:
        part = rows.where(in_range(key, kind, low, high))
        if task_rows:
            part = part.repartition(max(1, -(-part.count() // task_rows)))
        values = compute(part)
        path = f"{fill.path}/fill_range={number}"
        values.write.mode("overwrite").parquet(path)  # what a dead run left of this range goes
        done[number] = store.spark.read.schema(values.schema).parquet(path).count()
        now += done[number]
        _note(store, [(fill.id, table, name, fill.version, fill.path, number, low, high, True, done[number])])
    if len(done) < len(fill.ranges):
        return None, now
    schema = compute(rows.limit(0)).schema
    return store.adopt_columns(table, fill.path, sum(done.values()), schema, fill.version), now
