"""Computing derived columns only where they are missing."""

from __future__ import annotations

from pyspark.sql import DataFrame

from quern.functions.frames import Feature
from quern.operators.dedup import flag_near_duplicates
from quern.operators.fills import run_fill
from quern.schema import HAMMING_THRESHOLD, require_columns
from quern.sources.store import TableStore


def pending(
    store: TableStore, table: str, columns: list[str], inputs: list[str], version: int | None = None
) -> DataFrame:
    """(key, inputs) of the rows for which the columns were never computed.

    Rows up to the version that earlier fills settled are not read; of newer rows, those
    whose key a later file holds are left out, whatever its value. The columns must be
    held by the same files. Rows appended after ``version`` are left out.
    """
    key = store.key(table)
    since = store.settled(table, columns)
    base = store.read_base(table, version, since)
    source = base if set(inputs) <= set(base.columns) else store.read(table, version, since)
    require_columns(source, inputs)
    rows = source.select(key, *[c for c in inputs if c != key])
    done = store.added(table, columns, since)
    return rows if done is None else rows.join(done.select(key), key, "left_anti")


def backfill(
    store: TableStore,
    table: str,
    columns: list[str],
    registry: dict[str, Feature],
    overwrite: bool = False,
    task_rows: int | None = None,
    one_at_a_time: bool = False,
    checkpoint_rows: int | None = None,
    most_ranges: int | None = None,
) -> DataFrame:
    """Fill the named columns where they are missing; (column_name, status, rows).

    ``overwrite`` computes all rows anew and replaces the columns once that is done. Columns at the same stage share a scan and a commit; ``one_at_a_time`` commits
    each on its own, so that a run with slow functions resumes between them.
    ``task_rows`` bounds the rows of a task. Unregistered names are skipped.

    With ``checkpoint_rows`` a fill is cut into ranges of about so many rows, each of which is kept
    once written: a run that was stopped, or that stops itself after ``most_ranges`` ranges
    (status OPEN), is gone on with by the next call. Its rows are those computed by this call.
    """
    known = [c for c in columns if c in registry]
    report = [(c, "SKIP", 0) for c in columns if c not in registry]
    groups = [[c] for c in known] if one_at_a_time else store.columns_by_parts(table, known)
    for group in groups:
        inputs = sorted({i for c in group for i in registry[c].inputs})
        version = store.version(table)
        if checkpoint_rows and not overwrite:
            commit, rows_now = run_fill(
                store, table, group, lambda at, g=group, i=inputs: pending(store, table, g, i, at),
                lambda some, g=group: some.select(store.key(table), *[registry[c].column().alias(c) for c in g]),
                checkpoint_rows, task_rows, most_ranges)
            status = "DONE" if commit or not rows_now else "OPEN"
            report += [(c, status, rows_now) for c in group]
            continue
        if overwrite:
            rows = store.read(table).select(store.key(table), *[i for i in inputs if i != store.key(table)])
        else:
            rows = pending(store, table, group, inputs)
        if task_rows:
            rows = rows.repartition(max(1, -(-rows.count() // task_rows)))
        computed = rows.select(
            store.key(table), *[registry[c].column().alias(c) for c in group]
        )
        commit = store.add_columns(table, computed, recompute=overwrite, covers=version)
        report += [(c, "DONE", commit.rows if commit else 0) for c in group]
    return store.spark.createDataFrame(report, "column_name string, status string, rows bigint")


def backfill_near_duplicates(
    store: TableStore,
    table: str,
    hash_col: str = "dhash_bits",
    threshold: int = HAMMING_THRESHOLD,
    overwrite: bool = False,
) -> int:
    """Fill ``is_duplicate``. Rows flagged before keep their flag, so a copy that
    arrives later does not change its original; ``overwrite`` flags all rows anew."""
    key, version = store.key(table), store.version(table)
    todo = None if overwrite else pending(store, table, ["is_duplicate"], [hash_col]).select(key)
    flags = flag_near_duplicates(store.read(table), key, hash_col, threshold, only=todo)
    commit = store.add_columns(table, flags, recompute=overwrite, covers=version)
    return commit.rows if commit else 0
