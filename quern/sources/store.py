"""Versioned Parquet tables: appends, added column groups, snapshots and views.

A table is a list of immutable parts. Every commit writes new files and one
manifest row; nothing that exists is rewritten, so old versions stay readable.
One writer per table is assumed.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass
from urllib.parse import quote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MANIFEST_SCHEMA = (
    "name string, version bigint, kind string, path string, rows bigint, "
    "columns array<string>, key string, source string, filter string, source_version bigint, "
    "batch string, schema string, covers bigint"
)

# Kinds of commit. ``create`` and ``append`` add rows; ``columns`` adds a column
# group for keys that had none, ``recompute`` replaces one; ``drop_columns``
# hides columns; ``drop`` ends the table.
CREATE, APPEND, COLUMNS, RECOMPUTE, DROP_COLUMNS, DROP = (
    "create", "append", "columns", "recompute", "drop_columns", "drop",
)


def _literal(value) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


@dataclass(frozen=True)
class Commit:
    name: str
    version: int
    kind: str
    path: str | None = None
    rows: int | None = None
    columns: tuple[str, ...] = ()
    key: str | None = None
    source: str | None = None
    filter: str | None = None
    source_version: int | None = None
    batch: str | None = None
    schema: str | None = None
    # Version up to which all rows are settled for the columns of this commit.
    covers: int | None = None


class TableStore:
    """Tables under one folder that all executors can reach."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._log = f"{self.root}/_manifest"
        spark.createDataFrame([], MANIFEST_SCHEMA).write.mode("append").parquet(self._log)
        self.reopen()

    # --- manifest ------------------------------------------------------------

    def manifest(self) -> DataFrame:
        """All commits; one row each, so bounded by the number of commits."""
        return self.spark.read.schema(MANIFEST_SCHEMA).parquet(self._log)

    def reopen(self) -> None:
        """Read the manifest again, to see commits made through another handle."""
        self._known = [
            Commit(**{**r.asDict(), "columns": tuple(r["columns"] or ())})
            for r in self.manifest().collect()
        ]

    def _commits(self, name: str | None = None) -> list[Commit]:
        found = [c for c in self._known if name is None or c.name == name]
        return sorted(found, key=lambda c: (c.name, c.version))

    def _commit(self, commit: Commit) -> None:
        values = {**commit.__dict__, "columns": F.array(*[F.lit(c) for c in commit.columns])}
        fields = T._parse_datatype_string(MANIFEST_SCHEMA)
        row = self.spark.range(1, numPartitions=1).select(
            *[_literal(values[f.name]).cast(f.dataType).alias(f.name) for f in fields]
        )
        row.write.mode("append").parquet(self._log)
        self._known.append(commit)

    def _live(self, name: str, version: int | None = None) -> list[Commit]:
        """Commits since the table was last created, up to a version."""
        log = self._commits(name)
        if version is not None:
            log = [c for c in log if c.version <= version]
        starts = [i for i, c in enumerate(log) if c.kind == CREATE]
        if not starts or log[-1].kind == DROP:
            raise KeyError(f"no table {name!r}" + (f" at version {version}" if version else ""))
        return log[starts[-1] :]

    def exists(self, name: str) -> bool:
        return name in self.tables()

    def version(self, name: str) -> int:
        return self._live(name)[-1].version

    def key(self, name: str) -> str:
        return self._live(name)[0].key

    def tables(self) -> list[str]:
        last: dict[str, str] = {}
        for c in self._commits():
            last[c.name] = c.kind
        return sorted(n for n, kind in last.items() if kind != DROP)

    def views(self) -> list[str]:
        """Tables created from a definition; split tables and parents are not views."""
        live = set(self.tables())
        defined = {c.name: c.source for c in self._commits() if c.kind == CREATE}
        return sorted(n for n in live if defined[n] is not None)

    # --- rows ----------------------------------------------------------------

    def part_path(self, name: str) -> str:
        return f"{self.root}/{quote(name, safe='')}/{uuid.uuid4().hex[:12]}"

    def _write(self, df: DataFrame, name: str) -> tuple[str, int]:
        """Write a part; returns its path and rows, read from its footers."""
        path = self.part_path(name)
        df.write.mode("error").parquet(path)
        return path, self.spark.read.schema(df.schema).parquet(path).count()

    def _parts(self, commits: list[Commit]) -> DataFrame:
        """The rows of some parts that share a schema; the manifest gives the schema,
        so no footer is read to plan."""
        schema = T.StructType.fromJson(json.loads(commits[0].schema))
        return self.spark.read.schema(schema).parquet(*[c.path for c in commits])

    def _next(self, name: str) -> int:
        log = self._commits(name)
        return log[-1].version + 1 if log else 1

    def create(
        self,
        name: str,
        df: DataFrame,
        key: str,
        overwrite: bool = False,
        source: str | None = None,
        filter: str | None = None,
        source_version: int | None = None,
    ) -> Commit:
        """Write a table from ``df``; replacing one needs ``overwrite``."""
        if not overwrite and self.exists(name):
            raise ValueError(f"table {name!r} exists")
        path, rows = self._write(df, name)
        return self.adopt(name, path, rows, df.schema, key, source, filter, source_version)

    def adopt(
        self,
        name: str,
        path: str,
        rows: int,
        schema: T.StructType,
        key: str,
        source: str | None = None,
        filter: str | None = None,
        source_version: int | None = None,
    ) -> Commit:
        """Make files already written under the store the only part of a table."""
        commit = Commit(
            name, self._next(name), CREATE, path, rows, tuple(schema.fieldNames()), key,
            source, filter, source_version, schema=schema.json(),
        )
        self._commit(commit)
        return commit

    def append(
        self,
        name: str,
        df: DataFrame,
        batch: str | None = None,
        source_version: int | None = None,
    ) -> Commit | None:
        """Add rows with the base schema of the table. A ``batch`` already committed
        is skipped, so a repeated delivery adds nothing."""
        live = self._live(name)
        if batch is not None and any(c.batch == batch for c in live):
            return None
        base = T.StructType.fromJson(json.loads(live[0].schema))
        missing = set(base.fieldNames()) - set(df.columns)
        if missing:
            raise ValueError(f"missing required columns: {sorted(missing)}")
        fitted = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in base])
        path, rows = self._write(fitted, name)
        previous = live[0]
        commit = Commit(
            name, live[-1].version + 1, APPEND, path, rows,
            tuple(base.fieldNames()), previous.key, previous.source, previous.filter,
            source_version, batch, live[0].schema,
        )
        self._commit(commit)
        return commit

    def ingest(self, name: str, df: DataFrame, key: str, overwrite: bool = False) -> DataFrame:
        """Create, replace or append; one row (added, total, version)."""
        if overwrite or not self.exists(name):
            commit = self.create(name, df, key, overwrite=True)
        else:
            commit = self.append(name, df)
        total = sum(c.rows for c in self._live(name) if c.kind in (CREATE, APPEND))
        return self.spark.createDataFrame(
            [(name, commit.rows, total, commit.version)],
            "name string, added bigint, total bigint, version bigint",
        )

    def delete_where(self, name: str, condition: str) -> DataFrame:
        """New snapshot without the rows that satisfy ``condition``; one row (before, after)."""
        before = sum(c.rows for c in self._live(name) if c.kind in (CREATE, APPEND))
        kept = self.read(name).where(f"NOT coalesce({condition}, false)")
        commit = self.create(name, kept, self.key(name), overwrite=True)
        return self.spark.createDataFrame(
            [(name, before, commit.rows, commit.version)],
            "name string, before bigint, after bigint, version bigint",
        )

    # --- columns -------------------------------------------------------------

    def add_columns(
        self,
        name: str,
        df: DataFrame,
        recompute: bool = False,
        batch: str | None = None,
        covers: int | None = None,
    ) -> Commit | None:
        """Add a column group: ``df`` has the key and the new columns only.

        ``covers`` says that with this commit every row up to that version is settled,
        whatever its value. A group that exists gets no commit without rows.
        """
        live = self._live(name)
        key = live[0].key
        columns = tuple(c for c in df.columns if c != key)
        path, rows = self._write(df, name)
        if not rows and not recompute and all(c in self._groups(live) for c in columns):
            return None
        kind = RECOMPUTE if recompute else COLUMNS
        commit = Commit(
            name, live[-1].version + 1, kind, path, rows, columns, key, batch=batch,
            schema=df.schema.json(), covers=covers,
        )
        self._commit(commit)
        return commit

    def adopt_columns(self, name: str, path: str, rows: int, schema: T.StructType, covers: int) -> Commit:
        """Make files already written under the store a column group; its folders may be ranges."""
        live = self._live(name)
        columns = tuple(c for c in schema.fieldNames() if c != live[0].key)
        commit = Commit(
            name, live[-1].version + 1, COLUMNS, path, rows, columns, live[0].key, schema=schema.json(), covers=covers)
        self._commit(commit)
        return commit

    def settled(self, name: str, columns: list[str]) -> int:
        """Version up to which every row has all the columns; 0 if there is none."""
        groups = self._groups(self._live(name))
        return min(
            max((c.covers or 0 for c in groups.get(column, [])), default=0) for column in columns
        )

    def drop_columns(self, name: str, columns: list[str]) -> list[str]:
        """Hide added columns; returns those that existed."""
        live = self._live(name)
        present = [c for c in columns if c in self._groups(live)]
        if present:
            self._commit(
                Commit(name, live[-1].version + 1, DROP_COLUMNS, columns=tuple(present), key=live[0].key)
            )
        return present

    @staticmethod
    def _groups(live: list[Commit]) -> dict[str, list[Commit]]:
        """Added column to the commits that hold it, oldest first."""
        groups: dict[str, list[Commit]] = {}
        for c in live:
            if c.kind == COLUMNS:
                for col in c.columns:
                    groups[col] = [*groups.get(col, []), c]
            elif c.kind == RECOMPUTE:
                for col in c.columns:
                    groups[col] = [c]
            elif c.kind == DROP_COLUMNS:
                for col in c.columns:
                    groups.pop(col, None)
        return groups

    def columns_by_parts(self, name: str, columns: list[str]) -> list[list[str]]:
        """The named columns, grouped by the files that hold them so far."""
        groups = self._groups(self._live(name))
        shared: dict[tuple[str, ...], list[str]] = {}
        for column in columns:
            shared.setdefault(tuple(c.path for c in groups.get(column, [])), []).append(column)
        return list(shared.values())

    def added(self, name: str, columns: list[str], since: int = 0) -> DataFrame | None:
        """(key, columns) rows computed so far, or None before the first commit.

        The columns must be held by the same files; ``since`` leaves out older ones.
        """
        live = self._live(name)
        parts = [c for c in self._groups(live).get(columns[0], []) if c.version > since]
        return self._group_frame(parts, live[0].key, columns) if parts else None

    def _group_frame(self, parts: list[Commit], key: str, columns: list[str]) -> DataFrame:
        frame = None
        for commit in parts:
            version = F.lit(commit.version).alias("_version")
            part = self._parts([commit]).select(key, *columns, version)
            frame = part if frame is None else frame.unionByName(part)
        if len(parts) == 1:
            return frame.drop("_version")
        # Of a key filled twice the latest value counts; keys are unique per part.
        latest = [
            F.max_by(c, F.when(F.col(c).isNotNull(), F.col("_version"))).alias(c) for c in columns
        ]
        return frame.groupBy(key).agg(*latest)

    def read(self, name: str, version: int | None = None, since: int = 0) -> DataFrame:
        """The table at a version; added columns are joined on the key.

        With ``since`` only rows appended after that version, from the files written
        after it; columns that none of these files holds are NULL.

        Columns that share the same files are joined once. A query that uses none
        of a group's columns still keeps every row, so Spark drops the join's
        columns but not the join; use ``read_base`` when only base columns matter.
        """
        live = self._live(name, version)
        table = self._base(live, since)
        by_parts: dict[tuple[Commit, ...], list[str]] = {}
        for col, parts in self._groups(live).items():
            newer = tuple(c for c in parts if c.version > since)
            by_parts.setdefault(newer, []).append(col)
            if not newer:
                kind = T.StructType.fromJson(json.loads(parts[-1].schema))[col].dataType
                table = table.withColumn(col, F.lit(None).cast(kind))
        by_parts.pop((), None)
        for parts, columns in by_parts.items():
            group = self._group_frame(list(parts), live[0].key, columns)
            table = table.join(group, live[0].key, "left")
        return table

    def _base(self, live: list[Commit], since: int = 0) -> DataFrame:
        parts = [c for c in live if c.kind in (CREATE, APPEND)]
        newer = [c for c in parts if c.version > since]
        return self._parts(newer) if newer else self._parts(parts[:1]).where("false")

    def read_base(self, name: str, version: int | None = None, since: int = 0) -> DataFrame:
        """The rows without added columns: one scan, no join."""
        return self._base(self._live(name, version), since)

    # --- reports -------------------------------------------------------------

    def history(self, name: str) -> DataFrame:
        """(version, kind, rows) of a table's commits."""
        rows = self.manifest().where(F.col("name") == name)
        return rows.select("name", "version", "kind", "rows")

    def drop(self, name: str) -> None:
        """End a table; its files and versions stay."""
        self._commit(Commit(name, self._next(name), DROP))

    def row_counts(self) -> dict[str, tuple[int, int]]:
        """Rows and version of every table, from the manifest alone."""
        counts = {}
        for name in self.tables():
            live = self._live(name)
            rows = sum(c.rows for c in live if c.kind in (CREATE, APPEND))
            counts[name] = (rows, live[-1].version)
        return counts
