"""Column groups that share a bucketed, sorted layout, so adding columns costs readers no shuffle.

The base rows and each group of added columns are Parquet tables bucketed by the key into the same
number of buckets, partitioned by the version that wrote them. A read joins only the groups of the
columns asked for, bucket by bucket: the plan has sort-merge joins and no exchange, whatever the
width of the rows. Appended rows and fills of more keys are new partitions; nothing is rewritten.
One writer per table is assumed. The tables are external: a new session registers them again from
the log beside the data.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LOG_SCHEMA = "version int, part string, key string, buckets int, schema string, rows bigint"
BASE = "base"
VERSION = "_version"


@dataclass(frozen=True)
class Entry:
    version: int
    part: str
    key: str
    buckets: int
    schema: str
    rows: int


class BucketedTable:
    """A table under ``root``: base rows and column groups, read together without a shuffle."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._names: dict[str, str] = {}
        spark.createDataFrame([], LOG_SCHEMA).write.mode("append").parquet(f"{self.root}/_log")
        rows = spark.read.schema(LOG_SCHEMA).parquet(f"{self.root}/_log").orderBy("version").collect()  # one per commit
        self.log = [Entry(**r.asDict()) for r in rows]
        self._noted = {e.version for e in self.log}

    @property
    def version(self) -> int:
        return self.log[-1].version if self.log else 0

    def create(self, df: DataFrame, key: str, buckets: int) -> None:
        """Writes the base rows; keys are unique and not null."""
        if self.log:
            raise ValueError(f"there is a table at {self.root}")
        self._commit(BASE, df, key, buckets)

    def append(self, df: DataFrame) -> None:
        """More rows with the base schema."""
        base = self._schema(BASE)
        fitted = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in base])
        self._commit(BASE, fitted, self.log[0].key, self.log[0].buckets)

    def add_columns(self, df: DataFrame) -> None:
        """A column group: the key and columns of its own, for all keys or some.

        Columns written together form a group; of a key written again the later values count, NULL
        included.
        """
        key = self.log[0].key
        columns = sorted(c for c in df.columns if c != key)
        taken = {c: p for p in self._parts() for c in self._schema(p).fieldNames() if c != key}
        group = next((taken[c] for c in columns if c in taken), f"group_{len(self._parts())}")
        if group == BASE or (group in self._parts() and columns != sorted(set(self._schema(group).fieldNames()) - {key})):
            raise ValueError(f"columns {columns} are not a group of their own")
        self._commit(group, df.select(key, *columns), key, self.log[0].buckets)

    def read(self, columns: list[str] | None = None, version: int | None = None) -> DataFrame:
        """The key and the columns asked for (all by default), at a version."""
        key = self.log[0].key
        version = self.version if version is None else version
        table = self._scan(BASE, version)
        for part in self._parts(version):
            if part == BASE:
                continue
            own = [c for c in self._schema(part).fieldNames() if c != key and (columns is None or c in columns)]
            if own:
                table = table.join(self._latest(part, own, version), key, "left")
        return table.drop(VERSION) if columns is None else table.select(key, *[c for c in columns if c != key])

    def _latest(self, part: str, columns: list[str], version: int) -> DataFrame:
        key, rows = self.log[0].key, self._scan(part, version)
        if sum(e.part == part and e.version <= version for e in self.log) > 1:
            # Grouping by the bucketed key needs no shuffle either.
            last = F.max_by(F.struct(*columns), F.col(VERSION)).alias("_last")
            rows = rows.groupBy(key).agg(last).select(key, *[F.col(f"_last.{c}").alias(c) for c in columns])
        return rows.select(key, *columns)

    def _parts(self, version: int | None = None) -> list[str]:
        return list(dict.fromkeys(e.part for e in self.log if version is None or e.version <= version))

    def _schema(self, part: str) -> T.StructType:
        return T.StructType.fromJson(json.loads(next(e.schema for e in self.log if e.part == part)))

    def _scan(self, part: str, version: int) -> DataFrame:
        return self.spark.table(self._registered(part)).where(F.col(VERSION) <= version)

    def _registered(self, part: str) -> str:
        """Name of the part's table in this session's catalog."""
        if part not in self._names:
            name = f"quern_{part}_{uuid.uuid4().hex[:12]}"
            schema = self._schema(part)
            fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
            entry = self.log[0]
            self.spark.sql(
                f"CREATE TABLE {name} ({fields}, {VERSION} INT) USING parquet PARTITIONED BY ({VERSION}) "
                f"CLUSTERED BY (`{entry.key}`) SORTED BY (`{entry.key}`) INTO {entry.buckets} BUCKETS "
                f"LOCATION '{self.root}/{part}'")
            if any(e.part == part and e.version in self._noted for e in self.log):
                self.spark.catalog.recoverPartitions(name)
            self._names[part] = name
        return self._names[part]

    def _commit(self, part: str, df: DataFrame, key: str, buckets: int) -> None:
        version = self.version + 1
        if not self.log or part not in self._parts():
            self.log.append(Entry(version, part, key, buckets, df.schema.json(), 0))
        else:
            self.log.append(Entry(version, part, key, buckets, self._schema(part).json(), 0))
        name = self._registered(part)
        # The one shuffle is here, on the way in: a bucket is written by one task.
        dealt = df.repartition(buckets, key).withColumn(VERSION, F.lit(version))
        dealt.write.format("parquet").mode("append").partitionBy(VERSION).bucketBy(buckets, key).sortBy(key).saveAsTable(name)
        self.spark.catalog.refreshTable(name)
        rows = self.spark.table(name).where(F.col(VERSION) == version).count()
        self.log[-1] = Entry(version, part, key, buckets, self.log[-1].schema, rows)
        note = [tuple(self.log[-1].__dict__.values())]
        self.spark.createDataFrame(note, LOG_SCHEMA).coalesce(1).write.mode("append").parquet(f"{self.root}/_log")
