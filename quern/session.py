"""Session settings and the shared folder for checkpoints and written tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_local_dirs: dict[str, str] = {}


def local_session(cores: str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A single-machine session for tests and benchmarks."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("quern")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, taken from ``spark.checkpoint.dir``.

    Only a local session, where driver and executors are one process, may fall
    back to a temporary folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    sc = spark.sparkContext
    if not sc.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    app = sc.applicationId
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="quern-")
    return _local_dirs[app]


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new, unused path in the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def small_side(df: DataFrame, max_rows: int) -> DataFrame:
    """``df`` marked for broadcast if it has at most ``max_rows`` rows, else as it is.

    The wide side of a join then stays where it is, instead of being shuffled before
    adaptive execution learns how small the other side is.
    """
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


@contextmanager
def wide_rows(spark: SparkSession, batch_rows: int = 1024) -> Iterator[None]:
    """Actions inside move most of the input: they remove their shuffle files as they end, and
    Python gets ``batch_rows`` rows at once at most.

    Otherwise shuffle files stay until the driver happens to collect its garbage, beside all that
    is shuffled and written meanwhile.
    """
    rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    given = int(spark.conf.get(rows))
    wanted = {
        "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
        rows: str(min(given, batch_rows) if given > 0 else batch_rows),
    }
    before = {key: spark.conf.get(key, None) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def checkpointed(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: the rows are fixed and survive the loss of executors."""
    spark = df.sparkSession
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(shared_dir(spark))
    return df.checkpoint(eager=True)
