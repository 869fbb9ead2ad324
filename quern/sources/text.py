"""Text records from JSON or Parquet shards."""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quern.operators.ordering import before
from quern.schema import CORPUS_SCHEMA, conform
from quern.session import checkpointed, small_side

# Files whose layout is sent to every executor: a path and two numbers each.
BROADCAST_FILES = 100_000
# Requested positions that are sent to every executor: a path and three numbers each.
BROADCAST_REQUESTS = 200_000


def list_files(spark: SparkSession, root: str, pattern: str, first: int | None = None) -> list[str]:
    """Paths below a root in lexical order, optionally the first few."""
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", "true")
        .load(root)
        .select("path")
        .orderBy("path")
    )
    return [r["path"] for r in (files.limit(first) if first else files).collect()]


def with_global_index(rows: DataFrame, name: str = "position") -> DataFrame:
    """Add a dense 0-based index over files in path order, then rows in file order.

    Needs a file scan below it. The rows per file come from one aggregate, so no
    window runs over the rows; file and row number of each row are stable.
    """
    tagged = rows.withColumns(
        {"_file": F.col("_metadata.file_path"), "_row": F.col("_metadata.row_index")}
    )
    offsets = small_side(file_layout(rows).select("_file", "_offset"), BROADCAST_FILES)
    return (
        tagged.join(offsets, "_file")
        .withColumn(name, (F.col("_offset") + F.col("_row")).cast("bigint"))
        .drop("_file", "_row", "_offset")
    )


def file_layout(rows: DataFrame) -> DataFrame:
    """(_file, _rows, _offset): rows per file and rows of the files before it.

    One row per file, and Spark's driver already lists every file of a scan.
    """
    counts = rows.groupBy(F.col("_metadata.file_path").alias("_file")).agg(
        F.count("*").alias("_rows")
    )
    return counts.withColumn("_offset", before(F.col("_rows"), Window.orderBy("_file")))


def locate(layout: DataFrame, positions: DataFrame) -> DataFrame:
    """File and row in it of each global ``position``.

    A range join as an equi-join: positions are cut into buckets as wide as the mean
    file, and each file is listed under the buckets it spans, which are about twice
    as many as the files in total.
    """
    mean = layout.agg(F.ceil(F.avg("_rows")).alias("w")).first()["w"]
    width = max(int(mean or 1), 1)
    end = F.col("_offset") + F.col("_rows")
    spans = F.sequence(F.expr(f"_offset div {width}"), F.expr(f"(_offset + _rows - 1) div {width}"))
    files = layout.where("_rows > 0").withColumn("_span", F.explode(spans))
    asked = positions.withColumn("_span", F.expr(f"position div {width}"))
    inside = (F.col("position") >= F.col("_offset")) & (F.col("position") < end)
    joined = asked.join(files, "_span").where(inside)
    return joined.select(
        *positions.columns,
        F.col("_file").alias("file"),
        (F.col("position") - F.col("_offset")).cast("bigint").alias("offset"),
    )


def take_rows(rows: DataFrame, requests: DataFrame) -> DataFrame:
    """Rows of a file scan at the requested positions, in request order.

    Two phases: positions are first located in files and rows of them, then only the files that
    hold one are read. ``requests`` has (request_order, position); positions may repeat, and those
    outside the table give no row. ``rows`` must be a scan of Parquet files.
    """
    asked = checkpointed(locate(file_layout(rows), requests).select(
        F.col("request_order").alias("_order"), F.col("position").alias("_position"), F.col("file").alias("_file"),
        F.col("offset").alias("_row")))
    # No more names than the scan itself has files, which Spark's driver lists anyway.
    # Paths in a scan's metadata are written as in an address.
    files = [unquote(r["_file"]) for r in asked.select("_file").distinct().collect()]
    if not files:
        empty = rows.where("false")
        return empty.select(F.lit(0).cast("bigint").alias("request_order"), F.lit(0).cast("bigint").alias("position"), "*")
    picked = rows.sparkSession.read.schema(rows.schema).parquet(*files)
    tagged = picked.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    found = tagged.join(small_side(asked, BROADCAST_REQUESTS), ["_file", "_row"])
    return found.select(F.col("_order").alias("request_order"), F.col("_position").alias("position"), *rows.columns).orderBy("request_order")


def as_corpus(rows: DataFrame, id_col: str, text: str = "text", source: str | None = None):
    """(id, text, source, score, n_chars); a missing score is 0."""
    score = F.col("score") if "score" in rows.columns else F.lit(None)
    named = F.lit(source) if source is not None else F.col("source")
    shaped = rows.select(
        F.col(id_col).alias("id"),
        F.col(text).alias("text"),
        named.alias("source"),
        F.coalesce(score.cast("float"), F.lit(0.0)).alias("score"),
        F.length(text).alias("n_chars"),
    )
    return conform(shaped, CORPUS_SCHEMA)


def scan_parquet_shards(
    spark: SparkSession,
    paths: list[str],
    source: str,
    rows: int | None = None,
    text: str = "text",
    columns: tuple[str, ...] = ("text", "score"),
) -> DataFrame:
    """Corpus rows of Parquet shards, ids dense in (file, row) order, optionally capped.

    Only the named columns are read.
    """
    shards = spark.read.parquet(*sorted(paths))
    present = [c for c in columns if c in shards.columns]
    indexed = with_global_index(shards, "id").select("id", *present)
    if rows:
        indexed = indexed.where(F.col("id") < rows)
    return as_corpus(indexed, "id", text, source)


def scan_json_records(
    spark: SparkSession, path: str, source: str, rows: int | None = None
) -> DataFrame:
    """Corpus rows of JSON-lines files, numbered in (file, line) order."""
    from quern.operators.ordering import running_totals

    lines = spark.read.schema("text string, score double").json(path)
    placed = lines.withColumns(
        {
            "_file": F.col("_metadata.file_path"),
            "_start": F.col("_metadata.file_block_start"),
            "_line": F.monotonically_increasing_id(),
        }
    )
    order = [F.col("_file"), F.col("_start"), F.col("_line")]
    numbered = running_totals(placed, [], order, {"_n": F.lit(1).cast("bigint")})
    indexed = numbered.withColumn("id", F.col("_n") - 1)
    if rows:
        indexed = indexed.where(F.col("id") < rows)
    return as_corpus(indexed, "id", "text", source)
