"""Image files, their label files, and the frame table built from both."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.functions.images import image_size
from quern.operators.ordering import running_totals
from quern.schema import FRAME_SCHEMA, conform

# Image suffixes and the class count of positional labels.
IMAGE_SUFFIXES = r"\.(jpg|jpeg|png)$"
POSITION_CLASSES = 1000

_BOX = "struct<x1:double,y1:double,x2:double,y2:double,xmin:double,ymin:double,xmax:double,ymax:double>"
LABEL_SCHEMA = (
    "attributes struct<weather:string,scene:string,timeofday:string>, "
    "frames array<struct<timestamp:bigint, objects:array<struct<category:string, "
    f"box2d:{_BOX}, bbox:{_BOX}, "
    "attributes:struct<occluded:boolean,truncated:boolean,trafficLightColor:string>>>>>"
)


def _stem(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]+)\.[^./]+$", 1)


def read_image_files(spark: SparkSession, root: str, split: str) -> DataFrame:
    """(image_id, split, image_bytes) of the ``.jpg`` files of a split."""
    files = (
        spark.read.format("binaryFile").option("pathGlobFilter", "*.jpg").load(f"{root}/{split}")
    )
    return files.select(
        _stem(F.col("path")).alias("image_id"),
        F.lit(split).alias("split"),
        F.col("content").alias("image_bytes"),
    )


def read_label_files(spark: SparkSession, root: str, split: str) -> DataFrame:
    """(stem, label): one JSON text per label file of a split."""
    files = spark.read.option("pathGlobFilter", "*.json").text(f"{root}/{split}", wholetext=True)
    return files.select(_stem(F.col("_metadata.file_path")).alias("stem"), F.col("value").alias("label"))


def attach_labels(images: DataFrame, labels: DataFrame) -> DataFrame:
    """Add ``label``: the one of the same stem, else of the stem without its last
    ``-suffix``, else NULL. ``labels`` has one row per stem."""
    exact = labels.select(F.col("stem").alias("image_id"), F.col("label").alias("_exact"))
    short = labels.select(F.col("stem").alias("_short"), F.col("label").alias("_fallback"))
    joined = (
        images.join(exact, "image_id", "left")
        .withColumn("_short", F.regexp_replace("image_id", r"-[^-]*$", ""))
        .join(short, "_short", "left")
    )
    return joined.withColumn("label", F.coalesce("_exact", "_fallback")).drop(
        "_exact", "_short", "_fallback"
    )


def flatten_labels(frames: DataFrame) -> DataFrame:
    """Replace ``label`` JSON by frame attributes and parallel annotation arrays.

    Needs ``width`` and ``height``, the defaults of missing far edges. Only the
    first frame of a label counts; objects without a box are dropped.
    """
    parsed = frames.withColumn("_label", F.from_json("label", LABEL_SCHEMA))
    frame = F.get("_label.frames", 0)
    objects = F.coalesce(frame["objects"], F.array().cast(_objects_type()))

    def has_edges(box: Column) -> Column:
        edges = [box[e] for e in ("x1", "y1", "x2", "y2", "xmin", "ymin", "xmax", "ymax")]
        return F.coalesce(*edges).isNotNull()

    def box_of(obj: Column) -> Column:
        return F.when(has_edges(obj["box2d"]), obj["box2d"]).otherwise(obj["bbox"])

    def edges_of(obj: Column) -> Column:
        box = box_of(obj)
        zero = F.lit(0.0)
        return F.array(
            F.coalesce(box["x1"], box["xmin"], zero).cast("float"),
            F.coalesce(box["y1"], box["ymin"], zero).cast("float"),
            F.coalesce(box["x2"], box["xmax"], F.col("width")).cast("float"),
            F.coalesce(box["y2"], box["ymax"], F.col("height")).cast("float"),
        )

    boxed = parsed.withColumn("_objects", F.filter(objects, lambda o: box_of(o).isNotNull()))

    def each(pick) -> Column:
        return F.transform("_objects", pick)

    top = F.col("_label.attributes")
    undefined = F.lit("undefined")
    return boxed.withColumns(
        {
            "weather": F.coalesce(top["weather"], undefined),
            "scene": F.coalesce(top["scene"], undefined),
            "timeofday": F.coalesce(top["timeofday"], undefined),
            "timestamp": F.coalesce(frame["timestamp"], F.lit(0).cast("bigint")),
            "ann_categories": each(lambda o: F.coalesce(o["category"], F.lit("unknown"))),
            "ann_bboxes": each(edges_of),
            "ann_occluded": each(lambda o: F.coalesce(o["attributes"]["occluded"], F.lit(False))),
            "ann_truncated": each(lambda o: F.coalesce(o["attributes"]["truncated"], F.lit(False))),
            "ann_traffic_light_colors": each(
                lambda o: F.coalesce(o["attributes"]["trafficLightColor"], F.lit("none"))
            ),
            "num_annotations": F.size("_objects"),
        }
    ).drop("_label", "_objects", "label")


def _objects_type() -> T.DataType:
    parsed = T._parse_datatype_string(LABEL_SCHEMA)
    return parsed["frames"].dataType.elementType["objects"].dataType


def scan_images_labels(images: DataFrame, labels: DataFrame, limit: int | None = None) -> DataFrame:
    """Frame rows of (image_id, split, image_bytes), sorted by name when cut to the
    first ``limit`` images."""
    if limit:
        images = images.orderBy("image_id").limit(limit)
    # Labels are found by name alone; the image bytes join once, or stay in place.
    found = attach_labels(images.select("image_id"), labels).where(F.col("label").isNotNull())
    sized = images.withColumn("_size", image_size("image_bytes"))
    sized = sized.withColumns({"width": F.col("_size.width"), "height": F.col("_size.height")})
    frames = flatten_labels(sized.drop("_size").join(found, "image_id", "left"))
    return conform(frames, FRAME_SCHEMA)


def list_objects(spark: SparkSession, prefix: str, limit: int | None = None) -> DataFrame:
    """(path, length, label) of the image objects below a prefix, by path."""
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(prefix)
    )
    return positional_labels(files.select("path", "length"), limit)


def positional_labels(
    objects: DataFrame, limit: int | None = None, classes: int = POSITION_CLASSES
) -> DataFrame:
    """Image paths with label = place in path order mod ``classes``, optionally the first few."""
    images = objects.where(F.lower("path").rlike(IMAGE_SUFFIXES))
    if limit is not None:
        images = images.orderBy("path").limit(limit)
    numbered = running_totals(images, [], [F.col("path")], {"_place": F.lit(1).cast("bigint")})
    return numbered.withColumn("label", F.pmod(F.col("_place") - 1, F.lit(classes)).cast("int")).drop("_place")


def labelled_rows(images: DataFrame, index: str, classes: int) -> DataFrame:
    """(image_bytes, label) rows with label = index mod ``classes``."""
    return images.select(
        "image_bytes", F.pmod(F.col(index), F.lit(classes)).cast("int").alias("label")
    )
