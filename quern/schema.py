"""Table schemas and the fixed values that results depend on."""

from __future__ import annotations

from pyspark.sql import types as T

# Annotation categories and frame attribute values.
CATEGORIES = [
    "car", "truck", "bus", "person", "rider",
    "bicycle", "motorcycle", "traffic light", "traffic sign", "train",
]
WEATHER = ["clear", "overcast", "rainy", "snowy", "foggy", "undefined"]
SCENES = [
    "city street", "highway", "residential", "parking lot",
    "gas stations", "tunnel", "undefined",
]
TIMES_OF_DAY = ["daytime", "night", "dawn/dusk", "undefined"]
LIGHT_COLORS = ["none", "red", "green", "yellow"]

# Detector class of each category; a category not listed has none.
CLASS_IDS = {
    "person": 1, "rider": 1, "bicycle": 2, "car": 3, "motorcycle": 4,
    "bus": 6, "train": 7, "truck": 8, "traffic light": 10,
}
PERSON_CLASS = 1

# Byte tokenizer ids.
BOS_ID, EOS_ID, PAD_ID = 256, 257, 258

# Thresholds and sizes.
BLOCK_LEN = 1024
ROWS_PER_GROUP = 1024
HAMMING_THRESHOLD = 10
COSINE_THRESHOLD = 0.92
IOU_THRESHOLD = 0.5
SCORE_THRESHOLD = 0.3
VERBATIM_SIMILARITY = 0.9

# Time offsets, in steps of 0.1 s, around a row of an episode.
OBSERVATION_STEPS = [-1, 0]
ACTION_STEPS = list(range(-1, 15))

# Prefix of injected copies, and columns that previews leave out.
CANARY_PREFIX = "syndup_"
HEAVY_COLUMNS = {"image_bytes", "ann_bboxes", "ann_occluded", "ann_truncated"}

FRAME_SCHEMA = T.StructType(
    [
        T.StructField("image_id", T.StringType()),
        T.StructField("split", T.StringType()),
        T.StructField("image_bytes", T.BinaryType()),
        T.StructField("width", T.IntegerType()),
        T.StructField("height", T.IntegerType()),
        T.StructField("weather", T.StringType()),
        T.StructField("scene", T.StringType()),
        T.StructField("timeofday", T.StringType()),
        T.StructField("timestamp", T.LongType()),
        T.StructField("ann_categories", T.ArrayType(T.StringType())),
        T.StructField("ann_bboxes", T.ArrayType(T.ArrayType(T.FloatType()))),
        T.StructField("ann_occluded", T.ArrayType(T.BooleanType())),
        T.StructField("ann_truncated", T.ArrayType(T.BooleanType())),
        T.StructField("ann_traffic_light_colors", T.ArrayType(T.StringType())),
        T.StructField("num_annotations", T.IntegerType()),
    ]
)

CORPUS_SCHEMA = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("score", T.FloatType()),
        T.StructField("n_chars", T.IntegerType()),
    ]
)

BLOCK_SCHEMA = T.StructType([T.StructField("input_ids", T.ArrayType(T.IntegerType()))])

IMAGE_ROW_SCHEMA = T.StructType(
    [
        T.StructField("image_bytes", T.BinaryType()),
        T.StructField("label", T.IntegerType()),
    ]
)


def missing_columns(df, required) -> list[str]:
    """Required columns that ``df`` lacks, sorted."""
    return sorted(set(required) - set(df.columns))


def require_columns(df, required):
    """Return ``df``, or fail naming every column it lacks."""
    missing = missing_columns(df, required)
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    return df


def conform(df, schema: T.StructType):
    """Cast ``df`` to ``schema`` in its column order; a missing column is an error."""
    require_columns(df, schema.fieldNames())
    return df.select(*[df[f.name].cast(f.dataType).alias(f.name) for f in schema])
