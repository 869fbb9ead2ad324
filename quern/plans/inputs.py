"""The engine's inputs derived from the given tables, in Spark and as SQL text.

``SQL`` holds the same derivations as common table expressions, so that a query
and its check start from equal rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.functions.frames import add_features
from quern.functions.text import byte_token_count, byte_tokens
from quern.operators.dedup import repeat_flags
from quern.operators.ordering import running_totals
from quern.schema import CATEGORIES, LIGHT_COLORS, SCENES, TIMES_OF_DAY, WEATHER

EPISODE_STRIDE = 1_000_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- text --------------------------------------------------------------------


def corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, text, source, score, n_chars), score 0.00 to 4.99."""
    docs = table(spark, sf_dir, "documents")
    return docs.select(
        F.col("doc_id").alias("id"),
        "text",
        "source",
        (F.pmod(F.col("doc_id") * 37, F.lit(500)).cast("double") / 100.0).alias("score"),
        F.col("n_chars").cast("int").alias("n_chars"),
    )


def counted_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, source, score, n_chars, n_tokens, is_dup): the corpus without its text.

    One scan of the text; all planning runs on these narrow rows.
    """
    rows = corpus(spark, sf_dir).withColumn("n_tokens", byte_token_count(F.col("text")))
    return repeat_flags(rows, carry=("source", "score", "n_chars", "n_tokens"))


def tokenized_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, input_ids)."""
    return corpus(spark, sf_dir).select("id", byte_tokens("text").alias("input_ids"))


# --- frames ------------------------------------------------------------------


def _pick(values: list[str], index: Column) -> Column:
    return F.get(F.array(*[F.lit(v) for v in values]), index.cast("int"))


def frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One frame per order with 0 to 6 annotations computed from its keys."""
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    epoch = F.expr("timestampdiff(MILLISECOND, timestamp_ntz'1970-01-01 00:00:00', o_orderdate)")
    count = F.pmod(key, F.lit(7)).cast("int")
    slots = F.slice(F.array(*[F.lit(i) for i in range(6)]), F.lit(1), count)

    def box(i: Column) -> Column:
        x1 = F.pmod(cust * 37 + i * 211, F.lit(1000))
        y1 = F.pmod(key * 53 + i * 97, F.lit(500))
        x2 = x1 + F.pmod(cust * 7 + i * 31, F.lit(275)) - 4
        y2 = y1 + F.pmod(key * 11 + i * 13, F.lit(210)) + 10
        return F.array(*[e.cast("float") for e in (x1, y1, x2, y2)])

    return table(spark, sf_dir, "orders").select(
        key.alias("frame_key"),
        F.concat(F.lit("frame_"), F.lpad(key.cast("string"), 9, "0")).alias("image_id"),
        F.when(F.pmod(key, F.lit(5)) == 0, "val").otherwise("train").alias("split"),
        F.lit(1280).alias("width"),
        F.lit(720).alias("height"),
        _pick(WEATHER, F.pmod(key, F.lit(6))).alias("weather"),
        _pick(SCENES, F.pmod(cust, F.lit(7))).alias("scene"),
        _pick(TIMES_OF_DAY, F.pmod(key + cust, F.lit(4))).alias("timeofday"),
        epoch.alias("timestamp"),
        F.transform(
            slots, lambda i: _pick(CATEGORIES, F.pmod(key * 3 + cust + i * 7, F.lit(10)))
        ).alias("ann_categories"),
        F.transform(slots, box).alias("ann_bboxes"),
        F.transform(slots, lambda i: F.pmod(key + i, F.lit(3)) == 0).alias("ann_occluded"),
        F.transform(slots, lambda i: F.pmod(cust + i, F.lit(4)) == 0).alias("ann_truncated"),
        F.transform(slots, lambda i: _pick(LIGHT_COLORS, F.pmod(key + cust + i, F.lit(4)))).alias(
            "ann_traffic_light_colors"
        ),
        count.alias("num_annotations"),
    )


def flagged_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frames with the annotation features and a three-state ``is_duplicate``."""
    place = F.pmod(F.col("frame_key"), F.lit(11))
    flag = F.when(place != 0, place == 1)
    return add_features(frames(spark, sf_dir)).withColumn("is_duplicate", flag)


def boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One truth box per order line; the id is built from the line, so no numbering is needed."""
    cents = F.pmod(F.floor(F.col("l_extendedprice") * 100 + 0.5), F.lit(1 << 30))
    part = F.pmod(F.col("l_partkey"), F.lit(1 << 28))
    x1 = F.pmod(F.col("l_suppkey") * 37, F.lit(1000))
    y1 = F.pmod(F.col("l_partkey") * 53, F.lit(500))
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("frame_key"),
        ((cents * (1 << 28) + part) * 8 + F.col("l_linenumber")).alias("box_id"),
        _pick(CATEGORIES, F.pmod(F.col("l_partkey"), F.lit(10))).alias("category"),
        x1.cast("double").alias("x1"),
        y1.cast("double").alias("y1"),
        (x1 + 10 + F.pmod(F.col("l_partkey") * 7, F.lit(270))).cast("double").alias("x2"),
        (y1 + 10 + F.pmod(F.col("l_suppkey") * 11, F.lit(210))).cast("double").alias("y2"),
        (F.col("l_returnflag") == "R").alias("occluded"),
        (F.col("l_linestatus") == "F").alias("truncated"),
    )


def predictions(spark: SparkSession, sf_dir: str, drift: int = 1) -> DataFrame:
    """The truth boxes moved by up to ``drift`` times 15 pixels, with a score."""
    dx = (F.pmod(F.col("frame_key"), F.lit(31)) - 15) * drift
    dy = (F.pmod(F.col("box_id"), F.lit(25)) - 12) * drift
    score = F.pmod(F.col("frame_key") * 13 + F.pmod(F.col("box_id"), F.lit(97)), F.lit(100))
    return boxes(spark, sf_dir).select(
        "frame_key",
        F.col("box_id").alias("pred_id"),
        "category",
        (F.col("x1") + dx).alias("x1"),
        (F.col("y1") + dy).alias("y1"),
        (F.col("x2") + dx).alias("x2"),
        (F.col("y2") + dy).alias("y2"),
        (score.cast("double") / 100.0).alias("score"),
    )


# --- vectors and hashes ------------------------------------------------------


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings")


def bit_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(image_id, split, dhash): a 0/1 vector per embedding; bit i compares element i
    with the next one."""
    place = F.sequence(F.lit(0), F.lit(63))
    bits = F.transform(
        place,
        lambda i: (F.get("embedding", i) > F.get("embedding", F.pmod(i + 1, F.lit(64)))).cast("float"),
    )
    return vectors(spark, sf_dir).select(
        F.concat(F.lit("frame_"), F.lpad(F.col("vec_id").cast("string"), 9, "0")).alias("image_id"),
        F.when(F.pmod(F.col("vec_id"), F.lit(5)) == 0, "val").otherwise("train").alias("split"),
        bits.alias("dhash"),
    )


# --- images ------------------------------------------------------------------


def images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(image_id, split, image_bytes): each document's bytes as a 16-pixel-wide PPM image."""
    raw = F.encode("text", "UTF-8")
    height = F.greatest(F.ceil(F.octet_length(raw) / 48), F.lit(1)).cast("int")
    header = F.encode(F.format_string("P6\n16 %d\n255\n", height), "UTF-8")
    return (
        table(spark, sf_dir, "documents")
        .withColumns({"_raw": raw, "_height": height})
        .select(
            F.concat(F.lit("doc-"), F.col("doc_id").cast("string")).alias("image_id"),
            F.lit("train").alias("split"),
            F.concat(header, F.expr("rpad(_raw, _height * 48, X'00')")).alias("image_bytes"),
        )
    )


# --- episodes ----------------------------------------------------------------


def episodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(event_id, episode_index, idx, action, observation): a user's events in time order.

    Each user owns a range of EPISODE_STRIDE indices, so no numbering runs over users.
    """
    rows = table(spark, sf_dir, "events").select(
        "event_id", F.col("user_id").alias("episode_index"), "ts", "value"
    )
    placed = running_totals(
        rows,
        ["episode_index"],
        [F.col("ts").asc(), F.col("event_id").asc()],
        {"_k": F.lit(1).cast("bigint")},
    )
    return placed.select(
        "event_id",
        "episode_index",
        (F.col("episode_index") * EPISODE_STRIDE + F.col("_k") - 1).alias("idx"),
        F.col("value").alias("action"),
        F.round(F.col("value") * 2, 6).alias("observation"),
    )


def episode_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(episode_index, ep_start, ep_end)."""
    counts = table(spark, sf_dir, "events").groupBy("user_id").count()
    start = F.col("user_id") * EPISODE_STRIDE
    return counts.select(
        F.col("user_id").alias("episode_index"),
        start.alias("ep_start"),
        (start + F.col("count")).alias("ep_end"),
    )


# --- the same as SQL ---------------------------------------------------------

SPACE_CLASS = (
    r"[\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"
)


def _list(values: list[str]) -> str:
    return "[" + ",".join(f"'{v}'" for v in values) + "]"


SQL = {
    "corpus": """
corpus as (
  select doc_id as id, text, source, cast((doc_id*37)%500 as double)/100.0 as score,
    cast(n_chars as int) as n_chars from documents)""",
    "counted": f"""
hashed as (
  select *, md5(trim(regexp_replace(text, '{SPACE_CLASS}', ' ', 'g'))) as h,
    cast(octet_length(encode(text)) + 2 as int) as n_tokens from corpus),
counted as (
  select id, text, source, score, n_chars, n_tokens, min(id) over (partition by h) < id as is_dup
  from hashed)""",
    "frames": f"""
frames as (
  select o_orderkey as frame_key, concat('frame_', lpad(cast(o_orderkey as varchar),9,'0')) as image_id,
    case when o_orderkey%5=0 then 'val' else 'train' end as split, 1280 as width, 720 as height,
    (['clear','overcast','rainy','snowy','foggy','undefined'])[1+o_orderkey%6] as weather,
    (['city street','highway','residential','parking lot','gas stations','tunnel','undefined'])[1+o_custkey%7] as scene,
    (['daytime','night','dawn/dusk','undefined'])[1+(o_orderkey+o_custkey)%4] as timeofday,
    epoch_ms(o_orderdate) as timestamp,
    list_transform(range(o_orderkey%7), lambda i: ({_list(CATEGORIES)})[1+(o_orderkey*3+o_custkey+i*7)%10]) as ann_categories,
    list_transform(range(o_orderkey%7), lambda i: [(o_custkey*37+i*211)%1000, (o_orderkey*53+i*97)%500,
      (o_custkey*37+i*211)%1000 + (o_custkey*7+i*31)%275 - 4,
      (o_orderkey*53+i*97)%500 + (o_orderkey*11+i*13)%210 + 10]) as ann_bboxes,
    list_transform(range(o_orderkey%7), lambda i: (o_orderkey+i)%3=0) as ann_occluded,
    list_transform(range(o_orderkey%7), lambda i: (o_custkey+i)%4=0) as ann_truncated,
    list_transform(range(o_orderkey%7), lambda i: (['none','red','green','yellow'])[1+(o_orderkey+o_custkey+i)%4]) as ann_lights,
    cast(o_orderkey%7 as int) as num_annotations
  from orders)""",
    "flagged": """
anns as (
  select frame_key, unnest(ann_categories) as category, unnest(ann_bboxes) as box from frames),
person_area as (
  select frame_key, max(greatest(0, box[3]-box[1])*greatest(0, box[4]-box[2])) as area
  from anns where category='person' group by frame_key),
flagged as (
  select f.*, list_contains(ann_categories,'person') as has_person,
    list_contains(ann_categories,'rider') as has_rider,
    contains(lower(scene),'street') or contains(lower(scene),'intersection') as scene_has_crossroad,
    contains(lower(scene),'mountain') or contains(lower(scene),'rural') as scene_has_mountain,
    concat(timeofday,' ',weather,' scene on a ',scene) as scene_description,
    cast(coalesce(area,0)/cast(921600 as double)*100 as float) as person_bbox_area_pct,
    case frame_key%11 when 0 then null when 1 then true else false end as is_duplicate
  from frames f left join person_area a using (frame_key))""",
    "boxes": f"""
boxes as (
  select l_orderkey as frame_key,
    (cast(floor(l_extendedprice*100 + 0.5) as bigint) % 1073741824 * 268435456 + l_partkey % 268435456) * 8 + l_linenumber as box_id,
    ({_list(CATEGORIES)})[1+l_partkey%10] as category,
    cast((l_suppkey*37)%1000 as double) as x1, cast((l_partkey*53)%500 as double) as y1,
    cast((l_suppkey*37)%1000+10+(l_partkey*7)%270 as double) as x2,
    cast((l_partkey*53)%500+10+(l_suppkey*11)%210 as double) as y2,
    l_returnflag='R' as occluded, l_linestatus='F' as truncated
  from lineitem)""",
    "predictions": """
predictions as (
  select frame_key, box_id as pred_id, category,
    x1+(frame_key%31)-15 as x1, y1+(box_id%25)-12 as y1, x2+(frame_key%31)-15 as x2, y2+(box_id%25)-12 as y2,
    cast((frame_key*13+box_id%97)%100 as double)/100.0 as score
  from boxes)""",
    "hashes": """
bits as (
  select vec_id, concat('frame_', lpad(cast(vec_id as varchar),9,'0')) as image_id,
    case when vec_id%5=0 then 'val' else 'train' end as split,
    cast(list_aggregate(list_transform(range(64), lambda i:
      case when embedding[i+1] > embedding[(i+1)%64+1] then '1' else '0' end), 'string_agg', '') as bit) as h
  from embeddings)""",
    "episodes": f"""
ep_counts as (select user_id, count(*) as n from events group by user_id),
episodes as (
  select e.event_id, e.user_id as episode_index,
    cast(e.user_id*{EPISODE_STRIDE} + row_number() over (partition by e.user_id order by ts, event_id) - 1 as bigint) as idx,
    cast(e.user_id*{EPISODE_STRIDE} as bigint) as ep_start, cast(e.user_id*{EPISODE_STRIDE}+c.n as bigint) as ep_end,
    value as action, round(value*2, 6) as observation
  from events e join ep_counts c on e.user_id=c.user_id)""",
}


def with_sql(*names: str) -> str:
    """``with`` clause of the named derivations, in the order given."""
    return "with " + ",".join(SQL[n].rstrip() for n in names) + "\n"
