"""Queries about stored tables: ingest, added columns, versions, views, cycles."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.functions.frames import ANNOTATION_FEATURES, Feature, feature_registry
from quern.functions.text import byte_token_count
from quern.operators import backfill, health, views
from quern.operators.dedup import membership_flag
from quern.plans.inputs import corpus, frames, table, with_sql
from quern.plans.registry import query
from quern.session import fresh_path
from quern.sources import images as image_io
from quern.sources.bucketed import BucketedTable
from quern.sources.store import TableStore
from quern.streaming.cycle import file_stream, run_cycle

FLAGGED = with_sql("frames", "flagged")
FEATURES = ["has_person", "has_rider", "scene_description", "person_bbox_area_pct"]


def new_store(spark) -> TableStore:
    return TableStore(spark, fresh_path(spark, "store"))


def half(rows, odd: int):
    return rows.where(F.pmod(F.col("frame_key"), F.lit(2)) == odd)


def frame_store(spark, d, rows=None, features=FEATURES) -> TableStore:
    """A stored frame table with its annotation features filled."""
    store = new_store(spark)
    store.create("frames", frames(spark, d) if rows is None else rows, "frame_key")
    backfill.backfill(store, "frames", features, ANNOTATION_FEATURES)
    return store


# --- image and label ingest --------------------------------------------------


def image_files(spark, d):
    """Images of the documents under names with a ``-suffix``."""
    from quern.plans.inputs import images

    name = F.concat(
        F.regexp_replace("image_id", "doc-", "b"),
        F.lit("-f"),
        F.pmod(F.regexp_extract("image_id", r"(\d+)", 1).cast("bigint"), F.lit(16)).cast("string"),
    )
    return images(spark, d).withColumn("image_id", name)


def label_files(spark, d):
    """Label JSON of two thirds of the images: by full name, or by the name without suffix.

    Objects carry a box in either spelling, or none.
    """
    docs = table(spark, d, "documents")
    number = F.col("doc_id").cast("string")
    full = F.concat(
        F.lit("b"), number, F.lit("-f"), F.pmod(F.col("doc_id"), F.lit(16)).cast("string")
    )
    place = F.pmod(F.col("doc_id"), F.lit(3))
    size = F.pmod(F.col("n_chars"), F.lit(100)).cast("string")
    objects = F.concat(
        F.lit('{"category":"car","box2d":{"x1":1,"y1":2,"x2":'), size,
        F.lit(',"y2":9},"attributes":{"occluded":true,"trafficLightColor":"red"}},'
              '{"box2d":{},"bbox":{"xmin":3,"ymax":'), size,
        F.lit('}},{"category":"person","attributes":{"truncated":true}}'),
    )
    label = F.when(
        F.col("lang") == "en",
        F.concat(
            F.lit('{"attributes":{"weather":"'), F.col("source"),
            F.lit('"},"frames":[{"timestamp":'), F.col("n_chars").cast("string"),
            F.lit(',"objects":['), objects, F.lit("]}]}"),
        ),
    ).otherwise(F.lit('{"attributes":{"scene":"tunnel"},"frames":[]}'))
    stem = F.when(place == 0, full).otherwise(F.concat(F.lit("b"), number))
    return docs.where(place < 2).select(stem.alias("stem"), label.alias("label"))


LABELLED = """docs as (select doc_id, concat('b', doc_id, '-f', doc_id % 16) as image_id, lang, source, n_chars, 16 as width,
    greatest(cast(ceil(octet_length(encode(text))/48.0) as int), 1) as height, doc_id % 3 < 2 as labelled from documents),
  framed as (select *, labelled and lang = 'en' as has_objects from docs)
"""


@query(
    "scan_images_labels",
    f"""with {LABELLED} select image_id, 'train' as split, height, width,
      cast(octet_length(encode(concat('P6\n16 ', height, '\n255\n'))) + height*48 as int) as n_bytes,
      case when has_objects then source else 'undefined' end as weather, cast(case when has_objects then 2 else 0 end as int) as num_annotations from framed""",
)
def scan_images_labels(spark, d):
    rows = image_io.scan_images_labels(image_files(spark, d), label_files(spark, d))
    return rows.select(
        "image_id", "split", "height", "width", F.octet_length("image_bytes").alias("n_bytes"),
        "weather", "num_annotations",
    )


@query(
    "label_fallback_join",
    f"""with {LABELLED} select image_id, case doc_id % 3 when 0 then 'exact' when 1 then 'fallback' else 'none' end as found from framed""",
)
def label_fallback_join(spark, d):
    images = image_files(spark, d).select("image_id")
    labels = label_files(spark, d)
    joined = image_io.attach_labels(images, labels.withColumn("label", F.col("stem")))
    found = (
        F.when(F.col("label") == F.col("image_id"), "exact")
        .when(F.col("label").isNotNull(), "fallback")
        .otherwise("none")
    )
    return joined.select("image_id", found.alias("found"))


def parsed_frames(spark, d):
    return image_io.scan_images_labels(image_files(spark, d), label_files(spark, d))


@query(
    "flatten_labels",
    f"""with {LABELLED} select image_id, case when has_objects then 'car,unknown' else '' end as categories,
      case when has_objects then concat('1,2,', n_chars % 100, ',9;3,0,16,', n_chars % 100) else '' end as boxes,
      case when has_objects then 'true,false' else '' end as occluded, case when has_objects then 'false,false' else '' end as truncated,
      case when has_objects then 'red,none' else '' end as lights from framed""",
)
def flatten_labels(spark, d):
    boxes = F.transform("ann_bboxes", lambda b: F.array_join(b.cast("array<int>"), ","))
    return parsed_frames(spark, d).select(
        "image_id",
        F.array_join("ann_categories", ",").alias("categories"),
        F.array_join(boxes, ";").alias("boxes"),
        F.array_join(F.col("ann_occluded").cast("array<string>"), ",").alias("occluded"),
        F.array_join(F.col("ann_truncated").cast("array<string>"), ",").alias("truncated"),
        F.array_join("ann_traffic_light_colors", ",").alias("lights"),
    )


@query(
    "frame_attr_defaults",
    f"""with {LABELLED} select image_id, case when has_objects then source else 'undefined' end as weather,
      case when labelled and lang <> 'en' then 'tunnel' else 'undefined' end as scene, 'undefined' as timeofday,
      cast(case when has_objects then n_chars else 0 end as bigint) as timestamp from framed""",
)
def frame_attr_defaults(spark, d):
    return parsed_frames(spark, d).select("image_id", "weather", "scene", "timeofday", "timestamp")


@query(
    "list_objects",
    """with o as (select concat(url, case page_id % 4 when 0 then '.JPG' when 1 then '.jpeg' when 2 then '.png' else '.html' end) as path, page_id from pages),
      i as (select path, row_number() over (order by path) - 1 as p from o where regexp_matches(lower(path), '\\.(jpg|jpeg|png)$'))
      select path, cast(p % 1000 as int) as label from i""",
)
def list_objects(spark, d):
    suffix = F.array(*[F.lit(s) for s in (".JPG", ".jpeg", ".png", ".html")])
    place = F.pmod(F.col("page_id"), F.lit(4)).cast("int")
    paths = table(spark, d, "pages").select(F.concat("url", F.get(suffix, place)).alias("path"))
    return image_io.positional_labels(paths)


@query(
    "stage_image_rows",
    """select cast(doc_id % 10 as int) as label, count(*) as n from documents group by 1""",
)
def stage_image_rows(spark, d):
    from quern.plans.inputs import images

    store = new_store(spark)
    numbered = images(spark, d).withColumn(
        "index", F.regexp_extract("image_id", r"(\d+)", 1).cast("bigint")
    )
    for odd in (0, 1):
        part = numbered.where(F.pmod(F.col("index"), F.lit(2)) == odd)
        store.ingest("images", image_io.labelled_rows(part, "index", 10), key="image_bytes")
    return store.read("images").groupBy("label").agg(F.count("*").alias("n"))


# --- stored tables -----------------------------------------------------------


@query(
    "write_table",
    with_sql("frames")
    + """select 'train' as split, count(*) as added, count(*) as total, cast(1 as bigint) as version from frames where split='train'
      union all select 'val', count(*) filter (where split='val'), count(*), 2 from frames""",
)
def write_table(spark, d):
    store = new_store(spark)
    found = None
    for split in ("train", "val"):
        rows = frames(spark, d).where(F.col("split") == split)
        receipt = store.ingest("frames", rows, "frame_key").select(
            F.lit(split).alias("split"), "added", "total", "version"
        )
        found = receipt if found is None else found.unionByName(receipt)
    return found


@query(
    "add_column_group",
    """select doc_id as id, source, cast(n_chars as int) as n_chars, cast(octet_length(encode(text)) + 2 as int) as n_tokens from documents""",
)
def add_column_group(spark, d):
    store = new_store(spark)
    store.create("corpus", corpus(spark, d), "id")
    counted = store.read_base("corpus").select("id", byte_token_count(F.col("text")).alias("n_tokens"))
    store.add_columns("corpus", counted)
    return store.read("corpus").select("id", "source", "n_chars", "n_tokens")


@query(
    "bucketed_column_groups",
    """select doc_id as id, source, cast(n_chars as int) as n_chars, cast(octet_length(encode(text)) + 2 as int) as n_tokens,
      case when doc_id % 2 = 0 then doc_id % 7 end as part from documents""",
)
def bucketed_column_groups(spark, d):
    """Two column groups beside the base rows in one bucketed layout; the read has no shuffle."""
    stored = BucketedTable(spark, fresh_path(spark, "bucketed"))
    rows = corpus(spark, d)
    even = F.pmod(F.col("id"), F.lit(2)) == 0
    stored.create(rows.where(even), "id", 8)
    stored.add_columns(stored.read(["id"]).select("id", F.pmod(F.col("id"), F.lit(7)).alias("part")))
    stored.append(rows.where(~even))
    stored.add_columns(stored.read(["text"]).select("id", byte_token_count(F.col("text")).alias("n_tokens")))
    return stored.read(["source", "n_chars", "n_tokens", "part"])


@query(
    "drop_columns",
    FLAGGED + "select frame_key, has_rider, scene_description from flagged",
)
def drop_columns(spark, d):
    store = frame_store(spark, d)
    store.drop_columns("frames", ["has_person", "person_bbox_area_pct", "not_there"])
    added = [c for c in store.read("frames").columns if c in FEATURES]
    return store.read("frames").select("frame_key", *added)


@query(
    "snapshot_version",
    with_sql("frames")
    + """, h as (select frame_key%2 as odd, count(*) as n from frames group by 1)
      select cast(1 as bigint) as version, 'create' as kind, n as rows, n as readable from h where odd=0
      union all select 2, 'append', (select n from h where odd=1), count(*) from frames
      union all select 3, 'columns', count(*), count(*) from frames""",
)
def snapshot_version(spark, d):
    store = frame_store(spark, d, half(frames(spark, d), 0), features=[])
    store.append("frames", half(frames(spark, d), 1))
    backfill.backfill(store, "frames", ["has_rider"], ANNOTATION_FEATURES)
    readable = [(v, store.read("frames", v).count()) for v in (1, 2, 3)]
    counts = spark.createDataFrame(readable, "version bigint, readable bigint")
    return store.history("frames").join(counts, "version").select(
        "version", "kind", "rows", "readable"
    )


@query(
    "delete_rows",
    with_sql("frames")
    + "select count(*) as before, count(*) filter (where scene <> 'tunnel') as after from frames",
)
def delete_rows(spark, d):
    store = frame_store(spark, d, features=[])
    return store.delete_where("frames", "scene = 'tunnel'").select("before", "after")


@query(
    "incremental_backfill",
    FLAGGED
    + """select p.*, f.rows from (select 1 as pass, (select count(*) from flagged where frame_key%2=0) as computed
        union all select 2, (select count(*) from flagged where frame_key%2=1) union all select 3, 0) p,
      (select count(*) filter (where has_person) as rows from flagged) f""",
)
def incremental_backfill(spark, d):
    store = frame_store(spark, d, half(frames(spark, d), 0), features=[])
    passes = []
    for number in (1, 2, 3):
        if number == 2:
            store.append("frames", half(frames(spark, d), 1))
        report = backfill.backfill(store, "frames", ["has_person"], ANNOTATION_FEATURES)
        passes.append((number, report.first()["rows"]))
    done = spark.createDataFrame(passes, "pass int, computed bigint")
    flagged = store.read("frames").agg(F.count_if("has_person").alias("rows"))
    return done.join(F.broadcast(flagged))


@query(
    "resumable_backfill",
    FLAGGED
    + """select frame_key, has_person, scene_description,
      (select count(*) from flagged) as computed, 'OPEN,DONE' as states from flagged""",
)
def resumable_backfill(spark, d):
    """A fill in key ranges that stops after two of them; the next call computes only the rest."""
    store = frame_store(spark, d, features=[])
    columns = ["has_person", "scene_description"]
    size = max(1, store.read_base("frames").count() // 5)
    options = {"checkpoint_rows": size, "task_rows": 50_000}
    first = backfill.backfill(store, "frames", columns, ANNOTATION_FEATURES, most_ranges=2, **options).first()
    rest = backfill.backfill(store, "frames", columns, ANNOTATION_FEATURES, **options).first()
    return store.read("frames").select(
        "frame_key", *columns, F.lit(first["rows"] + rest["rows"]).cast("bigint").alias("computed"),
        F.lit(first["status"] + "," + rest["status"]).alias("states"))


# --- functions registered with the table -------------------------------------


@query(
    "parameterized_udf",
    FLAGGED + "select frame_key, person_bbox_area_pct >= 2.0 as prominent_person from flagged",
)
def parameterized_udf(spark, d):
    def above(percent: float) -> Feature:
        return Feature(("person_bbox_area_pct",), T.BooleanType(), lambda c: c >= percent)

    store = frame_store(spark, d, features=["person_bbox_area_pct"])
    registry = feature_registry(prominent_person=above(2.0))
    backfill.backfill(store, "frames", ["prominent_person"], registry)
    return store.read("frames").select("frame_key", "prominent_person")


@query(
    "row_udf",
    FLAGGED + "select frame_key, has_rider, scene_has_crossroad from flagged",
)
def row_udf(spark, d):
    store = frame_store(spark, d, features=["has_rider", "scene_has_crossroad"])
    return store.read("frames").select("frame_key", "has_rider", "scene_has_crossroad")


@query(
    "batch_udf",
    "select doc_id as id, cast(octet_length(encode(text)) + 2 as int) as n_tokens from documents",
)
def batch_udf(spark, d):
    from quern.plans.inputs import tokenized_corpus

    return tokenized_corpus(spark, d).select("id", F.size("input_ids").alias("n_tokens"))


# --- views -------------------------------------------------------------------

VIEWS_SQL = FLAGGED + """, v as (
  select 'nighttime_person_' || split as name from flagged where timeofday='night' and has_person
  union all select 'rider_' || split from flagged where has_rider
  union all select 'nighttime_rider_' || split from flagged where timeofday='night' and has_rider
  union all select 'distant_person_' || split from flagged where has_person and person_bbox_area_pct < 30.0),
counts as (select name, count(*) as rows from v group by name)
"""


def curated(spark, d) -> TableStore:
    store = frame_store(spark, d)
    views.create_views(store, "frames", {**views.ANNOTATION_VIEWS, **views.PERSON_VIEWS})
    return store


@query(
    "create_view",
    FLAGGED + "select frame_key, image_id, split from flagged where has_rider and split='val'",
)
def create_view(spark, d):
    store = frame_store(spark, d)
    views.create_view(store, "rider_val", "frames", "split = 'train'")
    views.create_view(store, "rider_val", "frames", views.ANNOTATION_VIEWS["rider_val"])
    return store.read("rider_val").select("frame_key", "image_id", "split")


@query("curate_views", VIEWS_SQL + "select name, rows from counts")
def curate_views(spark, d):
    status = views.view_status(curated(spark, d), "frames")
    return status.where("NOT is_source").select("name", "rows")


@query(
    "view_status",
    VIEWS_SQL
    + """select name, rows, cast(1 as bigint) as version, false as is_source from counts
      union all select 'frames', count(*), 2, true from frames""",
)
def view_status(spark, d):
    return views.view_status(curated(spark, d), "frames")


@query(
    "view_health",
    FLAGGED
    + """select 'rider_' || split as name, count(*) as rows, 'PASS' as status from flagged where has_rider group by split
      union all select unnest(['nighttime_person_train','nighttime_person_val','distant_person_train','distant_person_val']), null, 'FAIL'""",
)
def view_health(spark, d):
    store = frame_store(spark, d, features=["has_rider"])
    chosen = {n: f for n, f in views.ANNOTATION_VIEWS.items() if n.startswith("rider")}
    views.create_views(store, "frames", chosen)
    return health.view_health(views.view_status(store, "frames"))


@query(
    "add_view",
    FLAGGED
    + """select frame_key, scene, weather from flagged where weather='snowy' and scene='highway' and split='train'
      and (is_duplicate is null or not is_duplicate)""",
)
def add_view(spark, d):
    from quern.plans.inputs import flagged_frames

    store = frame_store(spark, d, features=[])
    flags = flagged_frames(spark, d).select("frame_key", "is_duplicate")
    store.add_columns("frames", flags)
    condition = "weather = 'snowy' AND scene = 'highway' AND split = 'train'"
    views.create_view(store, "snowy_train", "frames", condition)
    return store.read("snowy_train").select("frame_key", "scene", "weather")


GROWN = FLAGGED + """, g as (select 'rider_' || split as name, count(*) filter (where frame_key%2=0) as before, count(*) as after
  from flagged where has_rider group by split)
"""


def grown_store(spark, d) -> TableStore:
    """Views over half of the frames, then the other half appended and filled."""
    store = frame_store(spark, d, half(frames(spark, d), 0), features=["has_rider"])
    chosen = {n: f for n, f in views.ANNOTATION_VIEWS.items() if n.startswith("rider")}
    views.create_views(store, "frames", chosen)
    store.append("frames", half(frames(spark, d), 1))
    backfill.backfill(store, "frames", ["has_rider"], ANNOTATION_FEATURES)
    return store


@query("refresh_delta", GROWN + "select name, before, after, after-before as delta from g")
def refresh_delta(spark, d):
    return views.refresh_views(grown_store(spark, d))


@query(
    "refresh_view",
    FLAGGED + "select frame_key, split from flagged where has_rider and split='train'",
)
def refresh_view(spark, d):
    store = grown_store(spark, d)
    views.refresh_view(store, "rider_train")
    return store.read("rider_train").select("frame_key", "split")


@query(
    "refresh_after_fill",
    FLAGGED
    + """select frame_key, split, is_duplicate from flagged where has_rider and split='train'
      and (is_duplicate is null or not is_duplicate)""",
)
def refresh_after_fill(spark, d):
    """Flags that arrive after a refresh take rows out of the view again."""
    from quern.plans.inputs import flagged_frames

    flags = flagged_frames(spark, d).select("frame_key", "is_duplicate")
    store = frame_store(spark, d, half(frames(spark, d), 0), features=["has_rider"])
    store.add_columns("frames", half(flags, 0))
    views.create_view(store, "rider_train", "frames", views.ANNOTATION_VIEWS["rider_train"])
    store.append("frames", half(frames(spark, d), 1))
    backfill.backfill(store, "frames", ["has_rider"], ANNOTATION_FEATURES)
    views.refresh_view(store, "rider_train")
    store.add_columns("frames", half(flags, 1))
    views.refresh_view(store, "rider_train")
    return store.read("rider_train").select("frame_key", "split", "is_duplicate")


@query(
    "materialize_spec",
    FLAGGED
    + "select frame_key from flagged where timeofday='night' and has_person and person_bbox_area_pct < 2.0",
)
def materialize_spec(spark, d):
    store = frame_store(spark, d)
    name = views.materialize_spec(store, "frames", "nighttime_distant_person", bbox_pct=2.0)
    views.materialize_spec(store, "frames", "nighttime_distant_person")
    return store.read(name).select("frame_key")


@query(
    "append_refresh_cycle",
    with_sql("frames")
    + """select o_orderkey, o_custkey, o_totalprice, o_totalprice >= 300000 as is_big, o_totalprice >= 300000 as in_view from orders""",
)
def append_refresh_cycle(spark, d):
    """Orders arrive as files; each batch is appended, flagged and reflected in the view."""
    store = new_store(spark)
    orders = table(spark, d, "orders")
    store.create("orders", orders.where("false"), "o_orderkey")
    big = Feature(("o_totalprice",), T.BooleanType(), lambda c: c >= 300_000)
    backfill.backfill(store, "orders", ["is_big"], {"is_big": big})
    views.create_view(store, "big_orders", "orders", "is_big = true")
    drops = fresh_path(spark, "drops")
    orders.repartitionByRange(4, "o_orderkey").write.parquet(drops)
    stream = file_stream(spark, drops, orders.schema, files_per_batch=2)
    checkpoint = fresh_path(spark, "stream")
    run_cycle(
        store, stream, "orders", ["is_big"], {"is_big": big}, ["big_orders"], checkpoint
    ).awaitTermination()
    store.reopen()
    seen = store.read("big_orders").select("o_orderkey", F.lit(True).alias("in_view"))
    rows = store.read("orders").select("o_orderkey", "o_custkey", "o_totalprice", "is_big")
    return rows.join(seen, "o_orderkey", "left").withColumn(
        "in_view", F.coalesce("in_view", F.lit(False))
    )


@query(
    "flag_by_ids",
    """select c_custkey, exists (select 1 from orders where o_custkey = c_custkey) as has_orders from customer""",
)
def flag_by_ids(spark, d):
    ids = table(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey")).distinct()
    return membership_flag(
        table(spark, d, "customer").select("c_custkey"), ids, "c_custkey", "has_orders"
    )
