"""Queries over frames: filters, features, counts, canaries and duplicates."""

from __future__ import annotations

from pyspark.sql import functions as F

from quern.functions import boxes as box_fn
from quern.functions import vectors as vec_fn
from quern.functions.frames import add_features, feature_registry
from quern.operators import counts, dedup, filters, health
from quern.plans.inputs import bit_vectors, flagged_frames, frames, with_sql
from quern.plans.registry import query
from quern.schema import missing_columns, require_columns

FLAGGED = with_sql("frames", "flagged")


@query(
    "count_where",
    FLAGGED + "select count(*) as n from flagged where timeofday='night' and has_person",
)
def count_where(spark, d):
    return filters.count_where(flagged_frames(spark, d), filters.spec_filter("nighttime_person"))


@query(
    "preview",
    FLAGGED
    + """select image_id, split, weather, timeofday, scene_description, num_annotations
    from flagged where timeofday='night' and has_rider order by image_id limit 20""",
)
def preview(spark, d):
    rows = flagged_frames(spark, d)
    shown = filters.preview(rows, filters.spec_filter("nighttime_rider"), "image_id")
    return shown.select(
        "image_id", "split", "weather", "timeofday", "scene_description", "num_annotations"
    )


@query(
    "spec_filters",
    FLAGGED
    + """select frame_key, timeofday='night' and has_person as nighttime_person, has_rider as rider,
      timeofday='night' and has_rider as nighttime_rider, timeofday='daytime' and weather='clear' as daytime_clear,
      has_person and person_bbox_area_pct < 5.0 as distant_person,
      timeofday='night' and has_person and person_bbox_area_pct < 5.0 as nighttime_distant_person from flagged""",
)
def spec_filters(spark, d):
    flags = [F.expr(filters.spec_filter(s)).alias(s) for s in filters.SPEC_FILTERS]
    return flagged_frames(spark, d).select("frame_key", *flags)


@query(
    "spec_counts",
    FLAGGED
    + """select s.spec, cast(s.n as bigint) as n from (select
      count(*) filter (where timeofday='night' and has_person) as nighttime_person,
      count(*) filter (where has_rider) as rider,
      count(*) filter (where timeofday='night' and has_rider) as nighttime_rider,
      count(*) filter (where timeofday='daytime' and weather='clear') as daytime_clear,
      count(*) filter (where has_person and person_bbox_area_pct < 30.0) as distant_person,
      count(*) filter (where timeofday='night' and has_person and person_bbox_area_pct < 30.0) as nighttime_distant_person
      from flagged) t, lateral (select unnest(['nighttime_person','rider','nighttime_rider','daytime_clear','distant_person','nighttime_distant_person']) as spec,
      unnest([nighttime_person,rider,nighttime_rider,daytime_clear,distant_person,nighttime_distant_person]) as n) s""",
)
def spec_counts(spark, d):
    return counts.spec_counts(flagged_frames(spark, d))


@query(
    "spec_counts_missing_column",
    with_sql("frames")
    + """select 'daytime_clear' as spec, count(*) as n from frames where timeofday='daytime' and weather='clear'
      union all select unnest(['nighttime_person','rider','nighttime_rider','distant_person','nighttime_distant_person']), -1""",
)
def spec_counts_missing_column(spark, d):
    return counts.spec_counts(frames(spark, d))


@query(
    "dedup_clause",
    FLAGGED
    + """select 'rider_train' as view_name, frame_key from flagged where has_rider and split='train'
      and (is_duplicate is null or not is_duplicate)
      union all select 'rider_val', frame_key from flagged where has_rider and split='val'""",
)
def dedup_clause(spark, d):
    rows = flagged_frames(spark, d)

    def view(name):
        condition = f"has_rider = true AND split = '{name.split('_')[-1]}'"
        kept = rows.where(condition + filters.dedup_clause(rows, name))
        return kept.select(F.lit(name).alias("view_name"), "frame_key")

    return view("rider_train").unionByName(view("rider_val"))


@query(
    "null_predicate",
    FLAGGED
    + "select count(*) filter (where is_duplicate is null) as nulls, count(is_duplicate) as filled from flagged",
)
def null_predicate(spark, d):
    flag = F.col("is_duplicate")
    return flagged_frames(spark, d).agg(
        F.count_if(flag.isNull()).alias("nulls"), F.count_if(flag.isNotNull()).alias("filled")
    )


@query(
    "project",
    with_sql("frames")
    + "select image_id, array_to_string(ann_categories, ',') as categories, num_annotations from frames",
)
def project(spark, d):
    return frames(spark, d).select(
        "image_id", F.array_join("ann_categories", ",").alias("categories"), "num_annotations"
    )


@query(
    "valid_target_filter",
    FLAGGED
    + """select f.frame_key, coalesce(string_agg(t.label || ':' || t.x1 || ',' || t.y1 || ',' || t.x2 || ',' || t.y2, ';' order by t.i), '') as targets
      from frames f left join (
        select frame_key, i, m.label, box[1] as x1, box[2] as y1, box[3] as x2, box[4] as y2
        from (select frame_key, unnest(ann_categories) as category, unnest(ann_bboxes) as box,
                unnest(range(num_annotations)) as i from frames) a
        join (values ('person',1),('rider',1),('bicycle',2),('car',3),('motorcycle',4),('bus',6),('train',7),('truck',8),('traffic light',10)) m(category,label)
          using (category) where box[3] > box[1] and box[4] > box[2]) t using (frame_key) group by f.frame_key""",
)
def valid_target_filter(spark, d):
    targets = box_fn.valid_targets(F.col("ann_categories"), F.col("ann_bboxes"))
    as_text = F.transform(
        targets,
        lambda t: F.concat(
            t["label"].cast("string"), F.lit(":"), F.array_join(t["box"].cast("array<int>"), ",")
        ),
    )
    return frames(spark, d).select("frame_key", F.array_join(as_text, ";").alias("targets"))


@query(
    "required_columns",
    """select unnest(['dhash', 'has_person', 'white_balance']) as missing, (select count(*) from orders) as rows_lacking""",
)
def required_columns(spark, d):
    rows = require_columns(frames(spark, d), ["image_id", "ann_categories"])
    wanted = ["image_id", "has_person", "white_balance", "dhash"]
    lacking = F.array(*[F.lit(c) for c in missing_columns(rows, wanted)])
    total = rows.agg(F.count("*").alias("rows_lacking"))
    return total.select(F.explode(lacking).alias("missing"), "rows_lacking")


@query(
    "category_map",
    """select frame_key, category, m.label from (select l_orderkey as frame_key,
      (['car','truck','bus','person','rider','bicycle','motorcycle','traffic light','traffic sign','train'])[1+l_partkey%10] as category from lineitem) b
      left join (values ('person',1),('rider',1),('bicycle',2),('car',3),('motorcycle',4),('bus',6),('train',7),('truck',8),('traffic light',10)) m(category,label) using (category)""",
)
def category_map(spark, d):
    from quern.plans.inputs import boxes

    label = box_fn.category_class(F.col("category"))
    return boxes(spark, d).select("frame_key", "category", label.alias("label"))


# --- features ----------------------------------------------------------------


@query("array_has", FLAGGED + "select frame_key, has_person, has_rider from flagged")
def array_has(spark, d):
    return add_features(frames(spark, d), ["has_person", "has_rider"]).select(
        "frame_key", "has_person", "has_rider"
    )


@query(
    "scene_flags", FLAGGED + "select frame_key, scene_has_crossroad, scene_has_mountain from flagged"
)
def scene_flags(spark, d):
    names = ["scene_has_crossroad", "scene_has_mountain"]
    return add_features(frames(spark, d), names).select("frame_key", *names)


@query("scene_description", FLAGGED + "select frame_key, scene_description from flagged")
def scene_description(spark, d):
    rows = add_features(frames(spark, d), ["scene_description"])
    return rows.select("frame_key", "scene_description")


@query(
    "bbox_area_pct",
    with_sql("frames", "flagged")
    + """select frame_key, round(sum(greatest(0,box[3]-box[1])*greatest(0,box[4]-box[2])/cast(921600 as double)*100), 6) as covered_pct
      from anns group by frame_key""",
)
def bbox_area_pct(spark, d):
    areas = F.transform(
        "ann_bboxes",
        lambda b: box_fn.clipped_area(b) / (F.col("width").cast("double") * F.col("height")) * 100,
    )
    covered = F.aggregate(areas, F.lit(0.0), lambda acc, x: acc + x)
    return (
        frames(spark, d)
        .where("num_annotations > 0")
        .select("frame_key", F.round(covered, 6).alias("covered_pct"))
    )


@query(
    "person_bbox_area_pct",
    FLAGGED
    + "select frame_key, round(cast(person_bbox_area_pct as double), 5) as person_bbox_area_pct from flagged",
)
def person_bbox_area_pct(spark, d):
    rows = add_features(frames(spark, d), ["person_bbox_area_pct"])
    area = F.round(F.col("person_bbox_area_pct").cast("double"), 5)
    return rows.select("frame_key", area.alias("person_bbox_area_pct"))


@query(
    "argmax_box",
    FLAGGED
    + """, dets as (select frame_key, unnest(ann_categories) as category, unnest(ann_bboxes) as box,
        unnest(range(num_annotations)) as i from frames),
      ranked as (select frame_key, box, row_number() over (partition by frame_key
          order by (box[3]-box[1])*(box[4]-box[2]) desc, i) as r from dets
        where category in ('person','rider') and (frame_key*13+i*29)%100 >= 30)
      select f.frame_key, coalesce(array_to_string(r.box, ','), '0,0,0,0') as box
      from frames f left join (select * from ranked where r=1) r using (frame_key)""",
)
def argmax_box(spark, d):
    rows = frames(spark, d)
    labels = F.transform("ann_categories", box_fn.category_class)
    scores = F.transform(
        "ann_categories",
        lambda c, i: F.pmod(F.col("frame_key") * 13 + i * 29, F.lit(100)).cast("double") / 100,
    )
    best = box_fn.largest_detection(F.col("ann_bboxes"), labels, scores)
    return rows.select("frame_key", F.array_join(best.cast("array<int>"), ",").alias("box"))


@query(
    "udf_registry",
    FLAGGED
    + """select frame_key, has_person, has_rider, scene_has_crossroad, scene_has_mountain, scene_description,
      person_bbox_area_pct < 1.0 as small_person from flagged""",
)
def udf_registry(spark, d):
    rows = add_features(frames(spark, d), registry=feature_registry())
    return rows.select(
        "frame_key", "has_person", "has_rider", "scene_has_crossroad", "scene_has_mountain",
        "scene_description", (F.col("person_bbox_area_pct") < 1.0).alias("small_person"),
    )


# --- reports -----------------------------------------------------------------


@query(
    "duplicate_rate",
    FLAGGED
    + """select total, backfilled, duplicates, total-duplicates as eligible, round(backfilled*100.0/total,6) as backfilled_pct,
      round(duplicates*100.0/total,6) as duplicates_pct, round((total-duplicates)*100.0/total,6) as eligible_pct
      from (select count(*) as total, count(is_duplicate) as backfilled, count(*) filter (where is_duplicate) as duplicates from flagged)""",
)
def duplicate_rate(spark, d):
    row = dedup.duplicate_rate(flagged_frames(spark, d))
    shares = ["backfilled_pct", "duplicates_pct", "eligible_pct"]
    return row.withColumns({c: F.round(c, 6) for c in shares})


@query(
    "split_impact",
    FLAGGED
    + """, v as (select 'rider_train' as split, * exclude (split) from flagged where has_rider and split='train'
      union all select 'nighttime_person_train', * exclude (split) from flagged where timeofday='night' and has_person and split='train'
      union all select 'distant_person_train', * exclude (split) from flagged where has_person and person_bbox_area_pct<30 and split='train'),
      c as (select split, count(*) as before, count(*) filter (where is_duplicate is null or not is_duplicate) as after from v group by split)
      select split, before, after, before-after as removed, round((before-after)*100.0/before,6) as removed_pct from c""",
)
def split_impact(spark, d):
    rows = dedup.split_impact(flagged_frames(spark, d))
    return rows.withColumn("removed_pct", F.round("removed_pct", 6))


@query(
    "backfill_coverage",
    FLAGGED
    + """select column_name, filled, total-filled as nulls, total, case when filled=total then 'PASS' else 'WARN' end as status
      from (select count(*) as total, count(has_person) as a, count(has_rider) as b, count(scene_description) as c,
        count(scene_has_crossroad) as d, count(scene_has_mountain) as e, count(person_bbox_area_pct) as f, count(is_duplicate) as g from flagged) t,
      lateral (select unnest(['has_person','has_rider','scene_description','scene_has_crossroad','scene_has_mountain','person_bbox_area_pct','is_duplicate']) as column_name,
        unnest([a,b,c,d,e,f,g]) as filled)
      union all select unnest(['white_balance','dhash']), null, null, (select count(*) from frames), 'FAIL'""",
)
def backfill_coverage(spark, d):
    return health.column_coverage(flagged_frames(spark, d))


@query(
    "status_summary",
    FLAGGED
    + """, c as (select unnest([count(has_person), count(has_rider), count(scene_description), count(scene_has_crossroad),
        count(scene_has_mountain), count(person_bbox_area_pct), count(is_duplicate), -1, -1]) as filled, count(*) as total from flagged),
      s as (select case when filled=total then 'PASS' when filled<=0 then 'FAIL' else 'WARN' end as status from c
        union all select unnest(['PASS','PASS']))
      select status, count(*) as n from s group by status""",
)
def status_summary(spark, d):
    rows = flagged_frames(spark, d)
    return health.summarize(health.source_checks(rows), health.dedup_check(rows))


@query(
    "null_sample",
    FLAGGED
    + """, head as (select * from flagged order by frame_key limit 100)
      select 'is_duplicate' as column_name, count(*) filter (where is_duplicate is null) as nulls from head
      union all select 'has_person', count(*) filter (where has_person is null) from head""",
)
def null_sample(spark, d):
    return counts.null_sample(
        flagged_frames(spark, d), ["is_duplicate", "has_person"], "frame_key"
    )


@query("split_counts", with_sql("frames") + "select split, count(*) as n from frames group by split")
def split_counts(spark, d):
    return counts.split_counts(frames(spark, d))


@query(
    "percent_format",
    with_sql("frames")
    + """select weather, case when n=0 then '—' else printf('%.1f%%', k*100.0/n) end as share
      from (select weather, count(*) as n, count(*) filter (where num_annotations=0) as k from frames group by weather)""",
)
def percent_format(spark, d):
    rows = frames(spark, d).groupBy("weather").agg(
        F.count("*").alias("n"), F.count_if(F.col("num_annotations") == 0).alias("k")
    )
    return rows.select("weather", health.percent_text(F.col("k"), F.col("n")).alias("share"))


# --- bit vectors -------------------------------------------------------------

CANARIES = 1000

HASHES = (
    with_sql("hashes")
    + f""", canary as (select concat('syndup_', image_id) as image_id, split, h
        from (select * from bits where split='train' order by image_id limit {CANARIES})),
      hashed as (select image_id, split, h from bits union all select * from canary)"""
)


def packed_with_canaries(spark, d):
    rows = dedup.inject_canaries(bit_vectors(spark, d), CANARIES)
    return rows.withColumn("bits", vec_fn.pack_bits(F.col("dhash")))


@query("canary_inject", HASHES + "select image_id, split, h::varchar as bits from hashed")
def canary_inject(spark, d):
    rows = dedup.inject_canaries(bit_vectors(spark, d), CANARIES)
    text = F.array_join(F.col("dhash").cast("array<int>"), "")
    return rows.select("image_id", "split", text.alias("bits"))


@query("union_append", HASHES + "select split, count(*) as n from hashed group by split")
def union_append(spark, d):
    return counts.split_counts(dedup.inject_canaries(bit_vectors(spark, d), CANARIES))


@query(
    "prefix_predicate",
    HASHES + "select count(*) as n from hashed where starts_with(image_id, 'syndup_')",
)
def prefix_predicate(spark, d):
    rows = dedup.inject_canaries(bit_vectors(spark, d), CANARIES)
    return filters.count_where(rows, dedup.is_canary())


@query(
    "delete_where",
    with_sql("hashes") + "select image_id, split from bits",
)
def delete_where(spark, d):
    rows = dedup.inject_canaries(bit_vectors(spark, d), CANARIES)
    return dedup.delete_where(rows, dedup.is_canary()).select("image_id", "split")


NEIGHBORS = (
    HASHES
    + """, pairs as (select a.image_id, b.image_id as near_id, bit_count(xor(a.h, b.h)) as distance
        from hashed a join hashed b on a.image_id <> b.image_id),
      nearest as (select image_id, min(distance) as distance,
        arg_min(near_id, (distance, near_id)) as near_id from pairs where distance <= {t} group by image_id)"""
)


@query(
    "hamming_nn_join",
    NEIGHBORS.format(t=11)
    + """select h.image_id, cast(n.distance as int) as distance, n.near_id
      from hashed h left join nearest n using (image_id)""",
)
def hamming_nn_join(spark, d):
    near = dedup.hamming_neighbors(packed_with_canaries(spark, d), "image_id", "bits", threshold=11)
    return near.select(F.col("id").alias("image_id"), "distance", "near_id")


@query(
    "flag_near_duplicates",
    NEIGHBORS.format(t=10)
    + "select h.image_id, n.distance is not null as is_duplicate from hashed h left join nearest n using (image_id)",
)
def flag_near_duplicates(spark, d):
    return dedup.flag_near_duplicates(packed_with_canaries(spark, d), "image_id", "bits")


@query(
    "canary_verify",
    NEIGHBORS.format(t=10)
    + """select injected, flagged, injected-flagged as missed, case when injected=flagged then 'PASS' else 'FAIL' end as status
      from (select count(*) as injected, count(n.distance) as flagged
        from hashed h left join nearest n using (image_id) where starts_with(image_id,'syndup_'))""",
)
def canary_verify(spark, d):
    rows = packed_with_canaries(spark, d)
    return dedup.verify_canaries(dedup.flag_near_duplicates(rows, "image_id", "bits"))


@query(
    "nn_pairs_listing",
    NEIGHBORS.format(t=10)
    + """select id, near_id, distance from (select image_id as id, near_id, cast(distance as int) as distance
      from nearest order by image_id limit 60) order by id limit 20""",
)
def nn_pairs_listing(spark, d):
    rows = packed_with_canaries(spark, d)
    flags = dedup.flag_near_duplicates(rows, "image_id", "bits")
    return dedup.nearest_pairs(flags, rows, "image_id", "bits", n=20, pool=60)


@query(
    "hamming_distance",
    with_sql("hashes")
    + """select a.vec_id, cast(bit_count(xor(a.h, b.h)) as int) as distance from bits a
      join bits b on b.vec_id = (a.vec_id * 7 + 1) % (select count(*) from bits)""",
)
def hamming_distance(spark, d):
    from quern.plans.inputs import vectors

    rows = bit_vectors(spark, d).select(
        F.regexp_replace("image_id", "frame_0*(?=.)", "").cast("bigint").alias("vec_id"),
        vec_fn.pack_bits(F.col("dhash")).alias("h"),
    )
    total = vectors(spark, d).agg(F.count("*").alias("n"))
    other = rows.select(F.col("vec_id").alias("other"), F.col("h").alias("other_h"))
    paired = rows.join(F.broadcast(total)).withColumn(
        "other", F.pmod(F.col("vec_id") * 7 + 1, F.col("n"))
    )
    distance = vec_fn.hamming(F.col("h"), F.col("other_h"))
    return paired.join(other, "other").select("vec_id", distance.cast("int").alias("distance"))


