"""Exact and near duplicates."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions.text import content_key
from quern.functions.vectors import hamming
from quern.operators.counts import percent
from quern.operators.filters import SUMMARY_BBOX_PCT
from quern.schema import CANARY_PREFIX, FRAME_SCHEMA, HAMMING_THRESHOLD
from quern.session import checkpointed

BANDS, BAND_BITS = 4, 16
BAND_MASK = (1 << BAND_BITS) - 1

# A band value shared by more distinct hashes than this is split by a second band.
HOT_BAND_ROWS = 32_768

PROBES_PER_TASK = 2_000_000

# Rows per content key beyond which a lookup by that key is salted.
HOT_KEY_ROWS = 1_000_000
SALTS = 64
BROADCAST_KEYS = 100_000

CLEAN = "(is_duplicate IS NULL OR is_duplicate = false)"

# The train views whose loss of rows is reported.
TRAIN_VIEWS = {
    "rider_train": "has_rider = true AND split = 'train'",
    "nighttime_person_train": "timeofday = 'night' AND has_person = true AND split = 'train'",
    "distant_person_train": (
        f"has_person = true AND person_bbox_area_pct < {SUMMARY_BBOX_PCT} AND split = 'train'"
    ),
}


def keepers(df: DataFrame, id_col: str, key: Column) -> DataFrame:
    """(content, keep_id, n): the lowest id of each key and its number of rows.

    A plain aggregate, so a content copied across a third of the table shrinks to
    one row per task before the shuffle.
    """
    keyed = df.select(F.col(id_col).alias("_id"), key.alias("content"))
    return (
        keyed.where(F.col("content").isNotNull())
        .groupBy("content")
        .agg(F.min("_id").alias("keep_id"), F.count("*").alias("n"))
    )


def flag_repeats(keyed: DataFrame, id_col: str, key: str) -> DataFrame:
    """Replace ``key`` by ``is_dup``: false for the lowest id of each key, true for the rest.

    The flag comes from a join on the id, which is unique, never on the key, whose
    groups may be huge. A NULL key gives NULL.
    """
    first = keepers(keyed, id_col, F.col(key)).select(
        F.col("keep_id").alias(id_col), F.lit(True).alias("_first")
    )
    flag = F.when(F.col(key).isNotNull(), F.col("_first").isNull())
    return keyed.join(first, id_col, "left").withColumn("is_dup", flag).drop("_first", key)


def repeat_flags(df: DataFrame, id_col: str = "id", text: str = "text", carry: tuple = ()):
    """(id, carried columns, is_dup): repeats of a whitespace-normalized text.

    The text is read once. Its 16-byte hashes are written to the shared folder and
    both passes, finding the first of each and flagging the rest, run on those.
    """
    keyed = df.select(id_col, *carry, content_key(F.col(text)).alias("_content"))
    return flag_repeats(checkpointed(keyed), id_col, "_content")


def repeat_ids(df: DataFrame, id_col: str = "id", text: str = "text") -> DataFrame:
    """Ids of all rows but the first of each normalized text."""
    return repeat_flags(df, id_col, text).where("is_dup").select(id_col)


def membership_flag(df: DataFrame, ids: DataFrame, id_col: str, flag: str) -> DataFrame:
    """Add ``flag``: is the row's id in a set of unique ids."""
    marked = ids.select(id_col, F.lit(True).alias(flag))
    return df.join(marked, id_col, "left").withColumn(flag, F.coalesce(flag, F.lit(False)))


# --- Hamming neighbors -------------------------------------------------------


def _flips(radius: int) -> list[int]:
    """All band masks with at most ``radius`` bits."""
    return [
        sum(1 << b for b in bits)
        for r in range(radius + 1)
        for bits in combinations(range(BAND_BITS), r)
    ]


def _band(h: Column, index: Column | int) -> Column:
    index = F.lit(index) if isinstance(index, int) else index
    shift = index * BAND_BITS
    return F.call_function("shiftrightunsigned", h, shift.cast("int")).bitwiseAND(
        F.lit(BAND_MASK).cast("bigint")
    )


def _band_key(band: Column, value: Column) -> Column:
    return band.cast("bigint") * (1 << BAND_BITS) + value


def _pair_key(first_key: Column, band: Column, value: Column) -> Column:
    """Key of two bands; the offset keeps it apart from every one-band key."""
    return (first_key + 1) * (BANDS << BAND_BITS) + _band_key(band, value)


def _int_array(values: list[int]) -> Column:
    return F.array(*[F.lit(v).cast("bigint") for v in values])


def _band_targets(hashes: DataFrame) -> DataFrame:
    """(h, keep_id, band, key): four rows per hash."""
    bands = F.array(*[F.struct(F.lit(b).alias("band"), _band(F.col("h"), b).alias("v")) for b in range(BANDS)])
    rows = hashes.select("h", "keep_id", F.inline(bands))
    return rows.select("h", "keep_id", "band", _band_key(F.col("band"), F.col("v")).alias("key"))


def _band_probes(hashes: DataFrame, threshold: int) -> DataFrame:
    """(q, band, used, key): every band value within reach of the hash."""
    masks = _int_array(_flips(threshold // BANDS))
    rows = hashes.select(F.col("h").alias("q"), F.explode(_int_array(list(range(BANDS)))).alias("band"))
    rows = rows.select("q", "band", F.explode(masks).alias("mask"))
    value = _band(F.col("q"), F.col("band")).bitwiseXOR(F.col("mask"))
    return rows.select(
        "q",
        F.col("band").cast("int").alias("band"),
        F.bit_count("mask").alias("used"),
        _band_key(F.col("band"), value).alias("key"),
    )


def _other_bands(band: Column) -> Column:
    return F.filter(_int_array(list(range(BANDS))), lambda b: b != band)


def _split_hot(targets: DataFrame, probes: DataFrame, hot: DataFrame, threshold: int):
    """Give the rows of hot band values a second band as part of the key.

    If a band differs in e bits, the other three differ in at most threshold - e
    together, so one of them in at most a third of that: probing that radius in
    each of them loses no pair.
    """
    hot = F.broadcast(hot.select("key", F.lit(True).alias("hot")))
    marked_t = targets.join(hot, "key", "left")
    marked_p = probes.join(hot, "key", "left")

    second_t = marked_t.where("hot").select(
        "h", "keep_id", "key", F.explode(_other_bands(F.col("band").cast("bigint"))).alias("c")
    )
    second_t = second_t.select(
        "h", "keep_id", _pair_key(F.col("key"), F.col("c"), _band(F.col("h"), F.col("c"))).alias("key")
    )
    radius = F.expr(f"({threshold} - used) div {BANDS - 1}")
    by_radius = F.array(*[_int_array(_flips(r)) for r in range(threshold // (BANDS - 1) + 1)])
    second_p = marked_p.where("hot").select(
        "q", "key", "used", F.explode(_other_bands(F.col("band").cast("bigint"))).alias("c")
    )
    second_p = second_p.select("q", "key", "c", F.explode(F.get(by_radius, radius.cast("int"))).alias("mask"))
    second_p = second_p.select(
        "q",
        _pair_key(
            F.col("key"), F.col("c"), _band(F.col("q"), F.col("c")).bitwiseXOR(F.col("mask"))
        ).alias("key"),
    )
    cold_t = marked_t.where("hot IS NULL").select("h", "keep_id", "key")
    cold_p = marked_p.where("hot IS NULL").select("q", "key")
    return cold_t.unionByName(second_t), cold_p.unionByName(second_p)


def nearest_distinct(
    hashes: DataFrame,
    queries: DataFrame,
    threshold: int = HAMMING_THRESHOLD,
    hot_band_rows: int = HOT_BAND_ROWS,
) -> DataFrame:
    """(h, distance, near_id): nearest different hash within ``threshold`` bits.

    ``hashes`` has (h, keep_id) with unique h; ``queries`` has h. Exact: two hashes
    that differ in at most ``threshold`` bits differ in at most a quarter of them
    in one of four bands, and every such band value is probed (multi-index
    hashing, Norouzi et al. 2012). Ties go to the lowest id. Pairs beyond the
    threshold are dropped inside the join and the rest is reduced before the
    shuffle.
    """
    targets = _band_targets(hashes)
    # One hash becomes hundreds of probes, so tasks are sized by probes, not by bytes.
    fan_out = BANDS * len(_flips(threshold // BANDS))
    tasks = -(-queries.count() * fan_out // PROBES_PER_TASK)
    spread = queries.repartition(max(tasks, queries.sparkSession.sparkContext.defaultParallelism), "h")
    probes = _band_probes(spread, threshold)
    # At most BANDS * 2**BAND_BITS band values exist, so this table is bounded.
    hot = targets.groupBy("key").count().where(F.col("count") > hot_band_rows)
    if hot.isEmpty():
        targets, probes = targets.select("h", "keep_id", "key"), probes.select("q", "key")
    else:
        targets, probes = _split_hot(targets, probes, hot, threshold)
    distance = hamming(F.col("q"), F.col("h"))
    # The planner takes probes for no larger than the hashes they are made of and would broadcast them.
    pairs = probes.hint("merge").join(targets, "key").where((F.col("q") != F.col("h")) & (distance <= threshold))
    best = pairs.groupBy("q").agg(
        F.min(F.struct(distance.alias("distance"), F.col("keep_id").alias("near_id"))).alias("best")
    )
    return best.select(F.col("q").alias("h"), "best.distance", "best.near_id")


def salted_lookup(df: DataFrame, table: DataFrame, key: str, row_id: str, rows: str) -> DataFrame:
    """Left join of ``df`` to ``table`` (unique ``key``) that spreads hot keys.

    ``rows`` is a column of ``table`` with the number of ``df`` rows per key. Keys
    above HOT_KEY_ROWS are copied once per salt. There are at most
    count(df) / HOT_KEY_ROWS of them; the set is broadcast only if small enough.
    """
    hot = table.where(F.col(rows) > HOT_KEY_ROWS).select(key, F.lit(True).alias("_hot"))
    n_hot = hot.count()
    if n_hot == 0:
        return df.join(table, key, "left")
    if n_hot <= BROADCAST_KEYS:
        hot = F.broadcast(hot)
    salt = F.pmod(F.xxhash64(row_id), F.lit(SALTS)).cast("int")
    left = df.join(hot, key, "left").withColumn("_salt", F.when(F.col("_hot"), salt).otherwise(0))
    salts = F.when(F.col(rows) > HOT_KEY_ROWS, F.sequence(F.lit(0), F.lit(SALTS - 1)))
    right = table.withColumn("_salt", F.explode(F.coalesce(salts, F.array(F.lit(0)))))
    return left.join(right, [key, "_salt"], "left").drop("_hot", "_salt")


def hamming_neighbors(
    df: DataFrame,
    id_col: str,
    hash_col: str,
    threshold: int = HAMMING_THRESHOLD,
    hot_band_rows: int = HOT_BAND_ROWS,
    only: DataFrame | None = None,
) -> DataFrame:
    """(id, distance, near_id, first): nearest other row per hashed row within the
    threshold, NULL distance when there is none. ``only`` (unique ids) limits the rows
    that are asked about, not those they are compared with.

    Equal hashes collapse first: a group of copies is settled at distance 0 by one
    aggregate and never paired with itself. ``first`` marks one row per hash.
    """
    rows = df.where(F.col(hash_col).isNotNull()).select(
        F.col(id_col).alias("id"), F.col(hash_col).alias("h")
    )
    # One narrow row per hash, used by every step below.
    kept = checkpointed(keepers(rows, "id", F.col("h")).withColumnRenamed("content", "h"))
    firsts = kept.select(F.col("keep_id").alias("id"), F.lit(True).alias("first"))
    rest = rows.join(firsts, "id", "left_anti")
    second = rest.groupBy("h").agg(F.min("id").alias("second_id"))
    queries = kept.where("n = 1").select("h")
    if only is not None:
        asked = only.select(F.col(id_col).alias("id"))
        rows = rows.join(asked, "id", "left_semi")
        queries = queries.join(rows.select("h"), "h", "left_semi")
    near = nearest_distinct(kept.select("h", "keep_id"), queries, threshold, hot_band_rows)
    settled = kept.join(second, "h", "left").join(near, "h", "left")
    table = settled.select("h", "keep_id", "n", "second_id", "distance", "near_id")
    found = salted_lookup(rows, table, "h", "id", "n")
    first = F.col("id") == F.col("keep_id")
    copied = F.col("n") > 1
    return found.select(
        "id",
        F.when(copied, 0).otherwise(F.col("distance")).cast("int").alias("distance"),
        F.when(copied & first, F.col("second_id"))
        .when(copied, F.col("keep_id"))
        .otherwise(F.col("near_id"))
        .alias("near_id"),
        first.alias("first"),
    )


def flag_near_duplicates(
    df: DataFrame,
    id_col: str,
    hash_col: str,
    threshold: int = HAMMING_THRESHOLD,
    keep_first: bool = False,
    hot_band_rows: int = HOT_BAND_ROWS,
    only: DataFrame | None = None,
) -> DataFrame:
    """(id, is_duplicate): has another row within ``threshold`` bits; NULL without a hash.

    Both rows of a pair are flagged. With ``keep_first`` the first of a group of
    equal hashes stays unflagged unless a different hash is close to it.
    """
    near = hamming_neighbors(df, id_col, hash_col, threshold, hot_band_rows, only)
    flag = F.col("distance").isNotNull()
    if keep_first:
        flag = flag & ~(F.col("first") & (F.col("distance") == 0))
    hashed = near.select(F.col("id").alias(id_col), flag.alias("is_duplicate"))
    unhashed = df.where(F.col(hash_col).isNull()).select(
        id_col, F.lit(None).cast("boolean").alias("is_duplicate")
    )
    if only is not None:
        unhashed = unhashed.join(only.select(id_col), id_col, "left_semi")
    return hashed.unionByName(unhashed)


def nearest_pairs(
    flagged: DataFrame,
    all_rows: DataFrame,
    id_col: str,
    hash_col: str,
    n: int,
    pool: int,
    threshold: int = HAMMING_THRESHOLD,
) -> DataFrame:
    """First ``n`` pairs (id, near_id, distance) among the first ``pool`` flagged rows."""
    chosen = flagged.where("is_duplicate").orderBy(id_col).limit(pool).select(id_col)
    near = hamming_neighbors(all_rows, id_col, hash_col, threshold, only=chosen)
    pairs = near.where(F.col("distance").isNotNull())
    return pairs.select("id", "near_id", "distance").orderBy("id").limit(n)


# --- canaries and reports ----------------------------------------------------


def inject_canaries(df: DataFrame, n: int, key: str = "image_id", hash_col: str = "dhash"):
    """Append copies of ``n`` hashed train rows under new ids.

    Base columns and the hash are copied; every other derived column is NULL.
    """
    carried = {*FRAME_SCHEMA.fieldNames(), hash_col}
    source = df.where((F.col("split") == "train") & F.col(hash_col).isNotNull())
    source = source.orderBy(key).limit(n)
    copies = source.select(
        F.concat(F.lit(CANARY_PREFIX), F.col(key)).alias(key),
        *[F.col(c) for c in df.columns if c in carried and c != key],
    )
    return df.unionByName(copies, allowMissingColumns=True)


def is_canary(key: str = "image_id") -> Column:
    return F.col(key).startswith(CANARY_PREFIX)


def verify_canaries(df: DataFrame, key: str = "image_id") -> DataFrame:
    """Injected, flagged and missed canaries, PASS when none is missed."""
    row = df.agg(
        F.count_if(is_canary(key)).alias("injected"),
        F.count_if(is_canary(key) & F.col("is_duplicate")).alias("flagged"),
    ).withColumn("missed", F.col("injected") - F.col("flagged"))
    return row.withColumn("status", F.when(F.col("missed") == 0, "PASS").otherwise("FAIL"))


def delete_where(df: DataFrame, condition: Column) -> DataFrame:
    """Rows that do not satisfy the condition; rows where it is NULL stay."""
    return df.where(~F.coalesce(condition, F.lit(False)))


def duplicate_rate(df: DataFrame) -> DataFrame:
    """Totals and percentages of flagged frames."""
    row = df.agg(
        F.count("*").alias("total"),
        F.count("is_duplicate").alias("backfilled"),
        F.count_if("is_duplicate").alias("duplicates"),
    ).withColumn("eligible", F.col("total") - F.col("duplicates"))
    shares = {
        f"{c}_pct": percent(F.col(c), F.col("total"))
        for c in ("backfilled", "duplicates", "eligible")
    }
    return row.withColumns(shares)


def split_impact(df: DataFrame, views: dict[str, str] | None = None) -> DataFrame:
    """Rows of each train view before and after dropping copies; one scan."""
    views = TRAIN_VIEWS if views is None else views
    counts = df.agg(
        F.array(
            *[
                F.struct(
                    F.lit(name).alias("split"),
                    F.count_if(F.expr(sql)).alias("before"),
                    F.count_if(F.expr(f"({sql}) AND {CLEAN}")).alias("after"),
                )
                for name, sql in views.items()
            ]
        ).alias("rows")
    )
    rows = counts.select(F.inline("rows"))
    removed = F.col("before") - F.col("after")
    return rows.withColumns({"removed": removed, "removed_pct": percent(removed, F.col("before"))})


