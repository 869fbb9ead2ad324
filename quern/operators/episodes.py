"""Windows of observations and actions around the rows of an episode."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quern.operators.dedup import salted_lookup
from quern.schema import ACTION_STEPS, OBSERVATION_STEPS

# Rows of an episode that share a window partition.
CHUNK_ROWS = 4096


def attach_bounds(rows: DataFrame, bounds: DataFrame) -> DataFrame:
    """Add the ``ep_start``/``ep_end`` of each row's episode; unknown episodes fail.

    ``bounds`` has one row per ``episode_index``.
    """
    table = bounds.select(
        "episode_index", "ep_start", "ep_end", (F.col("ep_end") - F.col("ep_start")).alias("_rows")
    )
    joined = salted_lookup(rows, table, "episode_index", "idx", "_rows").drop("_rows")
    message = F.concat(F.lit("episode not in bounds: "), F.col("episode_index").cast("string"))
    start = F.when(F.col("ep_start").isNull(), F.raise_error(message).cast("bigint"))
    return joined.withColumn("ep_start", start.otherwise(F.col("ep_start")))


def action_window_steps_column(width: Column, configured: list[int], n_obs_steps: int) -> Column:
    """The same rule for a column of widths."""
    first = 1 - n_obs_steps
    return (
        F.when(width == len(configured), F.array(*[F.lit(s) for s in configured]))
        .when(width == 1, F.array(F.lit(0)))
        .otherwise(F.sequence(F.lit(first), (width + (first - 1)).cast("int")))
    )


def pad_mask(idx: Column, start: Column, end: Column, steps: list[int]) -> Column:
    """For each step: does the row it points at lie outside [start, end)."""
    offsets = F.array(*[F.lit(s) for s in steps])
    return F.transform(offsets, lambda d: (idx + d < start) | (idx + d >= end))


def episode_windows(
    rows: DataFrame,
    value: str = "action",
    observation: str | None = None,
    action_steps: list[int] = ACTION_STEPS,
    observation_steps: list[int] = OBSERVATION_STEPS,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Add ``actions``, ``observations`` and ``action_is_pad`` arrays to each row.

    ``rows`` has idx, ep_start, ep_end, with idx dense inside an episode. Steps
    beyond an end repeat the end row. An episode is cut into chunks by idx, and the
    rows near a border are copied into the neighboring chunk, so a window
    partition holds about ``chunk_rows`` rows however long the episode is.
    """
    observation = observation or value
    steps = [*action_steps, *observation_steps]
    behind, ahead = max(0, -min(steps)), max(0, max(steps))
    chunk_rows = max(chunk_rows, behind + ahead)
    place = F.col("idx") - F.col("ep_start")
    home = F.floor(place / chunk_rows)
    previous = F.floor((place - ahead) / chunk_rows)
    following = F.floor((place + behind) / chunk_rows)
    copies = rows.withColumn("_home", home).withColumn(
        "_chunk", F.explode(F.array_distinct(F.array(home, previous, following)))
    )
    window = Window.partitionBy("ep_start", "_chunk").orderBy("idx")
    whole = window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)

    def at(column: str, step: int) -> Column:
        if step == 0:
            return F.col(column)
        if step > 0:
            return F.when(
                F.col("idx") + step < F.col("ep_end"), F.lead(column, step).over(window)
            ).otherwise(F.last(column).over(whole))
        return F.when(
            F.col("idx") + step >= F.col("ep_start"), F.lag(column, -step).over(window)
        ).otherwise(F.first(column).over(whole))

    windows = copies.withColumns(
        {
            "actions": F.array(*[at(value, s) for s in action_steps]),
            "observations": F.array(*[at(observation, s) for s in observation_steps]),
            "action_is_pad": pad_mask(
                F.col("idx"), F.col("ep_start"), F.col("ep_end"), action_steps
            ),
        }
    )
    return windows.where(F.col("_chunk") == F.col("_home")).drop("_chunk", "_home")


def time_windows(
    rows: DataFrame,
    group: str,
    time: str,
    key: str,
    value: str,
    offsets: list[int],
    tolerance: int,
    chunk: int = 3_600_000_000,
) -> DataFrame:
    """(key, values): for each row the ``value`` of the nearest row of its group at each offset of time.

    ``time`` is a whole number, such as microseconds, and so are ``offsets``, ``tolerance`` and
    ``chunk``; rows may be uneven in time. A row further than ``tolerance`` from the wanted time
    gives NULL. Ties: the earlier row, then the lower key. Keys are unique; rows without a time or
    group have NULL at every offset.

    Wanted times and rows are laid side by side in chunks of time, a row near a border in both of
    its chunks, and sorted; the nearest on either side is the last seen from either end. A group of
    any length is so cut to pieces, and rows that crowd one moment cost a sort, not their pairs.
    """
    chunk = max(chunk, 2 * tolerance + 1)
    in_chunk = lambda t: F.expr(f"cast(floor(({t}) / {chunk}) as bigint)")
    plain = rows.select(
        F.col(group).alias("_group"), F.col(time).cast("bigint").alias("_time"), F.col(key).alias("_key"), F.col(value).alias("_value"))
    timed = plain.where("_group IS NOT NULL AND _time IS NOT NULL")
    steps = F.posexplode(F.array(*[F.lit(o).cast("bigint") for o in offsets])).alias("_step", "_offset")
    wanted = timed.select("_group", "_time", "_key", steps).select(
        "_group", (F.col("_time") + F.col("_offset")).alias("_at"), "_key", "_step", F.lit(1).alias("_asks"),
        F.lit(None).cast(plain.schema["_value"].dataType).alias("_value"))
    given = timed.select("_group", F.col("_time").alias("_at"), "_key", F.lit(-1).alias("_step"), F.lit(0).alias("_asks"), "_value")
    near = F.array_distinct(F.array(in_chunk(f"_at - {tolerance}"), in_chunk(f"_at + {tolerance}")))
    both = wanted.withColumn("_chunk", in_chunk("_at")).unionByName(given.withColumn("_chunk", F.explode(near)))
    row = F.when(F.col("_asks") == 0, F.struct("_at", "_key", "_value"))
    seen = lambda order: F.last(row, ignorenulls=True).over(
        Window.partitionBy("_group", "_chunk").orderBy(order, F.col("_asks"), F.col("_key").desc())
        .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    sided = both.select(
        "*", seen(F.col("_at").asc()).alias("_before"), seen(F.col("_at").desc()).alias("_after")).where("_asks = 1")
    gap = lambda side: F.abs(F.col(f"{side}._at") - F.col("_at"))
    nearer = F.when(
        F.col("_before").isNull() | (gap("_after") < gap("_before")), F.col("_after")).otherwise(F.col("_before"))
    picked = sided.withColumn("_near", nearer).select(
        "_key", "_step", F.when(F.abs(F.col("_near._at") - F.col("_at")) <= tolerance, F.col("_near._value")).alias("_value"))
    lists = picked.groupBy("_key").agg(F.array_sort(F.collect_list(F.struct("_step", "_value"))).alias("_list"))
    told = lists.select("_key", F.transform("_list", lambda s: s["_value"]).alias("values"))
    none = F.array_repeat(F.lit(None).cast(plain.schema["_value"].dataType), len(offsets))
    untimed = plain.where("_group IS NULL OR _time IS NULL").select("_key", none.alias("values"))
    return told.unionByName(untimed).withColumnRenamed("_key", key)


# --- feature metadata --------------------------------------------------------


def channels_first(kind: Column, shape: Column) -> Column:
    """Shape of a visual feature with channels first, when only the last size can
    be a channel count; other shapes are unchanged."""
    channel_counts = [1, 3, 4]
    first, last = F.get(shape, 0), F.get(shape, 2)
    swap = (
        (kind == "VISUAL")
        & (F.size(shape) == 3)
        & ~first.isin(channel_counts)
        & last.isin(channel_counts)
    )
    return F.when(swap, F.array(last, first, F.get(shape, 1))).otherwise(shape)


def feature_roles(features: DataFrame) -> DataFrame:
    """Add ``role`` and ``steps`` to rows (name, kind): actions are outputs and get
    the action window; inputs named ``observation.*`` get the observation window."""
    is_output = F.col("kind") == "ACTION"
    observed = ~is_output & F.col("name").startswith("observation.")
    return features.withColumns(
        {
            "role": F.when(is_output, "output").otherwise("input"),
            "steps": F.when(is_output, F.array(*[F.lit(s) for s in ACTION_STEPS])).when(
                observed, F.array(*[F.lit(s) for s in OBSERVATION_STEPS])
            ),
        }
    )
