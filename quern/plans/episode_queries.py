"""Episode window queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from quern.operators import episodes as ep
from quern.plans.inputs import episode_bounds, episodes, table, with_sql
from quern.plans.registry import query
from quern.schema import ACTION_STEPS, OBSERVATION_STEPS

EPISODES = with_sql("episodes")


def bounded(spark, d):
    return ep.attach_bounds(episodes(spark, d), episode_bounds(spark, d))


@query(
    "episode_bounds_lookup",
    EPISODES + "select event_id, episode_index, idx, ep_start, ep_end from episodes",
)
def episode_bounds_lookup(spark, d):
    return bounded(spark, d).select("event_id", "episode_index", "idx", "ep_start", "ep_end")


@query(
    "action_pad_mask",
    EPISODES
    + f"""select event_id, array_to_string(list_transform({ACTION_STEPS}, lambda s:
      case when idx+s < ep_start or idx+s >= ep_end then '1' else '0' end), '') as mask from episodes""",
)
def action_pad_mask(spark, d):
    mask = ep.pad_mask(F.col("idx"), F.col("ep_start"), F.col("ep_end"), ACTION_STEPS)
    digits = F.transform(mask, lambda m: F.when(m, "1").otherwise("0"))
    return bounded(spark, d).select("event_id", F.array_join(digits, "").alias("mask"))


def window_sql(column: str, steps: list[int], name: str) -> str:
    return f"""(select e.idx, string_agg(cast(cast(round(w.{column}*1000000) as bigint) as varchar), ',' order by s.s) as {name}
      from episodes e cross join (select unnest({steps}) as s) s
      join episodes w on w.idx = least(greatest(e.idx + s.s, e.ep_start), e.ep_end - 1) group by e.idx)"""


@query(
    "episode_window_join",
    EPISODES
    + f"""select e.event_id, a.actions, o.observations from episodes e
      join {window_sql('action', ACTION_STEPS, 'actions')} a using (idx)
      join {window_sql('observation', OBSERVATION_STEPS, 'observations')} o using (idx)""",
)
def episode_window_join(spark, d):
    rows = ep.episode_windows(bounded(spark, d), "action", "observation")

    def text(name):
        micro = F.transform(name, lambda x: F.round(x * 1_000_000).cast("bigint").cast("string"))
        return F.array_join(micro, ",").alias(name)

    return rows.select("event_id", text("actions"), text("observations"))


TIME_STEPS = [-7200, -900, 0, 900, 3600, 7200]
TIME_TOLERANCE = 600


@query(
    "episode_time_windows",
    f"""with e as (select event_id, user_id, epoch_us(ts) as t from events),
      w as (select event_id, user_id, i, t + cast(s as bigint) * 1000000 as want from e,
        (select unnest({TIME_STEPS}) as s, unnest(range({len(TIME_STEPS)})) as i)),
      n as (select w.event_id, w.i, e.event_id as near,
        row_number() over (partition by w.event_id, w.i order by abs(e.t - want), e.t, e.event_id) as r
        from w join e on e.user_id = w.user_id and abs(e.t - want) <= {TIME_TOLERANCE} * 1000000)
      select w.event_id, string_agg(coalesce(cast(near as varchar), '-'), ',' order by w.i) as near
      from w left join n on n.event_id = w.event_id and n.i = w.i and r = 1 group by w.event_id""",
)
def episode_time_windows(spark, d):
    """The nearest event of the same user at each offset in seconds; events are uneven in time."""
    rows = table(spark, d, "events").select(
        "event_id", "user_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("t"), F.col("event_id").alias("near"))
    found = ep.time_windows(
        rows, "user_id", "t", "event_id", "near", [s * 1_000_000 for s in TIME_STEPS], TIME_TOLERANCE * 1_000_000)
    shown = F.transform("values", lambda v: F.coalesce(v.cast("string"), F.lit("-")))
    return found.select("event_id", F.array_join(shown, ",").alias("near"))


@query(
    "action_window_deltas",
    f"""select event_id, array_to_string(case when w = 16 then {ACTION_STEPS} when w = 1 then [0] else range(-1, -1 + w) end, ',') as steps
      from (select event_id, 1 + event_id % 20 as w from events)""",
)
def action_window_deltas(spark, d):
    width = (F.pmod(F.col("event_id"), F.lit(20)) + 1).cast("int")
    steps = ep.action_window_steps_column(width, ACTION_STEPS, n_obs_steps=2)
    return table(spark, d, "events").select("event_id", F.array_join(steps, ",").alias("steps"))


def features(spark, d):
    """(name, kind, shape): one feature per part, shaped by its size and key."""
    place = F.pmod(F.col("p_partkey"), F.lit(4))
    kind = F.get(F.array(*[F.lit(k) for k in ("VISUAL", "STATE", "ACTION", "VISUAL")]), place.cast("int"))
    prefix = F.when(kind == "ACTION", "action.").when(place == 3, "camera.").otherwise("observation.")
    channels = (F.pmod(F.col("p_partkey"), F.lit(5)) + 1).cast("int")
    shape = F.when(place == 1, F.array("p_size")).otherwise(
        F.array(F.col("p_size"), F.col("p_size") + 1, channels)
    )
    return table(spark, d, "part").select(
        F.concat(prefix, F.col("p_partkey").cast("string")).alias("name"),
        kind.alias("kind"),
        shape.alias("shape"),
    )


FEATURES = """with features as (select concat(case p_partkey%4 when 2 then 'action.' when 3 then 'camera.' else 'observation.' end, p_partkey) as name,
  (['VISUAL','STATE','ACTION','VISUAL'])[1+p_partkey%4] as kind,
  case when p_partkey%4=1 then [p_size] else [p_size, p_size+1, cast(p_partkey%5+1 as int)] end as shape from part)
"""


@query(
    "hwc_to_chw_shape",
    FEATURES
    + """select name, array_to_string(case when kind='VISUAL' and len(shape)=3 and shape[1] not in (1,3,4) and shape[3] in (1,3,4)
      then [shape[3], shape[1], shape[2]] else shape end, 'x') as shape from features""",
)
def hwc_to_chw_shape(spark, d):
    shape = ep.channels_first(F.col("kind"), F.col("shape"))
    return features(spark, d).select("name", F.array_join(shape, "x").alias("shape"))


@query(
    "feature_split",
    FEATURES
    + f"""select name, case when kind='ACTION' then 'output' else 'input' end as role,
      case when kind='ACTION' then array_to_string({ACTION_STEPS}, ',') when starts_with(name, 'observation.') then '-1,0' end as steps from features""",
)
def feature_split(spark, d):
    rows = ep.feature_roles(features(spark, d))
    return rows.select("name", "role", F.array_join("steps", ",").alias("steps"))


@query(
    "mod_position_label",
    "select event_id, cast(event_id % 1000 as int) as label from events",
)
def mod_position_label(spark, d):
    label = F.pmod(F.col("event_id"), F.lit(1000)).cast("int")
    return table(spark, d, "events").select("event_id", label.alias("label"))

