"""Repeats flagged as rows arrive: keyed state remembers who brought each content first."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from quern.functions.text import content_hash


def first_seen(stream: DataFrame, id_col: str, text: str) -> DataFrame:
    """(id, first_id, is_dup) of a stream: whether a row's content came before, and with which id.

    Only the id and a hash of the normalized text are shuffled. The state holds one id per distinct
    content, so appended rows are flagged without reading old ones. The first row of a content is
    the one that arrives first, within a micro-batch the lowest id; a row delivered again under the
    id that was first is not a repeat. Rows without text are never repeats.
    """
    own = F.concat(F.lit("id:"), F.col(id_col).cast("string"))
    keyed = stream.select(
        F.col(id_col).cast("bigint").alias("id"), F.coalesce(content_hash(F.col(text)), own).alias("content"))

    def flag(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        ids = np.sort(np.concatenate([p["id"].to_numpy() for p in parts]))
        first = int(state.get[0] if state.exists else ids[0])
        if not state.exists:
            state.update((first,))
        yield pd.DataFrame({"id": ids, "first_id": first, "is_dup": ids != first})

    return keyed.groupBy("content").applyInPandasWithState(
        flag, "id bigint, first_id bigint, is_dup boolean", "first bigint", "append", GroupStateTimeout.NoTimeout)


def flag_arrivals(stream: DataFrame, id_col: str, text: str, path: str, checkpoint: str) -> StreamingQuery:
    """Writes the flags of all rows that have arrived to ``path``; call again for what comes later."""
    return (
        first_seen(stream, id_col, text).writeStream.format("parquet")
        .option("path", path).option("checkpointLocation", checkpoint)
        .outputMode("append").trigger(availableNow=True).start()
    )
