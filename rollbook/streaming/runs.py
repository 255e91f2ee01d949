"""Runs of misses kept across micro-batches, so that a scan batch stops while its outcomes stream in."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from rollbook.functions import fixed_values as fv

_STATE = "miss_run long, stopped boolean"
_ROW = "batch_id string, seq long, status string, others string, miss_run long, is_stop boolean"
# JSON of the other columns keeps microseconds.
_EXACT = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS", "ignoreNullFields": "false",
}


def counted_rows(rows: pd.DataFrame, run: int, limit: int) -> tuple[pd.DataFrame, int, bool]:
    """Rows of one batch in order of ``seq``, up to the one at which ``limit`` misses in a row are reached,
    with the run at each; the run at the end, and whether it reached the limit. ``run`` misses go before."""
    # A micro-batch has many small batches: a sort and a copy are saved where rows are in order.
    seq, status = rows["seq"].to_numpy(), rows["status"].to_numpy()
    if (seq[1:] < seq[:-1]).any():
        order = np.argsort(seq, kind="stable")
        rows, status = rows.take(order), status[order]
    miss, hit = status == "miss", status == "hit"
    misses = np.cumsum(miss)
    runs = misses - np.maximum.accumulate(np.where(hit, misses, -run))
    reached = np.flatnonzero(miss & (runs >= limit))
    n = int(reached[0]) + 1 if len(reached) else len(rows)
    stop = np.zeros(n, bool)
    stop[n - 1 :] = len(reached) > 0
    return rows.iloc[:n].assign(miss_run=runs[:n], is_stop=stop), int(runs[n - 1]), bool(len(reached))


def miss_run_stream(outcomes: DataFrame, limit: int = fv.MISS_LIMIT, time: str | None = None, idle: str = "1 day") -> DataFrame:
    """The streaming form of ``scan.miss_runs``: rows of ``batch_id, seq, status`` and more, as they are counted.

    Kept per batch are its run of misses and whether it has stopped; rows that land after the stop are left
    out, in this run of the query or, from its checkpoint, in a later one. Micro-batches count in the order
    they land, the rows of one in order of ``seq``, so a log that lands in order gives what ``miss_runs``
    gives for the whole. Rows without a batch_id are one batch.

    With ``time``, a timestamp column, a batch is forgotten once the watermark is ``idle`` past its last row;
    without it the state keeps a number for each batch ever seen.
    """
    rest = [f for f in outcomes.schema.fields if f.name not in ("batch_id", "seq", "status")]
    others = F.to_json(F.struct(*[F.col(f.name) for f in rest]), _EXACT) if rest else F.lit(None).cast("string")
    timed = outcomes if time is None else outcomes.withWatermark(time, idle)
    at = F.lit(0).cast("long") if time is None else F.unix_millis(F.col(time).cast("timestamp"))
    slim = timed.select(
        F.col("batch_id").cast("string").alias("batch_id"), F.col("seq").cast("long").alias("seq"), "status", others.alias("others"),
        at.alias("at"), *([] if time is None else [F.col(time).alias("event_time")]),
    )
    timeout = GroupStateTimeout.NoTimeout if time is None else GroupStateTimeout.EventTimeTimeout
    names = [c.split(" ")[0] for c in _ROW.split(", ")]

    def count(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        run, stopped = state.get if state.exists else (0, False)
        frames = list(parts)
        landed = frames[0] if len(frames) == 1 else pd.concat(frames)
        if not stopped:
            rows, run, stopped = counted_rows(landed, run, limit)
            yield rows[names]
        state.update((run, stopped))
        if time is not None:
            # Not behind the watermark, where Spark takes no timeout.
            state.setTimeoutTimestamp(max(int(landed["at"].max()), state.getCurrentWatermarkMs()) + 1)

    counted = slim.groupBy("batch_id").applyInPandasWithState(count, _ROW, _STATE, "append", timeout)
    back = F.from_json("others", T.StructType(rest), _EXACT)
    columns = [F.col(f"_others.{c}").alias(c) if c not in ("batch_id", "seq", "status") else F.col(c).cast(outcomes.schema[c].dataType).alias(c) for c in outcomes.columns]
    return counted.withColumn("_others", back).select(*columns, "miss_run", "is_stop")
