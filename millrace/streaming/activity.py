"""Streams of progress rows and heartbeats.

Event time comes with a watermark; what arrives later than it is dropped by Spark, so the delay
is a parameter of every operator.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from millrace.functions.time import micros


def minute_buckets(stream: DataFrame, group: list[str], ts: str, value: str, delay: str = "10 minutes") -> DataFrame:
    """Closed minutes once each (append mode): rows, sum and largest value."""
    return (
        stream.withWatermark(ts, delay)
        .groupBy(*group, F.window(ts, "1 minute"))
        .agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias("total"), F.max(value).alias("most"))
        .select(*group, F.col("window.start").alias("minute"), "n", "total", "most")
    )


def study_sessions(stream: DataFrame, group: list[str], ts: str, gap: str, delay: str = "10 minutes") -> DataFrame:
    """Sessions closed by a gap; the active time of a session is its last beat minus its first."""
    return (
        stream.withWatermark(ts, delay)
        .groupBy(*group, F.session_window(ts, gap))
        .agg(F.min(ts).alias("first"), F.max(ts).alias("last"), F.count(F.lit(1)).alias("beats"))
        .withColumn("active_us", micros("last") - micros("first"))
        .drop("session_window")
    )


def latest_writes(stream: DataFrame, key: list[str], t: str, value: str) -> DataFrame:
    """Last write wins per key as a stream of updates: a row comes out when a key's value changes.

    Ties in `t` go to the larger value; late arrivals with an older `t` change nothing.
    """
    fields = {f.name: f.dataType.simpleString() for f in stream.schema.fields}
    out = ", ".join(f"{k} {fields[k]}" for k in [*key, t, value])
    state = f"{t} {fields[t]}, {value} {fields[value]}"

    def update(k: tuple, batches: Iterator[pd.DataFrame], kept: GroupState) -> Iterator[pd.DataFrame]:
        best = tuple(kept.get) if kept.exists else None
        before = best
        for batch in batches:
            rows = batch[[t, value]].dropna(subset=[t])
            if rows.empty:
                continue
            rows = rows.sort_values([t, value], na_position="first")
            last = tuple(None if pd.isna(x) else x for x in rows.iloc[-1])
            if best is None or _newer(last, best):
                best = last
        if best is not None and best != before:
            kept.update(best)
            frame = pd.DataFrame([[*k, *best]], columns=[*key, t, value])
            yield frame.astype({c: "Int64" for c in (t, value) if fields[c] in ("bigint", "int", "smallint")})

    return stream.groupBy(*key).applyInPandasWithState(update, out, state, "update", GroupStateTimeout.NoTimeout)


def _newer(a: tuple, b: tuple) -> bool:
    if a[0] != b[0]:
        return a[0] > b[0]
    return b[1] is None and a[1] is not None or (a[1] is not None and b[1] is not None and a[1] > b[1])


def upsert_batches(key: list[str], order: list[str], write: Callable[[DataFrame], None], read: Callable[[], DataFrame | None]) -> Callable[[DataFrame, int], None]:
    """A `foreachBatch` function: merge each batch into a table, last `order` wins.

    `read` gives the table as it stands (None at first) and `write` replaces it atomically, for
    example by writing a new version and switching to it.
    """
    from millrace.operators.activity import latest_by_key

    def merge(batch: DataFrame, batch_id: int) -> None:
        current = read()
        rows = batch if current is None else current.unionByName(batch)
        value = [c for c in rows.columns if c not in (*key, *order)]
        write(latest_by_key(rows, key, order, value).select(*batch.columns))

    return merge
