"""Keyed state and activity logs: latest writes, study time, streaks, chunked logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.functions.time import micros
from millrace.operators.ranking import global_rank


def latest_by_key(df: DataFrame, key: list[str], order: list[str], value: list[str]) -> DataFrame:
    """Last write wins by `order`, ties by the larger value; one aggregation, map-side combined."""
    best = df.groupBy(*key).agg(F.max(F.struct(*order, *[c for c in value if c not in order])).alias("_m"))
    return best.select(*key, *[F.col(f"_m.{c}").alias(c) for c in dict.fromkeys([*order, *value])])


def device_max_sum(df: DataFrame, group: list[str], device: str, value: str) -> DataFrame:
    """Per-device values only grow: the largest of each device, summed."""
    return df.groupBy(*group, device).agg(F.max(value).alias("_m")).groupBy(*group).agg(F.sum("_m").alias("total"))


def upsert(current: DataFrame, changes: DataFrame, key: list[str], arrival: str) -> DataFrame:
    """The last arrival overwrites whatever stands at its key."""
    rows = current.unionByName(changes)
    value = [c for c in rows.columns if c not in (*key, arrival)]
    return latest_by_key(rows, key, [arrival], value)


def heartbeat_time(df: DataFrame, group: list[str], ts: str, tie: str, gap_seconds: int) -> DataFrame:
    """(group, active_us, beats): gaps up to the limit count whole, longer ones not at all."""
    w = W.partitionBy(*group).orderBy(ts, tie)
    us = micros(ts)
    gap = us - F.lag(us).over(w)
    return df.withColumn("_gap", gap).groupBy(*group).agg(
        F.sum(F.when(F.col("_gap") <= gap_seconds * 1_000_000, F.col("_gap")).otherwise(0)).alias("active_us"),
        F.count(F.lit(1)).alias("beats"),
    )


def day_streaks(df: DataFrame, group: list[str], day: Column) -> DataFrame:
    """(group, first_day, last_day, days): runs of consecutive days, as gaps and islands."""
    days = df.select(*group, day.alias("_d")).where(F.col("_d").isNotNull()).distinct()
    rn = F.row_number().over(W.partitionBy(*group).orderBy("_d"))
    runs = days.withColumn("_start", F.date_sub(F.col("_d"), rn))
    return runs.groupBy(*group, "_start").agg(
        F.min("_d").alias("first_day"), F.max("_d").alias("last_day"), F.count(F.lit(1)).alias("days")
    ).drop("_start")


def pool_size(marks: DataFrame, group: list[str], rank: str, listed: DataFrame, size: int, low: int) -> DataFrame:
    """(group, pool, listed): the smallest pool of the series size, +(size-low), ... with more than
    `low` unmarked ranks in it, at most the list's size.

    Only the marked ranks are looked at (a null rank marks nothing): with k of them at or under a
    pool, it holds pool - k unmarked ones. The k-th marked rank r gives all pools from there to the
    next one; the first of the series among these that is above k + low is a candidate. `listed` is a
    one-row frame with the list's size.
    """
    w = W.partitionBy(*group).orderBy(rank)
    step = size - low
    zero = marks.select(*group).distinct().withColumn(rank, F.lit(0))
    ranks = zero.unionByName(marks.where(F.col(rank).isNotNull()).select(*group, F.col(rank).cast("int").alias(rank)).distinct())
    runs = ranks.select(*group, rank, (F.row_number().over(w) - 1).alias("_k"), F.lead(rank).over(w).alias("_next"))
    least = F.greatest(F.col(rank), F.col("_k") + low + 1, F.lit(size))
    series = (F.lit(size) + F.ceil((least - size) / step) * step).cast("int")
    first = F.when((series < F.col("_next")) | F.col("_next").isNull(), series)
    sized = runs.groupBy(*group).agg(F.min(first).alias("_p")).join(F.broadcast(listed.toDF("listed")))
    return sized.select(*group, F.least(F.coalesce("_p", "listed"), F.col("listed")).alias("pool"), "listed")


def percentiles(df: DataFrame, group: str, value: str, shares: dict[str, float]) -> DataFrame:
    """Interpolated percentiles by rank: only the rows next to a wanted place are gathered."""
    rows = df.where(F.col(value).isNotNull()).select(group, value)
    ranked = global_rank(rows, [group], [value], "_rank")
    sizes = ranked.groupBy(group).agg(F.max("_rank").alias("_n"))
    at = {name: F.lit(share) * (F.col("_n") - 1) for name, share in shares.items()}
    near = ranked.join(F.broadcast(sizes), group).withColumn("_i", F.col("_rank") - 1)
    wanted = F.lit(False)
    for place in at.values():
        wanted = wanted | F.col("_i").isin(F.floor(place), F.ceil(place))
    near = near.where(wanted)
    low = {name: F.max(F.when(F.col("_i") == F.floor(p), F.col(value))) for name, p in at.items()}
    high = {name: F.max(F.when(F.col("_i") == F.ceil(p), F.col(value))) for name, p in at.items()}
    part = {name: F.max(p - F.floor(p)) for name, p in at.items()}
    return near.groupBy(group).agg(*[(low[n] + part[n] * (high[n] - low[n])).alias(n) for n in shares])


def union_sets(df: DataFrame, group: list[str], value: str, sides: str) -> DataFrame:
    """(group, merged): values of both sides of a key, each once, in order."""
    per = df.groupBy(*group, sides).agg(F.collect_set(value).alias("_s"))
    return per.groupBy(*group).agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("_s")))).alias("merged"))


def minute_totals(df: DataFrame, group: list[str], sums: list[str], maxima: list[str], minute: str) -> DataFrame:
    """Sums and maxima of minute rows, active minutes and the span from first to last minute."""
    of_day = F.col(minute)
    return df.groupBy(*group).agg(
        *[F.sum(c).alias(c) for c in sums], *[F.max(c).alias(c) for c in maxima],
        F.count_distinct(of_day).alias("active"), (F.max(of_day) - F.min(of_day) + 1).alias("span"),
    )


def reassemble(df: DataFrame, key: list[str], seq: str, part: str, order: str) -> DataFrame:
    """Join chunks by sequence number; of chunks sent twice the last counts."""
    last = df.groupBy(*key, seq).agg(F.max(F.struct(order, part))[part].alias("_p"))
    return last.groupBy(*key).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(seq, "_p"))), lambda x: x["_p"]), "").alias("body"),
        F.count(F.lit(1)).alias("parts"),
    )


def timeline(df: DataFrame, key: list[str], body: str) -> DataFrame:
    """Events of assembled bodies: one per line `offset,name`, with absolute seconds."""
    rows = df.select(*key, F.posexplode(F.split(body, "\n")).alias("line_no", "line")).where(F.col("line") != "")
    offset = F.expr("try_cast(substring_index(line, ',', 1) as bigint)")
    return rows.withColumn("offset", offset).withColumn("event", F.expr("substring(line, instr(line, ',') + 1)"))


def daily_series(df: DataFrame, group: list[str], day: Column) -> DataFrame:
    """Counts for each day from the first to the last, days without rows as 0."""
    counts = df.select(*group, day.alias("day")).where(F.col("day").isNotNull()).groupBy(*group, "day").agg(F.count(F.lit(1)).alias("n"))
    spine = counts.groupBy(*group).agg(F.explode(F.sequence(F.min("day"), F.max("day"), F.expr("interval 1 day"))).alias("day"))
    return spine.join(counts, [*group, "day"], "left").withColumn("n", F.coalesce("n", F.lit(0)))


def moving_sum(df: DataFrame, group: list[str], day: str, value: str, days: int, name: str) -> DataFrame:
    """Sum of the last `days` days by value range, so missing days do no harm."""
    w = W.partitionBy(*group).orderBy(F.unix_date(F.col(day))).rangeBetween(-(days - 1), 0)
    return df.withColumn(name, F.sum(value).over(w))


def search_rank(df: DataFrame, query: str, word: str, texts: list[str], rank: str, most: int = 50) -> DataFrame:
    """Exact word, then prefix, then inside the word, then inside the other texts."""
    q = query.lower()
    w = F.lower(F.col(word))
    other = None
    for t in texts:
        hit = F.coalesce(F.lower(F.col(t)).contains(q), F.lit(False))
        other = hit if other is None else other | hit
    score = F.when(w == q, 0).when(w.startswith(q), 1).when(w.contains(q), 2).when(other, 3)
    return df.withColumn("score", score).where(F.col("score").isNotNull()).orderBy("score", rank, word).limit(most)
