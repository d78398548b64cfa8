"""Ranks and running sums over groups of any size.

A window over a large group is one task. Here rows are range-partitioned by (group, order) and
sorted inside their range, numbered as they stand and written to the checkpoint folder once, so
that the ranges and numbers stand. A row's rank is its number less the first number of its group in
the range, plus the group's rows in earlier ranges: a table with at most one row per group and
range, which is all that is shuffled again. Running sums are windows inside a range. Order must be
total for a deterministic result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.plans.checkpoints import cut


def global_rank(
    df: DataFrame, group: list[str], order: list[Column | str], name: str = "rank", running: dict[str, str] | None = None
) -> DataFrame:
    """`df` with `name`, the place from 1 in its group, and running sums {new column: summed column}."""
    running = running or {}
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [*group, *order]
    ranged = df.repartitionByRange(parts, *keys).sortWithinPartitions(*keys)
    number = F.monotonically_increasing_id()  # the partition in the upper bits, the row in the lower 33
    ranged = cut(ranged.select("*", F.shiftright(number, 33).cast("int").alias("_range"), number.bitwiseAND((1 << 33) - 1).alias("_at")))
    sums = [F.count(F.lit(1)).alias("_rows"), F.min("_at").alias("_first")] + [F.sum(c).alias(f"_sum_{n}") for n, c in running.items()]
    before = W.partitionBy(*group).orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    offsets = ranged.groupBy(*group, "_range").agg(*sums)
    offsets = offsets.select(
        *[F.col(g).alias(f"_group_{g}") for g in group], F.col("_range").alias("_of"),
        (F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_first")).alias("_shift"),
        *[F.coalesce(F.sum(f"_sum_{n}").over(before), F.lit(0)).alias(f"_before_{n}") for n in running],
    )
    ranked = ranged
    rows = W.partitionBy(*group, "_range").orderBy("_at").rowsBetween(W.unboundedPreceding, 0)
    for n, c in running.items():
        ranked = ranked.withColumn(f"_run_{n}", F.sum(c).over(rows))
    on = F.col("_range") == F.col("_of")
    for g in group:
        on = on & F.col(g).eqNullSafe(F.col(f"_group_{g}"))
    out = ranked.join(offsets, on)
    return out.select(
        *df.columns, (F.col("_at") + F.col("_shift") + 1).cast("int").alias(name),
        *[(F.col(f"_before_{n}") + F.col(f"_run_{n}")).alias(n) for n in running],
    )
