"""A collection whose sources have target shares of its tokens.

Weighted fair queueing: the documents of a source are shuffled, once per repeat, and each gets
the virtual time at which it would be finished, the source's tokens up to its end divided by the
source's target share. Sorting all sources by that time interleaves them in the target shares;
the collection ends where the budget is full. A source that has used up its repeats leaves its
share to the others, which is as near to the targets as the repeats allow.

The cumulative tokens of a source are found in two levels, so no source stands in one task: a
source is cut into `BUCKETS`-wise ranges of its shuffle order, range totals are summed in a
small table, and rows are summed inside their range. The rows after the budget's end time, which
fill what whole documents left of it, are summed in ranges of their time likewise. Only per-source totals, one row for each
row of the targets table, come to the driver, to find the virtual time at which the budget ends
and the repeats it needs, so repeats beyond the budget are never made.

Defined cases: null texts and sources without a target are left out; targets without documents
get share 0; a source named twice in the targets has the sum of the shares and the larger
`max_repeats`; shares need not sum to 1 (they are relative); a null, zero or negative share or
cap takes nothing; without any usable document the result is empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.llm.token_counts import TOKENIZER, with_tokens
from millrace.plans.checkpoints import cut

ROWS_PER_BUCKET = 50_000
SEED = 7


def end_time(sources: list[tuple[float, int]], budget: float) -> float:
    """Virtual time at which (share, tokens at most) sources have filled the budget."""
    left, active = float(budget), sum(s for s, _ in sources)
    now = 0.0
    for share, most in sorted(sources, key=lambda x: x[1] / x[0]):
        until = most / share
        if (until - now) * active >= left:
            return now + left / active
        left -= (until - now) * active
        now, active = until, active - share
    return now


def _targets(targets: DataFrame) -> DataFrame:
    return (
        targets.where((F.col("target_share") > 0) & (F.col("max_repeats") > 0) & F.col("source").isNotNull())
        .groupBy("source")
        .agg(F.sum("target_share").alias("share"), F.max("max_repeats").alias("max_repeats"))
    )


def mix(
    documents: DataFrame, targets: DataFrame, budget: int | None = None, tokenizer: str = TOKENIZER, seed: int = SEED
) -> tuple[DataFrame, DataFrame]:
    """(collection, report).

    collection: source, doc_id, repeat (from 1), tokens, finish; range-sorted by finish.
    report: source, target_share, max_repeats, available, taken, documents, actual_share.
    `budget` is in tokens; by default the tokens of all documents of the target sources, once.
    """
    spark = documents.sparkSession
    wanted = _targets(targets)
    sized = cut(
        with_tokens(
            documents.where(F.col("text").isNotNull())
            .select("doc_id", "source", "text")
            .join(wanted.select("source"), "source", "left_semi"),
            path=tokenizer,
        ).select("doc_id", "source", "tokens")
    )
    totals = sized.groupBy("source").agg(F.sum("tokens").alias("available"), F.count(F.lit(1)).alias("n"), F.max("tokens").alias("longest"))
    plan = [
        r.asDict() for r in wanted.join(totals, "source").where(F.col("available") > 0).collect()
    ]  # one row for each target at most
    if budget is None:
        budget = sum(r["available"] for r in plan)
    end = end_time([(r["share"], r["available"] * r["max_repeats"]) for r in plan], budget) if plan else 0.0
    slack = 1.0
    rows = [
        (
            r["source"],
            float(r["share"]),
            min(int(r["max_repeats"]), int(slack + end * r["share"] / r["available"]) + 1),
            max(1, -(-int(r["n"]) // ROWS_PER_BUCKET)),
        )
        for r in plan
    ]
    known = spark.createDataFrame(rows, "source string, share double, repeats int, buckets int")
    space = F.lit(1 << 30)
    copies = (
        sized.join(known, "source")
        .withColumn("repeat", F.explode(F.sequence(F.lit(1), "repeats")))
        .withColumn("key", F.pmod(F.xxhash64("doc_id", "repeat", F.lit(seed)), space))
        .withColumn("bucket", F.floor(F.col("key") * F.col("buckets") / space).cast("int"))
    )
    ranges = copies.groupBy("source", "repeat", "bucket").agg(F.sum("tokens").alias("range_tokens"))
    before = W.partitionBy("source").orderBy("repeat", "bucket").rowsBetween(W.unboundedPreceding, -1)
    ranges = ranges.select(
        "source", "repeat", "bucket", F.coalesce(F.sum("range_tokens").over(before), F.lit(0)).alias("range_start")
    )
    inside = W.partitionBy("source", "repeat", "bucket").orderBy("key", "doc_id").rowsBetween(W.unboundedPreceding, 0)
    timed = copies.withColumn("upto", F.sum("tokens").over(inside)).join(ranges, ["source", "repeat", "bucket"])
    timed = timed.select(
        "source", "doc_id", "repeat", "tokens",
        ((F.col("range_start") + F.col("upto")) / F.col("share")).alias("finish"),
    )
    # what is left of the budget at the end is less than one document of every source, and the sources
    # still there fill it at their shares
    beyond = sum(r["longest"] for r in plan) / min(r["share"] for r in plan) if plan else 0.0
    timed = cut(timed.where(F.col("finish") <= F.lit(end * (1 + 1e-9) + beyond)))
    kept = timed.where(F.col("finish") <= F.lit(end * (1 + 1e-12)))
    used = kept.agg(F.sum("tokens")).first()[0] or 0
    order = ["finish", "source", "doc_id", "repeat"]
    rest = timed.where(F.col("finish") > F.lit(end * (1 + 1e-12)))
    rest = cut(rest.repartitionByRange(*order).withColumn("range", F.spark_partition_id()))
    earlier = W.orderBy("range").rowsBetween(W.unboundedPreceding, -1)
    starts = rest.groupBy("range").agg(F.sum("tokens").alias("range_tokens"))
    starts = starts.select("range", F.coalesce(F.sum("range_tokens").over(earlier), F.lit(0)).alias("range_start"))
    starts = starts.where(F.col("range_start") <= F.lit(budget - used))
    run = W.partitionBy("range").orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    tail = rest.join(starts, "range").withColumn("total", F.col("range_start") + F.sum("tokens").over(run))
    tail = tail.where(F.col("total") <= F.lit(budget - used)).select(*timed.columns)
    collection = kept.unionByName(tail)
    taken = collection.groupBy("source").agg(F.sum("tokens").alias("taken"), F.count(F.lit(1)).alias("documents"))
    everything = targets.where(F.col("source").isNotNull()).groupBy("source").agg(
        F.sum("target_share").alias("target_share"), F.max("max_repeats").alias("max_repeats")
    )
    whole = collection.agg(F.sum("tokens").alias("whole"))
    report = (
        everything.join(totals.select("source", "available"), "source", "left")
        .join(taken, "source", "left")
        .join(F.broadcast(whole))
        .select(
            "source", "target_share", "max_repeats",
            F.coalesce("available", F.lit(0)).alias("available"),
            F.coalesce("taken", F.lit(0)).alias("taken"),
            F.coalesce("documents", F.lit(0)).alias("documents"),
            F.coalesce(F.col("taken") / F.col("whole"), F.lit(0.0)).alias("actual_share"),
        )
    )
    return collection.orderBy("finish", "source", "doc_id", "repeat"), report
