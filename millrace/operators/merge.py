"""Merging of prioritised sources, patches, upserts and incremental work."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def priority_merge(sources: list[DataFrame], key: str, valid: Column | None = None) -> DataFrame:
    """First source that has a valid row for a key wins; within one source the smallest row does.

    Rows are cleaned (filtered by `valid`) before they are ranked. The winner is a minimum over
    (source number, row), so the merge is one aggregation without a window sort.
    """
    tagged = [d.withColumn("_prio", F.lit(i)) for i, d in enumerate(sources)]
    rows = reduce(DataFrame.unionByName, tagged)
    rows = rows.where(valid) if valid is not None else rows
    value = [c for c in rows.columns if c not in (key, "_prio")]
    best = rows.groupBy(key).agg(F.min(F.struct("_prio", *value)).alias("_best"))
    return best.select(key, *[F.col(f"_best.{c}").alias(c) for c in value], F.col("_best._prio").alias("source_no"))


def last_wins(sources: list[DataFrame], key: str) -> DataFrame:
    """Later sources overwrite earlier ones."""
    out = priority_merge(sources[::-1], key)
    return out.withColumn("source_no", F.lit(len(sources) - 1) - F.col("source_no"))


def first_of(rows: DataFrame, key: list[str], order: str, value: list[str], latest: bool = False) -> DataFrame:
    """Sources told apart by a column: per key the row of the first `order`, or of the latest.

    Any number of sources, one aggregation; of equal orders the smaller row counts (the larger with
    `latest`).
    """
    pick = F.max if latest else F.min
    best = rows.groupBy(*key).agg(pick(F.struct(order, *value)).alias("_best"))
    return best.select(*key, *[F.col(f"_best.{c}").alias(c) for c in [*value, order]])


def numbered(df: DataFrame, column: str, name: str) -> DataFrame:
    """`name`: the place from 0 of a column's value among its different values."""
    values = df.select(column).distinct()
    return df.join(values.select(column, (F.row_number().over(W.orderBy(column)) - 1).alias(name)), column)


def resolve_aliases(cards: DataFrame, aliases: DataFrame, key: str) -> DataFrame:
    """Give an aliased key the card of its base, one hop, where it has none and the base has one."""
    value = [c for c in cards.columns if c != key]
    base = cards.select(F.col(key).alias("_base"), *value)
    added = (
        aliases.select(key, F.col("same_as").alias("_base")).join(cards.select(key), key, "left_anti").join(base, "_base").select(key, *value)
    )
    return cards.unionByName(added)


def without(df: DataFrame, *excluded: DataFrame, key: str | list[str]) -> DataFrame:
    """Rows whose key stands in none of the excluded lists."""
    return reduce(lambda d, e: d.join(e.select(*([key] if isinstance(key, str) else key)).distinct(), key, "left_anti"), excluded, df)


def patch_fields(df: DataFrame, patches: DataFrame, key: str) -> DataFrame:
    """Overlay map<string,string> `patch` on string fields; a key with a null value sets null."""
    value = [c for c in df.columns if c != key]
    joined = df.join(patches.select(key, "patch"), key, "left")
    fields = [
        F.when(F.coalesce(F.map_contains_key("patch", F.lit(c)), F.lit(False)), F.col("patch")[c]).otherwise(F.col(c)).alias(c)
        for c in value
    ]
    return joined.select(key, *fields)


def symmetric_difference(left: DataFrame, right: DataFrame, key: list[str]) -> DataFrame:
    """Keys found on one side only, with the side."""
    l = left.select(*key).distinct().withColumn("_l", F.lit(1))  # noqa: E741
    r = right.select(*key).distinct().withColumn("_r", F.lit(1))
    both = l.join(r, key, "full_outer").where(F.col("_l").isNull() | F.col("_r").isNull())
    return both.select(*key, F.when(F.col("_r").isNull(), "left").otherwise("right").alias("only"))


def changed_rows(current: DataFrame, measured: DataFrame, key: list[str], sha: str = "sha") -> DataFrame:
    """Rows whose content has no measurement with the same hash."""
    return current.join(measured.select(*key, sha).distinct(), [*key, sha], "left_anti")


def insert_only(existing: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """Existing rows as they are, and new rows for keys not seen before."""
    return existing.unionByName(new.join(existing.select(*key).distinct(), key, "left_anti"))


def fold_store(rows: DataFrame, key: list[str], order: Column, last: list[str] | None = None, first: list[str] | None = None) -> DataFrame:
    """Fold ordered task outputs by key: `last` fields from the last row, `first` from the first."""
    aggs = [F.max_by(c, order).alias(c) for c in last or []] + [F.min_by(c, order).alias(c) for c in first or []]
    return rows.groupBy(*key).agg(*aggs)


def append_new(store: DataFrame, new: DataFrame, key: str, value: list[str], index: str, order: str) -> DataFrame:
    """`store` with the new values of a key behind its own, each once, in the order they came in.

    A value the key already holds keeps its index; the next index follows the key's largest.
    """
    first = new.groupBy(key, *value).agg(F.min(order).alias("_o"))
    known = store.select(F.col(key).alias("_k"), *[F.col(v).alias(f"_v{i}") for i, v in enumerate(value)])
    same = F.col(key) == F.col("_k")
    for i, v in enumerate(value):
        same = same & F.col(v).eqNullSafe(F.col(f"_v{i}"))
    fresh = first.join(known, same, "left_anti")
    last = store.groupBy(key).agg(F.max(index).alias("_last"))
    place = F.row_number().over(W.partitionBy(key).orderBy("_o"))
    added = fresh.withColumn("_n", place).join(last, key, "left").withColumn(index, (F.coalesce("_last", F.lit(-1)) + F.col("_n")).cast("int"))
    return store.select(key, index, *value).unionByName(added.select(key, index, *value))


def single_match(overrides: DataFrame, senses: DataFrame) -> DataFrame:
    """Override names to sense numbers with the count of matches; it must be 1."""
    named = senses.select("word", "idx", F.concat(F.coalesce("pos", F.lit("")), F.coalesce("zh", F.lit(""))).alias("name"))
    joined = overrides.join(named, ["word", "name"], "left")
    return joined.groupBy("word", "name").agg(F.min("idx").alias("idx"), F.count("idx").alias("matches"))


def override_present(base: DataFrame, patch: DataFrame, key: str, fields: dict[str, str]) -> DataFrame:
    """Left join that takes the patch's non-empty value; the base's value is kept under a new name."""
    p = patch.select(key, *[F.col(c).alias(f"_p_{c}") for c in fields])
    out = base.join(p, key, "left")
    for c, kept in fields.items():
        out = out.withColumn(kept, F.col(c)).withColumn(c, F.coalesce(F.nullif(F.col(f"_p_{c}"), F.lit("")), F.col(c)))
    return out.drop(*[f"_p_{c}" for c in fields])

