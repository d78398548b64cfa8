"""Constraints as queries: each gives the rows that break a rule and is empty when all is well."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def missing_reference(df: DataFrame, key: list[str], referred: DataFrame, referred_key: list[str]) -> DataFrame:
    """Rows whose key does not stand in the referred table; null keys break no rule."""
    ref = referred.select(*[F.col(b).alias(a) for a, b in zip(key, referred_key)]).distinct()
    present = None
    for k in key:
        present = F.col(k).isNotNull() if present is None else present & F.col(k).isNotNull()
    return df.where(present).join(ref, key, "left_anti")


def duplicate_keys(df: DataFrame, key: list[str]) -> DataFrame:
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > 1)


def rule_violations(df: DataFrame, id_cols: list[str], rules: dict[str, Column]) -> DataFrame:
    """(id, rule) for every rule a row breaks; a rule that is null counts as broken."""
    broken = F.filter(
        F.array(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in rules.items()]), lambda r: r.isNotNull()
    )
    return df.select(*id_cols, F.explode(broken).alias("rule"))


def uncovered_terms(cards: DataFrame, senses: DataFrame, key: str, text: str) -> DataFrame:
    """Senses none of whose terms is mentioned in the card's text."""
    joined = cards.join(senses, key)
    mentioned = F.exists("terms", lambda t: F.col(text).contains(t))
    return joined.where(~F.coalesce(mentioned, F.lit(False)))


def admissible_example() -> Column:
    """An example with both languages and no bracket in its English part."""
    return (F.trim("en") != "") & (F.trim("zh") != "") & ~F.col("en").rlike("[(（]")
