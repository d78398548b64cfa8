"""Writers: ranked lists, stores, review reports and work lists."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_ranked(freq: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV with header in rank order (range-sorted, as many files as the sort has parts)."""
    freq.orderBy("rank").write.csv(path, header=True, mode=mode)


def write_store(df: DataFrame, path: str, key: str, mode: str = "errorifexists") -> None:
    """JSON lines, one per key, by default refusing to overwrite an existing round."""
    df.repartitionByRange(key).sortWithinPartitions(key).write.json(path, mode=mode)


def review_lines(senses: DataFrame, phrases: DataFrame | None = None) -> DataFrame:
    """(word, block): a Markdown block per word with its senses and phrases."""
    item = F.format_string("- %s. %s%s (%d)", F.col("place").cast("string"), F.coalesce("pos", F.lit("")), F.coalesce("zh", F.lit("")), "hits")
    body = senses.groupBy("word").agg(F.array_sort(F.collect_list(F.struct("place", item.alias("t")))).alias("s"))
    lines = F.transform("s", lambda x: x["t"])
    if phrases is not None:
        listed = phrases.select(F.explode("words").alias("word"), "phrase", "count").groupBy("word").agg(
            F.array_sort(F.collect_list(F.struct((-F.col("count")).alias("o"), "phrase", "count"))).alias("p")
        )
        body = body.join(listed, "word", "left")
        tail = F.transform(F.coalesce("p", F.array().cast("array<struct<o:bigint,phrase:string,count:bigint>>")), lambda x: F.format_string("- %s ×%d", x["phrase"], x["count"]))
        lines = F.concat(lines, tail)
    return body.select("word", F.concat(F.lit("## "), "word", F.lit("\n"), F.array_join(lines, "\n")).alias("block"))


def work_list(contexts: DataFrame, following: int = 4) -> DataFrame:
    """Sentences of a work list ordered by what follows the headword as a whole word, then id."""
    word = F.concat(F.lit(r"(?<![a-z'’-])\Q"), F.lower("word"), F.lit(r"\E(?![a-z-])"))
    at = F.regexp_instr(F.lower("sentence"), word)
    rest = F.when(at > 0, F.substring(F.lower("sentence"), at + F.length("word"), F.length("sentence"))).otherwise("")
    key = F.slice(F.filter(F.split(rest, "[^a-z]+"), lambda t: t != ""), 1, following)
    return contexts.withColumn("after", key).orderBy("word", "after", "id")
