"""Ranked term and document frequency, cumulative cutoffs, coverage and list overlap.

Counts are partial aggregates on the word; ranks and running sums are taken over ranges of the
aggregated vocabulary, so neither tokens nor the vocabulary stand in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.functions.text import clean_text, is_word, lemma, raw_words, repair, split_contractions
from millrace.operators.ranking import global_rank


def token_counts(df: DataFrame, text: str, keep: list[str], form: str = "surface", cleaned: bool = False) -> DataFrame:
    """(keep, word, n): corpus words counted per `keep`.

    Raw words are counted first; contractions, repairs and the word rule are then applied to the
    distinct raw words only, which are few.
    """
    body = F.col(text) if cleaned else clean_text(F.col(text))
    raw = df.select(*keep, F.explode(raw_words(body)).alias("_raw")).groupBy(*keep, "_raw").agg(F.count(F.lit(1)).alias("n"))
    halves = raw.select(*keep, "n", F.explode(split_contractions(F.array("_raw"))).alias("_half"))
    words = halves.select(*keep, "n", repair(F.col("_half")).alias("word")).where(is_word(F.col("word")))
    if form == "lemma":
        words = words.withColumn("word", lemma(F.col("word")))
    return words.groupBy(*keep, "word").agg(F.sum("n").alias("n"))


def _weight(tokens: DataFrame) -> Column:
    return F.col("n") if "n" in tokens.columns else F.lit(1)


def term_frequency(tokens: DataFrame, running: bool = False) -> DataFrame:
    """(rank, word, count): most frequent first, ties by word; of rows or of counts `n`.

    With `running` also the running count, from the same ranking.
    """
    counts = tokens.groupBy("word").agg(F.sum(_weight(tokens)).cast("bigint").alias("count"))
    ranked = global_rank(counts, [], [F.desc("count"), "word"], "rank", {"running": "count"} if running else None)
    return ranked.select("rank", "word", "count", *(["running"] if running else []))


def top_terms(tokens: DataFrame, n: int) -> DataFrame:
    """The first n of `term_frequency`: each task keeps n words, the n best of them are ranked."""
    counts = tokens.groupBy("word").agg(F.sum(_weight(tokens)).cast("bigint").alias("count"))
    order = [F.desc("count"), F.asc("word")]
    first = counts.orderBy(*order).limit(n)
    return first.select(F.row_number().over(W.orderBy(*order)).alias("rank"), "word", "count")


def document_frequency(tokens: DataFrame, unit: str) -> DataFrame:
    """(rank, word, doc_freq, term_freq): by units, then occurrences, then word.

    Counted in two steps, first per (word, unit), so a frequent word is never one task's work.
    """
    per_unit = tokens.where(F.col(unit).isNotNull()).groupBy("word", unit).agg(F.sum(_weight(tokens)).cast("bigint").alias("n"))
    counts = per_unit.groupBy("word").agg(F.count(F.lit(1)).alias("doc_freq"), F.sum("n").alias("term_freq"))
    ranked = global_rank(counts, [], [F.desc("doc_freq"), F.desc("term_freq"), "word"])
    return ranked.select("rank", "word", "doc_freq", "term_freq")


def full_units(df: DataFrame, unit: str, text: str, least_chars: int = 3000) -> DataFrame:
    """Units whose raw texts add up to at least `least_chars` characters."""
    return (
        df.where(F.col(unit).isNotNull())
        .groupBy(unit)
        .agg(F.sum(F.length(text)).alias("chars"))
        .where(F.col("chars") >= least_chars)
    )


def cumulative_cutoff(freq: DataFrame, share: float = 0.8) -> DataFrame:
    """Smallest rank at which the running count reaches `share` of all, else the list size."""
    total = freq.agg(F.sum("count").alias("total"), F.count(F.lit(1)).alias("size"))
    listed = freq if "running" in freq.columns else global_rank(freq, [], ["rank"], "_place", {"running": "count"})
    running = listed.join(F.broadcast(total))
    reached = F.min(F.when(F.col("running") >= F.lit(share) * F.col("total"), F.col("rank")))
    return running.agg(
        F.coalesce(reached, F.max("size").cast("int")).alias("cutoff"),
        F.max("size").alias("words"),
        F.max("total").alias("tokens"),
    )


def list_overlap(left: DataFrame, right: DataFrame, n: DataFrame) -> DataFrame:
    """Words common to the first n of two ranked lists; `n` is a one-row frame with `cutoff`."""
    top = lambda d: d.join(F.broadcast(n), d["rank"] <= n["cutoff"]).select("word")
    both = top(left).intersect(top(right)).agg(F.count(F.lit(1)).alias("common"))
    return both.join(F.broadcast(n)).select(
        F.col("cutoff").alias("n"), "common", (F.col("common") / F.col("cutoff")).alias("ratio")
    )


def coverage(tokens: DataFrame, unit: str, listed: DataFrame) -> DataFrame:
    """(unit, tokens, hits, coverage): share of a unit's words that stand in a list, in percent.

    Tokens are counted per (unit, word) first; the list meets the aggregate, not the tokens.
    """
    counts = tokens.groupBy(unit, "word").agg(F.sum(_weight(tokens)).cast("bigint").alias("n"))
    marked = counts.join(listed.select("word", F.lit(1).alias("hit")), "word", "left")
    return (
        marked.groupBy(unit)
        .agg(F.sum("n").alias("tokens"), F.sum(F.when(F.col("hit") == 1, F.col("n")).otherwise(0)).alias("hits"))
        .withColumn("coverage", F.lit(100.0) * F.col("hits") / F.col("tokens"))
    )


def coverage_summary(per_unit: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Unweighted mean, least and most coverage over the units."""
    return per_unit.groupBy(*(by or [])).agg(
        F.round(F.avg("coverage"), 6).alias("mean"), F.min("coverage").alias("least"), F.max("coverage").alias("most"),
        F.count(F.lit(1)).alias("units"),
    )


def in_all_units(df_table: DataFrame, n_units: DataFrame) -> DataFrame:
    """Words found in every unit (relational division by count)."""
    return df_table.join(F.broadcast(n_units), df_table["doc_freq"] == n_units["n_units"]).select("word", "doc_freq")


def prefix_offsets(df: DataFrame, group: list[str], order: list[Column], size: Column) -> DataFrame:
    """`offset` of each row among the concatenated sizes of its group; groups may be of any size."""
    sized = df.withColumn("_size", size)
    summed = global_rank(sized, group, order, "_rn", {"_upto": "_size"})
    return summed.withColumn("offset", F.col("_upto") - F.col("_size")).drop("_rn", "_upto", "_size")
