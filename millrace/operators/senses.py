"""Counting, ranking and composing word senses from sentence labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# Parts of speech an inflected form belongs to.
FORM_POS = [
    ("复数", ["n."]), ("第三人称单数", ["v."]), ("过去式", ["v."]), ("过去分词", ["v.", "adj."]),
    ("现在分词", ["v."]), ("比较级", ["adj.", "adv."]), ("最高级", ["adj.", "adv."]),
]


def normalise_label(raw: Column) -> Column:
    """A raw label to array<struct<kind, sense, phrase>>.

    `X` is no use of the word, `P:...` a phrase, `N0` a new sense, a number a sense; a label
    that holds several is cut at semicolons, commas or JSON brackets.
    """
    parts = F.split(F.regexp_replace(raw, r"[\[\]\"\s]*([,;])[\[\]\"\s]*|^[\[\"\s]+|[\]\"\s]+$", "$1"), "[,;]")

    def one(p: Column) -> Column:
        p = F.trim(p)
        return F.struct(
            F.when(p == "X", "x").when(p.startswith("P:"), "phrase").when(p.rlike("^N[0-9]+$"), "new").when(p.rlike("^[0-9]+$"), "sense").otherwise("bad").alias("kind"),
            F.when(p.rlike("^N?[0-9]+$"), F.regexp_replace(p, "N", "").cast("int")).alias("sense"),
            F.when(p.startswith("P:"), F.trim(F.substring(p, 3, F.length(p)))).alias("phrase"),
        )

    return F.array_distinct(F.transform(F.filter(parts, lambda p: F.trim(p) != ""), one))


def labelled_sentences(labels: DataFrame, sentences: DataFrame) -> DataFrame:
    """Labels with the sentence they stand on; a label row stored twice counts once."""
    unique = labels.dropDuplicates(["word", "sid", "ord", "kind", "sense", "phrase"])
    return unique.join(sentences, ["word", "sid"])


def sense_weights(labelled: DataFrame, stem: Column, paper: Column, cap: int = 3) -> DataFrame:
    """(word, sense, hits, material, instruction, capped).

    Multiplicities are summed apart for material and instruction sentences; `capped` counts a
    sense at most `cap` times per paper. A sentence adds to a sense once.
    """
    rows = labelled.where(F.col("kind") == "sense").select("word", "sense", "sid", "n", stem.alias("stem"), paper.alias("paper"))
    rows = rows.dropDuplicates(["word", "sense", "sid"])
    per_paper = rows.groupBy("word", "sense", "paper").agg(
        F.count(F.lit(1)).alias("hits"),
        F.sum(F.when(~F.col("stem"), F.col("n")).otherwise(0)).alias("material"),
        F.sum(F.when(F.col("stem"), F.col("n")).otherwise(0)).alias("instruction"),
    )
    return per_paper.groupBy("word", "sense").agg(
        F.sum("hits").alias("hits"), F.sum("material").alias("material"), F.sum("instruction").alias("instruction"),
        F.sum(F.least(F.col("material"), F.lit(cap))).alias("capped"),
    )


def rank_senses(weights: DataFrame, promoted: Column | None = None, demoted: Column | None = None) -> DataFrame:
    """`place` of each sense in its word: promoted, not demoted, capped, material, instruction, index."""
    no = F.lit(False)
    order = W.partitionBy("word").orderBy(
        (promoted if promoted is not None else no).desc(), (demoted if demoted is not None else no).asc(),
        F.desc("capped"), F.desc("material"), F.desc("instruction"), "sense",
    )
    return weights.withColumn("place", F.row_number().over(order))


def keep_senses(ranked: DataFrame, n_sentences: DataFrame, small: int = 10, most: int = 6, extra: DataFrame | None = None) -> DataFrame:
    """Senses with two hits, or one in a word of few sentences; the first `most` of them, then
    the senses of `extra` (word, sense) whatever their place."""
    enough = ranked.join(n_sentences, "word").where((F.col("hits") >= 2) | ((F.col("hits") >= 1) & (F.col("sentences") <= small)))
    again = enough.withColumn("shown", F.row_number().over(W.partitionBy("word").orderBy("place")))
    kept = again.where(F.col("shown") <= most).select("word", "sense", "place")
    if extra is None:
        return kept
    added = ranked.join(extra, ["word", "sense"]).select("word", "sense", "place")
    return kept.unionByName(added).distinct()


def phrase_counts(labelled: DataFrame, key: Column) -> DataFrame:
    """(phrase, count, words): occurrences of a phrase, each sentence once whatever the headword."""
    rows = labelled.where((F.col("kind") == "phrase") & F.col("phrase").isNotNull()).select(
        key.alias("phrase"), "sid", "n", "word"
    )
    once = rows.groupBy("phrase", "sid").agg(F.max("n").alias("n"))
    counts = once.groupBy("phrase").agg(F.sum("n").alias("count"))
    words = rows.groupBy("phrase").agg(F.array_sort(F.collect_set("word")).alias("words"))
    return counts.join(words, "phrase")


def label_modes(labels: DataFrame, share: float = 0.9) -> DataFrame:
    """(word, labels, top, top_count, dominant): the commonest single-sense label of each word.

    Sentences with several labels count in the total only.
    """
    per_sentence = labels.dropDuplicates(["word", "sid", "ord", "kind", "sense", "phrase"]).groupBy("word", "sid").agg(
        F.count(F.lit(1)).alias("k"), F.max(F.when(F.col("kind") == "sense", F.col("sense"))).alias("sense")
    )
    single = F.when(F.col("k") == 1, F.col("sense"))
    counts = per_sentence.groupBy("word", single.alias("sense")).agg(F.count(F.lit(1)).alias("c"))
    best = F.max(F.when(F.col("sense").isNotNull(), F.struct(F.col("c"), (-F.col("sense")).alias("s"))))
    return counts.groupBy("word").agg(F.sum("c").alias("labels"), best.alias("b")).select(
        "word", "labels", (-F.col("b.s")).alias("top"), F.coalesce("b.c", F.lit(0).cast("bigint")).alias("top_count"),
        (F.coalesce("b.c", F.lit(0)) >= F.lit(share) * F.col("labels")).alias("dominant"),
    )


def label_samples(labelled: DataFrame) -> DataFrame:
    """(word, sense, count, sample): count of each sense label and its shortest sentence."""
    return labelled.where(F.col("kind") == "sense").groupBy("word", "sense").agg(
        F.count(F.lit(1)).alias("count"),
        F.min(F.struct(F.length("text").alias("len"), F.col("sid"), F.col("text")))["text"].alias("sample"),
    )


def shown_senses(kept: DataFrame, function_words: DataFrame, core_words: DataFrame, keep: DataFrame, most_function: int = 6, most_core: int = 5) -> DataFrame:
    """`kept` (word, sense, place) with `listed` and `shown`: function words are cut to their limit
    before the manually kept senses join, words with a core card show only their first senses."""
    flags = kept.join(function_words.select("word").distinct().withColumn("_f", F.lit(True)), "word", "left")
    first = flags.withColumn("_n", F.row_number().over(W.partitionBy("word").orderBy("place")))
    cut = first.where(F.col("_f").isNull() | (F.col("_n") <= most_function)).select("word", "sense", "place")
    added = cut.unionByName(keep.select("word", "sense", "place")).distinct()
    marked = added.join(function_words.select("word").distinct().withColumn("_f", F.lit(True)), "word", "left")
    marked = marked.join(core_words.select("word").distinct().withColumn("_c", F.lit(True)), "word", "left")
    listed = marked.withColumn("listed", F.row_number().over(W.partitionBy("word").orderBy("place")))
    hidden = F.col("_c").isNotNull() & F.col("_f").isNull() & (F.col("listed") > most_core)
    return listed.select("word", "sense", "place", "listed", (~hidden).alias("shown"))


def gloss_groups(senses: DataFrame, order: str = "place") -> DataFrame:
    """(word, groups array<struct<pos, text>>): glosses by part of speech, groups by first appearance."""
    s = senses.withColumn("pos", F.coalesce("pos", F.lit(""))).where(F.col("zh").isNotNull())
    groups = s.groupBy("word", "pos").agg(
        F.min(order).alias("first"), F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col("zh")))).alias("items")
    )
    text = F.array_join(F.transform("items", lambda x: x["zh"]), "; ")
    lines = groups.groupBy("word").agg(F.array_sort(F.collect_list(F.struct("first", "pos", text.alias("text")))).alias("g"))
    return lines.select("word", F.transform("g", lambda x: F.struct(x["pos"].alias("pos"), x["text"].alias("text"))).alias("groups"))


def definition_line(groups: Column, form: Column, irregular: Column, bare: Column) -> Column:
    """The definition of a word from its gloss groups.

    A regular form stands in brackets behind the last group it fits, unless a group tells it already;
    an irregular one stands in front, unless the word is to stay `bare` of it.
    """
    told = F.exists(groups, lambda g: g["text"].contains(form))
    target = form_target(form, F.transform(groups, lambda g: g["pos"]))
    last = F.array_max(F.filter(F.transform(groups, lambda g, i: F.when(g["pos"] == target, i)), lambda i: i.isNotNull()))
    marked = F.transform(groups, lambda g, i: F.concat(g["pos"], g["text"], F.when(i == last, F.concat(F.lit("("), form, F.lit(")"))).otherwise(""), F.lit(".")))
    plain = F.transform(groups, lambda g: F.concat(g["pos"], g["text"], F.lit(".")))
    in_front = form.isNotNull() & F.coalesce(irregular, F.lit(False))
    return (
        F.when(in_front & F.coalesce(bare, F.lit(False)), F.array_join(plain, " "))
        .when(in_front, F.concat(form, F.lit(". "), F.array_join(plain, " ")))
        .when(form.isNotNull() & ~told, F.array_join(marked, " "))
        .otherwise(F.array_join(plain, " "))
    )


def compose_definition(senses: DataFrame, order: str = "place") -> DataFrame:
    """(word, definition): glosses grouped by part of speech, groups by first appearance."""
    s = senses.withColumn("pos", F.coalesce("pos", F.lit(""))).where(F.col("zh").isNotNull())
    groups = s.groupBy("word", "pos").agg(
        F.min(order).alias("first"), F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col("zh")))).alias("items")
    )
    text = F.concat("pos", F.array_join(F.transform("items", lambda x: x["zh"]), "; "), F.lit("."))
    lines = groups.groupBy("word").agg(F.array_sort(F.collect_list(F.struct("first", text.alias("t")))).alias("g"))
    return lines.select("word", F.array_join(F.transform("g", lambda x: x["t"]), " ").alias("definition"))


def form_target(form: Column, groups: Column) -> Column:
    """The last group whose part of speech fits an inflected form, else the last group."""
    fits = F.flatten(F.array(*[F.when(form.contains(k), F.array(*map(F.lit, v))).otherwise(F.array().cast("array<string>")) for k, v in FORM_POS]))
    matching = F.filter(groups, lambda g: F.array_contains(fits, g))
    return F.element_at(F.when(F.size(matching) > 0, matching).otherwise(groups), -1)
