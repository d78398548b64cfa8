"""Sentences of a corpus and the contexts of headwords in them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.functions.text import WS, inflections, phrase_pattern, phrase_words, sentence_pieces, sid
from millrace.operators.ranking import global_rank
from millrace.plans.checkpoints import cut

# What marks the exam papers' own instructions.
DIRECTIONS = rf"(?i)^{WS}*Direct[il1]ons?\b"
STRUCTURE = rf"(?i)^{WS}*(?:Part\b|Section\b|Passage\b|Questions?{WS}+\p{{Nd}}|\p{{Nd}}+{WS}*\.|[A-D]\))"
STEM_WORDINGS = [
    r"^(?:part \S+ (?:writing|listening|reading|translation)|section [abc]\b|passage (?:one|two)\b",
    r"|questions? [0-9]+ (?:and|to) \S+ (?:are|is) based|\( ?[0-9]+ ?minutes ?\))",
    r"|answer sheet|single line through|corresponding letter|choices? marked|spoken only once",
    r"|word bank|choice in the bank|ten (?:blanks|statements)|statement given below",
    r"|you (?:will|are going to) (?:hear|read)\b|you (?:should|must) (?:write|choose|decide)",
    r"|you are (?:allowed|required|now to write)|you will have [0-9]+ minutes",
    r"|no more than [0-9]+ words|write at least|translate a passage",
    r"|^each (?:passage|statement|paragraph|choice)\b|identify the paragraph|you may (?:not )?(?:choose|use)",
    r"|read the passage through|for each of them there are",
]
STEM = "(?i)" + "".join(STEM_WORDINGS)
LINE_ENDS = rf"[.!?][\"”’)]*{WS}*$"
HEADWORD_TOKENS = r"(?<![A-Za-z'’-])([A-Za-z-]+)"


def sentence_rows(df: DataFrame, text: str, keep: list[str]) -> DataFrame:
    """One row per sentence with its position in the document."""
    return df.select(*keep, F.posexplode(sentence_pieces(F.col(text))).alias("pos", "sentence"))


def sentence_multiplicity(sentences: DataFrame, sitting: Column) -> DataFrame:
    """(sentence, n, sittings): occurrences and distinct sittings of each sentence."""
    per = sentences.select("sentence", sitting.alias("sitting")).groupBy("sentence", "sitting").agg(F.count(F.lit(1)).alias("k"))
    return per.groupBy("sentence").agg(F.sum("k").alias("n"), F.count("sitting").alias("sittings"))


def boilerplate(multiplicity: DataFrame, least: int = 3) -> DataFrame:
    """Sentences that stand in `least` sittings or more."""
    return multiplicity.where(F.col("sittings") >= least)


def directions_lines(df: DataFrame, text: str, key: list[str]) -> DataFrame:
    """(key, pos, line): the lines of Directions blocks, `pos` counting them within a text.

    A block opens at a Directions line, closes at a blank or structural line and after a line
    that ends a sentence: a line is inside where the last opening stands after the last break.
    """
    lines = df.select(*key, F.posexplode(F.split(text, r"\r\n|\n|\r", -1)).alias("_i", "line"))
    opens = F.col("line").rlike(DIRECTIONS)
    closes = ~opens & ((F.trim("line") == "") | F.col("line").rlike(STRUCTURE))
    upto = W.partitionBy(*key).orderBy("_i").rowsBetween(W.unboundedPreceding, 0)
    ended = F.lag(F.col("line").rlike(LINE_ENDS)).over(W.partitionBy(*key).orderBy("_i"))
    marked = lines.withColumn("_open", F.when(opens, F.col("_i"))).withColumn("_break", F.when(closes, F.col("_i") + 1).when(ended, F.col("_i")))
    inside = F.max("_open").over(upto) >= F.coalesce(F.max("_break").over(upto), F.lit(0))
    kept = marked.withColumn("_in", inside).where("_in")
    pos = F.row_number().over(W.partitionBy(*key).orderBy("_i")) - 1
    return kept.select(*key, pos.alias("pos"), "line")


def instruction_sentences(sentences: DataFrame, sitting: Column, texts: DataFrame, text: str, key: list[str]) -> DataFrame:
    """(sentence): the papers' own instructions: sentences by their wording, sentences of many
    sittings, and all that stands in the Directions blocks of `texts`."""
    repeated = boilerplate(sentence_multiplicity(sentences, sitting)).select("sentence")
    worded = sentences.where(F.col("sentence").rlike(STEM)).select("sentence")
    blocks = directions_lines(texts, text, key).select(F.explode(sentence_pieces(F.col("line"))).alias("sentence"))
    return repeated.unionByName(worded).unionByName(blocks).distinct()


def headword_occurrences(sentences: DataFrame, headwords: DataFrame) -> DataFrame:
    """Headword hits by equality of extracted tokens instead of a pattern per headword.

    A sentence counts once per word in `n` and with each hit in `hits`. The list joins by its
    size: small lists are broadcast by the planner, larger ones are shuffled on the word.
    """
    tokens = F.transform(F.regexp_extract_all("sentence", F.lit(HEADWORD_TOKENS), F.lit(1)), lambda t: F.lower(t))
    exploded = sentences.withColumn("word", F.explode(tokens))
    return exploded.join(headwords.select(F.lower("word").alias("word")).distinct(), "word")


def headword_contexts(sentences: DataFrame, headwords: DataFrame, src: str, order: list[str]) -> DataFrame:
    """(word, id, sid, n, hits, src): unique sentences of each word, interleaved by source.

    A sentence belongs to the source where it stands first in `order`; a word's sentences take
    turns through its sources, and `id` is the place in that sequence. Only content ids are ranked;
    whoever needs the texts joins them by `sid`.
    """
    hits = headword_occurrences(sentences.withColumn("sid", sid(F.col("sentence"))), headwords)
    per_row = hits.groupBy("word", "sid", src, *order).agg(F.count(F.lit(1)).alias("k"))
    first = F.min(F.struct(*order, F.col(src).alias("src")))
    unique = per_row.groupBy("word", "sid").agg(F.count(F.lit(1)).alias("n"), F.sum("k").alias("hits"), first.alias("f"))
    flat = unique.select("word", "sid", "n", "hits", F.col("f.src").alias("src"), *[F.col(f"f.{c}").alias(f"_o{i}") for i, c in enumerate(order)])
    turns = global_rank(flat, ["word", "src"], [f"_o{i}" for i in range(len(order))], "turn").select("word", "sid", "n", "hits", "src", "turn")
    placed = global_rank(turns, ["word"], ["turn", "src"], "place")
    return placed.select("word", (F.col("place") - 1).alias("id"), "sid", "n", "hits", "src")


def chunk(df: DataFrame, group: list[str], order: list[Column | str], size: int) -> DataFrame:
    """`chunk` number of each row when a group is cut into runs of `size` rows."""
    placed = global_rank(df, group, order, "_rn")
    return placed.withColumn("chunk", F.floor((F.col("_rn") - 1) / size).cast("int")).drop("_rn")


def stripe(df: DataFrame, order: list[Column | str], per_task: int) -> DataFrame:
    """`task` of each row when ceil(rows / per_task) tasks take rows in turn."""
    total = df.agg(F.ceil(F.count(F.lit(1)) / per_task).alias("_tasks"))
    placed = global_rank(df, [], order, "_rn").join(F.broadcast(total))
    return placed.withColumn("task", F.pmod(F.col("_rn") - 1, F.col("_tasks")).cast("int")).drop("_rn", "_tasks")


def next_fit(df: DataFrame, group: list[str], order: str, size: str, budget: int) -> DataFrame:
    """`bin` of each row when a group's rows fill bins in order and never look back.

    An item above the budget gets a bin of its own. What a range of rows does to the open bin is a
    table over its possible fillings, 0 to `budget` and one for more; the tables of a group's ranges
    are followed one after the other, and then every range is packed from the filling it begins
    with. So no group stands in one task. Sizes are whole numbers of at least 0.
    """
    names = [f"_g{i}" for i in range(len(group))]
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = df.select(*[F.col(g).alias(n) for g, n in zip(group, names)], F.col(order).alias("_o"), F.col(size).cast("bigint").alias("_s"))
    ranged = rows.repartitionByRange(parts, *names, "_o").sortWithinPartitions(*names, "_o")
    ranged = cut(ranged.withColumn("_range", F.spark_partition_id()).withColumn("_k", F.hash(*names) if names else F.lit(0)))
    types = {f.name: f.dataType.simpleString() for f in ranged.schema.fields}
    head = ", ".join(f"{n} {types[n]}" for n in names)
    head += ", " if head else ""
    over = budget + 1

    def step(used: np.ndarray, bins: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        fresh = (used > 0) & (used + n > budget)
        return np.minimum(np.where(fresh, n, used + n), over), bins + fresh

    def runs(batch: pd.DataFrame) -> Iterator[tuple[tuple, pd.DataFrame]]:
        for key, part in batch.groupby(names, sort=False, dropna=False) if names else [((), batch)]:
            yield tuple(None if pd.isna(k) else k for k in key), part

    def tables(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        done: list[tuple] = []
        now: tuple | None = None
        used = bins = None
        at = 0
        for batch in batches:
            for key, part in runs(batch):
                if key != now:
                    if now is not None:
                        done.append((*now, at, used.tolist(), bins.tolist()))
                    now, used, bins = key, np.arange(over + 1), np.zeros(over + 1, dtype=np.int64)
                at = int(part["_range"].iloc[0])
                for n in part["_s"]:
                    used, bins = step(used, bins, int(n))
        if now is not None:
            done.append((*now, at, used.tolist(), bins.tolist()))
        yield pd.DataFrame(done, columns=[*names, "_range", "_used", "_bins"])

    effect = ranged.mapInPandas(tables, f"{head}_range int, _used array<bigint>, _bins array<bigint>")
    listed = effect.groupBy(*names).agg(F.array_sort(F.collect_list(F.struct("_range", "_used", "_bins"))).alias("_r"))
    zero = F.struct(F.lit(0).cast("bigint").alias("u"), F.lit(0).cast("bigint").alias("b"))
    follow = lambda acc, r: F.struct(
        F.get(r["_used"], acc["u"].cast("int")).alias("u"), (acc["b"] + F.get(r["_bins"], acc["u"].cast("int"))).alias("b")
    )
    begins = F.transform("_r", lambda r, i: F.struct(r["_range"].alias("range"), F.aggregate(F.slice("_r", 1, i), zero, follow).alias("s")))
    starts = listed.select(*[F.col(n).alias(f"_of{n}") for n in names], F.explode(begins).alias("_b"))
    on = F.col("_range") == F.col("_b.range")
    for n in names:
        on = on & F.col(n).eqNullSafe(F.col(f"_of{n}"))
    entered = cut(ranged.join(F.broadcast(starts) if not names else starts, on).select(*ranged.columns, F.col("_b.s.u").alias("_u"), F.col("_b.s.b").alias("_b0")))
    entered = entered.repartition(parts, "_range", *names).sortWithinPartitions("_range", *names, "_o")

    def fill(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now: tuple | None = None
        used = number = 0
        for batch in batches:
            out = []
            for key, part in runs(batch):
                key = (*key, int(part["_range"].iloc[0]))
                if key != now:
                    now, used, number = key, int(part["_u"].iloc[0]), int(part["_b0"].iloc[0])
                for n in part["_s"]:
                    fresh = used > 0 and used + n > budget
                    number += fresh
                    used = min(int(n) if fresh else used + int(n), over)
                    out.append(number)
            yield batch[[*names, "_o", "_s"]].assign(bin=out)

    schema = f"{head}_o {types['_o']}, _s bigint, bin int"
    packed = entered.mapInPandas(fill, schema)
    size_type = df.schema[size].dataType
    return packed.select(*[F.col(n).alias(g) for n, g in zip(names, group)], F.col("_o").alias(order), F.col("_s").cast(size_type).alias(size), "bin")


def peek(df: DataFrame, body: str, needle: str, width: int = 700) -> DataFrame:
    """`around`: `width` characters on both sides of the first eight words of `needle` in `body`."""
    key = F.array_join(F.slice(F.split(needle, " "), 1, 8), " ")
    found = F.expr(f"instr({body}, array_join(slice(split({needle}, ' '), 1, 8), ' '))")
    begin = F.greatest(found - width, F.lit(1))
    return df.withColumn(
        "around", F.when(found > 0, F.substring(F.col(body), begin, found - begin + F.length(key) + width))
    )


def phrase_hits(sentences: DataFrame, phrases: DataFrame, text: str = "sentence", phrase: str = "phrase") -> DataFrame:
    """Sentences that hold a phrase, inflections, gaps and possessives allowed, without a nested loop.

    A phrase meets only the sentences that hold a form of its first real word (an equi-join on
    tokens); its pattern is then tried on those. `at` and `upto` are the places of the match, from
    0. Phrases under two real words match nothing.
    """
    keyed = phrases.select(phrase).distinct().select(phrase, phrase_pattern(F.col(phrase)).alias("_rx"), F.get(phrase_words(F.col(phrase)), 0).alias("_w"))
    keyed = keyed.where(F.col("_rx").isNotNull()).select(phrase, "_rx", F.explode(inflections(F.col("_w"))).alias("_first"))
    tokens = F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(r"([^\s.,;:!?\"“”()（）]+)"), F.lit(1)))
    met = sentences.withColumn("_first", F.explode(tokens)).join(keyed, "_first").drop("_first").distinct()
    found = met.where(F.rlike(F.col(text), F.col("_rx")))
    hit = F.regexp_substr(F.col(text), F.col("_rx"))
    at = F.instr(F.col(text), hit) - 1
    return found.withColumn("at", at).withColumn("upto", at + F.length(hit)).drop("_rx")


def over_headword(hits: DataFrame, word: str, text: str = "sentence") -> DataFrame:
    """Phrase hits that lie over an occurrence of the headword."""
    place = F.regexp_instr(F.lower(F.col(text)), F.concat(F.lit(r"(?<![A-Za-z'’-])\Q"), F.lower(word), F.lit(r"\E(?![A-Za-z-])"))) - 1
    placed = hits.withColumn("_at", place).where(F.col("_at") >= 0)
    return placed.where((F.col("at") < F.col("_at") + F.length(word)) & (F.col("_at") < F.col("upto"))).drop("_at")


def name_hint(text: Column, word: str) -> Column:
    """The word stands in capitals amid a sentence: it may be part of a name."""
    rest = word[1:]
    return text.rlike(rf"[^.!?:\"“‘(—–\-\])\s]\s+{word[:1].upper()}(?i:{rest})(?![A-Za-z-])")


def half_split(df: DataFrame, key: str, seed: int = 1) -> DataFrame:
    """`half` 0 or 1 by hash order of a key, as even as can be; the same in every run."""
    placed = global_rank(df.withColumn("_h", F.xxhash64(F.col(key), F.lit(seed))), [], ["_h", key], "_rn")
    return placed.withColumn("half", F.pmod("_rn", F.lit(2)).cast("int")).drop("_h", "_rn")
