"""Text corpora, word lists, JSON stores and the record formats built on plain text."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from millrace.operators.ranking import global_rank


def read_corpus(
    spark: SparkSession, root: str, subs: list[str], years: list[int] | None = None, prefix: str = "cet4_"
) -> DataFrame:
    """(path, sub, name, year, sitting, set_key, body), one row per file of `<root>/<sub>/*.txt`.

    A file name without a year is an error. `years` keeps only those years; None keeps all. `prefix`
    stands before the year; a sitting is the prefix, year and month, a set key the name without it.
    """
    paths = [f"{root}/{s}/*.txt" for s in subs]
    raw = spark.read.text(paths, wholetext=True).select(F.input_file_name().alias("path"), F.col("value").alias("body"))
    name = F.regexp_replace(F.element_at(F.split("path", "/"), -1), r"\.txt$", "")
    year = F.regexp_extract(name, r"_(\d{4})_\d{2}_\d+(?:_ans)?$", 1)
    rows = raw.withColumn("name", name).withColumn(
        "year",
        F.when(year != "", year.cast("int")).otherwise(
            F.raise_error(F.concat(F.lit("no year in file name: "), name)).cast("int")
        ),
    )
    if years is not None:
        rows = rows.where(F.col("year").isin(*years))
    stem = F.regexp_replace("name", "_ans", "")
    return rows.select(
        "path", F.element_at(F.split("path", "/"), -2).alias("sub"), "name", "year",
        F.substring("name", 1, len(prefix) + 7).alias("sitting"), F.regexp_replace(stem, f"^{prefix}", "").alias("set_key"), "body",
    )


def window_years(path: str) -> list[int]:
    """Years of a window file `{"years": [...]}`."""
    with open(path, encoding="utf-8") as f:
        return [int(y) for y in json.load(f)["years"]]


def read_ranked(spark: SparkSession, path: str, n: int | None = None, schema: str = "rank int, word string, count bigint") -> DataFrame:
    """A ranked CSV list, or its first `n` ranks; never by file order."""
    rows = spark.read.csv(path, header=True, schema=schema)
    return rows if n is None else rows.where(F.col("rank") <= n)


def read_json_or_empty(spark: SparkSession, path: str, schema: StructType | str, multi_line: bool = True) -> DataFrame:
    """A JSON file (or, without `multi_line`, JSON lines), or no rows of its schema where there is
    none; on any file system Spark knows."""
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    if not place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place):
        return spark.createDataFrame([], schema)
    return spark.read.json(path, schema=schema, multiLine=multi_line)


def task_files(spark: SparkSession, folder: str, done: bool = False) -> DataFrame:
    """(stem, body) of task inputs, or of their outputs."""
    raw = spark.read.text(f"{folder}/[ABCDE]_*.json", wholetext=True).select(F.input_file_name().alias("path"), F.col("value").alias("body"))
    is_out = F.col("path").endswith(".out.json")
    stem = F.regexp_replace(F.element_at(F.split("path", "/"), -1), r"(?:\.out)?\.json$", "")
    return raw.where(is_out if done else ~is_out).select(stem.alias("stem"), "body")


def numbered_lines(texts: DataFrame, key: list[str], body: str) -> DataFrame:
    """(key, line_no from 1, line) of whole texts, lines trimmed."""
    return texts.select(*key, F.posexplode(F.split(body, r"\r\n|\n|\r")).alias("_p", "_l")).select(
        *key, (F.col("_p") + 1).alias("line_no"), F.trim("_l").alias("line")
    )


def _carried(lines: DataFrame, key: list[str], name: str, value: Column) -> DataFrame:
    run = W.partitionBy(*key).orderBy("line_no").rowsBetween(W.unboundedPreceding, 0)
    return lines.withColumn(name, F.last(value, ignorenulls=True).over(run))


def parse_labels(texts: DataFrame, key: list[str], body: str) -> DataFrame:
    """Label files to rows (key, line_no, word, kind, id, label, pos, zh, note).

    `# word` opens a section, `N0 | pos | zh` names a new sense, `note:` a note, `id label` labels
    a sentence. Kinds: label, new, note, bad; lines before any section are bad.
    """
    lines = numbered_lines(texts, key, body).where(F.col("line") != "")
    header = F.when(F.col("line").startswith("#"), F.trim(F.expr("substring(line, 2)")))
    rows = _carried(lines, key, "word", header).where(~F.col("line").startswith("#"))
    label = F.regexp_extract("line", r"^(\d+)\s+(.*)$", 1)
    cut = F.split("line", r"\|", 3)
    kind = (
        F.when(F.col("word").isNull(), "bad")
        .when(F.col("line").rlike(r"^N\d+\s*\|"), "new")
        .when(F.col("line").startswith("note:"), "note")
        .when(label != "", "label")
        .otherwise("bad")
    )
    rows = rows.withColumn("kind", kind)
    of = lambda k, c: F.when(F.col("kind") == k, c)
    return rows.select(
        *key, "line_no", "word", "kind",
        of("label", label.try_cast("int")).alias("id"),
        of("label", F.trim(F.regexp_extract("line", r"^(\d+)\s+(.*)$", 2))).alias("label"),
        of("new", F.trim(F.get(cut, 1))).alias("pos"),
        of("new", F.trim(F.get(cut, 2))).alias("zh"),
        of("note", F.trim(F.expr("substring(line, 6)"))).alias("note"),
    )


def label_faults(labels: DataFrame, expected: DataFrame, exceptions: DataFrame | None = None) -> DataFrame:
    """(task, word, id, fault) of parsed label files against the `expected` (task, word, id).

    Faults: `bad line`, `unknown section`, `missing section`, `unknown id`, `id twice`, and `missing id`
    but for words of `exceptions`, whose gaps take a default.
    """
    none = F.lit(None).cast("int")
    sections, asked = labels.where(F.col("word").isNotNull()).select("task", "word").distinct(), expected.select("task", "word").distinct()
    told = labels.where(F.col("kind") == "label").select("task", "word", "id")
    fault = lambda d, name: d.select("task", "word", "id", F.lit(name).alias("fault"))
    missing = expected.join(told, ["task", "word", "id"], "left_anti")
    if exceptions is not None:
        missing = missing.join(exceptions.select("word").distinct(), "word", "left_anti")
    return (
        fault(labels.where(F.col("kind") == "bad").withColumn("id", none), "bad line")
        .unionByName(fault(sections.join(asked, ["task", "word"], "left_anti").withColumn("id", none), "unknown section"))
        .unionByName(fault(asked.join(sections, ["task", "word"], "left_anti").withColumn("id", none), "missing section"))
        .unionByName(fault(told.join(asked, ["task", "word"], "left_semi").join(expected, ["task", "word", "id"], "left_anti"), "unknown id"))
        .unionByName(fault(told.groupBy("task", "word", "id").agg(F.count(F.lit(1)).alias("k")).where("k > 1"), "id twice"))
        .unionByName(fault(missing.join(sections, ["task", "word"], "left_semi"), "missing id"))
    )


def fill_defaults(expected: DataFrame, labels: DataFrame, defaults: DataFrame) -> DataFrame:
    """(task, word, id, label, filled): labels of every expected sentence, gaps of words with a
    default filled with it; gaps of other words stay null."""
    return (
        expected.join(labels, ["task", "word", "id"], "left")
        .join(defaults, "word", "left")
        .select("task", "word", "id", F.coalesce("label", "default_label").alias("label"), F.col("label").isNull().alias("filled"))
    )


def parse_entries(texts: DataFrame, key: list[str], body: str) -> DataFrame:
    """Entry files to rows (key, rank, word, section, uk, us, def, ex_label, ex).

    `—— Section n ——` lines set the section (1 before any), `[rank] word` opens an entry, a line
    with 英[..] 美[..] gives its sounds, 释义 and 例句 lines its gloss and example; others are passed over.
    """
    lines = numbered_lines(texts, key, body)
    section = F.regexp_extract("line", r"——+\s*Section\s*(\d+)\s*——+", 1)
    head = F.col("line").rlike(r"^\[\d+\]\s+.+$")
    run = W.partitionBy(*key).orderBy("line_no").rowsBetween(W.unboundedPreceding, 0)
    rows = _carried(lines, key, "section", F.when(section != "", section.try_cast("int"))).withColumn(
        "entry", F.sum(head.cast("int")).over(run)
    )
    rows = rows.where((F.col("entry") > 0) & (section == ""))
    sounds = r"英\[(.*?)\]\s*美\[(.*?)\]"
    has_sound = F.col("line").rlike(sounds)
    gloss = ~has_sound & F.col("line").startswith("释义")
    example = ~has_sound & F.col("line").startswith("例句")
    last = lambda when, c: F.max_by(F.when(when, c), F.when(when, F.col("line_no")))
    return rows.groupBy(*key, "entry").agg(
        F.max(F.when(head, F.regexp_extract("line", r"^\[(\d+)\]", 1).try_cast("int"))).alias("rank"),
        F.max(F.when(head, F.trim(F.regexp_extract("line", r"^\[\d+\]\s+(.+)$", 1)))).alias("word"),
        F.coalesce(F.min(F.when(head, F.col("section"))), F.lit(1)).alias("section"),
        F.coalesce(last(has_sound, F.regexp_extract("line", sounds, 1)), F.lit("")).alias("uk"),
        F.coalesce(last(has_sound, F.regexp_extract("line", sounds, 2)), F.lit("")).alias("us"),
        F.coalesce(last(gloss, F.trim(F.regexp_replace("line", "^[^:]*:|^[^：]*：", ""))), F.lit("")).alias("def"),
        F.when(F.max(F.when(example, F.substring("line", 1, 6).contains("自编").cast("int"))) == 1, "例句（自编）").otherwise("例句").alias("ex_label"),
        F.coalesce(last(example, F.trim(F.regexp_extract("line", r"^例句(?:（自编）)?\s*[:：]\s*(.*)$", 1))), F.lit("")).alias("ex"),
    )


def markdown_blocks(texts: DataFrame, key: list[str], body: str) -> DataFrame:
    """Markdown to blocks (key, block, kind, rows): headings, tables, bullet runs, paragraphs.

    Neighbouring lines of one kind are one block (gaps and islands); blank lines end paragraphs
    but not bullet runs; `---` lines and table rules are dropped.
    """
    lines = numbered_lines(texts, key, body)
    kind = (
        F.when((F.col("line") == "") | (F.col("line") == "---"), "gap")
        .when(F.col("line").startswith("### "), "heading")
        .when(F.col("line").startswith("|"), "table")
        .when(F.col("line").startswith("* "), "bullets")
        .otherwise("paragraph")
    )
    w = W.partitionBy(*key).orderBy("line_no")
    rows = lines.withColumn("kind", kind)
    spoken = F.when(F.col("kind") != "gap", F.col("kind"))
    before = F.last(spoken, ignorenulls=True).over(w.rowsBetween(W.unboundedPreceding, -1))
    gap = F.lag("kind").over(w) == "gap"
    opens = (F.col("kind") == "heading") | before.isNull() | (before != F.col("kind")) | (gap & F.col("kind").isin("paragraph", "table"))
    rows = rows.withColumn("_opens", opens).where(F.col("kind") != "gap")
    rows = rows.withColumn("block", F.sum(F.col("_opens").cast("int")).over(w.rowsBetween(W.unboundedPreceding, 0)))
    rows = rows.where(~((F.col("kind") == "table") & F.col("line").rlike(r"^\|(?:\s*:?-+:?\s*\|)+$")))
    text = F.when(F.col("kind") == "heading", F.trim(F.expr("substring(line, 5)"))).when(
        F.col("kind") == "bullets", F.trim(F.expr("substring(line, 3)"))
    ).otherwise(F.col("line"))
    out = rows.select(*key, "block", "kind", F.struct("line_no", text.alias("t")).alias("_r"))
    return out.groupBy(*key, "block", "kind").agg(F.transform(F.array_sort(F.collect_list("_r")), lambda r: r["t"]).alias("rows"))


def pages_by_offset(df: DataFrame, order: list[str], size: int = 1000) -> DataFrame:
    """`page` and `place` of rows read in pages of a fixed size in a total order."""
    ranked = global_rank(df, [], list(order), "place").withColumn("place", F.col("place") - 1)
    return ranked.withColumn("page", F.floor(F.col("place") / size).cast("int"))
