"""Queries of the training-data operators and their SQL counterparts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import format_copies, mixing, mojibake, one_form, packing, repeated_lines, scan_repair, sentence_bounds
from millrace.plans.sql import fold_sql
from millrace.sources import read_table


def _form(spark: SparkSession, sf_dir: str, form: str) -> DataFrame:
    return read_table(spark, sf_dir, "contexts", spread=True).where(F.col("form") == form)


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_lines.find_repeated_lines(_form(spark, sf_dir, "page")).select("ctx_id", "line_no")


def p1_cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _form(spark, sf_dir, "page").select("ctx_id", "src", "text")
    return repeated_lines.remove_repeated_lines(pages)


def p1_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Covering templates with their wildcard slots, of the trees grown from both line ends."""
    pages = _form(spark, sf_dir, "page")
    front = repeated_lines.covering_templates(pages).withColumn("grown", F.lit("front"))
    return front.unionByName(repeated_lines.covering_templates(pages, backward=True).withColumn("grown", F.lit("back")))


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return format_copies.context_copies(read_table(spark, sf_dir, "contexts", spread=True))


def p2_collapsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return format_copies.collapse_contexts(read_table(spark, sf_dir, "contexts", spread=True))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentence_bounds.find_sentences(_form(spark, sf_dir, "passage"))


def p3_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    passages = _form(spark, sf_dir, "passage").select("ctx_id", "lang", "text")
    return sentence_bounds.add_sentences(passages)


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return one_form.find_same_looking(
        read_table(spark, sf_dir, "sense_examples"), read_table(spark, sf_dir, "entries_full")
    )


def p4_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "sense_examples").select("example_id", "en", "zh")
    return one_form.add_one_form(rows, ["en", "zh"])


def p4_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return one_form.add_one_form(read_table(spark, sf_dir, "entries_full").select("entry_id", "ex"), ["ex"])


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_repair.find_defects(_form(spark, sf_dir, "scan"))


def p5_repaired(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_repair.repair_scans(_form(spark, sf_dir, "scan").select("ctx_id", "text"))


def p6_packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read_table(spark, sf_dir, "documents", spread=True), read_table(spark, sf_dir, "containers"))


def p6_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packing_report(p6_packed(spark, sf_dir))


def p6_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per container: documents that stand in it once and whole, containers above capacity, and
    documents cut although they fit."""
    packed = p6_packed(spark, sf_dir)
    docs = packed.groupBy("container", "capacity", "doc").agg(
        F.count(F.lit(1)).alias("pieces"), F.min("token_from").alias("a"), F.max("token_to").alias("b"), F.sum(F.col("token_to") - F.col("token_from")).alias("n")
    )
    bins = packed.groupBy("container", "bin").agg((F.sum(F.col("token_to") - F.col("token_from")) > F.first("capacity")).alias("over"))
    whole = docs.groupBy("container").agg(
        F.count_if((F.col("a") == 0) & (F.col("b") == F.col("n"))).alias("whole"), F.count_if((F.col("pieces") > 1) & (F.col("n") <= F.col("capacity"))).alias("cut")
    )
    return whole.join(bins.groupBy("container").agg(F.count_if("over").alias("overfull")), "container")


def p7_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per source of the targets: records used more often than allowed, and sources without a row."""
    docs, targets = read_table(spark, sf_dir, "documents", spread=True), read_table(spark, sf_dir, "mix_targets")
    mixed, report = mixing.mix(docs, targets)
    often = mixed.groupBy("source", "doc_id").agg(F.count(F.lit(1)).alias("times")).join(targets.select("source", "max_repeats"), "source")
    bad = often.groupBy("source").agg(F.count_if(F.col("times") > F.col("max_repeats")).alias("too_often"))
    rows = report.join(bad, "source", "left")
    return rows.select("source", "target_share", "max_repeats", F.coalesce("too_often", F.lit(0)).alias("too_often"), (F.col("taken") > 0).alias("used"))


def p7_mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read_table(spark, sf_dir, "documents", spread=True), read_table(spark, sf_dir, "mix_targets"))[0]


def p7_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read_table(spark, sf_dir, "documents", spread=True), read_table(spark, sf_dir, "mix_targets"))[1]


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mojibake.judge_texts(read_table(spark, sf_dir, "documents", spread=True)).select("doc_id")


def p8_restored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mojibake.judge_texts(read_table(spark, sf_dir, "documents", spread=True))


QUERIES = {
    "p1_found": p1_found,
    "p1_cleaned": p1_cleaned,
    "p1_templates": p1_templates,
    "p2_found": p2_found,
    "p2_collapsed": p2_collapsed,
    "p3_found": p3_found,
    "p3_sentences": p3_sentences,
    "p4_found": p4_found,
    "p4_examples": p4_examples,
    "p4_entries": p4_entries,
    "p5_found": p5_found,
    "p5_repaired": p5_repaired,
    "p6_packed": p6_packed,
    "p6_report": p6_report,
    "p6_checks": p6_checks,
    "p7_mixed": p7_mixed,
    "p7_shares": p7_shares,
    "p7_checks": p7_checks,
    "p8_found": p8_found,
    "p8_restored": p8_restored,
}

_LETTERS = r"[^\p{L}]+"
_LETTERS_DIGITS = r"[^\p{L}\p{Nd}]+"
_LINE_KEY = fold_sql(f"regexp_replace(line, '{_LETTERS}', '', 'g')")
_TEXT_KEY = fold_sql(f"regexp_replace(text, '{_LETTERS_DIGITS}', '', 'g')")
_VALUE_KEY = fold_sql(f"regexp_replace(coalesce(value, ''), '{_LETTERS_DIGITS}', '', 'g')")

_P1_FOUND = f"""
WITH pages AS (
  SELECT ctx_id, src, text FROM contexts WHERE form = 'page' AND text IS NOT NULL AND src IS NOT NULL
), parts AS (
  SELECT ctx_id, src, string_split(text, chr(10)) AS ls FROM pages
), lines AS (
  SELECT ctx_id, src, unnest(range(len(ls))) AS i, unnest(ls) AS line FROM parts
), keyed AS (
  SELECT ctx_id, src, i, {_LINE_KEY} AS k FROM lines
), totals AS (
  SELECT src, count(*) AS pages FROM pages GROUP BY src
), covering AS (
  SELECT src, k FROM (SELECT src, k, count(DISTINCT ctx_id) AS docs FROM keyed WHERE k <> '' GROUP BY src, k)
  JOIN totals USING (src) WHERE docs >= 5 AND docs * 50 >= pages
)
"""

_P2_KEYED = f"""
WITH rows_ AS (
  SELECT ctx_id, word, form, text, n FROM contexts WHERE form IN ('sentence', 'card') AND text IS NOT NULL
), sentences AS (
  SELECT ctx_id, word, form, {_TEXT_KEY} AS k
  FROM rows_ WHERE form = 'sentence'
), json_items AS (
  SELECT ctx_id, lower(trim(key)) AS name, json_extract_string(text, '$."' || key || '"') AS value
  FROM (SELECT ctx_id, text, unnest(json_keys(text)) AS key FROM rows_
        WHERE form = 'card' AND ltrim(text, ' ' || chr(10) || chr(13) || chr(9)) LIKE '{{%')
), plain_items AS (
  SELECT ctx_id, lower(trim(string_split(item, ':')[1])) AS name, substr(item, instr(item, ':') + 1) AS value
  FROM (SELECT ctx_id, unnest(string_split_regex(trim(text, ' ' || chr(10) || chr(13) || chr(9)),
               '\\r\\n|\\n|\\r| \\| |; ')) AS item
        FROM rows_ WHERE form = 'card' AND ltrim(text, ' ' || chr(10) || chr(13) || chr(9)) NOT LIKE '{{%')
  WHERE trim(item) <> ''
), cards AS (
  SELECT ctx_id, string_agg(name || '=' || {_VALUE_KEY}, '&' ORDER BY name, value) AS k
  FROM (SELECT * FROM json_items UNION ALL SELECT * FROM plain_items) GROUP BY ctx_id
), keyed AS (
  SELECT ctx_id, word, form, k FROM sentences
  UNION ALL SELECT r.ctx_id, word, form, k FROM rows_ r JOIN cards USING (ctx_id)
), firsts AS (
  SELECT *, min(ctx_id) OVER (PARTITION BY word, form, k) AS first_id FROM keyed
)
"""

ORACLE = {
    "p1_found": _P1_FOUND
    + "SELECT ctx_id, CAST(i AS INTEGER) AS line_no FROM keyed JOIN covering USING (src, k)",
    "p1_cleaned": _P1_FOUND
    + """, marked AS (
  SELECT x.ctx_id, x.i, x.line, c.k IS NOT NULL AS gone
  FROM (SELECT l.ctx_id, l.src, l.i, l.line, q.k FROM lines l JOIN keyed q ON l.ctx_id = q.ctx_id AND l.i = q.i) x
  LEFT JOIN covering c ON x.src = c.src AND x.k = c.k
), rebuilt AS (
  SELECT ctx_id, coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '') AS text,
         count(*) FILTER (gone) AS lines_removed
  FROM marked GROUP BY ctx_id
)
SELECT p.ctx_id, p.src, CASE WHEN r.lines_removed > 0 THEN r.text ELSE p.text END AS text,
       CAST(coalesce(r.lines_removed, 0) AS INTEGER) AS lines_removed
FROM contexts p LEFT JOIN rebuilt r USING (ctx_id) WHERE p.form = 'page'""",
    "p6_checks": """SELECT c.container, (SELECT count(*) FROM documents WHERE text IS NOT NULL) AS whole, 0::BIGINT AS cut, 0::BIGINT AS overfull
FROM containers c WHERE capacity_tokens >= 1""",
    "p7_checks": """SELECT t.source, t.target_share, t.max_repeats, 0::BIGINT AS too_often,
  coalesce(t.max_repeats > 0 AND t.target_share > 0 AND t.source IN (SELECT source FROM documents WHERE text <> ''), false) AS used FROM mix_targets t""",
    "p2_found": _P2_KEYED
    + "SELECT first_id, ctx_id AS copy_id FROM firsts WHERE ctx_id <> first_id",
    "p2_collapsed": _P2_KEYED
    + """, totals AS (
  SELECT first_id AS ctx_id, count(*) AS copies, CAST(sum(n) AS BIGINT) AS total_n
  FROM firsts JOIN (SELECT ctx_id, n FROM rows_) USING (ctx_id) GROUP BY first_id
)
SELECT t.ctx_id, r.word, r.form, r.text, t.copies, t.total_n FROM totals t JOIN rows_ r USING (ctx_id)""",
}
