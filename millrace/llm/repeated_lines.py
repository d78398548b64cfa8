"""Lines that one source repeats over many of its documents.

Two lines are the same when their letters are, case folded; digits, bullets, bars and spacing are
slots of any content. A line walks down its source's token tree of fixed depth. The inner levels
are its first three tokens, cut where the letters themselves say so (`TOKEN`), so that a line
takes the same way however it is spaced; a second tree (`backward`) goes by the last tokens, for
lines whose beginning changes. The leaf levels are the line's words: up to four from the front,
all of the middle as one, up to four from the back. On a level a word has a branch of its own only if it
covers enough documents of the source there; any other word goes down the wildcard branch, and
between the first and the last wildcard every word does. So lines that differ in one word (a
weekday, a number in words) end in one template with a wildcard there.

Trees are partial aggregates of each map task, merged by the shuffle: first the inner nodes
(source, node), one small record each; only lines under a node that covers enough documents go
on to the leaves. That loses nothing: whatever covers enough documents has only nodes and words
that do. A template is a leaf path whose lines together cover enough documents.
`find_repeated_lines` then verifies the content of the lines of covering templates: of these it
gives the lines whose own letters stand in enough documents.

Nodes and found contents (at most 1 / `min_share` times the lines of a page per source) are
counted before they are used; up to `BROADCAST_ROWS` of them are broadcast, more are joined by
shuffle. No text is shuffled but that of lines under covering nodes, once per task and content.

Defined cases: null text or source, lines without letters and empty tables give no rows; a
document that repeats a line counts once, but each place is reported; rows with equal ids are
separate documents only through their ids (ids are taken to be unique).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.text import case_fold
from millrace.plans.checkpoints import cut

#: A token is one ideograph, or up to ten letters that end after one of the common last letters.
_END = "edsyéаяейьςη"
_FAR = r"\p{IsHan}"
TOKEN = rf"[{_FAR}]|[^{_FAR}{_END}]{{0,9}}[{_END}]|[^{_FAR}{_END}]{{1,10}}"
INNER = 3
FRONT = 4
BACK = 4
BROADCAST_ROWS = 500_000
WILD = "*"


def letter_streams(text: Column) -> Column:
    """Array of the lines' letters: one pass over the text, lines parted by \\n only."""
    letters = F.regexp_replace(text, r"[^\p{L}\n]+", "")
    return F.split(case_fold(letters), "\n", -1)


def _head(stream: Column) -> Column:
    """The first tokens, of at most ten letters each."""
    return F.regexp_extract(F.substring(stream, 1, 10 * INNER), f"^(?:{TOKEN}){{1,{INNER}}}", 0)


def _tail(stream: Column) -> Column:
    tokens = F.regexp_extract_all(stream, F.lit(f"({TOKEN})"), F.lit(1))
    return F.array_join(F.slice(tokens, -F.least(F.size(tokens), F.lit(INNER)), INNER), "")


def _node(stream: Column, backward: bool) -> Column:
    return F.xxhash64(F.lit(backward), _tail(stream) if backward else _head(stream))


def _content(stream: Column) -> Column:
    """128 bits of a line's letters."""
    return F.struct(F.xxhash64(F.lit("a"), stream).alias("a"), F.xxhash64(F.lit("b"), stream).alias("b"))


def _slots(words: Column) -> Column:
    """Words of a line by leaf level; levels a short line does not reach are empty."""
    n = F.size(words)
    front, back = F.least(F.lit(FRONT), F.ceil(n / 2)), F.least(F.lit(BACK), F.floor(n / 2))
    first = [F.when(front > i, F.get(words, F.lit(i))).otherwise("") for i in range(FRONT)]
    middle = F.array_join(F.slice(words, FRONT + 1, F.greatest(n - FRONT - BACK, F.lit(0))), " ")
    last = [F.when(back >= k, F.get(words, n - k)).otherwise("") for k in range(BACK, 0, -1)]
    return F.array(*first, middle, *last)


def _template(path: Column) -> Column:
    """A leaf path as text: what stands before its first and after its last wildcard."""
    upto = lambda p: F.slice(p, 1, (F.array_position(p, WILD) - 1).cast("int"))
    cut_out = F.concat(upto(path), F.array(F.lit(WILD)), F.reverse(upto(F.reverse(path))))
    return F.array_join(F.filter(F.when(F.array_contains(path, WILD), cut_out).otherwise(path), lambda t: t != ""), " ")


def _source_rows(df: DataFrame, id_col: str, text_col: str, src_col: str) -> DataFrame:
    return df.where(F.col(text_col).isNotNull() & F.col(src_col).isNotNull()).select(
        F.col(id_col).alias("_id"), F.col(src_col).alias("_src"), F.col(text_col).alias("_text")
    )


def _sized(df: DataFrame) -> DataFrame:
    """Written once; broadcast only if it was counted to have at most `BROADCAST_ROWS` rows."""
    done = cut(df)
    return F.broadcast(done) if done.count() <= BROADCAST_ROWS else done


def _lines(rows: DataFrame, backward: bool) -> DataFrame:
    """(_id, _src, _s, _words, _first, _node): the lines of each document in all their spacings;
    `_first` marks one of the spacings of a content."""
    text = F.col("_text")
    spaced = F.split(case_fold(F.regexp_replace(text, r"[^\p{L}\n]+", " ")), "\n", -1)
    pairs = F.transform(spaced, lambda w: F.struct(F.replace(w, F.lit(" "), F.lit("")).alias("s"), F.trim(w).alias("w")))
    pairs = F.filter(pairs, lambda p: p["s"] != "")
    rows = rows.select("_id", "_src", F.sort_array(F.array_distinct(pairs)).alias("_pairs"))
    first = lambda p, i: (i == 0) | (F.get("_pairs", i - 1)["s"] != p["s"])
    marked = F.transform("_pairs", lambda p, i: F.struct(p["s"].alias("s"), p["w"].alias("w"), first(p, i).alias("first")))
    lines = rows.select("_id", "_src", F.explode(marked).alias("_p"))
    lines = lines.select("_id", "_src", F.col("_p.s").alias("_s"), F.col("_p.w").alias("_words"), F.col("_p.first").alias("_first"))
    return lines.withColumn("_node", _node(F.col("_s"), backward))


def node_counts(
    df: DataFrame, id_col: str = "ctx_id", text_col: str = "text", src_col: str = "src", backward: bool = False
) -> DataFrame:
    """Merged inner nodes of the trees: (_src, _node, _docs), one row per node, any coverage."""
    rows = _source_rows(df, id_col, text_col, src_col)
    streams = F.filter(letter_streams(F.col("_text")), lambda s: s != "")
    keys = F.array_distinct(F.transform(streams, lambda s: _node(s, backward)))
    return rows.select("_src", F.explode(keys).alias("_node")).groupBy("_src", "_node").agg(F.count(F.lit(1)).alias("_docs"))


def _leaves(df: DataFrame, columns: tuple[str, str, str], min_docs: int, min_share: float, backward: bool):
    """(covering nodes with `_need` and `_pages`, contents under them with their template)."""
    rows = _source_rows(df, *columns)
    totals = rows.groupBy("_src").agg(F.count(F.lit(1)).alias("_pages"))
    need = F.greatest(F.lit(min_docs), F.ceil(F.col("_pages") * F.lit(min_share) - F.lit(1e-9)))
    nodes = (
        node_counts(df, *columns, backward)
        .where(F.col("_docs") >= min_docs)
        .join(totals.select("_src", "_pages", need.cast("bigint").alias("_need")), "_src")
        .where(F.col("_docs") >= F.col("_need"))
        .select("_src", "_node", "_need", "_pages")
    )
    nodes = _sized(nodes)
    leaf = ["_src", "_node"]
    contents = cut(
        _lines(rows, backward)
        .join(nodes, leaf)
        .groupBy(*leaf, "_need", "_pages", "_s")
        .agg(F.count_if("_first").alias("_docs"), F.min("_words").alias("_words"))
    )
    keyed = contents.withColumn("_c", _content(F.col("_s"))).withColumn("_level", _slots(F.split("_words", " ")))
    hashed = F.transform("_level", lambda w: F.when(w != "", F.xxhash64(w)))
    slots = keyed.select(*leaf, "_need", "_c", "_docs", F.posexplode(hashed).alias("_at", "_word")).where(F.col("_word").isNotNull())
    frequent = (
        slots.groupBy(*leaf, "_need", "_at", "_word").agg(F.sum("_docs").alias("_n")).where(F.col("_n") >= F.col("_need"))
    )
    kept = slots.join(frequent.select(*leaf, "_at", "_word"), [*leaf, "_at", "_word"]).groupBy(*leaf, "_c").agg(F.collect_set("_at").alias("_kept"))
    path = F.transform("_level", lambda w, i: F.when((w == "") | F.coalesce(F.array_contains("_kept", i), F.lit(False)), w).otherwise(WILD))
    leaves = keyed.join(kept, [*leaf, "_c"], "left").withColumn("_template", _template(path))
    return rows, nodes, leaves.select(*leaf, "_need", "_pages", "_s", "_c", "_docs", "_template")


def covering_templates(
    df: DataFrame,
    id_col: str = "ctx_id",
    text_col: str = "text",
    src_col: str = "src",
    min_docs: int = 5,
    min_share: float = 0.02,
    backward: bool = False,
) -> DataFrame:
    """(src, template, docs, pages, contents): templates whose lines stand in `min_docs` documents
    and in `min_share` of their source's documents, as words with `*` for the wildcards."""
    rows, nodes, leaves = _leaves(df, (id_col, text_col, src_col), min_docs, min_share, backward)
    placed = _lines(rows, backward).join(nodes.select("_src", "_node"), ["_src", "_node"], "left_semi")
    per_doc = placed.join(leaves.select("_src", "_node", "_s", "_need", "_pages", F.col("_template").alias("template")), ["_src", "_node", "_s"])
    per_doc = per_doc.groupBy("_src", "_need", "_pages", "template", "_id").agg(F.count(F.lit(1)).alias("_k"))
    docs = per_doc.groupBy("_src", "_need", "_pages", "template").agg(F.count(F.lit(1)).alias("docs"))
    kinds = leaves.groupBy("_src", F.col("_template").alias("template")).agg(F.count_distinct("_s").alias("contents"))
    return (
        docs.where(F.col("docs") >= F.col("_need"))
        .join(kinds, ["_src", "template"])
        .select(F.col("_src").alias(src_col), "template", "docs", F.col("_pages").alias("pages"), "contents")
    )


def _repeated(df: DataFrame, columns: tuple[str, str, str], min_docs: int, min_share: float) -> DataFrame:
    """(_src, _found): contents of covering templates, verified one by one, as 128-bit keys."""
    _, _, leaves = _leaves(df, columns, min_docs, min_share, False)
    leaf = ["_src", "_node", "_template"]
    covering = leaves.groupBy(*leaf, "_need").agg(F.sum("_docs").alias("_lines")).where(F.col("_lines") >= F.col("_need"))
    verified = cut(leaves.join(covering.select(*leaf), leaf).where(F.col("_docs") >= F.col("_need")).select("_src", "_c"))
    found = verified.groupBy("_src").agg(F.collect_list("_c").alias("_found"))
    return F.broadcast(found) if verified.count() <= BROADCAST_ROWS else found


def find_repeated_lines(
    df: DataFrame,
    id_col: str = "ctx_id",
    text_col: str = "text",
    src_col: str = "src",
    min_docs: int = 5,
    min_share: float = 0.02,
) -> DataFrame:
    """(id, line_no, src) of every line of a covering template whose content itself covers enough."""
    found = _repeated(df, (id_col, text_col, src_col), min_docs, min_share)
    pages = _source_rows(df, id_col, text_col, src_col).join(found, "_src")
    lines = pages.select("_id", "_src", "_found", F.posexplode(letter_streams(F.col("_text"))).alias("line_no", "_s"))
    hits = lines.where((F.col("_s") != "") & F.array_contains("_found", _content(F.col("_s"))))
    return hits.select(F.col("_id").alias(id_col), "line_no", F.col("_src").alias(src_col))


def remove_repeated_lines(
    df: DataFrame,
    id_col: str = "ctx_id",
    text_col: str = "text",
    src_col: str = "src",
    min_docs: int = 5,
    min_share: float = 0.02,
) -> DataFrame:
    """All rows and columns of `df` with the repeated lines taken out of `text_col`.

    `lines_removed` (replaced if there is such a column) counts them. Rows with nothing to
    remove, null texts among them, come out as they are. Texts meet their source's contents where
    they lie; nothing is put together again by a shuffle.
    """
    found = _repeated(df, (id_col, text_col, src_col), min_docs, min_share).select(F.col("_src").alias("_rm_src"), F.col("_found").alias("_rm_found"))
    joined = df.join(found, F.col(src_col) == F.col("_rm_src"), "left")
    streams = letter_streams(F.col(text_col))
    gone = F.transform(streams, lambda s: (s != "") & F.array_contains("_rm_found", _content(s)))
    joined = joined.withColumn("_rm_gone", F.when(F.col("_rm_found").isNotNull() & F.col(text_col).isNotNull(), gone))
    count = F.coalesce(F.size(F.filter("_rm_gone", lambda g: g)), F.lit(0))
    kept = F.filter(F.split(F.col(text_col), "\n", -1), lambda _, i: ~F.col("_rm_gone")[i])
    removed = F.when(F.col("_rm_gone").isNull(), 0).otherwise(count)
    return (
        joined.withColumn("lines_removed", removed)
        .withColumn(text_col, F.when(F.col("lines_removed") > 0, F.array_join(kept, "\n")).otherwise(F.col(text_col)))
        .drop("_rm_src", "_rm_found", "_rm_gone")
    )
