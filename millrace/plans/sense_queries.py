"""Queries over labels, senses, entries and examples."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from millrace.functions import text as T
from millrace.functions.signal import rms
from millrace.operators import contexts as C
from millrace.operators import frequency as Q
from millrace.operators import merge as M
from millrace.operators import senses as S
from millrace.operators import validate as V
from millrace.operators.ranking import global_rank
from millrace.plans.checkpoints import shared_folder
from millrace.plans.sql import WS, directions_cte, inflections_sql, lemma_sql, quoted, sentences_cte
from millrace.sources import corpus, read_table, sinks

KEEP = 6
FUNCTION_WORDS = ["", "prep.", "conj.", "pron.", "det.", "art.", "aux.", "modal v."]


def _t(name):
    return lambda spark, sf_dir: read_table(spark, sf_dir, name)


_labels, _senses, _entries, _examples, _contexts = map(_t, ("labels_norm", "senses", "entries_full", "sense_examples", "contexts"))


def _sentences(spark, sf_dir):
    """(word, sid, text, n, src) of the sentence contexts; equal texts of a word count together."""
    rows = _contexts(spark, sf_dir).where((F.col("form") == "sentence") & F.col("text").isNotNull())
    keyed = rows.select("word", T.sid(F.col("text")).alias("sid"), "text", F.coalesce("n", F.lit(1)).alias("n"), F.coalesce("src", F.lit("")).alias("src"))
    return keyed.groupBy("word", "sid").agg(F.min("text").alias("text"), F.sum("n").alias("n"), F.min("src").alias("src"))


def _labelled(spark, sf_dir):
    return S.labelled_sentences(_labels(spark, sf_dir), _sentences(spark, sf_dir))


def _instructions(spark, sf_dir):
    """The papers' own sentences: by wording, by number of sittings, and Directions blocks of the documents."""
    rows = _contexts(spark, sf_dir).where((F.col("form") == "sentence") & F.col("text").isNotNull() & F.col("src").isNotNull())
    docs = read_table(spark, sf_dir, "documents", spread=True).where(F.col("sub").isin("papers", "listening") & F.col("text").isNotNull())
    return C.instruction_sentences(rows.select(F.col("text").alias("sentence"), "src"), F.substring("src", 1, 12), docs, "text", ["doc_id"])


def instruction_sentences(spark, sf_dir):
    return _instructions(spark, sf_dir).select(T.sid(F.col("sentence")).alias("sid"))


def _marked(spark, sf_dir):
    """Labelled sentences with `stem`, whether they are instructions, and their paper."""
    stems = _instructions(spark, sf_dir).select(T.sid(F.col("sentence")).alias("sid"), F.lit(True).alias("stem"))
    rows = _labelled(spark, sf_dir).join(stems, "sid", "left")
    return rows.withColumn("stem", F.coalesce("stem", F.lit(False))).withColumn("paper", F.substring_index("src", "·", 1))


def _weights(spark, sf_dir):
    return S.sense_weights(_marked(spark, sf_dir), F.col("stem"), F.col("paper"))


def windowed_weights(spark, sf_dir):
    """The stored labels counted over the papers of some years only; nothing is labelled again."""
    rows = _marked(spark, sf_dir).where(F.col("paper").rlike("_20(?:19|20|21)_"))
    return S.sense_weights(rows, F.col("stem"), F.col("paper"))


def promoted_senses(spark, sf_dir):
    """First senses when senses with one hit are demoted and third senses promoted."""
    ranked = S.rank_senses(_weights(spark, sf_dir), promoted=F.col("sense") == 2, demoted=F.col("hits") == 1)
    return ranked.select("word", "sense", "place")


def label_modes(spark, sf_dir):
    return S.label_modes(_labels(spark, sf_dir))


def label_samples(spark, sf_dir):
    return S.label_samples(_labelled(spark, sf_dir))


def sense_weights(spark, sf_dir):
    return _weights(spark, sf_dir)


def sense_rank_capped(spark, sf_dir):
    return S.rank_senses(_weights(spark, sf_dir)).select("word", "sense", "place", "capped")


def primary_sense(spark, sf_dir):
    return S.rank_senses(_weights(spark, sf_dir)).where(F.col("place") == 1).select("word", "sense")


def _kept(spark, sf_dir):
    n = _sentences(spark, sf_dir).groupBy("word").agg(F.count(F.lit(1)).alias("sentences"))
    return S.keep_senses(S.rank_senses(_weights(spark, sf_dir)), n, most=KEEP)


def sense_keep_topk(spark, sf_dir):
    return _kept(spark, sf_dir)


def shown_with_manual(spark, sf_dir):
    """Kept senses and, whatever their place, every sense labelled as the second of a sentence."""
    n = _sentences(spark, sf_dir).groupBy("word").agg(F.count(F.lit(1)).alias("sentences"))
    extra = _labels(spark, sf_dir).where((F.col("ord") == 1) & (F.col("kind") == "sense")).select("word", "sense").distinct()
    return S.keep_senses(S.rank_senses(_weights(spark, sf_dir)), n, most=2, extra=extra)


def definitions(spark, sf_dir):
    kept = _kept(spark, sf_dir).join(_senses(spark, sf_dir).select("word", F.col("idx").alias("sense"), "pos", "zh"), ["word", "sense"])
    return S.compose_definition(kept)


def phrase_counts(spark, sf_dir):
    out = S.phrase_counts(_labelled(spark, sf_dir), T.phrase_key(F.col("phrase")))
    return out.select("phrase", "count", F.array_join("words", ",").alias("words"))


def phrase_usage(spark, sf_dir):
    rows = _labels(spark, sf_dir).where(F.col("phrase").isNotNull())
    return rows.groupBy(T.phrase_key(F.col("phrase")).alias("phrase")).agg(F.count(F.lit(1)).alias("uses"), F.count_distinct("word").alias("words"))


def unlabelled_anti(spark, sf_dir):
    rows = _sentences(spark, sf_dir).join(_labels(spark, sf_dir).select("word", "sid").distinct(), ["word", "sid"], "left_anti")
    return rows.groupBy("word").agg(F.count(F.lit(1)).alias("missing"))


def ref_violations(spark, sf_dir):
    """Labels whose sense has no gloss or does not exist: of the senses with a gloss none may be missing."""
    rows = _labels(spark, sf_dir).where(F.col("kind") == "sense").select("word", F.col("sense").alias("idx"), "sid").distinct()
    return V.missing_reference(rows, ["word", "idx"], _senses(spark, sf_dir).where(F.col("zh").isNotNull()), ["word", "idx"])


def label_rules(spark, sf_dir):
    rules = {
        "kind": F.col("kind").isin("sense", "phrase", "x", "new"),
        "sense number": (F.col("kind") != "sense") | (F.col("sense") >= 0),
        "phrase text": (F.col("kind") != "phrase") | (F.trim("phrase") != ""),
        "sid form": F.col("sid").rlike("^[0-9a-f]{16}$"),
        "first of its sentence": F.col("ord") == 0,
    }
    rows = V.rule_violations(_labels(spark, sf_dir), ["word", "sid"], rules)
    return rows.groupBy("rule").agg(F.count(F.lit(1)).alias("rows"))


def duplicate_labels(spark, sf_dir):
    return V.duplicate_keys(_labels(spark, sf_dir), ["word", "sid", "ord"]).select("word", "sid", "ord", F.col("rows").alias("copies"))


def task_key_difference(spark, sf_dir):
    left = _sentences(spark, sf_dir).select("word")
    return M.symmetric_difference(left, _labels(spark, sf_dir).select("word"), ["word"])


def admissible_examples(spark, sf_dir):
    ok = F.coalesce(V.admissible_example(), F.lit(False))
    return _examples(spark, sf_dir).where(ok).select("example_id", F.trim("en").alias("en"), F.trim("zh").alias("zh"))


def english_parts(spark, sf_dir):
    return _entries(spark, sf_dir).where(F.col("ex").isNotNull()).select("entry_id", F.md5(F.encode(T.english_part(F.col("ex")), "UTF-8")).alias("h"))


def sense_terms(spark, sf_dir):
    rows = _senses(spark, sf_dir).where(F.col("zh").isNotNull())
    full = F.concat(F.coalesce("pos", F.lit("")), "zh")
    return rows.select("word", "idx", F.explode(T.sense_terms(full)).alias("term"))


def core_mentions(spark, sf_dir):
    """Senses of words with a core card that its derivation does not mention."""
    cards = _entries(spark, sf_dir).where(F.col("core").isNotNull()).select("entry_id", "word", F.col("core.derive").alias("derive"))
    full = F.concat(F.coalesce("pos", F.lit("")), F.coalesce("zh", F.lit("")))
    s = _senses(spark, sf_dir).select("word", "idx", F.transform(T.sense_terms(full), T.longest_piece).alias("terms"))
    return V.uncovered_terms(cards, s, "word", "derive").select("entry_id", "idx")


def _numbered(spark, sf_dir, *columns):
    """(word, columns, edition_no) of all editions, numbered from 0 by name."""
    return M.numbered(_entries(spark, sf_dir).select("word", "edition", *columns), "edition", "edition_no").drop("edition")


def priority_merge(spark, sf_dir):
    """First non-empty sound of a word over all editions, newest first."""
    rows = _numbered(spark, sf_dir, "us").where(F.trim("us") != "")
    return M.first_of(rows, ["word"], "edition_no", ["us"], latest=True)


def last_wins(spark, sf_dir):
    """Later editions overwrite earlier ones, empty sounds too."""
    return M.first_of(_numbered(spark, sf_dir, "us").where(F.col("us").isNotNull()), ["word"], "edition_no", ["us"], latest=True)


def alias_merge(spark, sf_dir):
    cards = M.first_of(_numbered(spark, sf_dir, "uk").where(F.col("uk").isNotNull()), ["word"], "edition_no", ["uk"], latest=True).select("word", "uk")
    plural = _senses(spark, sf_dir).select("word").distinct().select("word", T.lemma(F.col("word")).alias("same_as"))
    return M.resolve_aliases(cards, plural.where(F.col("word") != F.col("same_as")), "word")


def veto_anti(spark, sf_dir):
    rows = _entries(spark, sf_dir)
    words = rows.where(F.col("core").isNotNull()).select("word").distinct()
    return M.without(words, rows.where(F.col("root").isNotNull()).select("word"), _labels(spark, sf_dir).where(F.col("kind") == "x").select("word"), key="word")


def entry_assembly(spark, sf_dir):
    """Entries with the composed gloss and the first example where there is one, originals kept."""
    base = _entries(spark, sf_dir).where(F.col("word").isNotNull()).select("entry_id", "word", "def", "ex")
    ex = _examples(spark, sf_dir).where(F.col("zh").isNotNull()).groupBy("word").agg(F.min(F.struct("example_id", "en", "zh")).alias("e"))
    patch = definitions(spark, sf_dir).withColumnRenamed("definition", "def").join(
        ex.select("word", F.concat("e.en", F.lit("（"), "e.zh", F.lit("）")).alias("ex")), "word", "full_outer"
    )
    out = M.override_present(base, patch, "word", {"def": "def_before", "ex": "ex_before"})
    return out.select("entry_id", "word", "def", F.md5(F.encode("ex", "UTF-8")).alias("ex_h"), F.col("def_before").alias("def0"))


def core_cards(spark, sf_dir):
    """Newest valid core card of each word, both texts filled in, without words that have a root card."""
    rows = _numbered(spark, sf_dir, "core", "root")
    image, derive = (F.nullif(F.trim(F.col(f"core.{c}")), F.lit("")).alias(c) for c in ("image", "derive"))
    cards = rows.select("word", "edition_no", image, derive).where(F.col("image").isNotNull() & F.col("derive").isNotNull())
    best = M.first_of(cards, ["word"], "edition_no", ["image", "derive"], latest=True).select("word", "image", "derive")
    return M.without(best, rows.where(F.col("root").isNotNull()).select("word"), key="word")


def whole_source(spark, sf_dir):
    """Cards of the last edition if it has one for every word of the edition before, else all of that one."""
    rows = _numbered(spark, sf_dir, "uk")
    last = rows.agg(F.max("edition_no").alias("last"))
    near = rows.join(F.broadcast(last)).where(F.col("edition_no") >= F.col("last") - 1).withColumn("new", F.col("edition_no") == F.col("last"))
    missing = near.groupBy("word").agg(F.bool_or("new").alias("has")).agg(F.count_if(~F.col("has")).alias("missing"))
    return near.join(F.broadcast(missing)).where(F.col("new") == (F.col("missing") == 0)).select("word", "uk", "edition_no")


def _kept_all(spark, sf_dir):
    n = _sentences(spark, sf_dir).groupBy("word").agg(F.count(F.lit(1)).alias("sentences"))
    return S.keep_senses(S.rank_senses(_weights(spark, sf_dir)), n, most=1_000_000)


def shown_senses(spark, sf_dir):
    """Senses shown after the limits for function words and words with a core card, manual ones kept."""
    ranked = S.rank_senses(_weights(spark, sf_dir))
    manual = _labels(spark, sf_dir).where((F.col("ord") == 1) & (F.col("kind") == "sense")).select("word", "sense").distinct()
    keep = ranked.join(manual, ["word", "sense"]).select("word", "sense", "place")
    core = _entries(spark, sf_dir).where(F.col("core").isNotNull()).select("word")
    return S.shown_senses(_kept_all(spark, sf_dir), function_senses(spark, sf_dir), core, keep, most_function=3, most_core=2)


def _glossed(spark, sf_dir):
    s = _senses(spark, sf_dir).select("word", F.col("idx").alias("sense"), "pos", "zh")
    return shown_senses(spark, sf_dir).join(s, ["word", "sense"])


def full_definitions(spark, sf_dir):
    """Definition of the shown senses with the word's form, and behind it the senses not shown."""
    rows = _glossed(spark, sf_dir)
    shown = S.gloss_groups(rows.where("shown")).withColumnRenamed("groups", "g")
    rest = S.gloss_groups(rows.where(~F.col("shown"))).withColumnRenamed("groups", "more")
    base = T.lemma(F.col("word"))
    irregular = T.irregular_form(F.col("word")).isNotNull()
    form = F.when(base != F.col("word"), F.concat(base, F.when(irregular, F.lit(" 的过去式")).otherwise(F.lit(" 的复数"))))
    line = S.definition_line(F.col("g"), form, irregular, F.length("word") <= 3)
    more = F.array_join(F.transform("more", lambda g: F.concat(g["pos"], g["text"], F.lit("."))), " ")
    out = shown.join(rest, "word", "left")
    return out.select("word", line.alias("definition"), F.concat_ws(" ", line, more).alias("whole"))


def phrase_fallback(spark, sf_dir):
    """Words none of whose senses is shown: their commonest phrase stands for them."""
    counts = S.phrase_counts(_labelled(spark, sf_dir), T.phrase_key(F.col("phrase")))
    per = counts.select("phrase", "count", F.explode("words").alias("word"))
    best = per.groupBy("word").agg(F.max(F.struct("count", "phrase")).alias("b"))
    return best.join(shown_senses(spark, sf_dir).where("shown").select("word").distinct(), "word", "left_anti").select("word", "b.phrase", "b.count")


def phrases_seen(spark, sf_dir):
    """The forty phrases labelled most often under each word."""
    counts = _labels(spark, sf_dir).where(F.col("phrase").isNotNull()).groupBy("word", "phrase").agg(F.count(F.lit(1)).alias("n"))
    listed = counts.groupBy("word").agg(F.slice(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("o"), "phrase", "n"))), 1, 40).alias("l"))
    return listed.select("word", F.posexplode("l").alias("pos", "x")).select("word", "pos", "x.phrase", "x.n")


def full_assembly(spark, sf_dir):
    """Entries with root, core card, definition and example of their own word where there is one."""
    base = _entries(spark, sf_dir).where(F.col("word").isNotNull()).select("entry_id", "word", "def")
    roots = M.first_of(_numbered(spark, sf_dir, "root").where(F.col("root").isNotNull()).select("word", "edition_no", F.col("root.summary").alias("root")), ["word"], "edition_no", ["root"], latest=True)
    patch = full_definitions(spark, sf_dir).select("word", F.col("definition").alias("def"))
    out = M.override_present(base, patch, "word", {"def": "def0"})
    out = out.join(roots.select("word", "root"), "word", "left").join(core_cards(spark, sf_dir).select("word", F.col("image").alias("core")), "word", "left")
    return out.select("entry_id", "word", "def", "def0", "root", "core")


def task_checks(spark, sf_dir):
    """Faults of the labels as a task's output: (check, rows), every check listed."""
    labels, sents = _labels(spark, sf_dir), _sentences(spark, sf_dir).select("word", "sid")
    sizes = _senses(spark, sf_dir).groupBy("word").agg((F.max("idx") + 1).alias("size"))
    asked = labels.select("word").distinct()
    named = lambda d, name: d.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("check"), "rows")
    keys = ["word", "sid"]
    return (
        named(sents.join(asked, "word").join(labels.select(*keys).distinct(), keys, "left_anti"), "sentence without label")
        .unionByName(named(labels.join(sents, keys, "left_anti"), "label without sentence"))
        .unionByName(named(labels.where(F.col("kind") == "sense").join(sizes, "word", "left").where(~F.coalesce((F.col("sense") >= 0) & (F.col("sense") < F.col("size")), F.lit(False))), "sense out of range"))
        .unionByName(named(V.duplicate_keys(labels, [*keys, "ord"]), "label twice"))
        .unionByName(named(labels.where((F.col("kind") == "phrase") & (F.coalesce(F.trim("phrase"), F.lit("")) == "")), "phrase without text"))
        .unionByName(named(labels.where(F.col("kind") == "new"), "new sense"))
    )


def missing_groups(spark, sf_dir):
    """Words with senses but without an entry that has a root summary."""
    have = _entries(spark, sf_dir).where(F.col("root.summary").isNotNull()).select("word").distinct()
    return _senses(spark, sf_dir).select("word").distinct().join(have, "word", "left_anti")


def legacy_keys(spark, sf_dir):
    """Ranks of the first edition translated to words, and those words' ranks in the last."""
    rows = _numbered(spark, sf_dir, "rank")
    ends = rows.agg(F.min("edition_no").alias("a"), F.max("edition_no").alias("b"))
    near = rows.join(F.broadcast(ends)).where(F.col("edition_no").isin(F.col("a"), F.col("b")))
    old = near.where(F.col("edition_no") == F.col("a")).select(F.col("rank").alias("old_rank"), "word")
    new = near.where(F.col("edition_no") == F.col("b")).select(F.col("rank").alias("new_rank"), "word")
    return old.join(new, "word", "left").select("old_rank", "word", "new_rank")


def clip_filters(spark, sf_dir):
    """Examples above a size floor whose (language, fullness) is one of the wanted pairs, in base64."""
    rows = _examples(spark, sf_dir).where(F.octet_length("en") >= 60)
    pairs = F.struct(F.col("zh").isNull(), F.length("en") > 100)
    wanted = F.array(*[F.struct(F.lit(a), F.lit(b)) for a, b in ((False, True), (True, False))])
    return rows.where(F.array_contains(wanted, pairs)).select("example_id", F.regexp_replace(F.base64(F.encode("en", "UTF-8")), r"[\r\n]", "").alias("b64"))


def entry_slice(spark, sf_dir):
    """The second slice of fifty entries of each edition."""
    placed = global_rank(_entries(spark, sf_dir).select("edition", "rank", "word"), ["edition"], ["rank", "word"], "place")
    return placed.where(F.col("place").between(51, 100)).select("edition", "word", "place")


def numeric_keys(spark, sf_dir):
    """Keys stored as text in the order of their numbers: ranks of each section, as one list."""
    rows = _entries(spark, sf_dir).select("section", F.col("rank").cast("string").alias("key")).distinct()
    listed = rows.groupBy("section").agg(F.array_sort(F.collect_list(F.struct(F.col("key").try_cast("int").alias("n"), "key"))).alias("l"))
    return listed.select("section", F.array_join(F.transform("l", lambda x: x["key"]), ",").alias("keys"))


def store_file(spark, sf_dir):
    """Labels written as a store of JSON lines and read again."""
    path = f"{shared_folder(spark)}/millrace_{uuid.uuid4().hex}"
    rows = _labels(spark, sf_dir).distinct()
    sinks.write_store(rows, path, "word")
    return corpus.read_json_or_empty(spark, path, rows.schema, multi_line=False)


def parsed_labels(spark, sf_dir):
    """Labels written as a label file and read again."""
    rows = _labels(spark, sf_dir).where((F.col("kind") == "sense") & F.col("sense").isNotNull()).distinct()
    lines = rows.groupBy("word").agg(F.array_sort(F.collect_list(F.concat(F.conv(F.substring("sid", 1, 6), 16, 10), F.lit(" "), F.col("sense").cast("string")))).alias("l"))
    texts = lines.select(F.concat(F.lit("# "), "word", F.lit("\n"), F.array_join("l", "\n"), F.lit("\nnote: none\n")).alias("body"), F.col("word").alias("file"))
    return corpus.parse_labels(texts, ["file"], "body").select("file", "line_no", "word", "kind", "id", "label", "note")


def label_file_faults(spark, sf_dir):
    """Faults of label files written from the labels, against the sentences of their words."""
    number = F.conv(F.substring("sid", 1, 6), 16, 10)
    rows = _labels(spark, sf_dir).where((F.col("kind") == "sense") & F.col("sense").isNotNull()).distinct()
    lines = rows.groupBy("word").agg(F.array_sort(F.collect_list(F.concat(number, F.lit(" "), F.col("sense").cast("string")))).alias("l"))
    texts = lines.select(F.col("word").alias("task"), F.concat(F.lit("# "), "word", F.lit("\n"), F.array_join("l", "\n")).alias("body"))
    asked = _sentences(spark, sf_dir).join(rows.select("word").distinct(), "word", "left_semi")
    expected = asked.select(F.col("word").alias("task"), "word", number.cast("int").alias("id")).distinct()
    return corpus.label_faults(corpus.parse_labels(texts, ["task"], "body"), expected).select("word", "id", "fault")


def sense_pages(spark, sf_dir):
    """A Markdown page per word, read again as blocks."""
    rows = _senses(spark, sf_dir).where(F.trim("zh") != "")
    items = rows.groupBy("word").agg(F.array_sort(F.collect_list(F.struct("idx", F.concat(F.lit("* "), F.trim("zh")).alias("t")))).alias("l"))
    body = F.concat(F.lit("### "), "word", F.lit("\n\n"), F.array_join(F.transform("l", lambda x: x["t"]), "\n\n"))
    blocks = corpus.markdown_blocks(items.select("word", body.alias("body")), ["word"], "body")
    return blocks.select("word", F.col("block").cast("int").alias("block"), "kind", F.array_join("rows", "|").alias("rows"))


def parsed_entries(spark, sf_dir):
    """Entries written in their text form and read again."""
    text = F.concat(
        F.lit("—— Section "), F.col("section").cast("string"), F.lit(" ——\n["), F.col("rank").cast("string"), F.lit("] "), "word",
        F.lit("\n英["), F.coalesce("uk", F.lit("")), F.lit("] 美["), F.coalesce("us", F.lit("")), F.lit("]\n释义："), F.coalesce("def", F.lit("")), F.lit("\n"),
    )
    texts = _entries(spark, sf_dir).select("entry_id", text.alias("body"))
    return corpus.parse_entries(texts, ["entry_id"], "body").select("entry_id", "rank", "word", "section", "uk", "us", "def", "ex_label", "ex")


def dataset_counters(spark, sf_dir):
    rows = _entries(spark, sf_dir)
    return rows.groupBy("edition").agg(
        F.count(F.lit(1)).alias("entries"), F.count("root").alias("with_root"), F.count("core").alias("with_core"),
        F.count_if(F.size("phr") > 0).alias("with_phrases"), F.count_if(F.coalesce(F.col("def") != F.col("def0"), F.lit(True))).alias("changed"),
    )


def slim_entries(spark, sf_dir):
    return _entries(spark, sf_dir).select("rank", "word", "section", F.col("root.summary").alias("root"), F.col("core.image").alias("core"), F.size("phr").alias("phrases"))


def root_parts(spark, sf_dir):
    """Parts of root cards, without a single part that only repeats the word."""
    rows = _entries(spark, sf_dir).where(F.col("root").isNotNull()).select("entry_id", "word", F.col("root.parts").alias("parts"))
    plain = lambda c: F.lower(F.translate(c, "-·() ", ""))
    good = F.filter("parts", lambda p: p["type"].isin("prefix", "root", "suffix") & (F.trim(p["text"]) != ""))
    rows = rows.withColumn("parts", good).where((F.size("parts") > 0) & ~((F.size("parts") == 1) & (plain(F.col("parts")[0]["text"]) == plain(F.col("word")))))
    return rows.select("entry_id", F.posexplode("parts").alias("pos", "p")).select("entry_id", "pos", "p.type", "p.text")


def hash_diff_incremental(spark, sf_dir):
    """Entries of every edition whose example was not the same in the edition before, by content hash."""
    rows = _numbered(spark, sf_dir, "ex").select("word", "edition_no", T.content_hash(F.coalesce("ex", F.lit("")), 12).alias("sha"))
    before = rows.select("word", (F.col("edition_no") + 1).alias("edition_no"), "sha")
    return M.changed_rows(rows, before, ["word", "edition_no"])


def insert_only_defaults(spark, sf_dir):
    """Default labels frozen at their first edition."""
    rows = _numbered(spark, sf_dir, "def").where(F.col("def").isNotNull())
    return M.first_of(rows, ["word"], "edition_no", ["def"]).select("word", "def")


def patch_overlay(spark, sf_dir):
    """Sounds of each word's newest edition, with the American one taken away from words labelled unused."""
    base = M.first_of(_numbered(spark, sf_dir, "us", "uk"), ["word"], "edition_no", ["us", "uk"], latest=True).select("word", "us", "uk")
    unused = _labels(spark, sf_dir).where(F.col("kind") == "x").select("word").distinct()
    patch = unused.select("word", F.create_map(F.lit("us"), F.lit(None).cast("string")).alias("patch"))
    return M.patch_fields(base, patch, "word")


def store_fold(spark, sf_dir):
    """Labels folded by (word, sid): the last kind and the first sense in label order."""
    rows = _labels(spark, sf_dir).select("word", "sid", "ord", "kind", F.coalesce("sense", F.lit(-1)).alias("sense"))
    return M.fold_store(rows, ["word", "sid"], F.struct("ord", "kind", "sense"), last=["kind"], first=["sense"])


def appended_senses(spark, sf_dir):
    """The first two senses of a word as its store, all glosses as answers: new ones are appended."""
    s = _senses(spark, sf_dir)
    out = M.append_new(s.where(F.col("idx") <= 1), s, "word", ["pos", "zh"], "idx", "idx")
    return out.select("word", "idx", "pos", "zh")


def override_matches(spark, sf_dir):
    s = _senses(spark, sf_dir)
    names = s.select("word", F.concat(F.coalesce("pos", F.lit("")), F.coalesce("zh", F.lit(""))).alias("name")).distinct()
    return M.single_match(names, s)


def group_index(spark, sf_dir):
    """Words of a part of speech, in alphabetical order."""
    rows = _senses(spark, sf_dir).select(F.coalesce("pos", F.lit("")).alias("pos"), F.lower("word").alias("word")).distinct()
    return rows.groupBy("pos").agg(F.count(F.lit(1)).alias("n"), F.array_join(F.array_sort(F.collect_list("word")), " ").alias("words"))


def function_senses(spark, sf_dir):
    ranked = S.rank_senses(_weights(spark, sf_dir)).where(F.col("place") == 1)
    pos = _senses(spark, sf_dir).select("word", F.col("idx").alias("sense"), F.coalesce("pos", F.lit("")).alias("pos"))
    return ranked.join(pos, ["word", "sense"]).where(F.col("pos").isin(FUNCTION_WORDS)).select("word", "pos")


def prefix_offsets(spark, sf_dir):
    rows = _entries(spark, sf_dir).where(F.col("ex").isNotNull()).select("edition", "rank", "word", F.octet_length("ex").cast("bigint").alias("bytes"))
    return Q.prefix_offsets(rows, ["edition"], [F.col("rank"), F.col("word")], F.col("bytes"))


def section_changes(spark, sf_dir):
    """Entries that open a new section of their edition."""
    from pyspark.sql import Window as W

    w = W.partitionBy("edition").orderBy("rank", "word")
    rows = _entries(spark, sf_dir).withColumn("before", F.lag("section").over(w))
    return rows.where(F.col("before").isNull() | (F.col("before") != F.col("section"))).select("edition", "rank", "word", "section")


def chunk_fixed(spark, sf_dir):
    return C.chunk(_sentences(spark, sf_dir).select("word", "sid"), ["word"], ["sid"], 5)


def stripe(spark, sf_dir):
    words = _senses(spark, sf_dir).groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= 2)
    return C.stripe(words.select("word"), ["word"], 28)


def pack_next_fit(spark, sf_dir):
    rows = _sentences(spark, sf_dir).groupBy("src", "word").agg(F.count(F.lit(1)).alias("k"))
    return C.next_fit(rows, ["src"], "word", "k", 20)


def loud_gain(spark, sf_dir):
    """Gain to a target level that keeps a peak under a ceiling, over the sizes of suppliers' accounts."""
    s = read_table(spark, sf_dir, "supplier").select("s_suppkey", (F.col("s_acctbal") / -500.0).alias("i"), (F.col("s_acctbal") / -2000.0).alias("tp"))
    return s.select("s_suppkey", T.level_gain(F.col("i"), F.col("tp")).alias("gain"))


def inflected_forms(spark, sf_dir):
    words = _senses(spark, sf_dir).select(F.lower("word").alias("word")).distinct()
    return words.select("word", F.explode(T.inflections(F.col("word"))).alias("form"))


def html_inline(spark, sf_dir):
    rows = _examples(spark, sf_dir).select("example_id", F.concat(F.lit("**"), "word", F.lit("** & *"), F.coalesce("zh", F.lit("")), F.lit("* <i>")).alias("t"))
    return rows.select("example_id", T.markdown_inline(F.col("t")).alias("html"))


def context_table(spark, sf_dir):
    """Nested contexts back from their long form: per word the number, total and first sentences."""
    rows = _sentences(spark, sf_dir)
    return rows.groupBy("word").agg(F.count(F.lit(1)).alias("sentences"), F.sum("n").alias("total"), F.min(F.struct("sid", "n"))["sid"].alias("first_sid"))


def phrase_hits(spark, sf_dir):
    phrases = _labels(spark, sf_dir).where(F.col("phrase").isNotNull()).select("phrase")
    rows = _sentences(spark, sf_dir).select("sid", F.col("text").alias("sentence")).distinct()
    return C.phrase_hits(rows, phrases).select("phrase", "sid", "at", "upto").distinct()


def phrase_hints(spark, sf_dir):
    """Phrases that lie over the headword of a sentence, and whether the word may be part of a name."""
    phrases = _labels(spark, sf_dir).where(F.col("phrase").isNotNull()).select("phrase")
    rows = _sentences(spark, sf_dir).select("word", "sid", F.col("text").alias("sentence"))
    return C.over_headword(C.phrase_hits(rows, phrases), "word").select("word", "sid", "phrase").distinct()


def half_split(spark, sf_dir):
    """Sizes of the halves, words in both and words in none: the halves part the list."""
    words = _senses(spark, sf_dir).select("word").distinct()
    halves = C.half_split(words, "word").groupBy("word").agg(F.min("half").alias("half"), F.count(F.lit(1)).alias("times"))
    all_words = words.join(halves, "word", "left")
    return all_words.groupBy("half").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("times") > 1).alias("twice"))


def label_forms(spark, sf_dir):
    """Labels written as text and normalised again."""
    rows = _labels(spark, sf_dir).select(
        F.when(F.col("kind") == "x", "X").when(F.col("kind") == "phrase", F.concat(F.lit("P:"), "phrase"))
        .when(F.col("kind") == "new", F.concat(F.lit("N"), F.coalesce("sense", F.lit(0)))).otherwise(F.col("sense").cast("string")).alias("raw"), "kind",
    )
    out = rows.where(F.col("raw").isNotNull()).select("kind", F.explode(S.normalise_label(F.col("raw"))).alias("l"))
    return out.groupBy("kind", F.col("l.kind").alias("read")).agg(F.count(F.lit(1)).alias("n"))


def work_list(spark, sf_dir):
    rows = _sentences(spark, sf_dir).select("word", F.col("sid").alias("id"), F.col("text").alias("sentence"))
    return sinks.work_list(rows).select("word", "id", F.array_join("after", " ").alias("after"))


def review_blocks(spark, sf_dir):
    kept = _kept(spark, sf_dir).join(_weights(spark, sf_dir).select("word", "sense", "hits"), ["word", "sense"])
    named = kept.join(_senses(spark, sf_dir).select("word", F.col("idx").alias("sense"), "pos", "zh"), ["word", "sense"])
    return sinks.review_lines(named)


def vector_levels(spark, sf_dir):
    rows = read_table(spark, sf_dir, "embeddings")
    return rows.select("vec_id", F.round(rms(F.col("embedding")), 6).alias("level"))


_SENT = """WITH sent AS (
  SELECT word, substr(sha1(text), 1, 16) AS sid, min(text) AS text, CAST(sum(coalesce(n, 1)) AS BIGINT) AS n, min(coalesce(src, '')) AS src
  FROM contexts WHERE form = 'sentence' AND text IS NOT NULL GROUP BY 1, 2
), lab AS (SELECT DISTINCT * FROM labels_norm), labelled AS (SELECT * FROM lab JOIN sent USING (word, sid))"""
_STEM = f"""papers AS (SELECT doc_id, text FROM documents WHERE sub IN ('papers', 'listening')), {directions_cte('papers', 'doc_id')}, dlines AS (
  SELECT doc_id, pos AS p, line FROM blocks), {sentences_cte('dlines', 'doc_id, p', text='line', name='dsent')}, stems AS (
  SELECT text AS t FROM contexts WHERE form = 'sentence' AND text IS NOT NULL AND src IS NOT NULL GROUP BY text HAVING count(DISTINCT substr(src, 1, 12)) >= 3
  UNION SELECT text FROM contexts WHERE form = 'sentence' AND src IS NOT NULL AND regexp_matches(text, {quoted(C.STEM)})
  UNION SELECT sentence FROM dsent)"""
_WEIGHT = _SENT + ", " + _STEM + """, once AS (
  SELECT DISTINCT word, sense, sid, n, sid IN (SELECT substr(sha1(t), 1, 16) FROM stems) AS stem, string_split(src, '·')[1] AS paper
  FROM labelled WHERE kind = 'sense' AND (WINDOWED)
), per_paper AS (
  SELECT word, sense, paper, count(*) AS hits, coalesce(sum(n) FILTER (NOT stem), 0) AS material, coalesce(sum(n) FILTER (stem), 0) AS instruction
  FROM once GROUP BY ALL
), weights AS (
  SELECT word, sense, CAST(sum(hits) AS BIGINT) AS hits, CAST(sum(material) AS BIGINT) AS material, CAST(sum(instruction) AS BIGINT) AS instruction,
    CAST(sum(least(material, 3)) AS BIGINT) AS capped FROM per_paper GROUP BY word, sense
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY word ORDER BY capped DESC, material DESC, instruction DESC, sense) AS INTEGER) AS place FROM weights
), counts AS (SELECT word, count(*) AS sentences FROM sent GROUP BY word
), enough AS (
  SELECT word, sense, place, row_number() OVER (PARTITION BY word ORDER BY place) AS shown FROM ranked JOIN counts USING (word)
  WHERE hits >= 2 OR (hits >= 1 AND sentences <= 10)
), kept AS (SELECT word, sense, place FROM enough WHERE shown <= 6), glossed AS (
  SELECT k.word, coalesce(s.pos, '') AS pos, s.zh, k.place FROM kept k JOIN senses s ON k.word = s.word AND k.sense = s.idx WHERE s.zh IS NOT NULL
), groups AS (
  SELECT word, pos, min(place) AS first, pos || string_agg(zh, '; ' ORDER BY place) || '.' AS t FROM glossed GROUP BY word, pos
), defs AS (SELECT word, string_agg(t, ' ' ORDER BY first) AS definition FROM groups GROUP BY word)"""
_PKEY = r"""regexp_replace(regexp_replace(lower(trim(phrase)), '^[.,;:!?"''“”‘’]+|[.,;:!?"''“”‘’]+$', '', 'g'), '\s+', ' ', 'g')"""
_FULL = "coalesce(pos, '') || coalesce(zh, '')"
_POSRX = r"^(?:modal v\.|aux\.|prep\.|conj\.|pron\.|det\.|art\.|adj\.|adv\.|num\.|int\.|n\.|v\.)"
_TERMS = rf"""string_split_regex(regexp_replace(regexp_replace({_FULL}, '{_POSRX}', ''), '（[^）]*）|\([^)]*\)', '', 'g'), '[，；、,;]')"""
_EDS = "WITH eds AS (SELECT CAST(dense_rank() OVER (ORDER BY edition) - 1 AS INTEGER) AS p, * FROM entries_full)"
_WINDOWED = _WEIGHT.replace("(WINDOWED)", "regexp_matches(src, '_20(?:19|20|21)_')")
_WEIGHT = _WEIGHT.replace("(WINDOWED)", "TRUE")
_SHOWN = _WEIGHT + """, manual AS (
  SELECT word, sense, place FROM ranked WHERE (word, sense) IN (SELECT word, sense FROM labels_norm WHERE ord = 1 AND kind = 'sense')
), fw AS (
  SELECT r.word FROM ranked r JOIN senses s ON r.word = s.word AND r.sense = s.idx
  WHERE place = 1 AND coalesce(s.pos, '') IN ('', 'prep.', 'conj.', 'pron.', 'det.', 'art.', 'aux.', 'modal v.')
), cutf AS (SELECT word, sense, place FROM enough WHERE word NOT IN (SELECT word FROM fw) OR shown <= 3
), both_ AS (SELECT * FROM cutf UNION SELECT * FROM manual
), listed AS (SELECT word, sense, place, CAST(row_number() OVER (PARTITION BY word ORDER BY place) AS INTEGER) AS listed FROM both_
), shown_ AS (
  SELECT *, NOT (word IN (SELECT word FROM entries_full WHERE core IS NOT NULL) AND word NOT IN (SELECT word FROM fw) AND listed > 2) AS shown FROM listed
)"""
_LEMMA = lemma_sql()
_FULLDEF = _SHOWN + f""", gl AS (SELECT k.word, coalesce(s.pos, '') AS pos, s.zh, k.place, k.shown FROM shown_ k JOIN senses s ON k.word = s.word AND k.sense = s.idx WHERE s.zh IS NOT NULL),
gg AS (SELECT word, shown, pos, min(place) AS first, string_agg(zh, '; ' ORDER BY place) AS t FROM gl GROUP BY word, shown, pos),
fm AS (SELECT DISTINCT word, {_LEMMA} AS base, {_LEMMA} <> word AND CASE word {" ".join(f"WHEN {quoted(f)} THEN true" for fs in T.IRREGULAR.values() for f in fs.split())} ELSE false END AS irr FROM gl),
ff AS (SELECT word, irr, CASE WHEN base <> word THEN base || CASE WHEN irr THEN ' 的过去式' ELSE ' 的复数' END END AS form FROM fm),
fit AS (SELECT g.*, f.form, f.irr, CASE WHEN f.form LIKE '%复数%' THEN pos = 'n.' WHEN f.form LIKE '%过去式%' THEN pos = 'v.' ELSE false END AS fits FROM gg g JOIN ff f USING (word) WHERE shown),
tgt AS (SELECT word, coalesce(max(first) FILTER (fits), max(first)) AS last, bool_or(contains(t, form)) AS told FROM fit GROUP BY word),
plain AS (SELECT f.word, any_value(form) AS form, any_value(irr) AS irr, any_value(told) AS told, string_agg(pos || t || '.', ' ' ORDER BY first) AS p,
  string_agg(pos || t || CASE WHEN first = last THEN '(' || form || ')' ELSE '' END || '.', ' ' ORDER BY first) AS m FROM fit f JOIN tgt USING (word) GROUP BY f.word),
fd AS (SELECT word, CASE WHEN form IS NOT NULL AND irr AND length(word) <= 3 THEN p WHEN form IS NOT NULL AND irr THEN form || '. ' || p WHEN form IS NOT NULL AND NOT told THEN m ELSE p END AS definition FROM plain),
rest AS (SELECT word, string_agg(pos || t || '.', ' ' ORDER BY first) AS more FROM gg WHERE NOT shown GROUP BY word)"""
_PHRASES = rf"""ph AS (SELECT DISTINCT phrase FROM labels_norm WHERE phrase IS NOT NULL), tk AS (
  SELECT phrase, unnest(range(len(ts))) AS i, unnest(ts) AS t FROM (SELECT phrase, list_filter(list_transform(string_split_regex(
    regexp_replace(lower(phrase), '\.{{2,}}|…', ' ... ', 'g'), '{WS}+'), lambda x: regexp_replace(x, '^[,;]+|[,;]+$', '', 'g')), lambda x: x <> '') AS ts FROM ph)
), kinds AS (
  SELECT *, CASE t WHEN '...' THEN 4 WHEN 'sb' THEN 3 WHEN 'sth' THEN 3 END AS width, t IN ('one''s', 'sb''s') AS owner FROM tk
), runs AS (
  SELECT *, count(*) FILTER (width IS NULL) OVER (PARTITION BY phrase ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS k FROM kinds
), gaps AS (SELECT phrase, k, max(width) AS gap FROM runs WHERE width IS NOT NULL GROUP BY phrase, k
), forms AS (SELECT phrase, k, string_agg('\Q' || f || '\E', '|' ORDER BY length(f) DESC, f) AS fs
  FROM (SELECT phrase, k, unnest({inflections_sql('t')}) AS f FROM runs WHERE width IS NULL AND NOT owner) GROUP BY phrase, k
), pieces AS (
  SELECT r.phrase, r.k, r.owner, CASE WHEN r.k > 0 THEN '\s+' || coalesce('(?:\S+\s+){{0,' || g.gap || '}}?', '') ELSE '' END
    || CASE WHEN r.owner THEN {quoted(T.POSSESSIVE)} ELSE '(?:' || fs || ')' END AS rx
  FROM runs r LEFT JOIN gaps g USING (phrase, k) LEFT JOIN forms f USING (phrase, k) WHERE r.width IS NULL
), patterns AS (
  SELECT phrase, '(?i)(?:^|[^A-Za-z''’-])(' || string_agg(rx, '' ORDER BY k) || ')(?:[^A-Za-z-]|$)' AS rx FROM pieces GROUP BY phrase HAVING count(*) FILTER (NOT owner) >= 2
), hit AS (
  SELECT word, sid, text, phrase, regexp_extract(text, rx, 1) AS h FROM sent, patterns WHERE regexp_matches(text, rx)
), hits AS (SELECT *, instr(text, h) - 1 AS "at", instr(text, h) - 1 + length(h) AS upto FROM hit)"""
_CORE = """cc AS (SELECT word, p, nullif(trim(core.image), '') AS image, nullif(trim(core.derive), '') AS derive FROM eds),
cards AS (SELECT word, arg_max(image, p) AS image, arg_max(derive, p) AS derive FROM cc WHERE image IS NOT NULL AND derive IS NOT NULL AND word NOT IN (SELECT word FROM entries_full WHERE root IS NOT NULL) GROUP BY word)"""

ORACLE = {
    "label_modes": """WITH lab AS (SELECT DISTINCT * FROM labels_norm), per AS (
  SELECT word, sid, count(*) AS k, max(sense) FILTER (kind = 'sense') AS sense FROM lab GROUP BY word, sid
), single AS (SELECT word, CASE WHEN k = 1 THEN sense END AS sense FROM per), c AS (SELECT word, sense, count(*) AS c FROM single GROUP BY ALL),
b AS (SELECT word, CAST(sum(c) AS BIGINT) AS labels, max({'c': c, 's': -sense}) FILTER (sense IS NOT NULL) AS b FROM c GROUP BY word)
SELECT word, labels, -b.s AS top, coalesce(b.c, 0) AS top_count, coalesce(b.c, 0) >= 0.9 * labels AS dominant FROM b""",
    "label_samples": _SENT + " SELECT word, sense, count(*) AS count, arg_min(text, {'l': length(text), 's': sid}) AS sample FROM labelled WHERE kind = 'sense' GROUP BY word, sense",
    "sense_weights": _WEIGHT + " SELECT * FROM weights",
    "sense_rank_capped": _WEIGHT + " SELECT word, sense, place, capped FROM ranked",
    "primary_sense": _WEIGHT + " SELECT word, sense FROM ranked WHERE place = 1",
    "sense_keep_topk": _WEIGHT + " SELECT * FROM kept",
    "shown_with_manual": _WEIGHT + """ SELECT word, sense, place FROM enough WHERE shown <= 2
UNION SELECT word, sense, place FROM ranked WHERE (word, sense) IN (SELECT word, sense FROM labels_norm WHERE ord = 1 AND kind = 'sense')""",
    "definitions": _WEIGHT + " SELECT * FROM defs",
    "phrase_counts": _SENT + f""", rows_ AS (SELECT {_PKEY} AS phrase, sid, n, word FROM labelled WHERE kind = 'phrase' AND phrase IS NOT NULL),
once AS (SELECT phrase, sid, max(n) AS n FROM rows_ GROUP BY phrase, sid), c AS (SELECT phrase, CAST(sum(n) AS BIGINT) AS count FROM once GROUP BY phrase)
SELECT c.phrase, count, (SELECT string_agg(DISTINCT word, ',' ORDER BY word) FROM rows_ r WHERE r.phrase = c.phrase) AS words FROM c""",
    "phrase_usage": f"SELECT {_PKEY} AS phrase, count(*) AS uses, count(DISTINCT word) AS words FROM labels_norm WHERE phrase IS NOT NULL GROUP BY 1",
    "unlabelled_anti": _SENT + " SELECT word, count(*) AS missing FROM sent WHERE (word, sid) NOT IN (SELECT word, sid FROM labels_norm) GROUP BY word",
    "ref_violations": "SELECT DISTINCT l.word, l.sense AS idx, l.sid FROM labels_norm l LEFT JOIN senses s ON l.word = s.word AND l.sense = s.idx AND s.zh IS NOT NULL WHERE l.kind = 'sense' AND l.sense IS NOT NULL AND s.word IS NULL",
    "label_rules": """SELECT rule, count(*) AS rows FROM (
  SELECT 'kind' AS rule FROM labels_norm WHERE NOT coalesce(kind IN ('sense', 'phrase', 'x', 'new'), false)
  UNION ALL SELECT 'sense number' FROM labels_norm WHERE NOT coalesce(kind <> 'sense' OR sense >= 0, false)
  UNION ALL SELECT 'phrase text' FROM labels_norm WHERE NOT coalesce(kind <> 'phrase' OR trim(phrase) <> '', false)
  UNION ALL SELECT 'first of its sentence' FROM labels_norm WHERE NOT coalesce(ord = 0, false)
  UNION ALL SELECT 'sid form' FROM labels_norm WHERE NOT coalesce(regexp_matches(sid, '^[0-9a-f]{16}$'), false)) GROUP BY rule""",
    "duplicate_labels": "SELECT word, sid, ord, count(*) AS copies FROM labels_norm GROUP BY ALL HAVING count(*) > 1",
    "task_key_difference": _SENT + """ SELECT word, 'left' AS only FROM (SELECT DISTINCT word FROM sent) WHERE word NOT IN (SELECT word FROM labels_norm)
UNION ALL SELECT word, 'right' FROM (SELECT DISTINCT word FROM labels_norm) WHERE word NOT IN (SELECT word FROM sent)""",
    "admissible_examples": "SELECT example_id, trim(en) AS en, trim(zh) AS zh FROM sense_examples WHERE trim(en) <> '' AND trim(zh) <> '' AND NOT regexp_matches(en, '[(（]')",
    "english_parts": r"SELECT entry_id, md5(trim(regexp_replace(string_split(replace(ex, '（', '('), '(')[1], '^[A-Z]:\s*', ''))) AS h FROM entries_full WHERE ex IS NOT NULL",
    "sense_terms": f"SELECT word, idx, term FROM (SELECT word, idx, regexp_replace(unnest({_TERMS}), '^[… .]+|[… .]+$', '', 'g') AS term FROM senses WHERE zh IS NOT NULL) WHERE term <> ''",
    "core_mentions": f"""WITH t AS (SELECT word, idx, regexp_replace(unnest({_TERMS}), '^[… .]+|[… .]+$', '', 'g') AS term FROM senses),
p AS (SELECT word, idx, term, unnest(string_split_regex(term, '…+')) AS piece FROM t WHERE term <> ''),
l AS (SELECT word, idx, term, arg_max(piece, length(piece)) AS piece FROM p GROUP BY ALL),
cards AS (SELECT entry_id, word, core.derive AS derive FROM entries_full WHERE core IS NOT NULL)
SELECT c.entry_id, s.idx FROM cards c JOIN senses s USING (word)
WHERE NOT EXISTS (SELECT 1 FROM l WHERE l.word = s.word AND l.idx = s.idx AND contains(c.derive, l.piece))""",
    "priority_merge": _EDS + " SELECT word, arg_max(us, p) AS us, max(p) AS edition_no FROM eds WHERE trim(us) <> '' GROUP BY word",
    "last_wins": _EDS + " SELECT word, arg_max(us, p) AS us, max(p) AS edition_no FROM eds WHERE us IS NOT NULL GROUP BY word",
    "alias_merge": _EDS + f""", cards AS (SELECT word, arg_max(uk, p) AS uk FROM eds WHERE uk IS NOT NULL GROUP BY word),
al AS (SELECT DISTINCT word, {lemma_sql()} AS same_as FROM senses)
SELECT word, uk FROM cards UNION ALL SELECT al.word, c.uk FROM al JOIN cards c ON c.word = al.same_as WHERE al.word <> al.same_as AND al.word NOT IN (SELECT word FROM cards)""",
    "veto_anti": "SELECT DISTINCT word FROM entries_full WHERE core IS NOT NULL AND word NOT IN (SELECT word FROM entries_full WHERE root IS NOT NULL) AND word NOT IN (SELECT word FROM labels_norm WHERE kind = 'x')",
    "entry_assembly": _WEIGHT + """, ex AS (SELECT word, arg_min(en || '（' || zh || '）', example_id) AS ex FROM sense_examples WHERE zh IS NOT NULL GROUP BY word)
SELECT e.entry_id, e.word, coalesce(nullif(d.definition, ''), e.def) AS def, md5(coalesce(nullif(x.ex, ''), e.ex)) AS ex_h, e.def AS def0
FROM entries_full e LEFT JOIN defs d USING (word) LEFT JOIN ex x USING (word) WHERE e.word IS NOT NULL""",
    "dataset_counters": "SELECT edition, count(*) AS entries, count(root) AS with_root, count(core) AS with_core, count(*) FILTER (len(phr) > 0) AS with_phrases, count(*) FILTER (coalesce(def <> def0, true)) AS changed FROM entries_full GROUP BY edition",
    "slim_entries": "SELECT rank, word, section, root.summary AS root, core.image AS core, CAST(len(phr) AS INTEGER) AS phrases FROM entries_full",
    "root_parts": """WITH p AS (SELECT entry_id, word, unnest(range(len(root.parts))) AS i, unnest(root.parts) AS x FROM entries_full WHERE root IS NOT NULL),
g AS (SELECT entry_id, word, i, x.type AS type, x.text AS text, count(*) OVER (PARTITION BY entry_id) AS k FROM p WHERE x.type IN ('prefix', 'root', 'suffix') AND trim(x.text) <> '')
SELECT entry_id, CAST(row_number() OVER (PARTITION BY entry_id ORDER BY i) - 1 AS INTEGER) AS pos, type, text FROM g
WHERE NOT (k = 1 AND lower(translate(text, '-·() ', '')) = lower(translate(word, '-·() ', '')))""",
    "hash_diff_incremental": _EDS + """, h AS (SELECT p, word, substr(sha256(coalesce(ex, '')), 1, 12) AS sha FROM eds)
SELECT word, p AS edition_no, sha FROM h WHERE NOT EXISTS (SELECT 1 FROM h b WHERE b.word = h.word AND b.sha = h.sha AND b.p = h.p - 1)""",
    "insert_only_defaults": _EDS + " SELECT word, arg_min(def, p) AS def FROM eds WHERE def IS NOT NULL GROUP BY word",
    "patch_overlay": _EDS + """, n AS (SELECT word, us, uk FROM eds QUALIFY row_number() OVER (PARTITION BY word ORDER BY p DESC) = 1)
SELECT word, CASE WHEN word IN (SELECT word FROM labels_norm WHERE kind = 'x') THEN NULL ELSE us END AS us, uk FROM n""",
    "store_fold": "SELECT word, sid, arg_max(kind, {'o': ord, 'k': kind, 's': coalesce(sense, -1)}) AS kind, arg_min(coalesce(sense, -1), {'o': ord, 'k': kind, 's': coalesce(sense, -1)}) AS sense FROM labels_norm GROUP BY word, sid",
    "appended_senses": """WITH st AS (SELECT * FROM senses WHERE idx <= 1), nw AS (SELECT word, pos, zh, min(idx) AS o FROM senses GROUP BY ALL),
fr AS (SELECT * FROM nw WHERE NOT EXISTS (SELECT 1 FROM st WHERE st.word = nw.word AND st.pos IS NOT DISTINCT FROM nw.pos AND st.zh IS NOT DISTINCT FROM nw.zh)),
la AS (SELECT word, max(idx) AS last FROM st GROUP BY word)
SELECT word, idx, pos, zh FROM st UNION ALL
SELECT word, CAST(coalesce(last, -1) + row_number() OVER (PARTITION BY word ORDER BY o) AS INTEGER), pos, zh FROM fr LEFT JOIN la USING (word)""",
    "override_matches": f"SELECT word, {_FULL} AS name, min(idx) AS idx, count(*) AS matches FROM senses GROUP BY 1, 2",
    "group_index": "SELECT pos, count(*) AS n, string_agg(word, ' ' ORDER BY word) AS words FROM (SELECT DISTINCT coalesce(pos, '') AS pos, lower(word) AS word FROM senses) GROUP BY pos",
    "function_senses": _WEIGHT + """ SELECT r.word, coalesce(s.pos, '') AS pos FROM ranked r JOIN senses s ON r.word = s.word AND r.sense = s.idx
WHERE place = 1 AND coalesce(s.pos, '') IN ('', 'prep.', 'conj.', 'pron.', 'det.', 'art.', 'aux.', 'modal v.')""",
    "prefix_offsets": "SELECT edition, rank, word, strlen(ex) AS bytes, CAST(sum(strlen(ex)) OVER (PARTITION BY edition ORDER BY rank, word ROWS UNBOUNDED PRECEDING) - strlen(ex) AS BIGINT) AS \"offset\" FROM entries_full WHERE ex IS NOT NULL",
    "section_changes": """SELECT edition, rank, word, section FROM (SELECT *, lag(section) OVER (PARTITION BY edition ORDER BY rank, word) AS b FROM entries_full) WHERE b IS NULL OR b <> section""",
    "chunk_fixed": _SENT + " SELECT word, sid, CAST((row_number() OVER (PARTITION BY word ORDER BY sid) - 1) // 5 AS INTEGER) AS chunk FROM sent",
    "stripe": """WITH w AS (SELECT word FROM senses GROUP BY word HAVING count(*) >= 2)
SELECT word, CAST((row_number() OVER (ORDER BY word) - 1) % (SELECT CAST(ceil(count(*) / 28.0) AS INTEGER) FROM w) AS INTEGER) AS task FROM w""",
    "pack_next_fit": "WITH RECURSIVE" + _SENT[4:] + """, k AS (SELECT src, word, count(*) AS k, row_number() OVER (PARTITION BY src ORDER BY word) AS i FROM sent GROUP BY src, word),
r AS (SELECT src, word, k, i, 0 AS b, k AS used FROM k WHERE i = 1 UNION ALL
  SELECT k.src, k.word, k.k, k.i, r.b + CASE WHEN r.used + k.k > 20 THEN 1 ELSE 0 END, CASE WHEN r.used + k.k > 20 THEN k.k ELSE r.used + k.k END
  FROM r JOIN k ON k.src = r.src AND k.i = r.i + 1)
SELECT src, word, k, CAST(b AS INTEGER) AS bin FROM r""",
    "half_split": "SELECT CAST(h AS INTEGER) AS half, CASE h WHEN 1 THEN (n + 1) // 2 ELSE n // 2 END AS n, 0::BIGINT AS twice FROM (SELECT count(DISTINCT word) AS n FROM senses), (VALUES (0), (1)) t(h)",
    "label_forms": "SELECT kind, kind AS read, count(*) AS n FROM labels_norm WHERE kind IN ('x', 'new') OR (kind = 'phrase' AND phrase IS NOT NULL) OR (kind = 'sense' AND sense IS NOT NULL) GROUP BY kind",
    "work_list": _SENT + """, r AS (SELECT word, sid AS id, string_split_regex(CASE WHEN text IS NULL THEN '' ELSE substr(lower(text), hit + length(word)) END, '[^a-z]+') AS ts FROM (
  SELECT *, CASE WHEN regexp_matches(lower(text), '^' || lower(word) || '([^a-z-]|$)') THEN 1 WHEN NOT regexp_matches(lower(text), '[^a-z''’-]' || lower(word) || '([^a-z-]|$)') THEN length(text) + 1
    ELSE length(regexp_extract(lower(text), '(?s)^(.*?[^a-z''’-])' || lower(word) || '(?:[^a-z-]|$)', 1)) + 1 END AS hit FROM sent))
SELECT word, id, array_to_string(list_slice(list_filter(ts, lambda t: t <> ''), 1, 4), ' ') AS after FROM r""",
    "review_blocks": _WEIGHT + """, named AS (SELECT k.word, k.place, w.hits, coalesce(s.pos, '') AS pos, coalesce(s.zh, '') AS zh FROM kept k JOIN weights w USING (word, sense) JOIN senses s ON s.word = k.word AND s.idx = k.sense)
SELECT word, '## ' || word || chr(10) || string_agg('- ' || place || '. ' || pos || zh || ' (' || hits || ')', chr(10) ORDER BY place) AS block FROM named GROUP BY word""",
    "vector_levels": "SELECT vec_id, round(sqrt(list_sum(list_transform(embedding, lambda x: x::DOUBLE * x::DOUBLE)) / len(embedding)), 6) AS level FROM embeddings",
    "loud_gain": "SELECT s_suppkey, round(least(-18.0 - s_acctbal / -500.0, -1.0 - s_acctbal / -2000.0), 1) AS gain FROM supplier",
    "html_inline": r"""SELECT example_id, regexp_replace(regexp_replace(replace(replace(replace('**' || word || '** & *' || coalesce(zh, '') || '* <i>', '&', '&amp;'), '<', '&lt;'), '>', '&gt;'),
'\*\*(.+?)\*\*', '<b>\1</b>', 'g'), '\*(.+?)\*', '<i>\1</i>', 'g') AS html FROM sense_examples""",
    "instruction_sentences": "WITH " + _STEM + " SELECT DISTINCT substr(sha1(t), 1, 16) AS sid FROM stems",
    "windowed_weights": _WINDOWED + " SELECT * FROM weights",
    "promoted_senses": _WEIGHT + " SELECT word, sense, CAST(row_number() OVER (PARTITION BY word ORDER BY sense = 2 DESC, hits = 1, capped DESC, material DESC, instruction DESC, sense) AS INTEGER) AS place FROM weights",
    "core_cards": _EDS + ", " + _CORE + " SELECT * FROM cards",
    "whole_source": _EDS + """, l AS (SELECT max(p) AS last FROM eds), near AS (SELECT word, uk, p, p = last AS new FROM eds, l WHERE p >= last - 1),
m AS (SELECT count(*) FILTER (NOT has) AS missing FROM (SELECT word, bool_or(new) AS has FROM near GROUP BY word))
SELECT word, uk, p AS edition_no FROM near, m WHERE new = (missing = 0)""",
    "shown_senses": _SHOWN + " SELECT * FROM shown_",
    "full_definitions": _FULLDEF + " SELECT word, definition, concat_ws(' ', definition, more) AS whole FROM fd LEFT JOIN rest USING (word)",
    "phrase_fallback": _SHOWN + f""", pr AS (SELECT {_PKEY} AS phrase, sid, n, word FROM labelled WHERE kind = 'phrase' AND phrase IS NOT NULL),
po AS (SELECT phrase, sid, max(n) AS n FROM pr GROUP BY phrase, sid), pc AS (SELECT phrase, CAST(sum(n) AS BIGINT) AS count FROM po GROUP BY phrase),
pw AS (SELECT DISTINCT word, phrase FROM pr), pb AS (SELECT word, max({{'c': count, 'p': phrase}}) AS b FROM pw JOIN pc USING (phrase) GROUP BY word)
SELECT word, b.p AS phrase, b.c AS count FROM pb WHERE word NOT IN (SELECT word FROM shown_ WHERE shown)""",
    "phrases_seen": """SELECT word, CAST(row_number() OVER (PARTITION BY word ORDER BY n DESC, phrase) - 1 AS INTEGER) AS pos, phrase, n
FROM (SELECT word, phrase, count(*) AS n FROM labels_norm WHERE phrase IS NOT NULL GROUP BY ALL) QUALIFY pos < 40""",
    "full_assembly": _FULLDEF + ", " + _EDS[5:] + ", " + _CORE + """, rs AS (SELECT word, arg_max({'s': root.summary}, p).s AS root FROM eds WHERE root IS NOT NULL GROUP BY word)
SELECT e.entry_id, e.word, coalesce(nullif(d.definition, ''), e.def) AS def, e.def AS def0, rs.root, c.image AS core
FROM entries_full e LEFT JOIN fd d USING (word) LEFT JOIN rs USING (word) LEFT JOIN cards c USING (word) WHERE e.word IS NOT NULL""",
    "task_checks": _SENT + """, z AS (SELECT word, max(idx) + 1 AS size FROM senses GROUP BY word)
SELECT 'sentence without label' AS check, count(*) AS rows FROM sent WHERE word IN (SELECT word FROM labels_norm) AND (word, sid) NOT IN (SELECT word, sid FROM labels_norm)
UNION ALL SELECT 'label without sentence', count(*) FROM labels_norm WHERE (word, sid) NOT IN (SELECT word, sid FROM sent)
UNION ALL SELECT 'sense out of range', count(*) FROM labels_norm l LEFT JOIN z USING (word) WHERE kind = 'sense' AND NOT coalesce(sense >= 0 AND sense < size, false)
UNION ALL SELECT 'label twice', count(*) FROM (SELECT 1 FROM labels_norm GROUP BY word, sid, ord HAVING count(*) > 1)
UNION ALL SELECT 'phrase without text', count(*) FROM labels_norm WHERE kind = 'phrase' AND coalesce(trim(phrase), '') = ''
UNION ALL SELECT 'new sense', count(*) FROM labels_norm WHERE kind = 'new'""",
    "missing_groups": "SELECT DISTINCT word FROM senses WHERE word NOT IN (SELECT word FROM entries_full WHERE root.summary IS NOT NULL)",
    "legacy_keys": _EDS + " SELECT o.rank AS old_rank, o.word, n.rank AS new_rank FROM eds o LEFT JOIN (SELECT word, rank FROM eds WHERE p = (SELECT max(p) FROM eds)) n USING (word) WHERE o.p = 0",
    "clip_filters": "SELECT example_id, base64(encode(en)) AS b64 FROM sense_examples WHERE strlen(en) >= 60 AND ((zh IS NOT NULL AND length(en) > 100) OR (zh IS NULL AND length(en) <= 100))",
    "entry_slice": "SELECT edition, word, CAST(row_number() OVER (PARTITION BY edition ORDER BY rank, word) AS INTEGER) AS place FROM entries_full QUALIFY place BETWEEN 51 AND 100",
    "numeric_keys": "SELECT section, string_agg(CAST(rank AS VARCHAR), ',' ORDER BY rank) AS keys FROM (SELECT DISTINCT section, rank FROM entries_full) GROUP BY section",
    "store_file": "SELECT DISTINCT * FROM labels_norm",
    "parsed_labels": """WITH l AS (SELECT DISTINCT * FROM labels_norm WHERE kind = 'sense' AND sense IS NOT NULL),
w AS (SELECT word, CAST(('0x' || substr(sid, 1, 6)) AS BIGINT) AS id, sense FROM l), r AS (SELECT *, row_number() OVER (PARTITION BY word ORDER BY id || ' ' || sense) + 1 AS line_no FROM w)
SELECT word AS file, CAST(line_no AS INTEGER) AS line_no, word, 'label' AS kind, CAST(id AS INTEGER) AS id, CAST(sense AS VARCHAR) AS label, NULL AS note FROM r
UNION ALL SELECT word, CAST(count(*) + 2 AS INTEGER), word, 'note', NULL, NULL, 'none' FROM w GROUP BY word""",
    "label_file_faults": _SENT + """, l AS (SELECT DISTINCT * FROM labels_norm WHERE kind = 'sense' AND sense IS NOT NULL),
t AS (SELECT word, CAST(('0x' || substr(sid, 1, 6)) AS INTEGER) AS id FROM l),
e AS (SELECT DISTINCT word, CAST(('0x' || substr(sid, 1, 6)) AS INTEGER) AS id FROM sent WHERE word IN (SELECT word FROM l))
SELECT word, id, 'unknown id' AS fault FROM t WHERE word IN (SELECT word FROM e) AND (word, id) NOT IN (SELECT word, id FROM e)
UNION ALL SELECT word, id, 'id twice' FROM t GROUP BY word, id HAVING count(*) > 1
UNION ALL SELECT word, id, 'missing id' FROM e WHERE (word, id) NOT IN (SELECT word, id FROM t)
UNION ALL (SELECT DISTINCT word, CAST(NULL AS INTEGER), 'unknown section' FROM t WHERE word NOT IN (SELECT word FROM e))""",
    "sense_pages": """WITH s AS (SELECT word, string_agg(trim(zh), '|' ORDER BY idx) AS r FROM senses WHERE trim(zh) <> '' GROUP BY word)
SELECT word, 1 AS block, 'heading' AS kind, word AS rows FROM s UNION ALL SELECT word, 2, 'bullets', r FROM s""",
    "parsed_entries": "SELECT entry_id, rank, word, section, coalesce(uk, '') AS uk, coalesce(us, '') AS us, coalesce(trim(def), '') AS def, '例句' AS ex_label, '' AS ex FROM entries_full",
    "phrase_hits": _SENT + ", " + _PHRASES + " SELECT DISTINCT phrase, sid, CAST(\"at\" AS INTEGER) AS \"at\", CAST(upto AS INTEGER) AS upto FROM hits",
    "phrase_hints": _SENT + ", " + _PHRASES + r""", w AS (
  SELECT *, regexp_extract(lower(text), '(?:^|[^a-z''’-])(' || lower(word) || ')(?:[^a-z-]|$)', 1) AS q,
    length(regexp_extract(lower(text), '^(?s)(.*?)(?:^|[^a-z''’-])' || lower(word) || '(?:[^a-z-]|$)', 1)) AS b FROM hits
), p AS (SELECT *, CASE WHEN starts_with(lower(text), lower(word)) AND b = 0 AND regexp_matches(lower(text), '^' || lower(word) || '([^a-z-]|$)') THEN 0 ELSE b + 1 END AS place FROM w WHERE q <> '')
SELECT DISTINCT word, sid, phrase FROM p WHERE "at" < place + length(word) AND place < upto""",
    "inflected_forms": f"SELECT word, unnest({inflections_sql()}) AS form FROM (SELECT DISTINCT lower(word) AS word FROM senses)",
    "context_table": _SENT + " SELECT word, count(*) AS sentences, CAST(sum(n) AS BIGINT) AS total, min(sid) AS first_sid FROM sent GROUP BY word",
}

QUERIES = {
    f.__name__: f
    for f in (
        label_modes, label_samples, sense_weights, sense_rank_capped, primary_sense, sense_keep_topk, shown_with_manual,
        definitions, phrase_counts, phrase_usage, unlabelled_anti, ref_violations, label_rules, duplicate_labels,
        task_key_difference, admissible_examples, english_parts, sense_terms, core_mentions, priority_merge, last_wins,
        alias_merge, veto_anti, entry_assembly, dataset_counters, slim_entries, root_parts, hash_diff_incremental,
        insert_only_defaults, patch_overlay, store_fold, appended_senses, override_matches, group_index, function_senses, prefix_offsets, section_changes,
        instruction_sentences, windowed_weights, promoted_senses, core_cards, whole_source, shown_senses, full_definitions, phrase_fallback, phrases_seen,
        full_assembly, task_checks, missing_groups, legacy_keys, clip_filters, entry_slice, numeric_keys, store_file, parsed_labels, label_file_faults, sense_pages, parsed_entries, phrase_hints,
        phrase_hits, half_split, label_forms, work_list, review_blocks, vector_levels, chunk_fixed, stripe, pack_next_fit, loud_gain, inflected_forms, html_inline, context_table,
    )
}
