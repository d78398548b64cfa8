"""Queries over the documents: word counts, coverage, sentences, boilerplate."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import text as T
from millrace.operators import contexts as C
from millrace.operators import frequency as Q
from millrace.plans.sql import WS, clean_sql, directions_cte, lemma_sql, sentences_cte, tokens_cte
from millrace.plans.checkpoints import cut, shared_folder
from millrace.sources import corpus, read_table, sinks

LEAST_CHARS = 3000


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents", spread=True)


def _tokens(spark: SparkSession, sf_dir: str, keep: list[str], form: str = "surface") -> DataFrame:
    return Q.token_counts(_docs(spark, sf_dir), "text", keep, form)


def _exam_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Papers and listening scripts of the sets that are long enough."""
    d = _docs(spark, sf_dir).where(F.col("sub").isin("papers", "listening")).select("doc_id", "set_key", "text")
    return d.join(Q.full_units(d, "set_key", "text", LEAST_CHARS).select("set_key"), "set_key", "left_semi")


def tf_surface(spark, sf_dir):
    return Q.term_frequency(_tokens(spark, sf_dir, []))


def tf_lemma(spark, sf_dir):
    return Q.term_frequency(_tokens(spark, sf_dir, [], "lemma"))


def df_rank(spark, sf_dir):
    return Q.document_frequency(Q.token_counts(_exam_docs(spark, sf_dir), "text", ["set_key"]), "set_key")


def df_in_all_sets(spark, sf_dir):
    docs = _exam_docs(spark, sf_dir)
    table = Q.document_frequency(Q.token_counts(docs, "text", ["set_key"]), "set_key")
    n = docs.agg(F.count_distinct("set_key").alias("n_units"))
    return Q.in_all_units(table, n)


def _tf_running(spark, sf_dir):
    return Q.term_frequency(_tokens(spark, sf_dir, []), running=True)


def headword_list(spark, sf_dir):
    """The list of headwords: the first 1,250 by document frequency."""
    return df_rank(spark, sf_dir).where(F.col("rank") <= 1250).select("rank", "word")


def cutoff_80(spark, sf_dir):
    return Q.cumulative_cutoff(_tf_running(spark, sf_dir))


def tf_df_overlap(spark, sf_dir):
    tf = _tf_running(spark, sf_dir)
    return Q.list_overlap(tf, df_rank(spark, sf_dir), Q.cumulative_cutoff(tf).select("cutoff"))


def coverage_per_doc(spark, sf_dir):
    """Words are counted per document once, written, and summed up to the list as well."""
    per_doc = cut(_tokens(spark, sf_dir, ["doc_id"]))
    tf = Q.term_frequency(per_doc, running=True)
    top = tf.join(F.broadcast(Q.cumulative_cutoff(tf).select("cutoff")), F.col("rank") <= F.col("cutoff"))
    return Q.coverage(per_doc, "doc_id", top)


def coverage_summary(spark, sf_dir):
    return Q.coverage_summary(coverage_per_doc(spark, sf_dir))


def stub_sets(spark, sf_dir):
    d = _docs(spark, sf_dir).where(F.col("sub").isin("papers", "listening") & F.col("set_key").isNotNull())
    full = Q.full_units(d, "set_key", "text", LEAST_CHARS).select("set_key")
    return d.select("set_key").subtract(full)


def contraction_repair(spark, sf_dir):
    raw = _docs(spark, sf_dir).select(F.explode(T.raw_words(T.clean_text(F.col("text")))).alias("raw"))
    counts = raw.groupBy("raw").agg(F.count(F.lit(1)).alias("k"))
    rows = counts.select("k", F.explode(T.split_contractions(F.array("raw"))).alias("w")).where(F.col("w").isin(*T.REPAIRS))
    return rows.groupBy("w").agg(F.sum("k").alias("n")).select("w", T.repair(F.col("w")).alias("word"), "n")


def clean_texts(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", T.content_hash(T.clean_text(F.col("text")), 16).alias("h"))


def window_scan(spark, sf_dir):
    d = _docs(spark, sf_dir).where(F.col("exam_year").between(2021, 2024))
    return d.groupBy("sub", "exam_year").agg(F.count(F.lit(1)).alias("docs"), F.sum("n_chars").alias("chars"))


def set_names(spark, sf_dir):
    d = _docs(spark, sf_dir).select("doc_id", "sub", "set_key")
    return d.where(F.col("set_key").isNotNull()).select(
        "doc_id", F.concat("set_key", F.when(F.col("sub") == "listening", "·听力").otherwise("")).alias("src"),
        F.substring("set_key", 1, 7).alias("sitting"),
    )


def stub_filters(spark, sf_dir):
    """Documents by length of their stripped text; those without any corpus word stand apart."""
    n = F.length(T.strip(F.coalesce("text", F.lit(""))))
    no_words = F.size(T.word_tokens(F.coalesce("text", F.lit("")))) == 0
    band = F.when(n < 200, "short").when(no_words, "no words").when(n < 3000, "stub").otherwise("full")
    return _docs(spark, sf_dir).withColumn("band", band).groupBy("band").agg(F.count(F.lit(1)).alias("docs"))


def _sentences(spark, sf_dir):
    return C.sentence_rows(_docs(spark, sf_dir), "text", ["doc_id"])


def sentences(spark, sf_dir):
    return _sentences(spark, sf_dir).select("doc_id", "pos", F.md5(F.encode("sentence", "UTF-8")).alias("h"))


def sentence_ids(spark, sf_dir):
    return _sentences(spark, sf_dir).select(T.sid(F.col("sentence")).alias("sid")).groupBy("sid").agg(F.count(F.lit(1)).alias("n"))


def _multiplicity(spark, sf_dir):
    d = _docs(spark, sf_dir).where(F.col("set_key").isNotNull())
    rows = C.sentence_rows(d, "text", ["doc_id", "set_key"])
    return C.sentence_multiplicity(rows, F.substring("set_key", 1, 7))


def sentence_multiplicity(spark, sf_dir):
    return _multiplicity(spark, sf_dir)


def boilerplate(spark, sf_dir):
    return C.boilerplate(_multiplicity(spark, sf_dir))


def _headwords(spark, sf_dir):
    return read_table(spark, sf_dir, "senses").select("word").distinct()


def _src_sentences(spark, sf_dir):
    d = _docs(spark, sf_dir).where(F.col("sub").isin("papers", "listening"))
    d = d.select("doc_id", "text", F.coalesce("source", F.lit("?")).alias("src"))
    return C.sentence_rows(d, "text", ["doc_id", "src"])


def headword_contexts(spark, sf_dir):
    return C.headword_contexts(_src_sentences(spark, sf_dir), _headwords(spark, sf_dir), "src", ["doc_id", "pos"])


def first_contexts(spark, sf_dir):
    """The first 80 sentences of each word."""
    return headword_contexts(spark, sf_dir).where(F.col("id") < 80)


def headword_totals(spark, sf_dir):
    hits = C.headword_occurrences(_src_sentences(spark, sf_dir), _headwords(spark, sf_dir))
    return hits.groupBy("word").agg(F.count(F.lit(1)).alias("total"), F.count_distinct("src").alias("sources"))


def top_words(spark, sf_dir):
    return Q.top_terms(_tokens(spark, sf_dir, []), 25)


def ranked_file(spark, sf_dir):
    """The ranked list written as CSV and its first 500 ranks read again."""
    path = f"{shared_folder(spark)}/millrace_{uuid.uuid4().hex}"
    sinks.write_ranked(tf_surface(spark, sf_dir), path)
    return corpus.read_ranked(spark, path, 500)


def directions_blocks(spark, sf_dir):
    """Lines of Directions blocks; every tenth document is given one in front, as the tables hold none."""
    front = F.when(F.col("doc_id") % 10 == 0, F.concat(F.lit("Directions: For this part you\nare to write\n\n"), "text")).otherwise(F.col("text"))
    return C.directions_lines(_docs(spark, sf_dir).select("doc_id", front.alias("text")), "text", ["doc_id"])


def peek_context(spark, sf_dir):
    """700 characters on both sides of the first words of every sentence."""
    d = _docs(spark, sf_dir)
    rows = d.select("doc_id", "text", F.posexplode(T.sentence_pieces(F.col("text"))).alias("pos", "sentence"))
    return C.peek(rows, "text", "sentence").select("doc_id", "pos", F.md5(F.encode("around", "UTF-8")).alias("h"))


_TOK = "WITH " + tokens_cte("documents", "doc_id")
_TF = "tf AS (SELECT CAST(row_number() OVER (ORDER BY count(*) DESC, word) AS INTEGER) AS rank, word, count(*) AS count FROM tokens GROUP BY word)"
_EXAM = f"""exam AS (
  SELECT * FROM documents WHERE sub IN ('papers', 'listening') AND set_key IN (
    SELECT set_key FROM documents WHERE sub IN ('papers', 'listening') AND set_key IS NOT NULL
    GROUP BY set_key HAVING sum(length(text)) >= {LEAST_CHARS}))"""
_DF = "WITH " + _EXAM + ", " + tokens_cte("exam", "set_key", name="etok") + """, dfr AS (
  SELECT CAST(row_number() OVER (ORDER BY count(DISTINCT set_key) DESC, count(*) DESC, word) AS INTEGER) AS rank,
         word, count(DISTINCT set_key) AS doc_freq, count(*) AS term_freq FROM etok GROUP BY word)"""
_CUT = """run AS (SELECT rank, sum(count) OVER (ORDER BY rank) AS running, sum(count) OVER () AS total, count(*) OVER () AS size FROM tf),
cut AS (SELECT CAST(coalesce(min(rank) FILTER (running >= 0.8 * total), max(size)) AS INTEGER) AS cutoff,
        max(size) AS words, CAST(max(total) AS BIGINT) AS tokens FROM run)"""
_COV = _TOK + ", " + _TF + ", " + _CUT + """, cov AS (
  SELECT doc_id, count(*) AS tokens, count(*) FILTER (word IN (SELECT word FROM tf WHERE rank <= (SELECT cutoff FROM cut))) AS hits
  FROM tokens GROUP BY doc_id), covered AS (SELECT doc_id, tokens, hits, 100.0::DOUBLE * hits / tokens AS coverage FROM cov)"""
_MULT = "WITH " + sentences_cte("documents", "doc_id, set_key", where="set_key IS NOT NULL") + """, mult AS (
  SELECT sentence, count(*) AS n, count(DISTINCT substr(set_key, 1, 7)) AS sittings FROM sentences GROUP BY sentence)"""
_SRC = "WITH srcdocs AS (SELECT doc_id, text, coalesce(source, '?') AS src FROM documents WHERE sub IN ('papers', 'listening')), " + sentences_cte(
    "srcdocs", "doc_id, src"
) + """, runs AS (
  SELECT doc_id, src, pos, sentence, unnest(regexp_extract_all(sentence, '[A-Za-z''’-]+')) AS r FROM sentences
), occ AS (
  SELECT doc_id, src, pos, sentence, lower(regexp_extract(r, '^[A-Za-z-]+')) AS word FROM runs
  WHERE regexp_matches(r, '^[A-Za-z-]') AND lower(regexp_extract(r, '^[A-Za-z-]+')) IN (SELECT lower(word) FROM senses)
)"""
_CTX = _SRC + """, rowsn AS (SELECT word, sentence, doc_id, pos, src, count(*) AS k FROM occ GROUP BY ALL),
uniq AS (SELECT word, sentence, count(*) AS n, CAST(sum(k) AS BIGINT) AS hits, min({'d': doc_id, 'p': pos, 's': src}) AS f FROM rowsn GROUP BY word, sentence),
turns AS (SELECT *, row_number() OVER (PARTITION BY word, f.s ORDER BY f.d, f.p, sentence) AS turn FROM uniq),
placed AS (SELECT word, CAST(row_number() OVER (PARTITION BY word ORDER BY turn, f.s) - 1 AS INTEGER) AS id,
  substr(sha1(sentence), 1, 16) AS sid, n, hits, f.s AS src FROM turns)"""
_FRONT = "SELECT doc_id, CASE WHEN doc_id % 10 = 0 THEN 'Directions: For this part you' || chr(10) || 'are to write' || chr(10) || chr(10) || text ELSE text END AS text FROM documents"

QUERIES = {
    f.__name__: f
    for f in (
        tf_surface, tf_lemma, df_rank, headword_list, df_in_all_sets, cutoff_80, tf_df_overlap, coverage_per_doc, coverage_summary,
        stub_sets, contraction_repair, clean_texts, window_scan, set_names, stub_filters, sentences, sentence_ids,
        sentence_multiplicity, boilerplate, headword_contexts, first_contexts, headword_totals, top_words, ranked_file, directions_blocks, peek_context,
    )
}
ORACLE = {
    "tf_surface": f"{_TOK}, {_TF} SELECT * FROM tf",
    "top_words": f"{_TOK}, {_TF} SELECT * FROM tf WHERE rank <= 25",
    "tf_lemma": f"{_TOK}, lem AS (SELECT {lemma_sql()} AS word FROM tokens) SELECT CAST(row_number() OVER (ORDER BY count(*) DESC, word) AS INTEGER) AS rank, word, count(*) AS count FROM lem GROUP BY word",
    "df_rank": f"{_DF} SELECT * FROM dfr",
    "df_in_all_sets": f"{_DF} SELECT word, doc_freq FROM dfr WHERE doc_freq = (SELECT count(DISTINCT set_key) FROM exam)",
    "cutoff_80": f"{_TOK}, {_TF}, {_CUT} SELECT * FROM cut",
    "tf_df_overlap": f"{_TOK}, {_TF}, {_CUT}, {_DF[5:]} SELECT cutoff AS n, count(*) AS common, count(*)::DOUBLE / cutoff AS ratio FROM cut, tf JOIN dfr USING (word) WHERE tf.rank <= cutoff AND dfr.rank <= cutoff GROUP BY cutoff",
    "coverage_per_doc": f"{_COV} SELECT * FROM covered",
    "coverage_summary": f"{_COV} SELECT round(avg(coverage), 6) AS mean, min(coverage) AS least, max(coverage) AS most, count(*) AS units FROM covered",
    "stub_sets": f"""SELECT set_key FROM documents WHERE sub IN ('papers', 'listening') AND set_key IS NOT NULL
GROUP BY set_key HAVING NOT coalesce(sum(length(text)) >= {LEAST_CHARS}, false)""",
    "contraction_repair": f"{_TOK} SELECT w, CASE w WHEN 'ca' THEN 'can' WHEN 'wo' THEN 'will' WHEN 'sha' THEN 'shall' ELSE 'not' END AS word, count(*) AS n FROM tokens_cut WHERE w IN ('ca', 'wo', 'sha', 'n''t') GROUP BY w",
    "clean_texts": f"SELECT doc_id, substr(sha256({clean_sql()}), 1, 16) AS h FROM documents",
    "window_scan": "SELECT sub, exam_year, count(*) AS docs, CAST(sum(n_chars) AS BIGINT) AS chars FROM documents WHERE exam_year BETWEEN 2021 AND 2024 GROUP BY ALL",
    "set_names": "SELECT doc_id, set_key || CASE WHEN sub = 'listening' THEN '·听力' ELSE '' END AS src, substr(set_key, 1, 7) AS sitting FROM documents WHERE set_key IS NOT NULL",
    "stub_filters": f"""{_TOK} SELECT CASE WHEN n < 200 THEN 'short' WHEN doc_id NOT IN (SELECT doc_id FROM tokens) THEN 'no words' WHEN n < 3000 THEN 'stub' ELSE 'full' END AS band, count(*) AS docs
FROM (SELECT doc_id, length(regexp_replace(coalesce(text, ''), '^{WS}+|{WS}+$', '', 'g')) AS n FROM documents) GROUP BY 1""",
    "sentences": "WITH " + sentences_cte("documents", "doc_id") + " SELECT doc_id, pos, md5(sentence) AS h FROM sentences",
    "sentence_ids": "WITH " + sentences_cte("documents", "doc_id") + " SELECT substr(sha1(sentence), 1, 16) AS sid, count(*) AS n FROM sentences GROUP BY 1",
    "sentence_multiplicity": f"{_MULT} SELECT * FROM mult",
    "boilerplate": f"{_MULT} SELECT * FROM mult WHERE sittings >= 3",
    "headword_contexts": f"{_CTX} SELECT * FROM placed",
    "first_contexts": f"{_CTX} SELECT * FROM placed WHERE id < 80",
    "peek_context": "WITH " + sentences_cte("documents", "doc_id") + """, k AS (
  SELECT d.doc_id, text, array_to_string(list_slice(string_split(sentence, ' '), 1, 8), ' ') AS key
  , pos FROM documents d JOIN sentences s USING (doc_id)), i AS (SELECT *, instr(text, key) AS hit FROM k)
SELECT doc_id, pos, CASE WHEN hit > 0 THEN md5(substr(text, greatest(hit - 700, 1), hit - greatest(hit - 700, 1) + length(key) + 700)) END AS h FROM i""",
    "headword_list": f"{_DF} SELECT rank, word FROM dfr WHERE rank <= 1250",
    "ranked_file": f"{_TOK}, {_TF} SELECT * FROM tf WHERE rank <= 500",
    "directions_blocks": f"WITH fronted AS ({_FRONT}), {directions_cte('fronted', 'doc_id')} SELECT * FROM blocks",
    "headword_totals": f"{_SRC} SELECT word, count(*) AS total, count(DISTINCT src) AS sources FROM occ GROUP BY word",
}
