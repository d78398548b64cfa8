import random

from pyspark.sql import functions as F

from millrace.operators import activity as A
from millrace.operators import contexts as C
from millrace.operators import frequency as Q
from millrace.operators import merge as M
from millrace.operators import senses as S
from millrace.operators import validate as V
from millrace.operators.ranking import global_rank
from millrace.sources import corpus, sinks


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_global_rank_equals_window(spark):
    random.seed(1)
    data = [(random.choice(["hot"] * 5 + ["a", "b", None]), random.randrange(50), i) for i in range(500)]
    df = spark.createDataFrame(data, "g string, v int, i int")
    got = {r["i"]: (r["rank"], r["run"]) for r in global_rank(df, ["g"], ["v", "i"], "rank", {"run": "v"}).collect()}
    for g in {d[0] for d in data}:
        total = 0
        for k, (_, v, i) in enumerate(sorted((d for d in data if d[0] == g), key=lambda d: d[1:]), 1):
            total += v
            assert got[i] == (k, total)


def test_ranks_on_ties_and_empty(spark):
    tokens = spark.createDataFrame([("b", 1), ("a", 1), ("a", 2), ("b", 2), ("c", 1)], "word string, u int")
    assert rows(Q.term_frequency(tokens), "rank", "word", "count") == [(1, "a", 2), (2, "b", 2), (3, "c", 1)]
    assert rows(Q.document_frequency(tokens, "u"), "rank", "word", "doc_freq") == [(1, "a", 2), (2, "b", 2), (3, "c", 1)]
    freq = Q.term_frequency(tokens)
    assert rows(Q.cumulative_cutoff(freq), "cutoff", "words", "tokens") == [(2, 3, 5)]
    empty = tokens.limit(0)
    assert Q.term_frequency(empty).count() == 0


def test_coverage_counts_misses(spark):
    tokens = spark.createDataFrame([(1, "a"), (1, "b"), (1, "a"), (2, "z")], "doc int, word string")
    listed = spark.createDataFrame([("a",)], "word string")
    got = {r["doc"]: round(r["coverage"], 3) for r in Q.coverage(tokens, "doc", listed).collect()}
    assert got == {1: 66.667, 2: 0.0}


def test_directions_block(spark):
    text = "Directions: read\nthe text\nnow.\nother\nDirectlons: x.\ny\nDirections a\n\nb"
    df = spark.createDataFrame([(1, text), (2, None), (3, "")], "i int, t string")
    got = [r["line"] for r in C.directions_lines(df, "t", ["i"]).orderBy("i", "pos").collect()]
    assert got == ["Directions: read", "the text", "now.", "Directlons: x.", "Directions a"]


def test_instructions_by_wording_sittings_and_blocks(spark):
    s = spark.createDataFrame([("You will hear two long talks.", "a"), *[("Same words again here.", x) for x in "abc"], ("Only twice said here.", "a"), ("Only twice said here.", "b")], "sentence string, src string")
    docs = spark.createDataFrame([(1, "Directions: Write an essay now\nof ten words only.\nNot this line here.")], "i int, t string")
    got = rows(C.instruction_sentences(s, F.col("src"), docs, "t", ["i"]), "sentence")
    assert got == [("Directions: Write an essay now",), ("Same words again here.",), ("You will hear two long talks.",), ("of ten words only.",)]


def test_headwords_by_tokens(spark):
    s = spark.createDataFrame([("s1", 1, 0, "It's in, it can't co-it IT"), ("s2", 2, 0, "it is it")], "src string, doc int, pos int, sentence string")
    hw = spark.createDataFrame([("it",), ("can",)], "word string")
    got = rows(C.headword_contexts(s, hw, "src", ["doc", "pos"]), "word", "id", "n", "hits", "src")
    assert got == [("can", 0, 1, 1, "s1"), ("it", 0, 1, 3, "s1"), ("it", 1, 1, 2, "s2")]


def test_next_fit(spark):
    df = spark.createDataFrame([("g", i, n) for i, n in enumerate([4, 6, 25, 1, 9, 1])], "g string, i int, n int")
    got = [r["bin"] for r in C.next_fit(df, ["g"], "i", "n", 10).orderBy("i").collect()]
    assert got == [0, 0, 1, 2, 2, 3]
    random.seed(5)
    data = [(random.choice(["hot"] * 4 + ["a", None]), i, random.choice([0, 1, 3, 9, 10, 12])) for i in range(400)]
    got = {r["i"]: r["bin"] for r in C.next_fit(spark.createDataFrame(data, "g string, i int, n int"), ["g"], "i", "n", 10).collect()}
    for g in {d[0] for d in data}:
        used = b = 0
        for _, i, n in [d for d in data if d[0] == g]:
            if used > 0 and used + n > 10:
                b, used = b + 1, 0
            used += n
            assert got[i] == b, (g, i)
    assert C.next_fit(df.limit(0), ["g"], "i", "n", 10).count() == 0


def test_stripe_is_permutation(spark):
    df = spark.createDataFrame([(i,) for i in range(60)], "i int")
    got = rows(C.stripe(df, ["i"], 28), "i", "task")
    assert [t for _, t in got] == [i % 3 for i in range(60)]


def test_priority_and_last_wins(spark):
    a = spark.createDataFrame([("x", ""), ("y", "1")], "k string, v string")
    b = spark.createDataFrame([("x", "2"), ("y", "3"), ("z", "4")], "k string, v string")
    assert rows(M.priority_merge([a, b], "k", F.col("v") != ""), "k", "v", "source_no") == [("x", "2", 1), ("y", "1", 0), ("z", "4", 1)]
    assert rows(M.last_wins([a, b], "k"), "k", "v", "source_no") == [("x", "2", 1), ("y", "3", 1), ("z", "4", 1)]


def test_patch_sets_null_explicitly(spark):
    base = spark.createDataFrame([("k", "1", "2"), ("l", "3", "4")], "k string, a string, b string")
    patch = spark.createDataFrame([("k", {"a": None, "b": "9"})], "k string, patch map<string,string>")
    assert sorted(tuple(r) for r in M.patch_fields(base, patch, "k").collect()) == [("k", None, "9"), ("l", "3", "4")]


def test_new_values_are_appended_once(spark):
    store = spark.createDataFrame([("a", 0, "n."), ("a", 1, None)], "w string, i int, v string")
    new = spark.createDataFrame([("a", "v.", 3), ("a", "n.", 1), ("a", None, 2), ("a", "v.", 9), ("a", "x", 1), ("b", "y", 5)], "w string, v string, o int")
    got = rows(M.append_new(store, new, "w", ["v"], "i", "o").na.fill("-"), "w", "i", "v")
    assert got == [("a", 0, "n."), ("a", 1, "-"), ("a", 2, "x"), ("a", 3, "v."), ("b", 0, "y")]


def test_alias_is_one_hop(spark):
    cards = spark.createDataFrame([("a", "1")], "w string, c string")
    alias = spark.createDataFrame([("b", "a"), ("c", "b"), ("a", "z")], "w string, same_as string")
    assert rows(M.resolve_aliases(cards, alias, "w"), "w", "c") == [("a", "1"), ("b", "1")]


def test_labels_normalise(spark):
    df = spark.createDataFrame([("3",), ("[1, 2]",), ("P:in the face of",), ("X",), ("N0",), ("1;P:a b",), ("?",)], "l string")
    got = [[(x["kind"], x["sense"], x["phrase"]) for x in r[0]] for r in df.select(S.normalise_label(F.col("l"))).collect()]
    assert got == [
        [("sense", 3, None)], [("sense", 1, None), ("sense", 2, None)], [("phrase", None, "in the face of")], [("x", None, None)],
        [("new", 0, None)], [("sense", 1, None), ("phrase", None, "a b")], [("bad", None, None)],
    ]


def test_capped_beats_plain_count(spark):
    data = [("w", 0, f"s{i}", 1, False, "p1") for i in range(27)] + [("w", 1, f"t{i}", 1, False, f"p{i // 2}") for i in range(10)]
    df = spark.createDataFrame(data, "word string, sense int, sid string, n int, stem boolean, paper string").withColumn("kind", F.lit("sense"))
    w = S.sense_weights(df, F.col("stem"), F.col("paper"))
    assert rows(w, "sense", "material", "capped") == [(0, 27, 3), (1, 10, 10)]
    assert rows(S.rank_senses(w).where("place = 1"), "sense") == [(1,)]


def test_keep_rule_and_manual_extra(spark):
    ranked = spark.createDataFrame([("w", i, i + 1, 1 if i else 5) for i in range(4)], "word string, sense int, place int, hits int")
    few = spark.createDataFrame([("w", 10)], "word string, sentences int")
    many = spark.createDataFrame([("w", 11)], "word string, sentences int")
    assert rows(S.keep_senses(ranked, few, most=2), "sense") == [(0,), (1,)]
    assert rows(S.keep_senses(ranked, many), "sense") == [(0,)]
    extra = spark.createDataFrame([("w", 3)], "word string, sense int")
    assert rows(S.keep_senses(ranked, few, most=2, extra=extra), "sense") == [(0,), (1,), (3,)]


def test_form_target(spark):
    df = spark.createDataFrame([("study 的复数", ["v.", "n."]), ("x", ["v.", "n."]), ("go 的过去分词", ["v.", "n.", "adj."])], "f string, g array<string>")
    assert [r[0] for r in df.select(S.form_target(F.col("f"), F.col("g"))).collect()] == ["n.", "n.", "adj."]


def test_latest_write_ties_and_late_rows(spark):
    df = spark.createDataFrame([("k", 5, 1), ("k", 5, 3), ("k", 4, 9), ("l", 1, None)], "k string, t int, v int")
    assert rows(A.latest_by_key(df, ["k"], ["t"], ["v"]), "k", "t", "v") == [("k", 5, 3), ("l", 1, None)]


def test_heartbeat_gap_limit(spark):
    base = "2024-01-01 00:00:00"
    df = spark.sql(
        f"select 1 u, id e, timestamp_ntz'{base}' + make_dt_interval(0, 0, 0, s) ts from values (1, 0.0), (2, 120.0), (3, 240.000001), (4, 250.0) t(id, s)"
    )
    assert A.heartbeat_time(df, ["u"], "ts", "e", 120).first()["active_us"] == 120_000_000 + 9_999_999


def test_pool_closed_form(spark):
    random.seed(2)
    for _ in range(5):
        n = random.randrange(5, 60)
        done = [random.random() < 0.7 for _ in range(n)]
        size, low = 10, 4
        pool = min(size, n)
        while pool < n and sum(not d for d in done[:pool]) <= low:
            pool = min(pool + size - low, n)
        df = spark.createDataFrame([("c", i + 1) for i, d in enumerate(done) if d] + [("c", None)], "c string, rank int")
        assert A.pool_size(df, ["c"], "rank", spark.createDataFrame([(n,)], "n int"), size, low).first()["pool"] == pool


def test_reassemble_last_duplicate_wins(spark):
    df = spark.createDataFrame([("k", 1, "b", 1), ("k", 0, "a", 2), ("k", 1, "B", 3)], "k string, seq int, part string, o int")
    assert A.reassemble(df, ["k"], "seq", "part", "o").first()["body"] == "aB"


def test_validators(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (3, "zz")], "id int, k string")
    ref = spark.createDataFrame([("a",)], "r string")
    assert rows(V.missing_reference(df, ["k"], ref, ["r"]), "id") == [(3,)]
    assert rows(V.rule_violations(df, ["id"], {"short": F.length("k") == 1}), "id", "rule") == [(2, "short"), (3, "short")]


def test_label_file(spark):
    body = "0 1\n# to\nnote: x\n3 0\n4 P:according to;1\nN0 | v. | 新\nwhat\n# be\n9 X"
    df = spark.createDataFrame([("f", body)], "task string, body string")
    got = rows(corpus.parse_labels(df, ["task"], "body"), "line_no", "word", "kind", "id", "label", "zh")
    assert got == [
        (1, None, "bad", None, None, None), (3, "to", "note", None, None, None), (4, "to", "label", 3, "0", None),
        (5, "to", "label", 4, "P:according to;1", None), (6, "to", "new", None, None, "新"), (7, "to", "bad", None, None, None),
        (9, "be", "label", 9, "X", None),
    ]


def test_label_faults(spark):
    body = "# to\n1 0\n1 X\n9 0\nwhat\n# odd\n1 0"
    labels = corpus.parse_labels(spark.createDataFrame([("f", body)], "task string, body string"), ["task"], "body")
    expected = spark.createDataFrame([("f", "to", 1), ("f", "to", 2), ("f", "be", 1)], "task string, word string, id int")
    faults = corpus.label_faults(labels, expected)
    assert sorted((r["word"], r["id"] or 0, r["fault"]) for r in faults.collect()) == [
        ("be", 0, "missing section"), ("odd", 0, "unknown section"), ("to", 0, "bad line"), ("to", 1, "id twice"), ("to", 2, "missing id"), ("to", 9, "unknown id"),
    ]
    eased = corpus.label_faults(labels, expected, spark.createDataFrame([("to",)], "word string"))
    assert eased.where("fault = 'missing id'").count() == 0


def test_sources_that_are_wrong_or_absent(spark, tmp_path):
    import pytest

    (tmp_path / "papers").mkdir()
    (tmp_path / "papers" / "notes.txt").write_text("x", encoding="utf-8")
    with pytest.raises(Exception, match="no year in file name"):
        corpus.read_corpus(spark, str(tmp_path), ["papers"]).collect()
    assert corpus.read_json_or_empty(spark, f"file://{tmp_path}/none.json", "a int").count() == 0
    (tmp_path / "A_r1_01.json").write_text("[1]", encoding="utf-8")
    (tmp_path / "A_r1_01.out.json").write_text("{}", encoding="utf-8")
    assert rows(corpus.task_files(spark, str(tmp_path)), "stem", "body") == [("A_r1_01", "[1]")]
    assert rows(corpus.task_files(spark, str(tmp_path), done=True), "stem", "body") == [("A_r1_01", "{}")]
    (tmp_path / "window.json").write_text('{"years": [2021, "2022"]}', encoding="utf-8")
    assert corpus.window_years(str(tmp_path / "window.json")) == [2021, 2022]
    store = spark.createDataFrame([("b", 1), ("a", 2)], "k string, v int")
    sinks.write_store(store, str(tmp_path / "store"), "k")
    with pytest.raises(Exception, match="(?i)exist"):
        sinks.write_store(store, str(tmp_path / "store"), "k")
    assert rows(corpus.read_json_or_empty(spark, str(tmp_path / "store"), store.schema, multi_line=False), "k", "v") == [("a", 2), ("b", 1)]


def test_entry_file(spark):
    body = "[1] go\n英[a] 美[b]\n释义: v.走\n—— Section 2 ——\n[2] to do\n例句（自编）：W: Oh：no（哦）\n词频 3\n[3] x"
    df = spark.createDataFrame([("f", body)], "f string, body string")
    got = rows(corpus.parse_entries(df, ["f"], "body"), "rank", "word", "section", "uk", "us", "def", "ex_label", "ex")
    assert got == [
        (1, "go", 1, "a", "b", "v.走", "例句", ""), (2, "to do", 2, "", "", "", "例句（自编）", "W: Oh：no（哦）"), (3, "x", 2, "", "", "", "例句", ""),
    ]


def test_review_lines_with_phrases(spark):
    senses = spark.createDataFrame([("go", 1, "v.", "走", 3), ("go", 2, None, None, 1)], "word string, place int, pos string, zh string, hits bigint")
    phrases = spark.createDataFrame([(["go", "on"], "go on", 2), (["go"], "go by", 5)], "words array<string>, phrase string, count bigint")
    block = sinks.review_lines(senses, phrases).first()["block"]
    assert block == "## go\n- 1. v.走 (3)\n- 2.  (1)\n- go by ×5\n- go on ×2"


def test_work_list_takes_the_whole_word(spark):
    df = spark.createDataFrame([(1, "it", "Italy likes it very much"), (2, "it", "no hit"), (3, "it", "it")], "id int, word string, sentence string")
    assert {r["id"]: r["after"] for r in sinks.work_list(df).collect()} == {1: ["very", "much"], 2: [], 3: []}


def test_markdown_blocks(spark):
    body = "intro\n\n### 1. Head\n\n| a | b |\n| --- | --- |\n| c | d |\n\n* one\n\n* two\ntail"
    df = spark.createDataFrame([("f", body)], "f string, body string")
    got = [tuple(r) for r in corpus.markdown_blocks(df, ["f"], "body").orderBy("block").select("kind", "rows").collect()]
    assert got == [("paragraph", ["intro"]), ("heading", ["1. Head"]), ("table", ["| a | b |", "| c | d |"]), ("bullets", ["one", "two"]), ("paragraph", ["tail"])]


def test_corpus_files_and_sinks(spark, tmp_path):
    papers = tmp_path / "papers"
    papers.mkdir()
    (papers / "cet4_2021_06_1_ans.txt").write_text("Hello there\nyou", encoding="utf-8")
    (papers / "cet4_2015_06_1.txt").write_text("old", encoding="utf-8")
    got = rows(corpus.read_corpus(spark, str(tmp_path), ["papers"], [2021]), "year", "sitting", "set_key", "body")
    assert got == [(2021, "cet4_2021_06", "2021_06_1", "Hello there\nyou")]
    freq = spark.createDataFrame([(1, "a", 3), (2, "b", 1)], "rank int, word string, count bigint")
    sinks.write_ranked(freq, str(tmp_path / "out"))
    assert rows(corpus.read_ranked(spark, str(tmp_path / "out"), 1), "word") == [("a",)]
    assert corpus.read_json_or_empty(spark, str(tmp_path / "none.json"), "a int").count() == 0


def test_phrase_hits_equal_nested_loop(spark):
    from millrace.functions.text import phrase_pattern

    texts = ["Take the whole cost into account.", "He will take it, into account", "in the face of it", "face it", "make up one's mind is to make up her mind", ""]
    phrases = ["take sth into account", "in the face of", "make up one's mind", "sth up", "face ... it"]
    s = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, sentence string")
    p = spark.createDataFrame([(x,) for x in phrases] + [(None,)], "phrase string")
    got = rows(C.phrase_hits(s, p), "id", "phrase")
    every = s.crossJoin(p).where(F.rlike(F.col("sentence"), phrase_pattern(F.col("phrase"))))
    assert got == rows(every, "id", "phrase") and len(got) >= 3
    over = C.over_headword(C.phrase_hits(s, p).withColumn("word", F.lit("face")), "word")
    assert {r["id"] for r in over.collect()} == {2, 3}


def test_name_hint(spark):
    df = spark.createDataFrame([("He met Will there.",), ("Will he come?",), ("It is over. Will you?",), ("he will go",)], "t string")
    assert [r[0] for r in df.select(C.name_hint(F.col("t"), "will")).collect()] == [True, False, False, False]


def test_definition_line(spark):
    groups = "array<struct<pos:string,text:string>>"
    data = [([("v.", "学习"), ("n.", "书房")], "study 的复数", False, False), ([("v.", "去")], "go 的过去式", True, False), ([("v.", "去")], "go 的过去式", True, True), ([("n.", "猫")], None, None, None)]
    df = spark.createDataFrame(data, f"g {groups}, form string, irr boolean, bare boolean")
    got = [r[0] for r in df.select(S.definition_line(*map(F.col, ("g", "form", "irr", "bare")))).collect()]
    assert got == ["v.学习. n.书房(study 的复数).", "go 的过去式. v.去.", "v.去.", "n.猫."]


def test_signals(spark):
    import numpy as np

    from millrace.functions import signal as G

    rate = 8000
    t = np.arange(rate) / rate
    tone = np.concatenate([np.zeros(rate // 2), 0.5 * np.sin(2 * np.pi * 200 * t)])
    df = spark.createDataFrame([(1, tone.tolist()), (2, [0.0] * 4000), (3, None), (4, [])], "i int, s array<double>")
    out = {r["i"]: r for r in df.select("i", G.median_pitch(rate, 400, 200)("s").alias("p"), G.onset_seconds(rate)("s").alias("o"), G.rms(F.col("s")).alias("r")).collect()}
    assert abs(out[1]["p"] - 200) < 3 and abs(out[1]["o"] - 0.5) < 0.02 and abs(out[1]["r"] - 0.2887) < 1e-3
    assert out[2]["p"] == 0.0 and out[2]["o"] is None and out[3]["p"] is None and out[4]["r"] is None
