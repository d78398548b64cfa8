import random
from collections import defaultdict

from millrace.llm import repeated_lines
from millrace.llm.repeated_lines import covering_templates, find_repeated_lines, node_counts, remove_repeated_lines

SCHEMA = "ctx_id bigint, src string, text string"


def letters(line):
    return "".join(c for c in line if c.isalpha()).casefold()


def brute(rows, least=5, share=0.02):
    pages = defaultdict(int)
    docs = defaultdict(set)
    for i, s, t in rows:
        if s is None or t is None:
            continue
        pages[s] += 1
        for line in t.split("\n"):
            if letters(line):
                docs[s, letters(line)].add(i)
    return {
        (i, n)
        for i, s, t in rows
        if s is not None and t is not None
        for n, line in enumerate(t.split("\n"))
        if letters(line) and len(docs[s, letters(line)]) >= least and len(docs[s, letters(line)]) >= share * pages[s] - 1e-9
    }


def data(n=400, seed=3):
    random.seed(seed)
    legal = ["All rights reserved {}", "• ALL RIGHTS   reserved.", "all rights re-served", "Teile diese Straße {}", "TEILE DIESE STRASSE", "分享本页 {}", "Пишите нам", "ſun and ﬁne", "SUN AND FINE", "λογος", "ΛΟΓΟΣ"]
    rows = []
    for i in range(n):
        src = random.choice(["hot"] * 4 + ["a", "b", None])
        lines = [f"Unique {random.random()} words {chr(97 + i % 26) * (i % 9 + 1)}" for _ in range(random.randrange(4))]
        lines += [random.choice(legal).format(i) for _ in range(random.randrange(3))]
        random.shuffle(lines)
        rows.append((i, src, random.choice(["\n", "\r\n"]).join(lines)))
    return rows + [(n, "hot", None), (n + 1, "hot", ""), (n + 2, "a", "\n\n123\n"), (n + 3, "b", "x" * 300_000 + "\nAll rights reserved")]


def test_equals_brute_force(spark):
    rows = data()
    got = {(r["ctx_id"], r["line_no"]) for r in find_repeated_lines(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == brute(rows) and got


def test_counts_a_document_once_and_share_counts(spark):
    rows = [(i, "s", "Same line\nsame LINE") for i in range(4)] + [(4, "s", "other")]
    df = spark.createDataFrame(rows, SCHEMA)
    assert find_repeated_lines(df).count() == 0
    assert find_repeated_lines(df, min_docs=4).count() == 8
    many = spark.createDataFrame([(i, "s", "Same" if i < 5 else f"x{'y' * i}") for i in range(251)], SCHEMA)
    assert find_repeated_lines(many).count() == 0
    assert find_repeated_lines(many.where("ctx_id < 250")).count() == 5


def test_removal_keeps_rows_columns_and_clashing_names(spark):
    rows = [(i, "s", f"keep {chr(97 + i) * 3}\n- Share 9") for i in range(6)] + [(9, None, "- Share 9"), (10, "s", None)]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as lines_removed", "'n' as _node", "'d' as docs", "5 as pages")
    out = {r["ctx_id"]: r for r in remove_repeated_lines(df).collect()}
    assert len(out) == 8 and out[0]["text"] == "keep aaa" and out[0]["lines_removed"] == 1
    assert out[9]["text"] == "- Share 9" and out[10]["text"] is None and out[10]["lines_removed"] == 0
    assert out[0]["_node"] == "n" and out[0]["docs"] == "d"


def test_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert find_repeated_lines(df).count() == 0 and node_counts(df).count() == 0 and covering_templates(df).count() == 0 and remove_repeated_lines(df).count() == 0


WORDS = "one two three four five six seven eight nine ten eleven twelve".split()


def test_lines_with_one_changing_word_share_a_template(spark):
    rows = [(i, "s", f"Page {w} of the Herald archive\n{w} readers like this page today") for i, w in enumerate(WORDS)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert covering_templates(df).count() == 0
    back = {r["template"]: (r["docs"], r["contents"]) for r in covering_templates(df, backward=True).collect()}
    assert back == {"page * of the herald archive": (12, 12), "* readers like this page today": (12, 12)}
    turned = spark.createDataFrame([(i, "s", f"Herald archive page {w} of thirty\nHerald archive no {w} {w}") for i, w in enumerate(WORDS)], SCHEMA)
    front = {r["template"]: (r["docs"], r["contents"]) for r in covering_templates(turned).collect()}
    assert front == {"herald archive page * of thirty": (12, 12), "herald archive no *": (12, 12)}
    assert find_repeated_lines(df).count() == 0


def test_spacing_does_not_split_templates(spark):
    shapes = ["Page one of the Herald archive", "PAGE ONE: of the herald-archive", "Pageone ofthe Heraldarchive", "Page 7 one of the (Herald) archive", "page one of the herald archive 12"]
    df = spark.createDataFrame([(i, "s", t) for i, t in enumerate(shapes)], SCHEMA)
    assert [(r["docs"], r["contents"]) for r in covering_templates(df).collect()] == [(5, 1)]
    assert find_repeated_lines(df).count() == 5


def test_beyond_the_broadcast_bound(spark, monkeypatch):
    monkeypatch.setattr(repeated_lines, "BROADCAST_ROWS", 0)
    rows = data(200)
    df = spark.createDataFrame(rows, SCHEMA)
    assert {(r["ctx_id"], r["line_no"]) for r in find_repeated_lines(df).collect()} == brute(rows)
    assert sum(r["lines_removed"] for r in remove_repeated_lines(df).collect()) == len(brute(rows))
