import json
import random
import re
from collections import defaultdict

from pyspark.sql import functions as F

from millrace.llm import format_copies as C

SCHEMA = "ctx_id bigint, word string, form string, text string, n bigint"


def content(v):
    return "".join(c for c in (v or "") if c.isalpha() or c.isdigit()).upper().lower()


def fields(form, text):
    if form == "sentence":
        return (("", content(text)),)
    if text.lstrip().startswith("{"):
        pairs = json.loads(text, object_pairs_hook=list)
    else:
        pairs = [x.split(":", 1) for x in re.split(r"\r\n|\n|\r| \| |; ", text.strip()) if x.strip()]
    return tuple(sorted((k.strip().lower(), content(v)) for k, v in pairs))


def brute(rows):
    groups = defaultdict(list)
    for i, w, f, t, _ in rows:
        if t is not None and f in ("sentence", "card"):
            groups[w, f, fields(f, t)].append(i)
    return {(min(g), i) for g in groups.values() for i in g if i != min(g)}


def data(n=300, seed=5):
    random.seed(seed)
    rows = []
    for i in range(n):
        w = random.choice(["to"] * 3 + ["go", None])
        if i % 2:
            t = random.choice(["It is 5 o'clock", "IT IS 5, OCLOCK!", "it is\n6 o clock", "Straße", "STRASSE", "", " "])
            rows.append((i, w, "sentence", t, i))
            continue
        card = {"en": random.choice(["A b.", "a B", "c"]), "zh": random.choice(["好。", "好"]), "pos": "n."}
        items = random.sample(sorted(card.items()), random.choice([2, 3]))
        if random.random() < 0.4:
            t = json.dumps({k.upper(): v for k, v in items}, ensure_ascii=False, indent=random.choice([None, 1]))
        else:
            t = random.choice([" | ", "; ", "\n", "\r\n"]).join(f"{k.title()}:{random.choice(['', ' '])}{v}" for k, v in items)
        rows.append((i, w, "card", t, None))
    long = "word " * 50_000
    return rows + [(n, "go", "sentence", None, 1), (n + 1, "go", "page", "A", 1), (n + 2, "x", "sentence", long, 1), (n + 3, "x", "sentence", long.upper(), 2)]


def test_equals_brute_force(spark):
    rows = data()
    got = {(r["first_id"], r["copy_id"]) for r in C.context_copies(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == brute(rows) and len(got) > 100


def test_collapse_counts_every_record(spark):
    rows = [r for r in data() if r[3] is not None and r[2] != "page"]
    out = C.collapse_contexts(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sum(r["copies"] for r in out) == len(rows)
    assert sum(r["total_n"] or 0 for r in out) == sum(r[4] or 0 for r in rows)


def test_collisions_are_split_by_fields(spark, monkeypatch):
    constant = lambda f: F.struct(F.lit(1).alias("k"), F.lit(2).alias("a"), F.lit(3).alias("b"))
    monkeypatch.setattr(C, "fingerprint", constant)
    rows = data(80)
    got = {(r["first_id"], r["copy_id"]) for r in C.context_copies(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == brute(rows)


def test_repeated_fields_are_a_bag(spark):
    rows = [(1, "w", "card", "en:a; en:a; zh:b", 1), (2, "w", "card", "en:a; zh:b", 1), (3, "w", "card", "zh:b; en:a; en:A", 1)]
    got = [tuple(r) for r in C.context_copies(spark.createDataFrame(rows, SCHEMA)).collect()]
    assert got == [(1, 3)]


def test_empty_and_clashing_columns(spark):
    df = spark.createDataFrame([], SCHEMA).selectExpr("*", "1 as _h", "2 as first_id", "3 as copies")
    assert C.context_copies(df).count() == 0 and C.collapse_contexts(df).count() == 0


def test_hot_groups_give_the_same_pairs(spark, monkeypatch):
    monkeypatch.setattr(C, "SALT_COPIES", 3)
    check_hot(spark)
    monkeypatch.setattr(C, "BROADCAST_ROWS", 0)
    check_hot(spark)


def check_hot(spark):
    rows = data()
    df = spark.createDataFrame(rows, SCHEMA)
    got = [(r["first_id"], r["copy_id"]) for r in C.context_copies(df).collect()]
    assert len(got) == len(set(got)) and set(got) == brute(rows)
    assert sum(r["copies"] for r in C.collapse_contexts(df).collect()) == sum(r[3] is not None and r[2] != "page" for r in rows)


def test_case_is_folded_in_full(spark):
    rows = [(1, "w", "sentence", "The SUN and ﬁne λογος", 1), (2, "w", "sentence", "the ſun and FINE ΛΟΓΟΣ", 2)]
    assert [tuple(r) for r in C.context_copies(spark.createDataFrame(rows, SCHEMA)).collect()] == [(1, 2)]
