import random
import unicodedata

import pyarrow as pa

from millrace.llm import one_form as O


def fold(*texts, alike="always"):
    return O.fold(pa.array(texts, pa.string()), alike).to_pylist()


def test_folds_and_keeps():
    assert fold("ｆｕｌｌ，（ａ）！", "é ǘ", "ﬁ ﬃ", "аеo", "x​­﻿y", "⼀年", "a　 b", "well‑known") == [
        "full,(a)!", "é ǘ", "fi ffi", "aeo", "xy", "一年", "a b", "well-known",
    ]
    kept = ["café cafe", "²2", "O0", "Ab aB", "½ Ⅳ ①", "a-b ab", "。.", "–-", "…"]
    assert fold(*kept) == kept


def test_nulls_empty_and_spaces():
    assert fold(None, "", "  ", " a  b ", None) == [None, "", "", "a b", None]
    assert O.fold(pa.array([], pa.string())).to_pylist() == []
    sliced = pa.array(["drop", None, "é", "ﬂ"]).slice(1)
    assert O.fold(sliced).to_pylist() == [None, "é", "fl"]


def test_lookalikes_by_text():
    assert fold("еvery day", "Это словарь", "a", alike="latin") == ["every day", "Это словарь", "a"]


def test_equals_the_same_rules_char_by_char():
    random.seed(4)
    pool = "abȩ́́̈ｅﬁＡ　\xa0 ‍漢⼤еΩ!？̣oO0"
    texts = ["".join(random.choices(pool, k=random.randrange(12))) for _ in range(400)]

    def slow(t):
        t = unicodedata.normalize("NFC", "".join(O._expansion(c) for c in t))
        t = unicodedata.normalize("NFC", "".join(chr(O.tables().alike[ord(c)]) for c in t))
        return " ".join(x for x in t.split(" ") if x)

    for t, got in zip(texts, fold(*texts)):
        assert got == slow(t), t


def test_pairs_against_brute_force(spark):
    ex = [(1, "w", "A café", "好，"), (2, "w", "A cafe", "好，"), (3, "v", "A café", "好，"), (4, "w", None, "x"), (5, "w", "x", None), (1, "w", "A café", "好，")]
    en = [(1, "w", "A café（好,）"), (2, "w", "A café（好，）"), (3, None, "A café（好，）"), (4, "w", None), (5, "v", "A café(好，)")]
    a = spark.createDataFrame(ex, "example_id bigint, word string, en string, zh string").selectExpr("*", "1 as key", "2 as h")
    b = spark.createDataFrame(en, "entry_id bigint, word string, ex string").selectExpr("*", "1 as key")
    got = sorted(tuple(r) for r in O.find_same_looking(a, b).collect())
    want = sorted(
        (i, j) for i, w, e, z in ex for j, v, x in en
        if None not in (e, z, x) and w == v and fold(f"{e}（{z}）") == fold(x) and f"{e}（{z}）" != x
    )
    assert got == want == [(1, 1), (1, 1), (3, 5)]
    assert O.find_same_looking(a.limit(0), b).count() == 0


def test_column_operator(spark):
    df = spark.createDataFrame([(1, "ａ", "old"), (2, None, "old")], "i int, t string, t_one string")
    assert [tuple(r) for r in O.add_one_form(df, ["t"]).select("i", "t_one").collect()] == [(1, "a"), (2, None)]
