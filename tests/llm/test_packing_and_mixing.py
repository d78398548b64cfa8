import os
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import mixing as M
from millrace.llm import packing as P
from millrace.llm.token_counts import TOKENIZER, count_tokens, with_tokens

pytestmark = pytest.mark.skipif(not os.path.exists(TOKENIZER), reason="no tokenizer file")
WORDS = "the river house garden market 图书馆 学习 дом school paper light".split()


def documents(spark, n=300, seed=8):
    random.seed(seed)
    rows = [(i, " ".join(random.choices(WORDS, k=random.choice([1, 5, 20, 60, 200]))), random.choice(["a"] * 4 + ["b", "c", None])) for i in range(n)]
    rows += [(n, None, "a"), (n + 1, "", "b"), (n + 2, "house " * 3000, "a"), (n + 3, rows[0][1], "c"), (n + 3, rows[0][1], "c")]
    return spark.createDataFrame(rows, "doc_id bigint, text string, source string").selectExpr("*", "1 as tokens", "2 as bin", "3 as share"), rows


def test_tokens(spark):
    df, rows = documents(spark, 5)
    got = [r["t"] for r in with_tokens(df, out_col="t").collect()]
    assert got == [None if t is None else count_tokens(t) for _, t, _ in rows]


def test_hilbert_curve_steps_to_neighbours():
    grid = np.array([[x, y] for x in range(16) for y in range(16)])
    keys = P.hilbert_keys(grid, 4)
    assert sorted(keys) == list(range(256))
    path = grid[np.argsort(keys)]
    assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def test_packing_is_whole_and_tight(spark):
    df, rows = documents(spark)
    sizes = spark.createDataFrame([("s", 64), ("l", 512), ("bad", 0), ("none", None)], "container string, capacity_tokens int")
    out = P.pack(df, sizes).collect()
    for name, cap in (("s", 64), ("l", 512)):
        pieces = defaultdict(list)
        bins = defaultdict(list)
        for r in out:
            if r["container"] == name:
                pieces[r["doc"]].append(r)
                bins[r["bin"]].append(r)
        assert set(pieces) == {i for i, t, _ in rows if t is not None}
        for i, t, _ in rows:
            if t is None or i == 303:
                continue
            ps = sorted(pieces[i], key=lambda r: r["piece"])
            n = count_tokens(t)
            assert ps[0]["token_from"] == 0 and ps[-1]["token_to"] == n
            assert all(a["token_to"] == b["token_from"] for a, b in zip(ps, ps[1:]))
            assert len(ps) == 1 or n > cap
        for b in bins.values():
            used = sum(r["token_to"] - r["token_from"] for r in b)
            assert used <= cap and all(r["unused"] == cap - used for r in b)
        used = sum(r["token_to"] - r["token_from"] for b in bins.values() for r in b)
        assert len(bins) <= -(-used // cap) * 1.05 + 1
    report = {r["container"]: r for r in P.packing_report(P.pack(df, sizes)).collect()}
    assert report["s"]["used"] == report["l"]["used"]
    assert P.pack(df.limit(0), sizes).count() == 0 and P.pack(df, sizes.limit(0)).count() == 0


def test_windows_carry_over():
    p = P.Packer(100, 0)
    out = []
    for k in range(5):
        out += p.add([(35, k * P.WINDOW + i) for i in range(P.WINDOW)])
    out += p.close()
    assert sorted(i for _, _, i in out) == list(range(5 * P.WINDOW))
    fill = defaultdict(int)
    for b, unused, _ in out:
        fill[b] += 35
        assert unused in (30, 65)
    assert max(fill.values()) <= 100


def test_neighbours_on_the_curve_share_containers(spark):
    random.seed(3)
    topics = [[f"{c}{i}" for i in range(40)] for c in "kmtz"]
    rows = [(i, " ".join(random.choices(random.choice(topics), k=random.randrange(5, 60)))) for i in range(600)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    sizes = spark.createDataFrame([("s", 600)], "container string, capacity_tokens int")
    packed = P.pack(df, sizes)
    report = P.packing_report(packed).first()
    places = [r["place"] for r in packed.collect()]
    random.shuffle(places)
    at_random = np.mean([abs(a - b) for a, b in zip(places[::2], places[1::2])]) / 2.0 ** (P.DIMS * P.BITS)
    assert report["span"] < 0.5 * at_random and report["filled"] > 0.9


def test_every_source_is_within_a_document_of_the_best_reachable_share(spark):
    df, rows = documents(spark, 600)
    shares = {"a": (0.3, 1), "b": (0.4, 3), "c": (0.3, 2)}
    targets = spark.createDataFrame([(s, *v) for s, v in shares.items()], "source string, target_share double, max_repeats int")
    taken = {r["source"]: r["taken"] for r in M.mix(df, targets)[1].collect()}
    sizes = {s: [count_tokens(t) for _, t, x in rows if x == s and t is not None] for s in shares}
    budget = sum(map(sum, sizes.values()))
    lo, hi = 0.0, 1e9
    for _ in range(200):
        time = (lo + hi) / 2
        reach = {s: min(share * time, sum(sizes[s]) * most) for s, (share, most) in shares.items()}
        lo, hi = (time, hi) if sum(reach.values()) < budget else (lo, time)
    for s in shares:
        assert abs(taken[s] - reach[s]) <= max(sizes[s]) + 1, (s, taken, reach)


def test_end_time():
    assert M.end_time([(0.5, 100), (0.5, 10)], 40) == 60
    assert M.end_time([(0.5, 10), (0.5, 10)], 100) == 20
    assert M.end_time([(0.25, 1000), (0.75, 1000)], 100) == 100


def test_mixture_meets_targets_and_caps(spark):
    df, rows = documents(spark, 600)
    targets = spark.createDataFrame([("a", 0.3, 1), ("b", 0.4, 3), ("c", 0.2, 50), ("none", 0.1, 2), (None, 0.5, 1), ("c", 0.0, 0)], "source string, target_share double, max_repeats int")
    mixed, report = M.mix(df, targets)
    got = [r.asDict() for r in mixed.collect()]
    sizes = defaultdict(int)
    for r in got:
        sizes[r["source"]] += r["tokens"]
    total = sum(sizes.values())
    budget = sum(count_tokens(t) for _, t, s in rows if s in ("a", "b", "c") and t)
    assert total <= budget and total >= budget - 3500
    caps = {"a": 1, "b": 3, "c": 50}
    times = defaultdict(int)
    for r in got:
        times[r["source"], r["doc_id"]] += 1
        assert r["repeat"] <= caps[r["source"]]
    assert all(n <= caps[s] * (2 if d == 603 else 1) for (s, d), n in times.items())
    rep = {r["source"]: r for r in report.collect()}
    assert rep["none"]["actual_share"] == 0.0 and abs(sum(r["actual_share"] for r in rep.values()) - 1) < 1e-9
    for s in "abc":
        assert rep[s]["taken"] == sizes[s]
    finish = [r["finish"] for r in got]
    assert finish == sorted(finish)
    one = M.mix(df, targets)[0]
    assert one.exceptAll(mixed).count() == 0


def test_mixture_edges(spark):
    df, _ = documents(spark, 20)
    targets = spark.createDataFrame([("zz", 1.0, 1)], "source string, target_share double, max_repeats int")
    mixed, report = M.mix(df, targets)
    assert mixed.count() == 0 and report.first()["actual_share"] == 0.0
    assert M.mix(df.limit(0), targets)[0].count() == 0
    assert M.mix(df, targets.limit(0))[1].count() == 0
    assert df.where(F.col("text").isNull()).count() == 1


def test_mixture_fills_budget_with_short_documents(spark):
    rows = [(i, "a", "a") for i in range(4000)] + [(4000 + i, " ".join(["word"] * 900), "b") for i in range(3)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    targets = spark.createDataFrame([("a", 0.9, 1), ("b", 0.1, 1)], "source string, target_share double, max_repeats int")
    size = count_tokens(rows[-1][1])
    mixed = M.mix(df, targets, budget=1000)[0].groupBy("source").sum("tokens").collect()
    assert size >= 500 and {r[0]: r[1] for r in mixed} == {"a": 1000}
