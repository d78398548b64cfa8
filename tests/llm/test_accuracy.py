"""Held-out accuracy: cases made from clean texts of the test data, so that the truth is known."""

import os
import random

import pytest
from pyspark.sql import functions as F

from millrace.llm import mojibake, scan_repair, sentence_bounds
from millrace.sources import read_table
from tests.compare import DATA

DOCUMENTS = os.path.join(os.path.dirname(DATA), "sf0.01")
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA) or not os.path.isdir(DOCUMENTS), reason="no test data")


@pytest.fixture(scope="module")
def sentences(spark):
    rows = read_table(spark, DATA, "contexts").where((F.col("form") == "sentence") & (F.col("lang") == "en") & F.col("text").isNotNull())
    texts = sorted({" ".join(r["text"].split()) for r in rows.select("text").collect()})
    return [t for t in texts if t.isascii() and t[0].isupper() and t[1].islower() and t[-1] == "." and "  " not in t]


def test_sentences_put_together_are_found_again(spark, sentences):
    random.seed(4)
    rows, truth = [], set()
    for i in range(150):
        at = 0
        parts = random.sample(sentences, 5)
        for p in parts:
            truth.add((i, at))
            at += len(p) + 1
        rows.append((i, " ".join(parts), "en"))
    got = {tuple(r) for r in sentence_bounds.find_sentences(spark.createDataFrame(rows, "ctx_id bigint, text string, lang string")).collect()}
    assert len(got & truth) >= 0.99 * len(truth) and len(got & truth) >= 0.99 * len(got)


def test_misread_words_are_found_and_repaired(spark, sentences):
    random.seed(5)
    channel = [("m", "rn"), ("d", "cl"), ("w", "vv"), ("o", "0"), ("l", "1"), ("s", "5"), ("e", "c"), ("h", "b")]
    rows, truth, clean = [], set(), {}
    for i in range(400):
        lines = random.sample(sentences, 4)
        clean[i] = " ".join(lines)
        for k, line in enumerate(lines):
            words = line.split(" ")
            w = random.randrange(1, len(words))
            good, bad = random.choice(channel)
            if random.random() < 0.3 and good in words[w][1:] and words[w].isalpha() and words[w].islower():
                words[w] = words[w][0] + words[w][1:].replace(good, bad, 1)
                truth.add((i, k))
            lines[k] = " ".join(words)
        rows.append((i, "\n".join(lines)))
    df = spark.createDataFrame(rows, "ctx_id bigint, text string")
    got = {(r["ctx_id"], r["line_no"]) for r in scan_repair.find_defects(df).where("defect = 'misread'").collect()}
    assert len(truth) > 50 and len(got & truth) >= 0.9 * len(truth) and len(got & truth) >= 0.95 * len(got)
    repaired = {r["ctx_id"]: r["repaired"] for r in scan_repair.repair_scans(df).collect()}
    assert sum(" ".join(repaired[i].split()) == clean[i] for i in clean) >= 0.9 * len(clean)


def test_garbled_documents_are_found_and_restored(spark):
    docs = read_table(spark, DOCUMENTS, "documents").where(F.col("text").isNotNull()).select("doc_id", "text", "lang")
    affected = {r["doc_id"] for r in mojibake.judge_texts(docs).select("doc_id").collect()}
    rows = [tuple(r) for r in docs.collect() if r["doc_id"] not in affected]
    random.seed(6)
    truth = {}
    for k, (i, text, lang) in enumerate(rows):
        read = random.choice(["latin-1", "cp437", "mac_roman"])
        if not text.isascii() and random.random() < 0.15:
            rows[k] = (i, text.encode().decode(read), lang)
            truth[i] = text
    out = {r["doc_id"]: r["restored"] for r in mojibake.judge_texts(spark.createDataFrame(rows, "doc_id bigint, text string, lang string")).collect()}
    found = set(out) & set(truth)
    assert len(truth) >= 10 and len(found) >= 0.95 * len(truth) and len(found) >= 0.95 * len(out)
    assert sum(out[i] == truth[i] for i in found) >= 0.85 * len(truth)
