from millrace.llm import scan_repair as S

CLEAN = (
    "The careful farmer visited the modern library after the long winter.\n"
    "The young teacher described the common method before the exam.\n"
    "Many people want to learn a second language in the capital.\n"
)


def model():
    total = {k: __import__("collections").Counter() for k in ("word", "pair", "title", "again", "cuts", "compound")}
    for _ in range(40):
        S.document_counts(CLEAN + "A well-known bridge was here.\nKey\n", total)
    grams = __import__("collections").Counter()
    for w, n in total["word"].items():
        for g in S._grams(w):
            grams[g] += n
    total["gram"] = grams
    return S.ScanModel({k: dict(v) for k, v in total.items()})


def test_defects_and_repair():
    text = (
        "12   Modern Farmers\nThe careful farrner visited the rnodern lib-\n— 12 —\n\x0c13   Modern Farmers\n"
        "rary after the lon9 winter. A well-\nknown bridge was here.\n\nKey\nMany people want to learn."
    )
    defects, repaired = S.analyse(text, model())
    assert defects == [(0, "header"), (1, "hyphen"), (1, "misread"), (2, "page_no"), (3, "header"), (4, "misread")]
    assert repaired == (
        "The careful farmer visited the modern library after the long winter. A well-known bridge was here.\n\nKey\n\nMany people want to learn."
    )


def test_figures_and_unknown_names_stay():
    text = "In 1987 the 2nd Zarmoktov bridge cost £671 or 76.5%.\nScore 53"
    m = model()
    m.headings.add("score #")
    assert S.analyse(text, m)[0] == []


def test_edges():
    m = model()
    for t in ("", "\n\n", "-", "—", "12", "…\x0c\r"):
        S.analyse(t, m)
    assert S.analyse("12", m) == ([(0, "page_no")], "")
    assert S.analyse("The exam." * 20_000, m)[0] == []


def test_vocabulary_drops_what_the_channel_explains():
    m = S.ScanModel({"word": {"hard": 1000, "bard": 5, "visitor5": 50, "lake": 40, "take": 900}})
    assert "bard" not in m.word and "visitor5" not in m.word and "lake" in m.word


def test_confusion_probabilities_follow_the_corpus():
    words = {"modern": 3000, "farmer": 3000, "summer": 3000, "the": 9000, "lake": 3000, "rnodern": 30, "farrner": 30, "surnmer": 30}
    m = S.ScanModel({"word": words})
    assert m.channel["rn", "m"] > -6 > m.channel["lc", "k"] and "rnodern" not in m.word and "lake" in m.word
    assert m.decode(["the", "rnodern"])[1] == ("modern", 0)


def test_a_rare_name_keeps_its_own_word_but_not_its_misreading():
    m = S.ScanModel({"word": {"zarmoktov": 6, "zarrnoktov": 1, "bridge": 5000, "the": 60_000}})
    assert "zarmoktov" in m.word and "zarrnoktov" not in m.word


def test_capital_i_read_for_small_l():
    assert S._recase("large", "Iarge", 0) == "large" and S._recase("Large", "LARGE", 2) == "LARGE" and S._recase("india", "Indja", 3) == "India"
    text = "The careful farmer visited the Iibrary after the long winter."
    assert S.analyse(text, model()) == ([(0, "misread")], "The careful farmer visited the library after the long winter.")


def test_all_confusions_of_a_word():
    words = {"environmentally": 400, "responsibilities": 400, "installed": 400, "the": 3000}
    m = S.ScanModel({"word": words})
    for bad, good in (("environrnentallv", "environmentally"), ("resp0nsibi1itie5", "responsibilities"), ("1n5t@11ed", "installed")):
        assert m.decode(["the", bad])[1][0] == good, bad
    near = {"hat", "bat", "hot", "haf", "bot", "baf", "hof"}
    m = S.ScanModel({"word": dict.fromkeys(near, 40) | {"the": 10_000_000}})
    assert near <= {r[0] for r in m.readings("hat")}
    m = S.ScanModel({"word": {"lil" * 6: 40}})
    assert "lil" * 6 in {r[0] for r in m.readings("1|l" + "1|!" * 5)}


def test_operator(spark):
    rows = [(i, CLEAN) for i in range(30)] + [(90, CLEAN.replace("modern", "rnodern")), (91, None), (92, ""), (90, "The exarn.")]
    df = spark.createDataFrame(rows, "ctx_id bigint, text string").selectExpr("*", "1 as line_no", "'x' as repaired", "2 as _id")
    got = sorted(tuple(r) for r in S.find_defects(df).collect())
    assert got == [(90, 0, "misread"), (90, 0, "misread")]
    out = {r["ctx_id"]: r["repaired"] for r in S.repair_scans(df).collect()}
    assert out[91] is None and out[92] == "" and len(out) == 33
    assert S.find_defects(df.limit(0)).count() == 0
