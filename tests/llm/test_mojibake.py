import random

from millrace.llm import mojibake as M

EN = "That’s why the farmer sold the café. “I can’t,” she said – it cost £{}. The sign said «новый учебник». At 2{} °C all was well."
ZH = "你知道学生为什么去了图书馆吗？据统计，20{}年有{}%的学生参观了展览馆。老师说：“真不错！我们再来吧。”"
RU = "Вчера студент перевёл новый словарь. В 19{} г. врач починил старый мост."


def corpus(n=120):
    random.seed(6)
    num = lambda: random.randrange(10, 99)
    return [(i * 3 + k, t.format(num(), num()), lang) for i in range(n) for k, (t, lang) in enumerate(((EN, "en"), (ZH, "zh"), (RU, "ru")))]


def judge():
    by = {}
    for _, t, lang in corpus():
        by.setdefault(lang, []).append(t)
    return M.train(by)


def test_round_trips():
    j = judge()
    en, zh, ru = EN.format(41, 7), ZH.format(17, 55), RU.format(78)
    sloppy = lambda t, c: "".join(bytes([b]).decode(c, "ignore") or chr(b) for b in t.encode("utf-8"))
    bad = {
        "en1252": (en, sloppy(en, "cp1252")), "en437": (en, en.encode().decode("cp437")), "enmac": (en, en.encode().decode("mac_roman")),
        "enlatin": (en, en.encode().decode("latin-1")), "twice": (en, sloppy(sloppy(en, "cp1252"), "cp1252")),
        "zhlatin": (zh, zh.encode("gb18030").decode("latin-1")), "ru1251": (ru, ru.encode("cp1251").decode("latin-1")),
        "rukoi": (ru, ru.encode("koi8_r").decode("cp1251")), "ruutf": (ru, ru.encode().decode("cp1251", "ignore")),
        "part": (en + " " + en, en + " " + en.encode().decode("mac_roman")),
    }
    for name, (good, garbled) in bad.items():
        text, chain, saved = j.restore(garbled)
        assert chain and saved > 0, name
        if name != "ruutf":
            assert text == good, (name, text)


def test_clean_texts_stay():
    j = judge()
    for t in (EN.format(60, 3), ZH.format(11, 22), RU.format(66), "plain ascii ? * \\x92", "", "SÃO ZARENÃO – CHÂTEAU café"):
        text, chain, saved = j.restore(t)
        assert text == t or t.startswith("SÃO"), (t, text, chain)


def test_long_text():
    j = judge()
    garbled = (EN.format(41, 7) * 400).encode().decode("cp437")
    assert j.restore(garbled)[0] == EN.format(41, 7) * 400


def test_one_byte_readings():
    j = judge()
    en, ru = EN.split(" The sign")[0].format(41), RU.format(78)
    for wrote, read in (("cp1252", "cp1251"), ("cp1252", "cp1250"), ("cp866", "cp1251"), ("cp1251", "cp866")):
        good = en if wrote == "cp1252" else ru
        text, chain, _ = j.restore(good.encode(wrote).decode(read))
        assert (text, chain) == (good, [f"{wrote} as {read}"]), (wrote, read, text, chain)
    cafe = "Then she said: the café. And I can say the café."
    for wrote in ("cp437", "cp850"):
        assert j.restore(cafe.encode(wrote).decode("cp1252"))[0] == cafe, wrote


def test_every_step_under_every_dictionary():
    j = judge()
    filler = " and so on, as was said before, in the same way. "
    sloppy = lambda t: "".join(bytes([b]).decode("cp1252", "ignore") or chr(b) for b in t.encode("utf-8"))
    bad = filler.join(sloppy(t) for t in [EN.format(41, 7)[:40], "the café", "£41", RU.format(78), ZH.format(17, 55)])
    j.restore(bad)
    compressors, steps = j._ready
    size = lambda t: min(len(c.compress(t.encode())) for c in compressors) + M.ESCAPE * M.unusual_pairs(t, j.usual)
    gains = []
    for step in steps:
        removed, groups = j._stretches(bad, step)
        spans = [(max(0, g[0][0] - M.CONTEXT), g[-1][1] + M.CONTEXT, g) for g in groups]
        gain = [size(bad[a:b]) - size(j._rewritten(bad, a, min(b, len(bad)), g)) for a, b, g in spans]
        if removed:
            gains.append(sum(g for g in gain if g >= 2))
    tried, undone = [], j._undone
    j._undone = lambda text, groups, least: tried.append(undone(text, groups)) or tried[-1]
    j.restore(bad)
    assert len(gains) > 4 and sorted(saved for saved, _ in tried[: len(gains)]) == sorted(gains)


def test_ending_early_changes_no_choice():
    j = judge()
    whole = judge()
    plain = whole._undone
    whole._undone = lambda text, groups, least: plain(text, groups)
    for good in (EN.format(41, 7) * 6, ZH.format(17, 55) * 6, RU.format(78) * 6 + EN.format(41, 7)):
        for read in ("latin-1", "cp437", "mac_roman"):
            bad = good.encode().decode(read)
            assert j.restore(bad) == whole.restore(bad)


def test_usual_pairs_of_long_texts_and_other_languages(spark):
    rows = corpus(20) + [(900 + i, "Ġużeppi ħareġ. ", "mt") for i in range(8)] + [(950 + i, "Żagħżugħ " + "and so on " * 400, "en") for i in range(4)]
    j = M.fit_judge(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"))
    assert {"Ġa", "Ża"} <= j.usual


def test_languages_without_a_dictionary_stay():
    j = judge()
    for t in (
        "El niño comió una manzana y después volvió a su casa con su mamá.", "Zażółć gęślą jaźń, powiedział chłopiec.",
        "나는 어제 학교에 갔다. 오늘은 집에 있다.", "Η γάτα κοιμάται στον κήπο.",
    ):
        assert j.restore(t) == (t, [], 0), t


def test_labels_of_the_table_are_the_languages(spark):
    rows = corpus(20) + [(900 + i, f"El niño número {i} comió después.", "es") for i in range(30)] + [(990, "x", None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    assert set(M.fit_judge(df).dictionaries) == {"en", "zh", "ru", "es"}


def test_operator(spark):
    rows = corpus(60) + [(1000, EN.format(12, 3).encode().decode("mac_roman"), "en"), (1001, None, "en"), (1002, "", None), (1003, "It�s lost", "en")]
    rows += [(1000, rows[180][1], "fr")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").selectExpr("*", "1 as restored", "2 as chain", "3 as h")
    out = sorted(tuple(r) for r in M.judge_texts(df).select("doc_id", "restored", "lost").collect())
    good = EN.format(12, 3)
    assert out == [(1000, good, False), (1000, good, False), (1003, "It�s lost", True)]
    assert M.judge_texts(df.limit(0)).count() == 0


def test_many_texts_at_once_give_what_each_step_gives_alone():
    j = judge()
    good = [EN.format(41, 7), ZH.format(17, 55), RU.format(78), "plain", "", "é\x00é", "ÿ", "Ã", "naïve 😀 �"]
    sloppy = lambda t, c: "".join(bytes([b]).decode(c, "ignore") or chr(b) for b in t.encode("utf-8", "surrogatepass"))
    texts = good + [sloppy(t, c) for t in good for c in ("cp1252", "latin-1", "cp437", "mac_roman", "cp1251", "cp1250")]
    texts += ["Ã©" + "é" * 3 + "\xed\xa0\x80", "\xf4\x90\x80\x80Ã©", "\xe0\x80\x80", "\xf0\x9f\x98\x80", "â€", "\xef\xbf\xbd\xef\xbf\xbd", "\x85Ð"]
    j._setup()
    seen = 0
    for text, found in zip(texts, j._of_bytes(texts)):
        for k, step in enumerate(j._ready[1]):
            if step.chars is not None and not step.spans:
                removed, groups = j._stretches(text, step)
                assert found.get(k, (0, [])) == ((removed, groups) if removed > 0 else (0, [])), (text, M.STEPS[k])
                seen += removed > 0
    assert seen > 100
    assert j.restore_all(texts) == [judge().restore(t) for t in texts]
    assert j.with_unusual(texts) == [M.unusual_pairs(t, j.usual) > 0 for t in texts]


def test_dictionaries_rest_on_all_texts(spark):
    long = "Now here is the plain beginning of it. " * 100
    rows = [(i, "At the café.", "en") for i in range(900)] + [(1000 + i, f"{long}Their tête-à-tête was naïve.", "en") for i in range(9)]
    rows += [(2000, "It was a cafй here.", "en")]
    j = M.fit_judge(spark.createDataFrame(rows, "doc_id bigint, text string, lang string").repartition(7))
    assert "naïve".encode() in j.dictionaries["en"] and "cafй".encode() not in j.dictionaries["en"]
    again = M.fit_judge(spark.createDataFrame(rows[::-1], "doc_id bigint, text string, lang string").repartition(3))
    assert again.dictionaries == j.dictionaries and again.usual == j.usual


def test_counts_are_those_of_each_text_alone():
    rows = corpus(30) + [(900 + i, t, lang) for i, (t, lang) in enumerate([("", "en"), ("é", "fr"), ("é", "fr"), ("éé", "fr"), ("xé é", ""), ("あ" * 30, "ja")])]
    counts = M._Counts()
    for part in (rows[:50], rows[50:]):
        counts.add([r[2] for r in part], [r[1] for r in part])
    got = {(r.lang, r.key): r.n for r in counts.rows().itertuples() if r.kind == "pair"}
    want = {}
    for _, t, lang in rows:
        c = t.translate(M._CLASS)
        for p in {c[i : i + 2] for i in range(len(c) - 1)}:
            if not p.isascii():
                want[lang, p] = want.get((lang, p), 0) + 1
    assert not any(M._suspicious(t, counts.steps) for _, t, _ in rows) and got == want
