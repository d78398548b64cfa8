from millrace.llm import sentence_bounds as S

MODEL = S.CorpusModel(
    {("low", w): 50 for w in ("the", "some", "a", "it", "this")}
    | {("start", w): 50 for w in ("The", "Some", "Tovan", "Did", "Der", "Am")}
    | {("dot", "p.m"): 40, ("dl", "p.m"): 20, ("dot", "Fig"): 30, ("dd", "Fig"): 30, ("dot", "e.g"): 9, ("dl", "e.g"): 9}
    | {("dot", "Mr"): 40, ("pair", "Mr Tovan"): 30}
)

CASES = [
    ["Mr. Tovan came at 3 p.m. ", "The end."],
    ["It opens at 3 p.m. Beijing time."],
    ["It opens at 3 p.m.", "Did it?"],
    ["See Fig. 3 (cf. p. 9) now. ", "Some foods, e.g. rice, cost $4.50."],
    ["J. V. Temgor moved to the U.S. ", "The rest stayed."],
    ["The man said, “It is lost. That is all.” ", "The rest stayed."],
    ['"Can we begin?" Tovan asked the man. ', "It was late."],
    ["“Stop! Wait.” the man cried."],
    ["The house (the old one, ed. 7, was lost!) opened."],
    ["Notes on a Talk\n\n", "M: Well... the man\nnever came.\n", "W: Did he really?!"],
    ["他说：“真不错！再来吧。”然后走了。", "你知道吗？", "好"],
    ["他回答：“我们去了。很好。”", "最近几年，人多了。"],
    ["記者は「すばらしい。また来ます。」と言って、帰りました。", "いくらですか？"],
    ["डॉ. मेरन ने 23.8 किलोमीटर चला। ", "कल गया?"],
    ["ครูอ่านหนังสือ 16 ครั้งต่อปีค่ะ ", "นักเรียนชอบ ตลาด และบ้านมากครับ"],
    ["راجع د. توفان القاموس، وكان 63.9 دينار. ", "هل قرأ؟ ", "نعم."],
    ["«Это план! Пойдём.» — сказал врач. ", "В 1986 г. фермер ушёл."],
    ["«\xa0Arrêtez\xa0! C’est assez.\xa0» a crié Dalen. ", "Pourquoi\xa0? ", "Oui."],
    ["Am 5. März kam er. ", "„Halt! Das ist falsch.“, rief er."],
]


def test_cases():
    for parts in CASES:
        text = "".join(parts)
        starts = [sum(map(len, parts[:k])) for k in range(len(parts))]
        assert S.split_points(text, MODEL) == starts, (text, S.split_points(text, MODEL))


def test_document_evidence_comes_before_the_corpus():
    bare = S.CorpusModel({})
    assert S.split_points("He met sgt. blue. Then sgt. Brown left.", bare) == [0, 18]


def test_document_evidence_decides_against_the_corpus():
    corpus = {("low", w): 50 for w in ("the", "then", "it", "we")} | {("dot", "Gen"): 40, ("pair", "Gen Tovan"): 40}
    m = S.CorpusModel(corpus)
    assert "Gen" in m.title
    assert S.split_points("He is gen. staff, Gen. and more. The Gen. Tovan left.", m) == [0, 33]
    assert S.split_points("They met Brown in the U.S. Brown stayed.", m) == [0]
    assert S.split_points("They met in the U.S. Brown stayed.", m) == [0, 21]


def test_letters_and_dotted_tokens():
    m = S.CorpusModel({("low", w): 50 for w in ("the", "then", "it", "he")} | {("dot", "Fig"): 30, ("dd", "Fig"): 30})
    for parts in (
        ["We chose plan B. ", "Then we left the house."], ["Take vitamin C. ", "It helps."], ["J. V. Temgor came. ", "Then he left."],
        ["He bought it in the U.S. ", "Later he sold it."], ["See fig. 3. ", "It helps."], ["See Fig. 3 here."],
        ["‘Wait. It is cold,’ he said. ", "It’s over."], ["'Wait. It is cold,' he said. ", "The dogs' bowl is here. ", "It helps."],
        ["The ‘expert’ left. ", "It was late. ", "‘Stop,’ he said."],
    ):
        text = "".join(parts)
        assert S.split_points(text, m) == [sum(map(len, parts[:k])) for k in range(len(parts))], (text, S.split_points(text, m))


def test_edges():
    for text in ("", "  \n ", "\n\n"):
        assert S.split_points(text, MODEL) == []
    assert S.split_points("  x", MODEL) == [2]
    assert S.split_points("Open “quote. The end (too. Here.", MODEL) == [0, 13, 27]
    assert len(S.split_points("It is here. " * 20_000, MODEL)) == 20_000
    assert S.split_points("。。。!!!...???", MODEL)[0] == 0


def test_rare_language_keeps_its_evidence(spark):
    rows = [(f"w{chr(97 + i % 26)}{chr(97 + i // 26)} here again.", "en") for i in range(400)] + [("wegen usw. und so weiter", "de")] * 2
    df = spark.createDataFrame(rows, "text string, lang string")
    m = S.corpus_model(df, min_share=0.01)
    assert "wegen" in m.low and "usw" in m.abbreviation and "wab" not in m.low
    assert "wegen" not in S.corpus_model(df.drop("lang"), min_share=0.01).low


def test_operator(spark):
    rows = [(1, "Mr. Wim left. It rained.", "old"), (2, None, "x"), (3, "", None), (1, "Mr. Wim left. It rained.", "old")]
    df = spark.createDataFrame(rows, "ctx_id bigint, text string, sents string").selectExpr("*", "7 as sent_start", "8 as _id")
    got = sorted(tuple(r) for r in S.find_sentences(df).collect())
    assert got[0] == (1, 0) and len(got) % 2 == 0
    out = S.add_sentences(df).collect()
    assert len(out) == 4 and [x["text"] for x in out[0]["sents"]][-1] == "It rained." and out[1]["sents"] == [] and out[2]["sents"] == []
    assert S.find_sentences(df.limit(0)).count() == 0
