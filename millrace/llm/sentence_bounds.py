"""Sentence boundaries across languages and scripts.

A full stop is ambiguous after an abbreviation, a number or an initial. It is settled in two
steps: first by what the same document shows beyond doubt (a word followed by a stop and then
by a small letter is an abbreviation here; a word written small, or opening a line, can open a
sentence here; a word in capitals amid a sentence is a name here), and only where the document
is silent by the same evidence counted over the whole corpus. Where both are silent, a new word
in capitals opens a sentence after letters in capitals (`U.S.`), but not after an initial or an
abbreviation in small letters. Scripts have their
own terminators: ideographic and Indic stops are never ambiguous, Thai ends a sentence with a
polite particle before a space, the ASCII stop ends nothing in CJK and Devanagari text. Quoted
speech and brackets are matched first and never cut inside.

The corpus evidence is counted in one pass with partial counts per task. Only keys that make
up at least `min_share` of their kind in a language are kept, so the table handed to the tasks has
at most `languages * kinds / min_share` entries whatever the size of the corpus.

Defined cases: null text gives no sentences (an empty array in `add_sentences`), as do empty
and blank texts; unbalanced quotes and brackets protect nothing.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MIN_SHARE = 1e-5

# Marks of the scripts.
OPEN = {"‘": "’", "'": "'", "“": "”", "„": "“”", "«": "»", "「": "」", "『": "』", "(": ")", "（": "）", "[": "]", "【": "】", "《": "》", "〈": "〉"}
CLOSE = set("”»」』)）]】》〉")
QUOTES = set('"“”„«»「」『』‘’\'')
THAI_END = ("ครับผม", "ครับ", "ค่ะ", "คะ", "จ้ะ", "จ๊ะ", "นะ")
SAID = (
    "said says asked asks answered replied cried called shouted whispered added wondered "
    "explained exclaimed declared demanded repeated remarked thought began continued told"
).split()
ZH_GOES_ON = ("然后", "接着", "随后", "便", "就", "又", "并", "于是", "说", "问", "答", "喊", "道", "他说", "她说")
JA_GOES_ON = ("と", "って", "という", "など", "を", "が", "は", "の", "に", "も", "で")

_MARK = re.compile(r'["“”„«»「」『』()（）\[\]【】《》〈〉‘]|(?<=[^\w\s])[’\'](?!\w)|(?<=[^\W_sS])’(?!\w)|(?:(?<=\s)|\A)\'(?=[^\W\d_a-z])|\n[^\S\n]*\n')
_EVENT = re.compile(r"[.!?…。！？｡।॥؟۔]+|\n\s*|(?<=[ก-๛])[^\S\n]+")
_BEFORE = re.compile(r"\w(?:[\w.’'\-]*\w)?$")
_WORD = re.compile(r"[^\W\d_][\w’'\-]*")
_INITIAL = re.compile(r"(?<!\w)[^\W\d_]\.\s?$")
_LABEL = re.compile(r"(?:[^\W\d_][\w.]{0,14}(?: [A-Z][\w.]{0,14})?)[:：]\s")
_ATTRIBUTION = re.compile(r"(?:[\w’'\-.]+ ){1,4}?(?:" + "|".join(SAID) + r")\b")
_DOT = re.compile(r"(?<![.\s])\.(?!\.)")
_CJK = re.compile(r"[぀-ヿ㐀-鿿豈-﫿]")
_INDIC = re.compile(r"[ऀ-ॿ]")
_THAI = re.compile(r"[฀-๿]")
_WORDS = re.compile(r"(?<![\w.])[^\W\d_][\w’'\-]*")
_AMID = re.compile(r"(?<=[^\W\d_])[^\S\n]([^\W\d_][\w’'\-]*)")
_OPENING = re.compile(r"(?:\A|\n|[!?][”\"]?[^\S\n]+)(?:[^\W\d_][\w.]{0,10}: )?([^\W\d_][\w’'\-]*)")


def _next_kind(text: str, i: int) -> tuple[str, str, int]:
    """Kind and word of what follows position i, and where it stands.

    Kinds: `low`, `cap`, `num`, `open` (quote or bracket), `mark` (comma, dash ...), `other`
    (a letter of a script without case), `end`.
    """
    n = len(text)
    while i < n and text[i].isspace():
        i += 1
    if i >= n:
        return "end", "", i
    c = text[i]
    if c.isdigit():
        return "num", "", i
    if c in OPEN or c == '"':
        return "open", "", i
    if c.isalpha():
        word = _WORD.match(text, i).group()
        return ("low" if c.islower() else "cap" if c.isupper() else "other"), word, i
    return "mark", "", i


def _token_before(text: str, i: int) -> str:
    m = _BEFORE.search(text, max(0, i - 32), i)
    return m.group() if m else ""


def _key(token: str) -> str:
    return "#" if token[-1:].isdigit() else token


def document_evidence(text: str) -> dict[str, Counter]:
    """Unambiguous occurrences in one document, by kind of evidence."""
    ev = {k: Counter() for k in ("low", "start", "amid", "dot", "dl", "dd", "pair")}
    for m in _WORDS.finditer(text):
        if m.group()[0].islower():
            ev["low"][m.group()] += 1
    for m in _OPENING.finditer(text):
        if m.group(1)[0].isupper():
            ev["start"][m.group(1)] += 1
    for m in _AMID.finditer(text):
        if m.group(1)[0].isupper() and text[m.start() - 1].islower():
            ev["amid"][m.group(1)] += 1
    for m in _DOT.finditer(text):
        token = _token_before(text, m.start())
        if not token or text[m.end() : m.end() + 1] in CLOSE or text.startswith('"', m.end()):
            continue
        token, (kind, word, at) = _key(token), _next_kind(text, m.end())
        if at == m.end() and kind != "mark":
            continue
        ev["dot"][token] += 1
        if kind == "low" or (kind == "mark" and text[at] in ",;:،؛"):
            ev["dl"][token] += 1
        elif kind == "num":
            ev["dd"][token] += 1
        elif kind == "cap":
            ev["pair"][f"{token} {word}"] += 1
        elif kind == "open":
            ev["pair"][f"{token} \""] += 1
    return ev


class CorpusModel:
    """Corpus-wide evidence about stops and sentence openings."""

    def __init__(self, counts: dict[tuple[str, str], int]):
        self.low = {k for (kind, k) in counts if kind == "low"}
        self.start = {k for (kind, k) in counts if kind == "start"}
        self.amid = {k for (kind, k) in counts if kind == "amid"}
        self.abbreviation: set[str] = set()
        self.numeric: set[str] = set()
        self.title: set[str] = set()
        commons: Counter = Counter()
        cased: Counter = Counter()
        for (kind, k), n in counts.items():
            if kind == "pair":
                token, word = k.split(" ", 1)
                if word == '"' or word.lower() in self.low:
                    commons[token] += n
                else:
                    cased[token] += n
        for (kind, token), n in counts.items():
            if kind != "dot":
                continue
            low, num = counts.get(("dl", token), 0), counts.get(("dd", token), 0)
            if token == "#":
                continue
            if low >= 2 and low >= 0.2 * n:
                self.abbreviation.add(token)
            if num >= 3 and num >= 0.6 * n:
                self.numeric.add(token)
            rest = n - low - num - commons[token]
            if n >= 8 and len(token) <= 5 and commons[token] <= 0.1 * n and cased[token] and rest >= 0.8 * n:
                self.title.add(token)


def _spans(text: str) -> list[tuple[int, int]]:
    """Outermost matched quotes and brackets as (first, last) positions."""
    stack: list[tuple[str, int]] = []
    found: list[tuple[int, int]] = []
    for m in _MARK.finditer(text):
        c, i = m.group()[0], m.start()
        if c == "\n":
            stack.clear()
            continue
        at = None
        if c in "’'":
            at = next((j for j in range(len(stack) - 1, -1, -1) if c in OPEN.get(stack[j][0], "")), None)
            if at is None:
                if c == "'" and text[i + 1 : i + 2].isupper():
                    stack.append((c, i))
                continue
        elif c == '"':
            at = next((j for j in range(len(stack) - 1, -1, -1) if stack[j][0] == '"'), None)
            if at is None:
                if i + 1 < len(text) and not text[i + 1].isspace():
                    stack.append((c, i))
                continue
        elif c in CLOSE or (c == "“" and stack and stack[-1][0] == "„"):
            at = next((j for j in range(len(stack) - 1, -1, -1) if c in OPEN.get(stack[j][0], "")), None)
            if at is None:
                continue
        else:
            stack.append((c, i))
            continue
        found.append((stack[at][1], i))
        del stack[at:]
    found.sort()
    outer: list[tuple[int, int]] = []
    for a, b in found:
        if not outer or a > outer[-1][1]:
            outer.append((a, b))
    return outer


def _wrapped(text: str, spans: list[tuple[int, int]]) -> bool:
    """Line ends of a text without spaces are wrapping where full lines are alike long and
    sentences end in the middle of lines."""
    lengths = [len(x.strip()) for x in text.split("\n")[:-1] if x.strip()]
    if len(lengths) < 3 or max(lengths) - min(lengths) > 3:
        return False
    inside = lambda i: any(a < i < b for a, b in spans)
    return any(not inside(m.start()) for m in re.finditer(r"[。！？｡](?=[^\n])", text))


def split_points(text: str, model: CorpusModel) -> list[int]:
    """Starts of the sentences of a text."""
    n = len(text)
    start = 0
    while start < n and text[start].isspace():
        start += 1
    if start >= n:
        return []
    starts = [start]
    evidence: dict[str, Counter] = {}
    n_cjk, n_indic = len(_CJK.findall(text)), len(_INDIC.findall(text))
    cjk, indic = n_cjk * 4 > n, n_indic * 4 > n
    no_case = cjk or bool(_THAI.search(text))
    spans = _spans(text)
    wrapped = no_case and "\n" in text and _wrapped(text, spans)
    si = 0

    def here() -> dict[str, Counter]:
        if not evidence:
            evidence.update(document_evidence(text))
        return evidence

    def opens(word: str, silent: bool = False) -> bool:
        """The word can open a sentence: by this document, else by the corpus, else `silent`."""
        ev = here()
        small = word[:1].lower() + word[1:]
        if ev["low"][small] or ev["start"][word]:
            return True
        if small in model.low or word in model.start:
            return True
        return silent and not ev["amid"][word] and word not in model.amid

    def common(word: str) -> bool:
        small = word[:1].lower() + word[1:]
        return bool(here()["low"][small]) or small in model.low

    def stop_ends(i: int, after: int) -> bool:
        """A single ASCII stop at i, with closing marks up to `after`, ends its sentence."""
        if cjk or indic:
            return False
        token = _token_before(text, i)
        kind, word, at = _next_kind(text, after)
        if kind in ("low", "mark"):
            return kind == "mark" and text[at] not in ",;:،؛.-–—)]…%" and at > after
        if at == after and kind != "end":
            if kind == "open":
                return bool(token) and token[-1].islower()
            if not token or token in model.numeric or token in model.title:
                return False
            if kind == "num":
                return len(token) > 3 and token.isalpha() and token[-1].islower() and token not in model.abbreviation
            if kind == "other":
                return len(token) > 1 and token.isalpha()
            if kind != "cap" or len(word) < 2:
                return False
            if len(token) > 1 and "." not in token and token[-1].islower():
                return common(word) or word in model.start or len(token) > 3
            return "." in token and opens(word)
        if not token:
            return True
        if token[-1].isdigit():
            if kind != "cap":
                return kind != "num" or len(token) > 2
            return opens(word)
        if len(token) == 1 and token.isalpha():
            if kind != "cap":
                return kind == "end"
            return len(word) > 1 and common(word) and not here()["amid"][word] and not _INITIAL.search(text, max(0, i - 8), i - 1)
        ev = here()
        names = set()
        if token[0].isupper() and len(token) <= 5:
            names = {p for p in ev["pair"] if p.startswith(token + " ") and not p.endswith('"') and not opens(p[len(token) + 1 :])}
        other_case = {token, token.lower(), token.capitalize()}
        if kind == "num":
            return not (ev["dd"][token] > 1 or other_case & model.numeric)
        if len(names) > 1 and not ev["dl"][token] and "." not in token:
            return kind != "cap" or common(word)
        if token in model.title and not ev["dl"][token]:
            return kind != "cap" or common(word)
        if token in model.abbreviation or ev["dl"][token] or "." in token:
            if kind in ("open", "end"):
                return True
            if kind == "other":
                return not (token in model.abbreviation or ev["dl"][token])
            return opens(word, silent=token.isupper()) or bool(_LABEL.match(text, at))
        return True

    def quote_ends(a: int, b: int) -> bool:
        """A quotation from a to b that closes on a terminator ends the sentence around it."""
        kind, word, at = _next_kind(text, b + 1)
        if kind == "end":
            return True
        if kind in ("low", "mark"):
            return False
        before = text[starts[-1] : a]
        before = before[m.end() :] if (m := _LABEL.match(before)) else before
        led = any(c.isalnum() for c in before)
        if _CJK.match(text[at]):
            return not text.startswith(JA_GOES_ON if text[b] in "」』" else ZH_GOES_ON, at)
        if _INDIC.match(text[at]) or _THAI.match(text[at]):
            return not word.startswith(("और", "फिर", "तथा"))
        if led or kind in ("num", "open"):
            return True
        return not _ATTRIBUTION.match(text, at)

    def cut(i: int) -> None:
        while i < n and text[i].isspace():
            i += 1
        if i < n and i > starts[-1]:
            starts.append(i)

    pos = 0
    while True:
        m = _EVENT.search(text, pos)
        at = m.start() if m else n
        if si < len(spans) and spans[si][0] <= at:
            a, b = spans[si]
            si += 1
            pos = b + 1
            inner = b - 1
            while inner > a and (text[inner].isspace() or text[inner] in CLOSE):
                inner -= 1
            if text[b] in QUOTES and text[inner] in ".!?…。！？।॥؟" and inner > a:
                follow = b + 1
                if follow < n and text[follow] in ".!?。！？।":
                    continue
                if quote_ends(a, b):
                    cut(b + 1)
            continue
        if not m:
            break
        s, pos = m.group(), m.end()
        if s[0] == "\n":
            nxt = _LABEL.match(text, pos)
            line = text[text.rfind("\n", 0, at) + 1 : at]
            if s.count("\n") > 1 or nxt:
                cut(pos)
            elif no_case and at and (_CJK.match(text[at - 1]) or _THAI.match(text[at - 1])):
                if not wrapped:
                    cut(pos)
            elif _is_heading(text, line, at, pos, starts[-1]):
                cut(pos)
            continue
        if s[0].isspace():
            if text[:at].endswith(THAI_END):
                cut(pos)
            continue
        after = pos
        while after < n and text[after] in "”\"»’)]」』）" and not text[after].isspace():
            if si < len(spans) and spans[si][0] == after:
                break
            after += 1
        last = s[-1]
        if last in "。！？｡।॥؟۔" or (last in "!?" and (cjk or indic)):
            nxt = text[after : after + 1]
            if nxt and nxt in "，、；,;":
                continue
            cut(after)
        elif s == ".":
            if stop_ends(at, after):
                cut(after)
        else:
            kind, word, where = _next_kind(text, after)
            if kind in ("cap", "num", "open", "other") and (where > after or kind in ("cap", "open")):
                cut(after)
    return starts


def _is_heading(text: str, line: str, at: int, nxt: int, start: int) -> bool:
    """A short line in title case that stands alone before a line in capitals."""
    if not text.startswith(line, start) or start + len(line) != at or len(line) > 50:
        return False
    words = line.split()
    if not words or len(words) > 8 or not text[nxt : nxt + 1].isupper():
        return False
    if text[nxt:].split("\n", 1)[0] and len(text[nxt:].split("\n", 1)[0]) < 1.5 * len(line):
        return False
    return all(w[0].isupper() or w[0].isdigit() or len(w) <= 3 for w in words) and line[-1].isalnum()


def corpus_model(
    df: DataFrame, text_col: str = "text", min_share: float = MIN_SHARE, lang_col: str = "lang"
) -> CorpusModel:
    """Count evidence over all rows; keep keys of at least `min_share` of their kind in a language.

    Without a column `lang_col` all rows are one language.
    """

    def frame(total: dict[tuple[str | None, str], Counter]) -> pd.DataFrame:
        rows = [(lang, k, w, n) for (lang, k), c in total.items() for w, n in c.items()]
        return pd.DataFrame(rows, columns=["lang", "kind", "key", "n"])

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: dict[tuple[str | None, str], Counter] = {}
        for batch in batches:
            for lang, text in zip(batch["_lang"], batch["_text"]):
                for kind, c in document_evidence(text).items():
                    total.setdefault((lang, kind), Counter()).update(c)
            if sum(map(len, total.values())) > 200_000:
                yield frame(total)
                total = {}
        if total:
            yield frame(total)

    lang = F.col(lang_col).cast("string") if lang_col in df.columns else F.lit(None).cast("string")
    texts = df.where(F.col(text_col).isNotNull()).select(
        F.coalesce(lang, F.lit("")).alias("_lang"), F.col(text_col).alias("_text")
    )
    counts = (
        texts.mapInPandas(count, "lang string, kind string, key string, n bigint")
        .groupBy("lang", "kind", "key")
        .agg(F.sum("n").alias("n"))
    )
    kinds = counts.groupBy("lang", "kind").agg(F.sum("n").alias("total"))
    shares = counts.join(kinds, ["lang", "kind"]).groupBy("kind", "key").agg(
        F.sum("n").alias("n"), F.max(F.col("n") / F.col("total")).alias("share")
    )
    kept = shares.where(F.col("share") >= F.lit(min_share))
    return CorpusModel({(r["kind"], r["key"]): r["n"] for r in kept.select("kind", "key", "n").collect()})


def find_sentences(
    df: DataFrame, id_col: str = "ctx_id", text_col: str = "text", model: CorpusModel | None = None
) -> DataFrame:
    """(id, sent_start) of every sentence, positions in code points from 0."""
    model = model or corpus_model(df, text_col)
    rows = df.where(F.col(text_col).isNotNull()).select(
        F.col(id_col).alias("_id"), F.col(text_col).alias("_text")
    )
    id_type = rows.schema["_id"].dataType.simpleString()
    shared = df.sparkSession.sparkContext.broadcast(model)

    def split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            points = [split_points(t, shared.value) for t in batch["_text"]]
            sizes = [len(p) for p in points]
            yield pd.DataFrame(
                {"_id": batch["_id"].repeat(sizes), "sent_start": pd.Series([x for p in points for x in p], dtype="int32").values}
            )

    return rows.mapInPandas(split, f"_id {id_type}, sent_start int").select(
        F.col("_id").alias(id_col), "sent_start"
    )


def add_sentences(
    df: DataFrame,
    text_col: str = "text",
    out_col: str = "sents",
    model: CorpusModel | None = None,
) -> DataFrame:
    """All rows and columns of `df` with `out_col` holding array<struct<id int, text string>>.

    An existing `out_col` is replaced. White space inside a sentence is kept, around it is not.
    """
    shared = df.sparkSession.sparkContext.broadcast(model or corpus_model(df, text_col))

    @F.pandas_udf("array<struct<id int, text string>>")
    def split(texts: pd.Series) -> pd.Series:
        out = []
        for t in texts:
            points = split_points(t, shared.value) if isinstance(t, str) else []
            ends = points[1:] + [len(t)] if points else []
            out.append([{"id": k, "text": t[a:b].strip()} for k, (a, b) in enumerate(zip(points, ends))])
        return pd.Series(out)

    return df.withColumn(out_col, split(F.col(text_col)))
