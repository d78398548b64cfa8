"""Repair of text read from scanned pages.

Words are decoded line by line with a noisy channel: every word has candidate readings reached
by undoing character confusions, a reading costs its confusion probabilities, and the line's
best sequence under the corpus n-grams is found by Viterbi. The probability of each confusion is
estimated from the corpus by expectation maximisation: words that misreadings of other words
explain better than words of their own are counted as such, and the confusions they took are set
against the places where they could have happened. Words the corpus does not know are
scored by a character n-gram model of all its words, so that made-up names keep their spelling
unless a confusion clearly explains them better. Line furniture is settled first: page numbers
by their form, running headers by form, by interrupting a sentence and by repeating within
their document, against headings, which stand once in many documents. A word cut at a line end
is joined over page breaks; a compound known with its hyphen keeps it.

Corpus counts (words, word pairs, character 4-grams, title lines) are gathered in one pass with
partial counts per task. Keys below `min_share` of their kind are dropped, so the model handed to
the tasks has at most `kinds / min_share` entries whatever the size of the corpus.

Defined cases: null texts give no defects and stay null; empty texts stay empty; a text of
nothing but furniture becomes empty. Line numbers count from 0 between \\n characters.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from itertools import product

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MIN_SHARE = {"word": 1e-6, "pair": 2e-6, "gram": 1e-7, "title": 1e-4, "again": 1e-6, "cuts": 1e-6, "compound": 1e-6}
#: Probability of a confusion before any is seen, which counts as so many places without evidence.
CONFUSION = 4e-4
PLACES = 20_000
ROUNDS = 3
UNKNOWN = 0.02
#: Least log probability of the letters of a word, when its count is weighed against misreadings.
RAREST = -20.0
NOISE = 0.01

# What a reader makes of what was printed, as misread form: printed forms.
CONFUSIONS = {
    "0": "o", "1": "l i", "5": "s", "6": "b", "9": "g", "@": "a", "!": "i l", "8": "b", "3": "e", "$": "s", "|": "l i", "4": "a",
    "rn": "m", "cl": "d", "ri": "n", "ii": "u", "vv": "w", "nn": "m", "lc": "k", "tl": "d", "li": "h",
    "m": "rn nn", "d": "cl", "n": "ri u", "u": "n ii", "w": "vv", "f": "t", "t": "f", "c": "e", "e": "c",
    "b": "h", "h": "b li k", "y": "v", "v": "y", "l": "i", "i": "l", "o": "c", "a": "o", "q": "g", "j": "i", "k": "lc", "z": "s",
}
_UNDO = {bad: tuple(good.split()) for bad, good in CONFUSIONS.items()}
SIGNS = set("015698@!34$|")

_TOKEN = re.compile(r"(?:[^\W_]|[@|$]|!(?=[^\W_]))+(?:[’'\-](?:[^\W_]|[@|$]|!(?=[^\W_]))+)*")
_SPLIT = re.compile(r"[’'\-]")
_NUMBER = re.compile(r"\d+(?:s|st|nd|rd|th|am|pm|kg|km|cm|mm|m)?$", re.IGNORECASE)
_PAGE_NO = re.compile(
    r"[\W_]*(?:(?:page|p[.]?)\s*)?(?:\d{1,4}|[ivxlc]{1,8})(?:\s*(?:of|/)\s*\d{1,4})?[\W_]*$|\s*\d{1,4}\s*[|]\s*page\s*$", re.IGNORECASE
)
_NUM_EDGE = re.compile(r"^\s*\d{1,4}\s{2,}|\s{2,}\d{1,4}\s*$")
HYPHENS = "-¬‐­‑"
_SMALL = {"a", "an", "and", "at", "by", "for", "in", "of", "on", "the", "to", "with"}
_PLAIN = str.maketrans({"0": "o", "1": "l", "5": "s", "6": "b", "9": "g", "@": "a", "!": "i"})


def _title_key(line: str) -> str | None:
    """Case-folded title of a line in title case or capitals, without a page number at its
    edge, other figures masked; None for lines of running text."""
    body = _NUM_EDGE.sub("", line).strip()
    if not body or body[-1] in ".!?,;:”\"’)" + HYPHENS:
        return None
    words = body.split()
    letters = False
    for w in words:
        c = w[0]
        if c.isalpha():
            letters = True
            if c.islower() and w not in _SMALL:
                return None
        elif c in "“\"£$€–—":
            return None
        elif c.isdigit() and not w.isdigit():
            letters = True
    if not letters:
        return None
    return re.sub(r"(?<!\w)\d+(?!\w)", "#", body).translate(_PLAIN).lower()


def _is_page_no(line: str) -> bool:
    s = line.strip("\f ")
    return bool(s) and bool(_PAGE_NO.match(s))


def _furniture(lines: list[str]) -> list[str]:
    """`page_no`, `blank`, `title` (heading or header) or `text` for each line."""
    kinds = []
    for line in lines:
        s = line.strip("\f \r\t")
        if not s:
            kinds.append("blank")
        elif _is_page_no(s):
            kinds.append("page_no")
        elif _title_key(s) is not None:
            kinds.append("title")
        else:
            kinds.append("text")
    return kinds


def _cuts_sentence(lines: list[str], kinds: list[str], i: int) -> bool:
    """The text around line i runs on over it."""
    before = next((lines[j].strip() for j in range(i - 1, -1, -1) if kinds[j] == "text"), "")
    after = next((lines[j].strip() for j in range(i + 1, len(lines)) if kinds[j] == "text"), "")
    if not before or not after:
        return False
    return before[-1] not in ".!?:”\"" or after[:1].islower()


def _tokens(line: str) -> list[str]:
    return [p for m in _TOKEN.finditer(line) for p in _SPLIT.split(m.group().lower()) if p]


def document_counts(text: str, total: dict[str, Counter]) -> None:
    """Add one document's words, word pairs, 4-grams and title lines to `total`."""
    lines = text.split("\n")
    kinds = _furniture(lines)
    titles: Counter = Counter()
    cuts: set[str] = set()
    carry = False
    for i, (line, kind) in enumerate(zip(lines, kinds)):
        if kind == "title":
            key = _title_key(line.strip("\f \r\t"))
            titles[key] += 1
            if _cuts_sentence(lines, kinds, i):
                cuts.add(key)
        if kind != "text":
            continue
        words = _tokens(line)
        for m in _TOKEN.finditer(line):
            if "-" in m.group():
                total["compound"][m.group().lower()] += 1
        if carry:
            words = words[1:]
        carry = line.rstrip()[-1:] in HYPHENS and line.strip() != "-"
        if carry:
            words = words[:-1]
        total["word"].update(words)
        total["pair"].update(zip(words, words[1:]))
    for key, n in titles.items():
        total["title"][key] += 1
        if n > 1:
            total["again"][key] += 1
    for key in cuts:
        total["cuts"][key] += 1


def _grams(word: str) -> list[str]:
    w = "^^^" + word + "$"
    return [w[i : i + 4] for i in range(len(w) - 3)]


class ScanModel:
    """Corpus n-grams, title evidence and the decoder."""

    def __init__(self, counts: dict[str, dict]):
        self.word: dict[str, int] = counts.get("word", {})
        self.pair: dict[tuple[str, str], int] = counts.get("pair", {})
        self.compound: dict[str, int] = counts.get("compound", {})
        self.n = max(1, sum(self.word.values()))
        grams: dict[str, int] = counts.get("gram", {})
        self.orders: list[dict[str, int]] = [Counter(), Counter(), Counter(), dict(grams)]
        self.context: list[dict[str, int]] = [Counter(), Counter(), Counter(), Counter()]
        for g, n in grams.items():
            for k in range(4):
                if k < 3:
                    self.orders[k][g[3 - k :]] += n
                self.context[k][g[3 - k : 3]] += n
        self.headings = set()
        for key, docs in counts.get("title", {}).items():
            again, cut = counts.get("again", {}).get(key, 0), counts.get("cuts", {}).get(key, 0)
            if docs >= 5 and again <= 0.05 * docs and cut <= 0.25 * docs:
                self.headings.add(key)
        self._memo: dict[str, tuple] = {}
        self.channel = {(bad, good): math.log(CONFUSION) for bad, goods in _UNDO.items() for good in goods}
        self._learn()

    def _learn(self) -> None:
        """Estimate the channel, then drop the words that it explains and their pairs.

        A counted word is a misreading when it mixes letters and signs, when it stands at most
        `NOISE` times as often as a word one confusion away, or when the misreadings expected of
        such words account for its count better than a word of its own does.
        """
        near = {w: o for w in self.word if (o := [(c, edit) for c, edit in self._one_undone(w) if c in self.word])}
        mixed = {w for w in self.word if any(c in SIGNS for c in w) and not _NUMBER.match(w)}
        alone = {w: math.log(self.n * UNKNOWN) + max(self.spelled(w), RAREST) for w in near}
        noise: set[str] = set()
        for _ in range(ROUNDS):
            noise, taken = set(mixed), Counter()
            for w, origins in near.items():
                if _NUMBER.match(w):
                    continue
                n = self.word[w]
                rates = [self.word[c] * math.exp(self.channel[e]) for c, e in origins]
                rate = sum(rates)
                misread = n * math.log(rate) - rate - math.lgamma(n + 1)
                if w in mixed or misread > alone[w] - math.log(n * (n + 1)) or any(self.word[c] * NOISE >= n for c, _ in origins):
                    noise.add(w)
                    for r, (_, e) in zip(rates, origins):
                        taken[e] += n * r / rate
            places: Counter = Counter()
            for w, n in self.word.items():
                if w not in noise:
                    for bad, good in self.channel:
                        k = w.count(good)
                        if k:
                            places[bad, good] += k * n
            self.channel = {e: math.log((taken[e] + PLACES * CONFUSION) / (places[e] + PLACES)) for e in self.channel}
        self.word = {w: n for w, n in self.word.items() if w not in noise}
        self.pair = {p: n for p, n in self.pair.items() if p[0] not in noise and p[1] not in noise}

    @staticmethod
    def _one_undone(word: str) -> Iterator[tuple[str, tuple[str, str]]]:
        """Readings one undone confusion away, each with the confusion."""
        for i in range(len(word)):
            for width in (1, 2):
                bad = word[i : i + width]
                if len(bad) == width:
                    for good in _UNDO.get(bad, ()):
                        yield word[:i] + good + word[i + width :], (bad, good)

    def spelled(self, word: str, read: bool = False) -> float:
        """Log probability of a word's letters under the interpolated 4-gram model; of a word as
        `read`, by what the model counted elsewhere."""
        less = int(read and word.isalpha())
        return sum(self._letter(g, less) for g in _grams(word))

    def _letter(self, gram: str, less: int = 0) -> float:
        """Log probability of the last letter of a 4-gram after the others."""
        p = 1e-4
        for k in range(4):
            seen = self.context[k].get(gram[3 - k : 3], 0) - less
            if seen > 0:
                p = 0.25 * p + 0.75 * max(0, self.orders[k].get(gram[3 - k :], 0) - less) / seen
        return math.log(p)

    def prior(self, word: str, read: bool = False) -> float:
        """Log probability of a word; of a word as `read`, by its other occurrences."""
        n = self.word.get(word, 0) - read
        if n > 0:
            return math.log(n / self.n)
        return math.log(UNKNOWN) + self.spelled(word, read)

    def _undone(self, word: str, edits: int) -> dict[str, tuple[float, int, int]]:
        """Readings within `edits` undone confusions: reading -> (log probability, edits, first position)."""
        found = {word: (0.0, 0, len(word))}
        frontier = dict(found)
        for _ in range(edits):
            fresh: dict[str, tuple[float, int, int]] = {}
            for w, (p, k, first) in frontier.items():
                for i in range(len(w)):
                    for width in (1, 2):
                        bad = w[i : i + width]
                        if len(bad) < width:
                            continue
                        for good in _UNDO.get(bad, ()):
                            c = w[:i] + good + w[i + width :]
                            reached = (p + self.channel[bad, good], k + 1, min(first, i))
                            if c not in found or (c in fresh and fresh[c] < reached):
                                found[c] = fresh[c] = reached
            frontier = fresh
        return found

    def _signs_undone(self, word: str) -> list[str]:
        """Readings with every sign undone: all of them, or where there are too many to list,
        those in the vocabulary and the one with the most probable letters."""
        options = [_UNDO[c] if c in SIGNS else (c,) for c in word]
        if math.prod(map(len, options)) <= 4096:
            return ["".join(p) for p in product(*options)]
        fits = re.compile("".join(f"[{''.join(map(re.escape, o))}]" for o in options))
        known = [w for w in self.word if len(w) == len(word) and fits.fullmatch(w)]
        best = {"^^^": (0.0, "")}
        for o in [*options, ("$",)]:
            following: dict[str, tuple[float, str]] = {}
            for state, (score, text) in best.items():
                for c in o:
                    reached = (score + self._letter(state + c), text + c)
                    following[state[1:] + c] = max(following.get(state[1:] + c, reached), reached)
            best = following
        return [*known, max(best.values())[1][:-1]]

    def readings(self, word: str) -> tuple[tuple[str, float, float, int], ...]:
        """(reading, channel log probability, prior, first changed position), best first.

        All signs of a word are undone, and two confusions in all where it has fewer signs. Every
        reading in the vocabulary is kept; of the others only the best, since no word pair can
        speak for one of them.
        """
        if word in self._memo:
            return self._memo[word]
        signs = sum(c in SIGNS for c in word)
        letters = sum(c.isalpha() for c in word)
        if not letters or (signs and _NUMBER.match(word)) or (len(word) < 2 and not signs):
            out = ((word, 0.0, 0.0, -1),)
        else:
            found = {word: (0.0, 0, len(word))}
            start = min((i for i, c in enumerate(word) if c in SIGNS), default=len(word))
            for base in self._signs_undone(word) if signs else [word]:
                p0 = sum(self.channel[a, b] for a, b in zip(word, base) if a in SIGNS)
                for c, (p, k, first) in self._undone(base, max(0, 2 - signs)).items():
                    reached = (p0 + p, k + signs, min(first, start))
                    found[c] = max(found.get(c, reached), reached)
            scored = []
            for c, (p, k, first) in found.items():
                if k and any(x in SIGNS for x in c):
                    continue
                if k > max(1, signs) and c not in self.word:
                    continue
                scored.append((c, p, self.prior(c, read=not k), first if k else -1))
            scored.sort(key=lambda r: -(r[1] + r[2]))
            unknown = next((r for r in scored if r[0] not in self.word), None)
            out = tuple(r for r in scored if r[0] in self.word or r is unknown)
            if all(r[3] >= 0 for r in out):
                out += tuple(r for r in scored if r[3] < 0)
        if len(self._memo) > 300_000:
            self._memo.clear()
        self._memo[word] = out
        return out

    def _step(self, prev: str | None, word: str, prior: float) -> float:
        """Log probability of a word after another, interpolated with its prior."""
        if prev is None:
            return prior
        seen = self.word.get(prev, 0)
        if not seen:
            return prior
        n = self.pair.get((prev, word), 0)
        p = math.exp(prior)
        return math.log(0.6 * n / seen + 0.4 * p) if n else prior + math.log(0.4)

    def decode(self, words: list[str]) -> list[tuple[str, int]]:
        """Best readings of a line's words with the first changed position (-1: as read)."""
        options = [self.readings(w) for w in words]
        if all(len(o) == 1 for o in options):
            return [(o[0][0], o[0][3]) for o in options]
        best: list[list[tuple[float, int]]] = []
        for i, opts in enumerate(options):
            row = []
            for word, channel, prior, _ in opts:
                if i == 0:
                    row.append((channel + prior, -1))
                    continue
                scores = [
                    best[-1][j][0] + self._step(p[0], word, prior) for j, p in enumerate(options[i - 1])
                ]
                j = max(range(len(scores)), key=scores.__getitem__)
                row.append((scores[j] + channel, j))
            best.append(row)
        path = []
        j = max(range(len(best[-1])), key=lambda k: best[-1][k][0])
        for i in range(len(words) - 1, -1, -1):
            path.append((options[i][j][0], options[i][j][3]))
            j = best[i][j][1]
        return path[::-1]

    def joined(self, left: str, right: str) -> bool:
        """A word cut as left-right joins without its hyphen."""
        l, r = left.lower().translate(_PLAIN), right.lower().translate(_PLAIN)
        with_hyphen, without = self.compound.get(f"{l}-{r}", 0), self.word.get((_SPLIT.split(l)[-1] + _SPLIT.split(r)[0]), 0)
        return not with_hyphen > without


def analyse(text: str, model: ScanModel) -> tuple[list[tuple[int, str]], str]:
    """(line_no, defect) pairs of a text and the repaired text."""
    lines = text.split("\n")
    kinds = _furniture(lines)
    defects: list[tuple[int, str]] = []
    keys = Counter(_title_key(x.strip("\f \r\t")) for x, k in zip(lines, kinds) if k == "title")
    for i, kind in enumerate(kinds):
        if kind != "title":
            continue
        s = lines[i].strip("\f \r\t")
        key = _title_key(s)
        numbered = bool(_NUM_EDGE.search(s))
        if numbered or keys[key] > 1 or (key not in model.headings):
            kinds[i] = "header"
        else:
            kinds[i] = "heading"
    for i, kind in enumerate(kinds):
        if kind in ("header", "page_no"):
            defects.append((i, kind))
    body = [i for i, k in enumerate(kinds) if k in ("text", "heading")]
    paragraphs: list[str] = []
    current = ""
    glue = False
    cut: tuple[int, str, bool] | None = None
    for at, i in enumerate(body):
        line = lines[i].strip("\f \r\t")
        tokens = list(_TOKEN.finditer(line))
        words: list[str] = []
        places: list[tuple[int, int]] = []
        for m in tokens:
            start = m.start()
            for p in _SPLIT.split(m.group()):
                if p:
                    words.append(p)
                    places.append((start, start + len(p)))
                start += len(p) + 1
        hyphen = kinds[i] == "text" and line[-1:] in HYPHENS and len(line) > 1 and bool(places) and places[-1][1] == len(line) - 1
        forms = [w.lower() for w in words]
        skip_first = None
        wrong = False
        if cut is not None and forms:
            skip_first = (cut[1] + forms[0]) if cut[2] else None
        if skip_first is not None:
            first_fix = model.decode([skip_first])[0]
            forms[0] = skip_first
            if first_fix[1] >= 0:
                owner = cut[0] if first_fix[1] < len(cut[1]) else i
                if (owner, "misread") not in defects:
                    defects.append((owner, "misread"))
        last = None
        if hyphen:
            nxt = next((lines[j].strip("\f \r\t") for j in body[at + 1 :]), "")
            head = _TOKEN.search(nxt)
            left = tokens[-1].group()
            joins = model.joined(left, head.group()) if head and head.start() == 0 else True
            if joins:
                defects.append((i, "hyphen"))
                last = len(words) - 1
                cut = (i, forms[last] if not (last == 0 and skip_first is not None) else forms[0], True)
            else:
                cut = None
        else:
            cut = None
        use = forms if last is None else forms[:last]
        fixes = model.decode(use) if use else []
        fixed = line
        for k in range(len(use) - 1, -1, -1):
            reading, pos = fixes[k]
            if pos < 0:
                continue
            if k == 0 and skip_first is not None:
                a, b = places[0]
                tail = reading[len(reading) - (b - a) :] if len(reading) == len(forms[0]) else None
                if tail is not None:
                    fixed = fixed[:a] + tail + fixed[b:]
                continue
            wrong = True
            a, b = places[k]
            fixed = fixed[:a] + _recase(reading, words[k], pos) + fixed[b:]
        if wrong and (i, "misread") not in defects:
            defects.append((i, "misread"))
        if kinds[i] == "heading":
            if current:
                paragraphs.append(current)
            paragraphs.append(fixed)
            current, glue = "", False
            continue
        if current and not glue and _paragraph_break(kinds, body, at, current, line):
            paragraphs.append(current)
            current = ""
        current = current + ("" if glue or not current else " ") + fixed
        glue = False
        if hyphen:
            glue = True
            if last is not None:
                current = current[:-1]
    if current:
        paragraphs.append(current)
    return sorted(defects), "\n\n".join(paragraphs)


def _paragraph_break(kinds: list[str], body: list[int], at: int, current: str, line: str) -> bool:
    gap = kinds[body[at - 1] + 1 : body[at]]
    return "blank" in gap and current[-1:] in ".!?”\"" and not line[:1].islower()


def _recase(reading: str, original: str, changed: int) -> str:
    """A reading in the case of the word as read; a capital I read for a small l becomes small."""
    if changed == 0 and original[0] == "I" and reading[0] == "l" and not original.isupper():
        return reading
    if original.isupper() and len(original) > 1:
        return reading.upper()
    if original[:1].isupper() or (original[:1] in SIGNS and original[1:2].isupper()):
        return reading[:1].upper() + reading[1:]
    return reading


def scan_model(df: DataFrame, text_col: str = "text", min_share: dict[str, float] | None = None) -> ScanModel:
    """Corpus counts of all rows, each kind cut at its share."""
    shares = MIN_SHARE | (min_share or {})
    kinds = ("word", "pair", "title", "again", "cuts", "compound")

    def frame(total: dict[str, Counter]) -> pd.DataFrame:
        grams: Counter = Counter()
        for w, n in total["word"].items():
            if w.isalpha():
                for g in _grams(w):
                    grams[g] += n
        rows = [("gram", g, n) for g, n in grams.items()]
        for k in kinds:
            rows += [(k, " ".join(w) if k == "pair" else w, n) for w, n in total[k].items()]
        return pd.DataFrame(rows, columns=["kind", "key", "n"])

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = {k: Counter() for k in kinds}
        for batch in batches:
            for text in batch["_text"]:
                document_counts(text, total)
            if len(total["pair"]) > 400_000:
                yield frame(total)
                total = {k: Counter() for k in kinds}
        yield frame(total)

    texts = df.where(F.col(text_col).isNotNull()).select(F.col(text_col).alias("_text"))
    counts = (
        texts.mapInPandas(count, "kind string, key string, n bigint")
        .groupBy("kind", "key")
        .agg(F.sum("n").alias("n"))
    )
    totals = counts.groupBy("kind").agg(F.sum("n").alias("total"))
    share = F.create_map(*[F.lit(x) for kv in shares.items() for x in kv])
    kept = counts.join(totals, "kind").where(F.col("n") >= F.col("total") * share[F.col("kind")])
    tables: dict[str, dict] = {}
    for r in kept.select("kind", "key", "n").collect():
        key = tuple(r["key"].split(" ")) if r["kind"] == "pair" else r["key"]
        tables.setdefault(r["kind"], {})[key] = r["n"]
    return ScanModel(tables)


def find_defects(
    df: DataFrame, id_col: str = "ctx_id", text_col: str = "text", model: ScanModel | None = None
) -> DataFrame:
    """(id, line_no, defect) of every faulty line."""
    model = model or scan_model(df, text_col)
    rows = df.where(F.col(text_col).isNotNull()).select(
        F.col(id_col).alias("_id"), F.col(text_col).alias("_text")
    )
    id_type = rows.schema["_id"].dataType.simpleString()
    shared = df.sparkSession.sparkContext.broadcast(model)

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = [(i, n, d) for i, t in zip(batch["_id"], batch["_text"]) for n, d in analyse(t, shared.value)[0]]
            yield pd.DataFrame(out, columns=["_id", "line_no", "defect"])

    return rows.mapInPandas(find, f"_id {id_type}, line_no int, defect string").select(
        F.col("_id").alias(id_col), "line_no", "defect"
    )


def repair_scans(
    df: DataFrame, text_col: str = "text", out_col: str = "repaired", model: ScanModel | None = None
) -> DataFrame:
    """All rows and columns of `df` with the repaired text in `out_col` (replaced if present)."""
    shared = df.sparkSession.sparkContext.broadcast(model or scan_model(df, text_col))

    @F.pandas_udf("string")
    def repair(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: analyse(t, shared.value)[1] if isinstance(t, str) else None)

    return df.withColumn(out_col, repair(F.col(text_col)))
