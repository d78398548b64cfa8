"""Text that was read in the wrong character encoding.

A wrong reading is a chain of steps (stored in `wrote`, read as `read`); undoing a step turns
stretches of characters back into the bytes that `read` gives for them and decodes those with
`wrote`. For every step the stretches it could undo are found, each with its surroundings; the
surroundings are compressed as they stand and as decoded, with a zstandard dictionary for each language, and the smaller size over the languages is the description length. A step pays
where it saves more than its own cost, on the stretches that it makes shorter. The step that
saves most is undone, then again, for texts garbled twice, until none pays; where none does at
all the text stays unchanged. (Trying every paying step as the first of a chain took ten times
as long and restored fewer texts.)

What was lost for good - the replacement character, stray control and private-use characters -
marks a text as affected too, whether or not anything can be restored.

Nothing is fitted on a sample. Over all texts, whole, but those with signs of garbling, pairs of
neighbouring characters and pieces (words that hold characters beyond ASCII, alone and with their
neighbours) are counted by language. A language's dictionary is the `DICTIONARY` bytes of pieces that
have most bytes in all its texts, of the `PIECES` first that stand in at least `PIECE_SHARE` of them,
those with an unusual pair left out. So the tables are bounded whatever the input. The languages are
the `MOST_LANGUAGES` most frequent labels. All texts are then judged, whole.

Defined cases: null text is never affected; empty and ASCII texts are unaffected at once; a
language without pieces adds no dictionary; a table without any usable text is judged by plain
zstandard.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import chain, filterfalse
from operator import add

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.plans.checkpoints import cut

MOST_LANGUAGES = 32
PIECES = 8_000
PIECE_SHARE = 2e-4
DICTIONARY = 65536
CONTEXT = 28
STEP_COST = 3
STRETCH_COST = 2
ESCAPE = 2
SHORT = 48
LEVEL = 3
PAIR_SHARE = 0.005

#: (wrote, read): how the text was stored, how it was read. In the order they are tried.
STEPS = (
    ("utf-8", "cp1252"), ("utf-8", "latin-1"), ("utf-8", "gb18030"), ("utf-8", "cp437"), ("utf-8", "mac_roman"),
    ("gb18030", "cp1252"), ("gb18030", "latin-1"), ("cp1252", "mac_roman"), ("utf-8", "cp1251"), ("utf-8", "cp932"),
    ("cp932", "cp1252"), ("cp932", "latin-1"), ("cp1251", "cp1252"), ("cp1251", "latin-1"), ("koi8_r", "cp1251"),
    ("cp1251", "koi8_r"), ("koi8_r", "cp1252"), ("mac_roman", "cp1252"), ("cp1252", "cp437"),
    ("utf-8", "cp850"), ("utf-8", "koi8_r"), ("utf-8", "cp1250"), ("utf-8", "big5"), ("big5", "cp1252"),
    ("cp866", "cp1251"), ("cp1251", "cp866"), ("cp437", "cp1252"), ("cp850", "cp1252"), ("cp1252", "cp1251"),
    ("cp1252", "gb18030"), ("cp1250", "cp1252"), ("cp1252", "cp1250"),
)
SINGLE = {"cp1252", "latin-1", "cp437", "mac_roman", "cp1251", "cp850", "koi8_r", "cp1250", "cp866"}
#: Valid UTF-8 in characters of these readings is a sign of garbling; in other readings accented letters
#: beside quotation marks are valid by chance.
SIGNS_OF = tuple(s for s in STEPS if s[0] == "utf-8" and s[1] in ("cp1252", "latin-1", "cp437"))

_LOST = re.compile("[�\x80-\x84\x86-\x9f-]")
_SYMBOL_IN_WORD = re.compile(r"[‚„¬¨´¶§©®±¤¦†‡‰√∂∫≈≠≤≥∑∏∞◊∆‹›¸˚˘˝˛\u2500-\u25ff](?<=[^\W\d_].)")
_HIGH = re.compile(r"[^\x00-\x7f]+")
_PLAIN_CHAR = re.compile(r"[0-9A-Za-z]")
_STRAY = re.compile(r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f-\x9f]")
_HIGH_RUN = re.compile(r"[^\x00-\x7f][^\x00-\x7f]+")
_FOUR_LATIN = re.compile(r"[\xa0-\xff][\xa0-\xff]{3}")
_LONG_LATIN_RUN = re.compile(r"(?<![^ ])[\xa0-\xff]{4,}(?![^ ])")
_CHUNK = re.compile(r"[^\x00-\x7f]{1,4}")
#: Characters that two bytes of GB 18030 write which could begin UTF-8.
_LIKE_UTF8 = frozenset(
    c for b in range(0xC2, 0xF5) for d in range(0x80, 0xC0) for c in bytes([b, d]).decode("gb18030", "ignore")[:1]
)


def _table(codec: str) -> dict[str, int]:
    """Characters of a one-byte encoding; bytes it leaves open stand for themselves."""
    out: dict[str, int] = {}
    for b in range(0x80, 0x100):
        try:
            c = bytes([b]).decode(codec)
        except UnicodeDecodeError:
            c = chr(b)
        out.setdefault(c, b)
    return out


class _Step:
    """Finds and undoes the stretches of one wrong reading."""

    def __init__(self, wrote: str, read: str):
        self.wrote, self.read = wrote, read
        self.memo: dict[str, tuple[int, int, str | None]] = {}
        self.chars = _table(read) if read in SINGLE else None
        #: A stretch may hold ASCII characters, which are second bytes.
        self.spans = self.chars is not None and wrote not in SINGLE and wrote != "utf-8"
        self.bytes = {ord(c): b for c, b in (self.chars or {}).items()}
        if self.chars is not None and not self.spans:
            #: The byte of a character, 0 for none, and the character of a byte as it was stored, -1 for none.
            self.lut = np.zeros(0x10000, np.uint8)
            self.lut[list(self.bytes)] = list(self.bytes.values())
            self.out = np.full(256, -1, np.int64)
            if wrote in SINGLE:
                for b in range(0x80, 0x100):
                    c = bytes([b]).decode(wrote, "ignore")
                    if c and not _STRAY.search(c):
                        self.out[b] = ord(c)
        if self.chars is None:
            self.pattern = _HIGH
        elif wrote == "utf-8":
            pick = lambda lo, hi: "[" + "".join(re.escape(c) for c, b in self.chars.items() if lo <= b <= hi) + "]"
            tail = pick(0x80, 0xBF)
            #: Characters that a stretch begins with.
            self.first = re.compile(pick(0xC2, 0xF4))
            self.pattern = re.compile(
                f"(?:{pick(0xC2, 0xDF)}{tail}|{pick(0xE0, 0xEF)}{tail}{{2}}|{pick(0xF0, 0xF4)}{tail}{{3}})+"
            )
        else:
            high = "[" + "".join(re.escape(c) for c in self.chars) + "]"
            if wrote in SINGLE:
                self.pattern = re.compile(high + "+")
            else:
                self.pattern = re.compile(f"{high}(?:[@-~]?{high}+)*[@-~]?")

    def undo(self, stretch: str) -> str | None:
        try:
            if self.chars is not None:
                raw = stretch.translate(self.bytes).encode("latin-1")
            else:
                parts = [p.encode(self.read) for p in stretch.split("�")]
                raw = b"\xff".join(parts)
            if self.wrote in SINGLE:
                out = raw.decode(self.wrote)
            else:
                try:
                    out = raw.decode(self.wrote)
                except UnicodeDecodeError:
                    if self.wrote == "utf-8" and self.chars is not None:
                        return None
                    if self.chars is not None and stretch[-1:].isascii():
                        kept = self.undo(stretch[:-1])
                        return None if kept is None else kept + stretch[-1]
                    out = raw.decode(self.wrote, "replace")
        except (UnicodeEncodeError, UnicodeDecodeError, ValueError):
            return None
        if out == stretch or out.count("�") * 2 > len(out):
            return None
        if self.wrote != "utf-8" and _STRAY.search(out):
            return None
        return out


_CLASS = {**{ord(c): "a" for c in "abcdefghijklmnopqrstuvwxyz"}, **{ord(c): "A" for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}, **{ord(c): "0" for c in "0123456789"}}
_PLAIN = sorted({_CLASS.get(i, chr(i)) for i in range(128)})
ASCII_PAIRS = frozenset(a + b for a in _PLAIN for b in _PLAIN)


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def _text(codes: np.ndarray) -> str:
    return codes.astype("<u4").tobytes().decode("utf-32-le", "surrogatepass")


_CLASSES = np.array([ord(_CLASS.get(i, chr(i))) for i in range(128)], np.int64)


def _pair_keys(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index of the second character, key) of every pair with a character beyond ASCII."""
    high = codes > 127
    at = np.flatnonzero(high[1:] | high[:-1]) + 1
    a, b = codes[at - 1].astype(np.int64), codes[at].astype(np.int64)
    return at, np.where(a < 128, _CLASSES[np.minimum(a, 127)], a) << 21 | np.where(b < 128, _CLASSES[np.minimum(b, 127)], b)


class _PairSet:
    """A hash table of pairs, looked up by arrays of keys."""

    def __init__(self, pairs: Iterable[str]):
        keys = [ord(p[0]) << 21 | ord(p[1]) for p in pairs]
        self.bits = max(10, (8 * len(keys)).bit_length())
        self.slots = np.full(1 << self.bits, -1, np.int64)
        for key, at in zip(keys, self._slot(np.array(keys, np.int64)).tolist()):
            while self.slots[at] >= 0 and self.slots[at] != key:
                at = (at + 1) % len(self.slots)
            self.slots[at] = key

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def lacks(self, keys: np.ndarray) -> np.ndarray:
        at = self._slot(keys)
        found = self.slots[at]
        out = found != keys
        left = np.flatnonzero(out & (found >= 0))
        while left.size:
            at[left] = (at[left] + 1) % len(self.slots)
            found = self.slots[at[left]]
            out[left] = found != keys[left]
            left = left[(found >= 0) & (found != keys[left])]
        return out


def unusual_pairs(text: str, usual: frozenset[str] | set[str]) -> int:
    """Neighbouring characters, one of them not ASCII, that are not usual in any language.

    `usual` holds the pairs of ASCII classes too.
    """
    t = text.translate(_CLASS) if _PLAIN_CHAR.search(text) else text
    return len(list(filterfalse(usual.__contains__, map(add, t, t[1:]))))


def _bounds(inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Beginnings and ends of the stretches that are true."""
    edges = np.flatnonzero(np.diff(np.concatenate(([False], inside, [False])).astype(np.int8)))
    return edges[::2], edges[1::2]


def _running(flags: np.ndarray) -> np.ndarray:
    return np.concatenate(([0], np.cumsum(flags)))


#: A stretch: from, to, its text when undone, unusual pairs removed by that. Groups are of neighbours.
Stretch = tuple[int, int, str, int]
Groups = list[list[Stretch]]
#: Of a text, by step: unusual pairs removed and the stretches.
Found = dict[int, tuple[int, Groups]]


def _put(groups: Groups, a: int, b: int, out: str, less: int) -> None:
    if groups and a - groups[-1][-1][1] < CONTEXT and b - groups[-1][0][0] < 400:
        groups[-1].append((a, b, out, less))
    else:
        groups.append([(a, b, out, less)])


class Judge:
    """Description lengths under the languages' dictionaries, and the choice of the chain.

    A description is the zstandard frame under the best language plus an escape for every pair
    of neighbouring characters that is not usual in any language. Every step that removes one of those
    pairs is compressed, under every dictionary. A step that removes none is never taken: between
    two readings in usual pairs only, a few bytes of zstandard say nothing. So texts without
    unusual pairs need no compression.
    """

    def __init__(self, dictionaries: dict[str, bytes], usual: set[str]):
        self.dictionaries, self.usual = dictionaries, frozenset(usual) | ASCII_PAIRS
        self._ready = self._raw = self._table = None
        self._runs: dict[str, int] = {}
        self._sizes: dict[str, int] = {}
        self._made: dict[tuple[str, str, str], tuple] = {}
        self._long: dict[str, int] = {}

    def __getstate__(self) -> dict:
        return {"dictionaries": self.dictionaries, "usual": self.usual, "_ready": None, "_raw": None, "_table": None, "_runs": {}, "_sizes": {}, "_made": {}, "_long": {}}

    def _setup(self) -> None:
        params = zstandard.ZstdCompressionParameters.from_level(
            LEVEL, format=zstandard.FORMAT_ZSTD1_MAGICLESS, write_checksum=False, write_content_size=False, write_dict_id=False
        )
        compressors = []
        for data in self.dictionaries.values():
            d = zstandard.ZstdCompressionDict(data, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(compression_params=params)
            compressors.append(zstandard.ZstdCompressor(dict_data=d, compression_params=params))
        if not compressors:
            compressors = [zstandard.ZstdCompressor(compression_params=params)]
        self._ready = (compressors, [_Step(*s) for s in STEPS])

    def _pair_sets(self) -> tuple[set[str], _PairSet]:
        """The usual pairs with every letter and digit of a class, and as a table of those beyond ASCII."""
        if self._raw is None:
            of = {"a": "abcdefghijklmnopqrstuvwxyz", "A": "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0": "0123456789"}
            self._raw = {a + b for p in self.usual for a in of.get(p[0], p[0]) for b in of.get(p[1], p[1])}
            self._table = _PairSet(p for p in self.usual if not p.isascii())
        return self._raw, self._table

    def _count(self, text: str) -> int:
        """`unusual_pairs` of a text."""
        raw = self._raw if self._raw is not None else self._pair_sets()[0]
        return len(list(filterfalse(raw.__contains__, map(add, text, text[1:]))))

    def with_unusual(self, texts: list[str]) -> list[bool]:
        """Which texts hold an unusual pair."""
        out = [False] * len(texts)
        table = self._pair_sets()[1]
        some, size = [], 0
        last = len(texts) - 1
        for i, t in enumerate(texts):
            if not t.isascii():
                some.append(i)
                size += len(t)
            if some and (size > 2_000_000 or i == last):
                ends = np.cumsum([len(texts[k]) for k in some])
                at, keys = _pair_keys(_codes("".join(texts[k] for k in some)))
                at = at[table.lacks(keys)]
                of = np.searchsorted(ends, at, "right")  # the text of the second character
                inside = of == np.searchsorted(ends, at - 1, "right")
                for k in np.unique(of[inside]).tolist():
                    out[some[k]] = True
                some, size = [], 0
        return out

    def size(self, text: str) -> int:
        """Bytes of the text under the language that fits it best."""
        if self._ready is None:
            self._setup()
        memo = self._sizes
        n = memo.get(text)
        if n is None:
            data = text.encode("utf-8", "surrogatepass")
            n = min(len(c.compress(data)) for c in self._ready[0])
            if len(memo) > 20_000:
                memo.clear()
            memo[text] = n
        return n

    def _unusual(self, text: str, run: re.Match) -> int:
        """Unusual pairs of a run of characters beyond ASCII, its neighbours included."""
        a, b = run.span()
        return self._pairs_of(text[a - 1 if a else 0 : b + 1])

    def _pairs_of(self, run: str) -> int:
        """`unusual_pairs`, kept for short runs; for long ones while the steps look at one text."""
        kept = self._runs if len(run) <= SHORT else self._long
        n = kept.get(run)
        if n is None:
            n = self._count(run)
            if len(kept) >= 200_000:
                kept.clear()
            kept[run] = n
        return n

    def _stretches(self, text: str, step: _Step, places: list[tuple[int, int]] | None = None) -> tuple[int, Groups]:
        """Unusual pairs removed by undoing a step, and its stretches in groups of neighbours.

        Only readings as UTF-8 are undone where no pair is unusual; of the others the stretches
        outside `places` need not be looked for.
        """
        groups: Groups = []
        removed = 0
        where = [(0, len(text))] if places is None or step.wrote == "utf-8" else places
        for m in chain.from_iterable(step.pattern.finditer(text, lo, hi) for lo, hi in where):
            a, b = m.span()
            before, after, out = self._known(step, text[max(0, a - 1) : a], m.group(), text[b : b + 1])
            if out is None:
                continue
            removed += before - after
            _put(groups, a, b, out, before - after)
        return removed, groups

    def _of_runs(self, text: str) -> Found:
        """`_stretches` of the steps whose reading has several bytes a character: whole runs of
        characters beyond ASCII. What they make of a run between its neighbours is kept.
        """
        found: Found = {}
        for m in _HIGH.finditer(text):
            at, end = m.span()
            key = (text[at - 1 : at] if at else "", m.group(), text[end : end + 1])
            known = self._made.get(key)
            if known is None:
                known = tuple(self._made_of(*key))
                if end - at <= SHORT:
                    if len(self._made) > 200_000:
                        self._made.clear()
                    self._made[key] = known
            for k, less, out in known:
                removed, groups = found.get(k) or (0, [])
                _put(groups, at, end, out, less)
                found[k] = removed + less, groups
        return found

    def _made_of(self, left: str, run: str, right: str) -> Iterator[tuple[int, int, str]]:
        """(step, pairs removed, text) of every such step that undoes the run."""
        for k, step in enumerate(self._ready[1]):
            if step.chars is None:
                before, after, out = self._known(step, left, run, right)
                if out is not None:
                    yield k, before - after, out

    def _of_bytes(self, texts: list[str]) -> list[Found]:
        """`_stretches` of every text for the steps from one byte a character whose stretches hold no
        ASCII, where they remove a pair; all stretches of a step are undone as arrays."""
        found: list[Found] = [{} for _ in texts]
        codes = _codes("\n".join(texts))
        starts = np.cumsum([0] + [len(t) + 1 for t in texts])
        high = codes > 127
        near = high.copy()  # all else is ASCII between ASCII, where no pair is unusual
        near[1:] |= high[:-1]
        near[:-1] |= high[1:]
        near[starts[1:-1] - 1] = True
        index = np.flatnonzero(near)
        codes = codes[index].astype(np.int64)
        between = np.searchsorted(index, starts[1:-1] - 1)
        low = np.where(codes < 0x10000, codes, 0)
        bad = self._flagged(codes, between)
        bytes_of: dict[str, np.ndarray] = {}
        for k, step in enumerate(self._ready[1]):
            if step.chars is None or step.spans:
                continue
            raw = bytes_of.get(step.read)
            if raw is None:
                raw = bytes_of[step.read] = step.lut[low]
            made = self._utf8(codes, raw) if step.wrote == "utf-8" else self._one_byte(codes, raw, step)
            if made is None:
                continue
            lo, hi, fits, inside, new, keep = made
            before = bad[hi + 1] - bad[lo]
            if step.wrote != "utf-8":
                fits = fits & (before > 0)
            if not before[fits].any():
                continue
            taken = inside.copy()
            taken[inside] = np.repeat(fits, hi - lo)
            new = np.where(taken, new, codes)
            to, till, marks = lo, hi, between
            if keep is not None:
                keep = keep | ~taken
                new = new[keep]
                place = _running(keep)
                to, till, marks = place[lo], place[hi], place[between]
            flagged = self._flagged(new, marks)
            after = flagged[till + 1] - flagged[to]
            use = np.flatnonzero(fits & (after <= before))
            less = (before - after)[use]
            first = index[lo[use]]
            of = np.searchsorted(starts, first, "right") - 1
            paying = np.bincount(of, less, minlength=len(texts)) > 0
            some = paying[of]
            if not some.any():
                continue
            use, less, first, of = use[some], less[some], first[some], of[some]
            at, out = starts[of], _text(new)
            end = index[hi[use] - 1] + 1
            for i, x, y, c, d, n in zip(*(v.tolist() for v in (of, first - at, end - at, to[use], till[use], less))):
                removed, groups = found[i].get(k) or (0, [])
                _put(groups, x, y, out[c:d], n)
                found[i][k] = removed + n, groups
        return found

    def _flagged(self, codes: np.ndarray, between: np.ndarray) -> np.ndarray:
        """Running count of unusual pairs: before index i, those whose second character stands before i.
        Characters `between` texts are in none."""
        at, keys = _pair_keys(codes)
        out = np.zeros(len(codes) + 2, np.int64)
        out[at[self._pair_sets()[1].lacks(keys)] + 1] = 1
        out[between + 1] = out[between + 2] = 0
        return np.cumsum(out)

    @staticmethod
    def _one_byte(codes: np.ndarray, raw: np.ndarray, step: _Step) -> tuple | None:
        inside = raw > 0
        if not inside.any():
            return None
        lo, hi = _bounds(inside)
        new = step.out[raw]
        wrong, changed = _running(inside & (new < 0)), _running(inside & (new != codes))
        return lo, hi, (wrong[hi] == wrong[lo]) & (changed[hi] > changed[lo]), inside, new, None

    @staticmethod
    def _utf8(codes: np.ndarray, raw: np.ndarray) -> tuple | None:
        """Stretches of whole UTF-8 sequences; a wrong one among them spoils its stretch."""
        n = len(raw)
        b = np.concatenate((raw, np.zeros(3, raw.dtype))).astype(np.int64)
        tail = (b >= 0x80) & (b <= 0xBF)
        t1, t2, t3 = tail[1 : n + 1], tail[1 : n + 1] & tail[2 : n + 2], tail[1 : n + 1] & tail[2 : n + 2] & tail[3 : n + 3]
        b0, b1, b2, b3 = b[:n], b[1 : n + 1] & 63, b[2 : n + 2] & 63, b[3 : n + 3] & 63
        two, three, four = (b0 >= 0xC2) & (b0 <= 0xDF) & t1, (b0 >= 0xE0) & (b0 <= 0xEF) & t2, (b0 >= 0xF0) & (b0 <= 0xF4) & t3
        start = two | three | four
        if not start.any():
            return None
        inside = start.copy()
        inside[1:] |= start[:-1]
        inside[2:] |= (three | four)[:-2]
        inside[3:] |= four[:-3]
        new = np.where(two, (b0 & 31) << 6 | b1, np.where(three, (b0 & 15) << 12 | b1 << 6 | b2, (b0 & 7) << 18 | b1 << 12 | b2 << 6 | b3))
        wrong = three & ((new < 0x800) | (new >> 11 == 27)) | four & ((new < 0x10000) | (new > 0x10FFFF))
        lo, hi = _bounds(inside)
        wrong, lost, chars = _running(wrong), _running(start & (new == 0xFFFD)), _running(start)
        fits = (wrong[hi] == wrong[lo]) & (2 * (lost[hi] - lost[lo]) <= chars[hi] - chars[lo])
        return lo, hi, fits, inside, new, start

    def _odd(self, text: str) -> list[tuple[int, int]]:
        """Places of characters beyond ASCII that stand in unusual pairs: from one white space to the
        next, which no stretch goes over."""
        places: list[tuple[int, int]] = []
        for m in _HIGH.finditer(text):
            a, b = m.span()
            if (not places or b > places[-1][1]) and self._unusual(text, m):
                lo = max(text.rfind(" ", 0, a), text.rfind("\n", 0, a)) + 1
                hi = min((i for c in " \n" if (i := text.find(c, b)) >= 0), default=len(text))
                places.append((lo, hi))
        return places

    def _known(self, step: _Step, left: str, stretch: str, right: str) -> tuple[int, int, str | None]:
        """`_one`, kept for short stretches."""
        key = left + stretch + right
        known = step.memo.get(key)
        if known is None:
            known = self._one(step, left, stretch, right)
            if len(key) <= SHORT:
                if len(step.memo) > 20_000:
                    step.memo.clear()
                step.memo[key] = known
        return known

    def _one(self, step: _Step, left: str, stretch: str, right: str) -> tuple[int, int, str | None]:
        """Unusual pairs of one stretch between its neighbours before and after undoing a step."""
        before = self._pairs_of(left + stretch + right)
        if not before and step.wrote != "utf-8":
            return 0, 0, None
        out = step.undo(stretch)
        if out is None:
            return before, 0, None
        after = self._count(left + out + right)
        return before, after, None if after > before else out

    def _undone(self, text: str, groups: Groups, least: int = 0) -> tuple[int, str]:
        """Bytes saved by undoing the groups where that shortens the text, and the text then.

        Escapes are saved for the pairs removed: stretches never touch, so no pair belongs to two.
        Stops with (0, text) as soon as the groups left cannot bring more than `least` bytes: none can
        save more than its window has and the escapes of its pairs.
        """
        parts, at, saved = [], 0, 0
        windows, left = [], 0
        for g in groups:
            a, b = max(0, g[0][0] - CONTEXT), min(len(text), g[-1][1] + CONTEXT)
            escapes = ESCAPE * sum(hit[3] for hit in g)
            window = text[a:b]
            size = self._sizes.get(window) or len(window.encode("utf-8", "surrogatepass")) + 16
            windows.append((g, a, b, window, escapes, size + escapes))
            left += size + escapes
        for g, a, b, window, escapes, most in windows:
            if saved + left <= least:
                return 0, text
            left -= most
            gain = self.size(window) - self.size(self._rewritten(text, a, b, g)) + escapes
            if gain < STRETCH_COST:
                continue
            saved += gain
            for s, e, out, _ in g:
                parts += [text[at:s], out]
                at = e
        return saved, "".join(parts) + text[at:]

    @staticmethod
    def _rewritten(text: str, a: int, b: int, hits: list[Stretch]) -> str:
        out, at = [], a
        for s, e, new, _ in hits:
            out += [text[at:s], new]
            at = e
        return "".join(out) + text[at:b]

    def restore(self, text: str) -> tuple[str, list[str], int]:
        """(text, steps undone, bytes saved); unchanged when no chain pays for itself.

        The step that saves most is undone first, then the one that saves most of what is left.
        """
        return self.restore_all([text])[0]

    def restore_all(self, texts: list[str]) -> list[tuple[str, list[str], int]]:
        """`restore` of every text; the stretches of many are looked for at once."""
        done: list[tuple[str, list[str], int]] = [(t, [], 0) for t in texts]
        if self._ready is None:
            self._setup()
        active = list(range(len(texts)))
        while active := [i for i, odd in zip(active, self.with_unusual([done[i][0] for i in active])) if odd]:
            paid, some, size = [], [], 0
            for i in active:
                some.append(i)
                size += len(done[i][0])
                if size > 500_000 or i == active[-1]:
                    for k, found in zip(some, self._of_bytes([done[k][0] for k in some])):
                        text, undone, total = done[k]
                        if (best := self._best(text, found)) is not None:
                            done[k] = best[2], [*undone, best[1]], total + best[0]
                            paid.append(k)
                    some, size = [], 0
            active = paid
        return done

    def _best(self, text: str, found: Found) -> tuple[int, str, str] | None:
        """(bytes saved, step, text then) of the step that saves most, if it saves more than its cost."""
        self._long.clear()
        places = self._odd(text)
        steps = self._ready[1]
        tried = []
        for k, (removed, groups) in chain(self._of_runs(text).items(), found.items()):
            if removed > 0:
                tried.append((-removed, k, steps[k], groups))
        for k, s in enumerate(steps):
            if s.spans:
                removed, groups = self._stretches(text, s, places)
                if removed > 0:
                    tried.append((-removed, k, s, groups))
        best, least = None, STEP_COST
        for _, k, s, groups in sorted(tried, key=lambda t: t[:2]):  # likely ones first, so that others end early
            saved, new = self._undone(text, groups, least)
            if saved > least:
                best, least = (saved - STEP_COST, f"{s.wrote} as {s.read}", new), saved
        return best


def _suspicious(text: str, steps: list[_Step]) -> bool:
    """Signs of garbling that keep a text out of the counts."""
    if text.isascii():
        return False
    if _LOST.search(text) or _SYMBOL_IN_WORD.search(text):
        return True
    runs = _HIGH_RUN.findall(text)  # a character read from several bytes is several characters
    joined = " ".join(runs)
    if any(s.undo(m.group()) is not None for s in steps if s.first.search(joined) for m in s.pattern.finditer(joined)):
        return True
    if _FOUR_LATIN.search(joined) and _LONG_LATIN_RUN.search(joined):
        return True
    for run in runs:
        if run[0] in _LIKE_UTF8:
            try:
                if len(run.encode("gb18030").decode("utf-8")) > 1:
                    return True
            except (UnicodeEncodeError, UnicodeDecodeError):
                pass
    return False


def _pieces(text: str) -> set[str]:
    """Words that hold characters beyond ASCII, after a space, alone and between their neighbours; long
    ones, as of languages without spaces, in chunks of such characters."""
    out: set[str] = set()
    words = text.split()
    for i, w in enumerate(words):
        if not w.isascii():
            if len(w) > 24:
                out.update(_CHUNK.findall(w))
            else:
                out.add(" " + w)
                near = " " + " ".join(words[max(0, i - 1) : i + 2])
                if len(near) <= 48:
                    out.add(near)
    return out


class _Counts:
    """In how many texts of a language each pair and piece stands; texts with signs of garbling left out."""

    def __init__(self):
        self.steps = [_Step(*s) for s in SIGNS_OF]
        self.langs: dict[str, int] = {}
        self.clear()

    def clear(self) -> None:
        self.texts: Counter = Counter()
        self.pieces: dict[str, Counter] = {}
        self.pairs: list[tuple[np.ndarray, np.ndarray]] = []

    def add(self, langs: list[str], texts: list[str]) -> None:
        clean, size = [], 0
        for lang, t in zip(langs, texts):
            if not _suspicious(t, self.steps):
                self.texts[lang] += 1
                if not t.isascii():
                    self.pieces.setdefault(lang, Counter()).update(_pieces(t))
                    clean.append((lang, t))
                    size += len(t)
                    if size > 2_000_000:
                        self._add_pairs(clean)
                        clean, size = [], 0
        if clean:
            self._add_pairs(clean)

    def _add_pairs(self, rows: list[tuple[str, str]]) -> None:
        ends = np.cumsum([len(t) for _, t in rows])
        at, keys = _pair_keys(_codes("".join(t for _, t in rows)))
        of = np.searchsorted(ends, at, "right")
        inside = of == np.searchsorted(ends, at - 1, "right")
        once = np.unique(of[inside] << 42 | keys[inside])  # a text counts once
        lang = np.array([self.langs.setdefault(lang, len(self.langs)) for lang, _ in rows], np.int64)
        self.pairs.append(np.unique(lang[once >> 42] << 42 | once & (1 << 42) - 1, return_counts=True))

    def size(self) -> int:
        return sum(map(len, self.pieces.values())) + sum(len(k) for k, _ in self.pairs)

    def rows(self) -> pd.DataFrame:
        """(lang, kind, key, n); the count of the texts has the kind "" and no key."""
        out = [(lang, "", "", n) for lang, n in self.texts.items()]
        if self.pairs:
            keys, which = np.unique(np.concatenate([k for k, _ in self.pairs]), return_inverse=True)
            n = np.bincount(which, np.concatenate([n for _, n in self.pairs])).astype(np.int64)
            names = list(self.langs)
            out += [(names[k >> 42], "pair", chr(k >> 21 & 0x1FFFFF) + chr(k & 0x1FFFFF), m) for k, m in zip(keys.tolist(), n.tolist())]
        out += [(lang, "piece", p, n) for lang, c in self.pieces.items() for p, n in c.items()]
        return pd.DataFrame(out, columns=["lang", "kind", "key", "n"])


def _dictionary(pieces: list[tuple[str, int]], usual: frozenset[str] | set[str]) -> bytes | None:
    """The pieces with most bytes in all texts, the largest last, where zstandard refers to them at least
    cost; without those that hold unusual pairs.

    `usual` holds the pairs of ASCII classes too.
    """
    kept = sorted((n * len(p.encode()), p) for p, n in pieces if not unusual_pairs(p, usual))
    data = "".join(p for _, p in kept).encode()[-DICTIONARY:]
    return data if len(data) >= 8 else None


def train(texts: dict[str, list[str]]) -> Judge:
    """Usual pairs, those in two texts at least, and a dictionary for each language, from all texts given."""
    counts = _Counts()
    for lang, some in texts.items():
        counts.add([lang] * len(some), some)
    rows = counts.rows()
    seen = rows[rows["kind"] == "pair"].groupby("key")["n"].sum()
    usual = set(seen[seen >= 2].index)
    made = {lang: _dictionary(list(c.items()), usual | ASCII_PAIRS) for lang, c in counts.pieces.items()}
    return Judge({lang: d for lang, d in made.items() if d}, usual)


def fit_judge(df: DataFrame, text_col: str = "text", lang_col: str = "lang") -> Judge:
    """Usual pairs, and dictionaries of the most usual pieces for each language, counted over all texts, whole.

    Texts with signs of garbling do not count. A pair is usual in at least `PAIR_SHARE` of a
    language's texts, two at least. The languages are the labels of the table, the `MOST_LANGUAGES` most
    frequent at most.
    """

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts = _Counts()
        for batch in batches:
            counts.add(batch["_lang"].tolist(), batch["_text"].tolist())
            if counts.size() > 400_000:
                yield counts.rows()
                counts.clear()
        yield counts.rows()

    unlabelled = "\U0010ffff"
    rows = df.where(F.col(text_col).isNotNull()).select(
        F.coalesce(F.col(lang_col).cast("string"), F.lit(unlabelled)).alias("_lang"), F.col(text_col).alias("_text")
    )
    counts = rows.mapInPandas(count, "lang string, kind string, key string, n bigint")
    counts = cut(counts.groupBy("lang", "kind", "key").agg(F.sum("n").alias("n")))
    texts = counts.where(F.col("kind") == "").select("lang", F.col("n").alias("texts"))
    pairs = counts.where((F.col("kind") == "pair") & (F.col("n") >= 2)).join(texts, "lang")
    usual = {r["key"] for r in pairs.where(F.col("n") >= F.col("texts") * PAIR_SHARE).select("key").distinct().collect()}
    labels = texts.where(F.col("lang") != unlabelled).orderBy(F.desc("texts"), "lang").limit(MOST_LANGUAGES)
    pieces = counts.where(F.col("kind") == "piece").join(F.broadcast(labels), "lang").where(F.col("n") >= F.col("texts") * PIECE_SHARE)
    most = W.partitionBy("lang").orderBy(F.desc(F.col("n") * F.octet_length("key")), "key")
    found: dict[str, list[tuple[str, int]]] = {}
    for r in pieces.withColumn("k", F.row_number().over(most)).where(F.col("k") <= PIECES).select("lang", "key", "n").collect():
        found.setdefault(r["lang"], []).append((r["key"], r["n"]))
    made = {lang: _dictionary(found[lang], usual | ASCII_PAIRS) for lang in sorted(found)}
    return Judge({lang: d for lang, d in made.items() if d}, usual)


def judge_texts(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    judge: Judge | None = None,
) -> DataFrame:
    """(id, restored, chain, saved, lost) of every affected text.

    `restored` is the best text found, `chain` the steps undone, `lost` whether characters are
    still missing in it.
    """
    judge = judge or fit_judge(df, text_col, lang_col)
    rows = df.where(F.col(text_col).isNotNull()).select(
        F.col(id_col).alias("_id"), F.col(text_col).alias("_text")
    )
    id_type = rows.schema["_id"].dataType.simpleString()
    shared = df.sparkSession.sparkContext.broadcast(judge)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            texts = batch["_text"].tolist()
            for i, t, (new, chain, saved) in zip(batch["_id"], texts, shared.value.restore_all(texts)):
                if chain or _LOST.search(t):
                    out.append((i, new, chain, saved, bool(_LOST.search(new))))
            yield pd.DataFrame(out, columns=["_id", "restored", "chain", "saved", "lost"])

    schema = f"_id {id_type}, restored string, chain array<string>, saved bigint, lost boolean"
    return rows.mapInPandas(run, schema).withColumnRenamed("_id", id_col)
