"""One form for text that looks the same but is stored with different characters.

A batch of Arrow strings is read as one array of code points. A lookup table as long as the
Unicode range gives every code point its replacement: itself, another one, none (zero-width
and soft characters) or an entry of an expansion table (ligatures). Output places are the
running sum of the replacement lengths, so expansion and removal are one scatter. Letters
with marks are taken apart by the same table; the marks of all letters are put in canonical order
with one sort and composed by looking up (letter, mark) pairs of the whole batch at once, first
marks first. No string call is made per row.

What is folded: full-width and half-width forms, presentation forms and ligatures, CJK radicals
and compatibility ideographs, spaces of any width, zero-width characters, hyphens, decomposed
letters, look-alike letters of Greek, Cyrillic, Armenian and phonetic alphabets. What is kept
apart: accents, capital and small letters, letters and digits, raised and ordinary figures,
hyphen and no hyphen, other marks.

Defined cases: null stays null, empty stays empty; runs of spaces become one, spaces at the
ends go. In `add_one_form` look-alikes are folded only in texts that hold more Latin than other
letters of the look-alikes' alphabets, so Russian or Greek text stays as it is; the comparison
key folds them always.
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

# Letters that look like the Latin letter below them.
LOOKALIKES = {
    "аеорсухіјѕԁһԛԝӏɑɡοναιıѵց": "aeopcyxijsdhqwlagovaiivg",
    "АВЕКМНОРСТУХІЈЅԌԚԜ": "ABEKMHOPCTYXIJSGQW",
    "ΑΒΕΖΗΙΚΜΝΟΡΤΥΧ": "ABEZHIKMNOPTYX",
    "ϲϳ": "cj",
    "ոսհ": "nuh",
}
HYPHENS = "‐‑⁃﹣"
_FOLDED = {"<wide>", "<narrow>", "<compat>", "<noBreak>", "<initial>", "<medial>", "<final>", "<isolated>", "<small>", "<vertical>", "<font>"}
_KEEP = set("…″‴⁗‼⁇⁈⁉¨¯´¸˘˙˚˛˜˝‗‾℀℁℅℆№℡")


def _expansion(c: str) -> str:
    """Replacement of one character, before look-alikes, marks apart from their letters."""
    return unicodedata.normalize("NFD", _replacement(c))


def _replacement(c: str) -> str:
    cat = unicodedata.category(c)
    if cat == "Zs":
        return " "
    if c in "\t\n\r\v\f\x85  ":
        return " "
    if cat == "Cf" or c in "͏ᅟᅠ឴឵ㅤﾠ" or "︀" <= c <= "️":
        return ""
    if c in HYPHENS:
        return "-"
    if c in _KEEP:
        return c
    decomposition = unicodedata.decomposition(c)
    tag = decomposition.split(" ", 1)[0] if decomposition else ""
    if tag in _FOLDED and cat[0] != "N":
        return unicodedata.normalize("NFKC", c)
    if tag in ("<wide>", "<narrow>", "<small>", "<font>"):
        return unicodedata.normalize("NFKC", c)
    return c


class Tables:
    """Lookup arrays over all code points and the table of composable pairs."""

    def __init__(self) -> None:
        size = sys.maxunicode + 1
        self.single = np.arange(size, dtype=np.uint32)
        self.length = np.ones(size, dtype=np.uint8)
        self.order = np.zeros(size, dtype=np.uint8)
        self.expanded: dict[int, str] = {}
        pairs: dict[int, int] = {}
        for cp in range(size):
            if 0xAC00 <= cp <= 0xD7A3 or 0xD800 <= cp <= 0xF8FF or 0x20000 <= cp <= 0x2F7FF or 0x323B0 <= cp:
                continue
            c = chr(cp)
            if cp < 0x80 and c.isprintable():
                continue
            new = _expansion(c)
            if len(new) == 1:
                self.single[cp] = ord(new)
            else:
                self.length[cp] = len(new)
                if new:
                    self.expanded[cp] = new
            self.order[cp] = unicodedata.combining(c)
            d = unicodedata.decomposition(c)
            if d and not d.startswith("<") and " " in d and unicodedata.normalize("NFC", c) == c:
                base, accent = (int(x, 16) for x in d.split())
                pairs[(base << 21) | accent] = cp
        for cp in range(0x2F800, 0x2FA20):
            new = unicodedata.normalize("NFD", chr(cp))
            if len(new) == 1:
                self.single[cp] = ord(new)
        self.pair_keys = np.array(sorted(pairs), dtype=np.int64)
        self.pair_values = np.array([pairs[k] for k in sorted(pairs)], dtype=np.uint32)
        wide = max(map(len, self.expanded.values()))
        slots = np.zeros((len(self.expanded) + 1, wide), dtype=np.uint32)
        self.slot = np.zeros(size, dtype=np.uint16)
        for k, (cp, new) in enumerate(sorted(self.expanded.items()), 1):
            self.slot[cp] = k
            slots[k, : len(new)] = [ord(x) for x in new]
        self.slots = slots
        self.alike = np.arange(size, dtype=np.uint32)
        for strange, latin in LOOKALIKES.items():
            for a, b in zip(strange, latin):
                self.alike[ord(a)] = ord(b)
        self.is_alike = self.alike != np.arange(size, dtype=np.uint32)
        self.alphabet = np.zeros(size, dtype=np.uint8)
        for lo, hi, k in ((0x41, 0x5A, 1), (0x61, 0x7A, 1), (0xC0, 0x24F, 1), (0x370, 0x3FF, 2), (0x400, 0x52F, 2), (0x531, 0x587, 2)):
            self.alphabet[lo : hi + 1] = k


_TABLES: Tables | None = None


def tables() -> Tables:
    """Tables of this worker, built once from the Unicode data of the interpreter."""
    global _TABLES
    if _TABLES is None:
        _TABLES = Tables()
    return _TABLES


def _code_points(strings: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all rows and the offsets of rows among them; nulls count as empty."""
    strings = strings.cast(pa.large_string())
    if strings.null_count:
        strings = strings.fill_null("")
    offsets = np.frombuffer(strings.buffers()[1], dtype=np.int64)[strings.offset : strings.offset + len(strings) + 1]
    data = strings.buffers()[2]
    raw = memoryview(data)[offsets[0] : offsets[-1]] if data is not None and len(offsets) else b""
    points = np.frombuffer(bytes(raw).decode("utf-8").encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    octets = np.frombuffer(raw, dtype=np.uint8)
    starts = np.concatenate(([0], np.cumsum((octets & 0xC0) != 0x80)))
    return points, starts[offsets - offsets[0]] if len(offsets) else np.zeros(1, dtype=np.int64)


def _compact(points: np.ndarray, bounds: np.ndarray, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    running = np.concatenate(([0], np.cumsum(keep)))
    return points[keep], running[bounds]


def _compose(points: np.ndarray, bounds: np.ndarray, t: Tables) -> tuple[np.ndarray, np.ndarray]:
    """Marks in canonical order, composed with their letter where nothing stands between."""
    order = t.order[points]
    if not order.any():
        return points, bounds
    begins = np.zeros(len(points) + 1, dtype=bool)
    begins[bounds] = True
    starts = (order == 0) | begins[:-1]
    at = np.flatnonzero(starts)
    group = np.cumsum(starts) - 1
    step = np.arange(len(points)) - at[group]
    if (step > 1).any():
        by = np.lexsort((np.where(order == 0, -1, order.astype(np.int16)), group))
        points, order = points[by], order[by]
    else:
        points = points.copy()
    marks = np.flatnonzero(step)
    marks = marks[np.argsort(step[marks], kind="stable")]
    rounds = np.split(marks, np.flatnonzero(np.diff(step[marks])) + 1) if len(marks) else []
    last = np.zeros(len(at), dtype=np.uint8)
    keep = np.ones(len(points), dtype=bool)
    for now in rounds:
        g = group[now]
        base = at[g]
        keys = (points[base].astype(np.int64) << 21) | points[now]
        where = np.minimum(np.searchsorted(t.pair_keys, keys), len(t.pair_keys) - 1)
        hit = (t.pair_keys[where] == keys) & (order[base] == 0) & (last[g] < order[now])
        points[base[hit]] = t.pair_values[where[hit]]
        keep[now[hit]] = False
        last[g[~hit]] = order[now[~hit]]
    return _compact(points, bounds, keep)


def _strings(points: np.ndarray, bounds: np.ndarray, valid: np.ndarray) -> pa.Array:
    """Arrow strings of the rows between bounds."""
    data = points.astype("<u4").tobytes().decode("utf-32-le", "surrogatepass").encode("utf-8", "replace")
    width = 1 + (points >= 0x80).astype(np.int64) + (points >= 0x800) + (points >= 0x10000)
    offsets = np.concatenate(([0], np.cumsum(width)))[bounds].astype(np.int64)
    bits = pa.array(valid).buffers()[1] if not valid.all() else None
    return pa.LargeStringArray.from_buffers(len(valid), pa.py_buffer(offsets), pa.py_buffer(data), bits)


def fold(strings: pa.Array, alike: str = "always") -> pa.Array:
    """One form of every string; `alike`: fold look-alike letters `always` or in `latin` texts."""
    t = tables()
    if isinstance(strings, pa.ChunkedArray):
        strings = strings.combine_chunks()
    valid = np.asarray(strings.is_valid())
    points, bounds = _code_points(strings)
    sizes = t.length[points].astype(np.int64)
    places = np.concatenate(([0], np.cumsum(sizes)))
    out = np.empty(places[-1], dtype=np.uint32)
    ones = sizes == 1
    out[places[:-1][ones]] = t.single[points[ones]]
    for i in np.unique(sizes[sizes > 1]):
        which = np.flatnonzero(sizes == i)
        rows = t.slots[t.slot[points[which]]]
        for k in range(int(i)):
            out[places[which] + k] = rows[:, k]
    points, bounds = out, places[bounds]
    points, bounds = _compose(points, bounds, t)
    strange = t.is_alike[points]
    if strange.any():
        if alike == "latin":
            owner = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
            kinds = t.alphabet[points]
            latin = np.bincount(owner, weights=kinds == 1, minlength=len(bounds) - 1)
            other = np.bincount(owner, weights=kinds == 2, minlength=len(bounds) - 1)
            strange &= (latin > other)[owner]
        points = np.where(strange, t.alike[points], points)
        points, bounds = _compose(points, bounds, t)
    space = points == 0x20
    if space.any():
        first = np.zeros(len(points) + 1, dtype=bool)
        first[bounds] = True
        before = np.concatenate(([True], space[:-1])) | first[:-1]
        after = np.concatenate((space[1:], [True])) | first[1:]
        keep = ~(space & (before | (after & first[1:])))
        points, bounds = _compact(points, bounds, keep)
        space = points == 0x20
        last = np.zeros(len(points) + 1, dtype=bool)
        last[bounds] = True
        points, bounds = _compact(points, bounds, ~(space & last[1:]))
    return _strings(points, bounds, valid)


def _folded(df: DataFrame, columns: dict[str, str], alike: str) -> DataFrame:
    """`df` with folded copies of string columns, batch by batch in Arrow."""
    added = [StructField(new, StringType()) for new in columns.values()]
    schema = StructType(list(df.schema.fields) + added)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            arrays, names = list(batch.columns), list(batch.schema.names)
            for old, new in columns.items():
                arrays.append(fold(batch.column(names.index(old)), alike).cast(pa.string()))
            yield pa.RecordBatch.from_arrays(arrays, names + list(columns.values()))

    return df.mapInArrow(run, schema)


def add_one_form(df: DataFrame, columns: list[str], suffix: str = "_one") -> DataFrame:
    """All rows and columns of `df` with `<column><suffix>` for each column (replaced if present)."""
    new = {c: c + suffix for c in columns}
    rest = df.drop(*[c for c in new.values() if c in df.columns])
    return _folded(rest, new, "latin")


def find_same_looking(examples: DataFrame, entries: DataFrame) -> DataFrame:
    """(example_id, entry_id): an entry shows the example to the eye, in other characters.

    Only 128-bit keys of word and folded text, a hash of the stored text, and ids meet in the join; no
    text is shuffled. A key is two hashes of 64 bits, so that two texts share one by chance in one of
    2^128 pairs; the pairs whose stored texts hash alike are left out as the same text.
    """
    shown = examples.where(F.col("en").isNotNull() & F.col("zh").isNotNull()).select(
        "word", "example_id", F.concat("en", F.lit("（"), "zh", F.lit("）")).alias("text")
    )
    kept = entries.where(F.col("ex").isNotNull()).select("word", "entry_id", F.col("ex").alias("text"))

    def keyed(rows: DataFrame, id_col: str) -> DataFrame:
        folded = _folded(rows.where(F.col("word").isNotNull()), {"text": "key"}, "always")
        pair = lambda seed, *c: F.xxhash64(F.lit(seed), *c)
        return folded.select(id_col, pair("a", "word", "key").alias("a"), pair("b", "word", "key").alias("b"), pair("c", "text").alias("c"), pair("d", "text").alias("d"))

    x, y = keyed(shown, "example_id").alias("x"), keyed(kept, "entry_id").alias("y")
    other = (F.col("x.c") != F.col("y.c")) | (F.col("x.d") != F.col("y.d"))
    same = (F.col("x.a") == F.col("y.a")) & (F.col("x.b") == F.col("y.b")) & other
    return x.join(y, same).select("example_id", "entry_id")
