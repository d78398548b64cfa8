"""Documents put into containers of a fixed number of tokens.

Each document becomes a hashed vector of its tokens, projected to `DIMS` numbers by fixed
random signs; their ranks on a grid give its place on a Hilbert curve, along which documents of
like content are neighbours. All items are range-sorted along the curve, and each task packs
its stretch: a window of neighbours at a time goes into the fullest container with room,
largest first, and containers that stay too empty are opened again for the next window. A window
looks ahead over `WINDOW` documents, or as many as fill `WINDOW_BINS` containers: larger ones would
fill containers a little better and put documents together that lie far apart on the curve. A
document above the capacity is cut into full containers and one rest, which is an item like any
other; nothing else is cut.

The sort key ends with the id, so a third of the rows standing on one point of the curve is cut
into ranges like the rest. A task leaves at most a few containers open at the end of its
stretch of about `ROWS_PER_TASK` items.

Defined cases: null texts are no items; empty texts are items of size 0; capacities below 1 or
null are left out; ids that occur twice are items of their own.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.token_counts import TOKENIZER, encoder
from millrace.plans.checkpoints import cut

DIMS = 4
BITS = 8
BUCKETS = 512
#: A window is packed when it holds so many documents and the tokens of so many containers.
WINDOW = 128
WINDOW_BINS = 20
REOPEN = 0.02
ROWS_PER_TASK = 200_000


def hilbert_keys(grid: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Places on the Hilbert curve of points with integer coordinates (rows) below 2^bits."""
    x = grid.astype(np.int64).T.copy()
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        p = q - 1
        for i in range(n):
            high = (x[i] & q) != 0
            t = (x[0] ^ x[i]) & p
            x[0] = np.where(high, x[0] ^ p, x[0] ^ t)
            x[i] = np.where(high, x[i], x[i] ^ t)
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    t = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        t = np.where((x[n - 1] & q) != 0, t ^ (q - 1), t)
        q >>= 1
    x ^= t
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            key = (key << 1) | ((x[i] >> b) & 1)
    return key


def _signs() -> np.ndarray:
    return np.random.default_rng(20).choice([-1.0, 1.0], size=(BUCKETS, DIMS))


def curve_places(batches_of_ids: list[list[int]]) -> np.ndarray:
    """Hilbert keys of token lists."""
    vectors = np.zeros((len(batches_of_ids), BUCKETS))
    for row, ids in zip(vectors, batches_of_ids):
        if ids:
            slots = (np.asarray(ids, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(55)
            row += np.log1p(np.bincount(slots.astype(np.int64), minlength=BUCKETS))
    norms = np.linalg.norm(vectors, axis=1, keepdims=True)
    vectors /= np.where(norms == 0, 1, norms)
    z = vectors @ _signs()
    grid = np.clip(((np.tanh(z) + 1) / 2 * (1 << BITS)).astype(np.int64), 0, (1 << BITS) - 1)
    return hilbert_keys(grid)


class Packer:
    """Containers of one capacity, filled along the curve."""

    def __init__(self, capacity: int, first_bin: int):
        self.capacity, self.next_bin = capacity, first_bin
        self.waiting: list[tuple[int, int]] = []
        self.held = 0

    def full(self, n: int) -> list[int]:
        """Numbers for n containers that one piece fills."""
        self.next_bin += n
        return list(range(self.next_bin - n, self.next_bin))

    def add(self, items: list[tuple[int, int]]) -> list[tuple[int, int, int]]:
        """Take (size, item) pairs; give (bin, unused, item) of the containers now closed."""
        self.waiting += items
        self.held += sum(size for size, _ in items)
        return self._pack(last=False) if len(self.waiting) >= WINDOW and self.held >= WINDOW_BINS * self.capacity else []

    def close(self) -> list[tuple[int, int, int]]:
        return self._pack(last=True) if self.waiting else []

    def _pack(self, last: bool) -> list[tuple[int, int, int]]:
        bins: list[list[tuple[int, int]]] = []
        room: list[tuple[int, int]] = []
        for size, item in sorted(self.waiting, key=lambda x: -x[0]):
            at = bisect_left(room, (size, -1))
            if at == len(room):
                bins.append([])
                free, b = self.capacity, len(bins) - 1
            else:
                free, b = room.pop(at)
            bins[b].append((size, item))
            insort(room, (free - size, b))
        free_of = {b: free for free, b in room}
        window, self.waiting = len(self.waiting), []
        out = []
        limit = self.capacity * REOPEN
        for b, content in enumerate(bins):
            if not last and free_of[b] > limit:
                self.waiting += content
                continue
            out += [(self.next_bin, free_of[b], item) for _, item in content]
            self.next_bin += 1
        if len(self.waiting) >= max(1, window // 2) and not last:
            out += self._flush_half()
        self.held = sum(size for size, _ in self.waiting)
        return out

    def _flush_half(self) -> list[tuple[int, int, int]]:
        """Close what cannot be filled better, so that each window makes room for the next."""
        held, self.waiting = self.waiting, []
        half = len(held) // 2
        old, young = held[:half], held[half:]
        self.waiting = old
        out = self._pack(last=True)
        self.waiting = young
        return out


def pack(
    documents: DataFrame, containers: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str = TOKENIZER
) -> DataFrame:
    """One row per piece: container, capacity, bin, doc, place, piece, token_from, token_to, unused.

    `bin` is unique within its container; `place` is the document's on the curve; `unused` is the free space of the piece's bin; pieces
    are numbered from 0; token positions are half open.
    """
    wanted = [
        (r["container"], int(r["capacity_tokens"]))
        for r in containers.where(F.col("container").isNotNull() & (F.col("capacity_tokens") >= 1)).select("container", "capacity_tokens").distinct().collect()
    ]  # the containers table is a short list of sizes
    rows = documents.where(F.col(text_col).isNotNull()).select(F.col(id_col).alias("doc"), F.col(text_col).alias("text"))
    id_type = rows.schema["doc"].dataType.simpleString()

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        e = encoder(tokenizer)
        for batch in batches:
            ids = [e.encode_ordinary(t) for t in batch["text"]]
            yield pd.DataFrame({"doc": batch["doc"], "tokens": [len(x) for x in ids], "place": curve_places(ids)})

    sized = cut(rows.mapInPandas(measure, f"doc {id_type}, tokens bigint, place bigint"))
    sizes = F.array(*[F.struct(F.lit(n).alias("container"), F.lit(c).alias("capacity")) for n, c in wanted]) if wanted else F.array().cast("array<struct<container:string,capacity:int>>")
    items = sized.select("doc", "tokens", "place", F.explode(sizes).alias("c")).select("c.container", "c.capacity", "place", "doc", "tokens")
    parts = max(1, -(-sized.count() * len(wanted) // ROWS_PER_TASK))
    ranged = items.repartitionByRange(parts, "container", "place", "doc").sortWithinPartitions("container", "place", "doc")
    schema = f"container string, capacity int, bin bigint, doc {id_type}, place bigint, piece int, token_from bigint, token_to bigint, unused bigint"

    def fill(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        first = TaskContext.get().partitionId() << 36
        packers: dict[tuple[str, int], Packer] = {}
        held: dict[int, tuple] = {}
        serial = 0

        def frame(done: list[tuple]) -> pd.DataFrame:
            return pd.DataFrame(done, columns=["container", "capacity", "bin", "doc", "place", "piece", "token_from", "token_to", "unused"])

        def named(key: tuple[str, int], closed: list[tuple[int, int, int]]) -> list[tuple]:
            return [(*key, b, *held.pop(item), unused) for b, unused, item in closed]

        for batch in batches:
            done: list[tuple] = []
            for key, group in batch.groupby(["container", "capacity"], sort=False):
                key = (key[0], int(key[1]))
                packer = packers.setdefault(key, Packer(key[1], first))
                new = []
                for doc, place, tokens in zip(group["doc"], group["place"], group["tokens"]):
                    whole, rest = divmod(int(tokens), key[1]) if tokens > key[1] else (0, int(tokens))
                    for piece, b in enumerate(packer.full(whole)):
                        done.append((*key, b, doc, place, piece, piece * key[1], (piece + 1) * key[1], 0))
                    if rest or not whole:
                        held[serial] = (doc, place, whole, whole * key[1], whole * key[1] + rest)
                        new.append((rest, serial))
                        serial += 1
                for i in range(0, len(new), WINDOW):
                    done += named(key, packer.add(new[i : i + WINDOW]))
            yield frame(done)
        yield frame([row for key, packer in packers.items() for row in named(key, packer.close())])

    return ranged.mapInPandas(fill, schema)


def packing_report(packed: DataFrame) -> DataFrame:
    """Per container: bins, documents, tokens used, space unused, the share filled and `span`, the
    mean part of the curve between neighbouring documents of a bin (a third for documents at random)."""
    bins = packed.groupBy("container", "capacity", "bin").agg(
        F.sum(F.col("token_to") - F.col("token_from")).alias("used"), F.count(F.lit(1)).alias("pieces"),
        F.when(F.count(F.lit(1)) > 1, (F.max("place") - F.min("place")) / (F.count(F.lit(1)) - 1) / F.lit(float(1 << (DIMS * BITS)))).alias("gap"),
    )
    return bins.groupBy("container", "capacity").agg(
        F.count(F.lit(1)).alias("bins"),
        F.sum("pieces").alias("pieces"),
        F.sum("used").alias("used"),
        F.sum(F.col("capacity") - F.col("used")).alias("unused"),
        (F.sum("used") / F.sum("capacity")).alias("filled"),
        F.avg("gap").alias("span"),
    )
