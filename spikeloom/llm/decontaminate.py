"""Benchmark decontamination by the q-gram lemma.

Texts are lower-cased and blanks collapsed. A benchmark item is cut into windows of WINDOW characters, STEP apart (and its
last one; a shorter item is one window). A window with at most e edits against a region of a document keeps
WINDOW - Q + 1 - Q * e of its q-grams there, and their diagonals (document minus item position) lie within e of each other; so
some band of diagonals 2(e + 1) wide, of bands that overlap by half, holds them all. Windows that reach this count in a
band are verified by banded alignment, which gives the exact number of edits up to the budget.

Windows of equal content are one window of the index, and a long text is searched in pieces of PIECE characters that overlap. A piece
with more than MANY hits is searched in segments of SEGMENT characters, those of equal content once; so repetitive texts and items cost what
their different parts cost. Hits are taken up HITS at a time.

The result has a row for each document and item with at least one window within its budget: `windows` counts these, `edits` is the
smallest number. Both are of the item's distinct windows and the document's rows together, however many blocks there are. It equals a search for every window by brute force. Null and empty texts match nothing; items below Q
characters are too short to search for. Items with equal ids are one item, rows with equal doc_id one document; rows with a null
doc_id are searched as one document without an id, and `keep_clean` looks at each row's text alone. The benchmark goes to all executors in blocks of about
BLOCK characters, dealt by item_id (an item that is longer is a block by itself). Other columns are ignored, or passed through.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import U64, mixed, portions, powers

WINDOW, STEP, EDITS, Q = 64, 8, 6, 8
BLOCK = 500_000
PIECE, SEGMENT = 1 << 13, 256
#: Hits taken up at a time, and those of a piece from which on it is searched by segments.
HITS, MANY = 1 << 22, 1 << 17
_FILTER_BITS = 22


def normal(text: str | None) -> np.ndarray:
    """The code points of a text in lower case, with single blanks."""
    return np.frombuffer(" ".join((text or "").lower().split()).encode("utf-32-le", "surrogatepass"), np.uint32)


def qgrams(points: np.ndarray) -> np.ndarray:
    if len(points) < Q:
        return np.empty(0, np.uint64)
    up, down = powers(len(points) + 1)
    c = np.zeros(len(points) + 1, np.uint64)
    np.cumsum((points.astype(np.uint64) + U64(1)) * up[: len(points)], out=c[1:])
    return mixed((c[Q:] - c[:-Q]) * down[: len(points) - Q + 1])


def _distinct(x: np.ndarray) -> np.ndarray:
    """Sorted and distinct; by sorting, which is faster here than by hashing."""
    x = np.sort(x)
    return x[np.concatenate([[True], x[1:] != x[:-1]])] if len(x) else x


class Index:
    """The windows of a block of items, each content once, and their q-grams."""

    def __init__(self, items: list[tuple[int, str]]):
        texts, starts, sizes, owner, at = [normal(t) for _, t in items], [], [], [], 0
        self.names = [i for i, _ in items]
        self.points = np.full(sum(len(p) + WINDOW for p in texts) + WINDOW, 0xFFFFFFFF, np.uint32)
        for k, p in enumerate(texts):
            if len(p) >= Q:
                size = min(WINDOW, len(p))
                own = sorted({*range(0, len(p) - size + 1, STEP), len(p) - size})
                starts += [at + s for s in own]
                sizes += [size] * len(own)
                owner += [k] * len(own)
            self.points[at : at + len(p)] = p
            at += len(p) + WINDOW
        starts, sizes, self.owner = (np.array(x, np.int64) for x in (starts, sizes, owner))
        # a content's windows: those of `members` from first to last of its number
        whole = np.where(np.arange(WINDOW) < sizes[:, None], self.points[starts[:, None] + np.arange(WINDOW)], np.uint32(0xFFFFFFFE))
        _, first, same = np.unique(np.ascontiguousarray(whole).view(f"V{4 * WINDOW}").ravel(), return_index=True, return_inverse=True) if len(starts) else (None, *[np.zeros(0, np.int64)] * 2)
        order = np.argsort(first)  # contents by where they begin first
        same = np.argsort(order)[same]
        self.members, self.ends = np.argsort(same, kind="stable"), np.cumsum(np.bincount(same, minlength=len(first)))
        self.starts, self.sizes = starts[first[order]], sizes[first[order]]
        self.budgets = np.minimum(EDITS * self.sizes // WINDOW, (self.sizes - Q) // Q)
        self.least = self.sizes - Q + 1 - Q * self.budgets
        covered = np.zeros(len(self.points) + 1, np.int64)  # q-grams of these windows alone
        np.add.at(covered, self.starts, 1)
        np.add.at(covered, self.starts + self.sizes - Q + 1, -1)
        places = np.flatnonzero(np.cumsum(covered) > 0)
        grams = qgrams(self.points)[places] if len(places) else np.zeros(0, np.uint64)
        order = np.argsort(grams, kind="stable")
        self.places = places[order]
        self.grams, self.first, self.count = np.unique(grams[order], return_index=True, return_counts=True)
        self.filter = np.zeros(1 << _FILTER_BITS, bool)
        self.filter[(self.grams >> U64(64 - _FILTER_BITS)).astype(np.int64)] = True

    def hits(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The places of a text's q-grams that windows have, and the numbers of these q-grams."""
        h = qgrams(points)
        at = np.flatnonzero(self.filter[(h >> U64(64 - _FILTER_BITS)).astype(np.int64)])
        if not len(at) or not len(self.grams):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        k = np.minimum(np.searchsorted(self.grams, h[at]), len(self.grams) - 1)
        real = self.grams[k] == h[at]
        return at[real], k[real]

    def candidates(self, at: np.ndarray, k: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(window, first place of a band of the text where it may begin) pairs that reach the window's count, from what `hits` returns."""
        none = np.empty(0, np.int64), np.empty(0, np.int64)
        if not len(at):
            return none
        half, n, wide, found = EDITS + 1, self.count[k], len(self.points), []
        upto = np.cumsum(n)
        cuts = np.unique(np.searchsorted(upto, np.arange(HITS, upto[-1] + HITS, HITS), "right")).tolist()
        for low, high in zip([0, *cuts], [*cuts, len(k)]):  # distinct (band, place) of some hits at a time
            if low < high:
                m, own = n[low:high], k[low:high]
                place = self.places[np.repeat(self.first[own] - (np.cumsum(m) - m), m) + np.arange(m.sum())]
                key = (np.repeat(at[low:high], m) - place) // half * wide + place
                found.append(_distinct(np.concatenate([key, key - wide])))
        hits = _distinct(np.concatenate(found)) if len(found) > 1 else found[0]
        band = np.floor_divide(hits, wide)
        place = hits - band * wide
        # windows are looked up only where the least count of hits lies within one window
        least = max(1, int(self.least.min()))
        if len(band) < least:
            return none
        ok = np.flatnonzero((band[least - 1 :] == band[: len(band) - least + 1]) & (place[least - 1 :] - place[: len(band) - least + 1] <= WINDOW - Q))
        run = np.cumsum(np.bincount(ok, minlength=len(band) + 1) - np.bincount(ok + least, minlength=len(band) + 1))[: len(band)]
        band, place = band[run > 0], place[run > 0]
        out = [none]
        cuts = np.concatenate([[0], np.flatnonzero(band[1:] != band[:-1]) + 1, [len(band)]]) if len(band) else np.zeros(1, np.int64)
        for low, high in zip(cuts, cuts[1:]):
            own = place[low:high]
            w = np.arange(*np.searchsorted(self.starts, [own[0] - WINDOW, own[-1] + 1]))
            count = np.searchsorted(own, self.starts[w] + self.sizes[w] - Q, "right") - np.searchsorted(own, self.starts[w])
            w = w[count >= self.least[w]]
            out.append((w, band[low] * half + self.starts[w]))
        return tuple(np.concatenate(x) for x in zip(*out, strict=True))

    def edits(self, points: np.ndarray, window: np.ndarray, diagonal: np.ndarray) -> np.ndarray:
        """The edits of each candidate's window against its band of the text; candidates of equal characters are aligned once."""
        wide = 4 * EDITS + 3
        padded = np.concatenate([np.full(WINDOW * 2, 0xFFFFFFFE, np.uint32), points, np.full(WINDOW * 3, 0xFFFFFFFE, np.uint32)])
        out = np.empty(len(window), np.int64)
        for low in range(0, len(window), 1 << 14):
            w, d = window[low : low + (1 << 14)], diagonal[low : low + (1 << 14)]
            begin = np.clip((d - EDITS + 2 * WINDOW)[:, None] + np.arange(WINDOW + wide), 0, len(padded) - 1)
            both = np.ascontiguousarray(np.concatenate([self.sizes[w, None].astype(np.uint32), self.points[self.starts[w, None] + np.arange(WINDOW)], padded[begin]], axis=1))
            _, first, where = np.unique(both.view(f"V{4 * both.shape[1]}").ravel(), return_index=True, return_inverse=True) if len(w) > 64 else (None, np.arange(len(w)), np.arange(len(w)))
            out[low : low + len(w)] = self._aligned(padded, w[first], d[first])[where]
        return out

    def _aligned(self, padded: np.ndarray, window: np.ndarray, diagonal: np.ndarray) -> np.ndarray:
        """Banded alignment of all candidates at once."""
        wide = 4 * EDITS + 3
        out = np.empty(len(window), np.int64)
        for size in np.unique(self.sizes[window]):
            k = np.flatnonzero(self.sizes[window] == size)
            begin = self.starts[window[k]]
            pattern = self.points[begin[:, None] + np.arange(size)]
            zero = diagonal[k] - EDITS + 2 * WINDOW
            text = padded[np.clip(zero[:, None] + np.arange(size + wide), 0, len(padded) - 1)]
            ramp = np.arange(wide)
            cost = np.zeros((len(k), wide), np.int64)
            for r in range(size):
                step = cost + (text[:, r : r + wide] != pattern[:, r, None])
                step[:, :-1] = np.minimum(step[:, :-1], cost[:, 1:] + 1)
                cost = np.minimum.accumulate(step - ramp, axis=1) + ramp
            out[k] = cost.min(axis=1)
        return out

    def search(self, text: str | None) -> dict[int, tuple[set[int], int]]:
        """item id -> (its windows found, the smallest number of edits)."""
        least: dict[int, int] = {}
        whole, seen = normal(text), set()

        def look(begin: int, end: int, finer: bool) -> None:
            points = whole[begin:end]
            if finer:  # what repeats is searched once
                key = hashlib.blake2b(points.tobytes(), digest_size=16).digest()
                if key in seen:
                    return
                seen.add(key)
            at, k = self.hits(points)
            if not finer and self.count[k].sum() > MANY:
                for cut in range(begin, end, SEGMENT):
                    look(max(0, cut - 2 * WINDOW), min(end, cut + SEGMENT), True)
                return
            window, diagonal = self.candidates(at, k)
            edits = self.edits(points, window, diagonal)
            good = edits <= self.budgets[window]
            for w, e in zip(window[good].tolist(), edits[good].tolist(), strict=True):
                least[w] = min(e, least.get(w, e))

        for k in range(0, max(1, len(whole)), PIECE):
            look(max(0, k - 2 * WINDOW), k + PIECE, False)
        found: dict[int, tuple[set[int], int]] = {}
        for w, e in least.items():
            for own in self.members[self.ends[w - 1] if w else 0 : self.ends[w]].tolist():
                windows, before = found.setdefault(self.names[self.owner[own]], (set(), e))
                windows.add(own)
                if e < before:
                    found[self.names[self.owner[own]]] = windows, e
        return found


def _blocks(benchmark: DataFrame) -> Iterator[Callable[[], Index]]:
    """Loaders of the benchmark's index, a block at a time; each block is sent to the executors once."""
    spark = benchmark.sparkSession
    items = benchmark.where("item_id IS NOT NULL AND text IS NOT NULL").select("item_id", "text")
    chars = items.agg(F.coalesce(F.sum(F.char_length("text")), F.lit(0))).first()[0]
    n = max(1, -(-chars // BLOCK))
    for b in range(n):
        rows = items.where(F.pmod(F.xxhash64("item_id"), F.lit(n)) == b).distinct().orderBy("item_id", "text").collect()  # about BLOCK characters
        sent = spark.sparkContext.broadcast([(r.item_id, r.text) for r in rows])
        key = uuid.uuid4().hex

        def load(sent=sent, key=key) -> Index:
            if key not in _loaded:
                _loaded.clear()
                _loaded[key] = Index(sent.value)
            return _loaded[key]

        yield load


_loaded: dict = {}


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, windows, edits for each document that holds a passage of an item."""
    rows, out = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), None
    for load in _blocks(benchmark):

        def run(batches: Iterator[pa.RecordBatch], load=load) -> Iterator[pa.RecordBatch]:
            index = load()
            for batch in portions(batches):
                found = [(d, i, sorted(w), e) for d, t in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist(), strict=True) for i, (w, e) in sorted(index.search(t).items())]
                columns = list(zip(*found, strict=True)) or [[]] * 4
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.int32()), strict=True)], names=["doc_id", "item_id", "own", "edits"])

        part = rows.mapInArrow(run, "doc_id long, item_id long, own array<long>, edits int").select("doc_id", "item_id", "edits", F.explode("own").alias("own"))
        out = part if out is None else out.unionByName(part)
    return out.groupBy("doc_id", "item_id").agg(F.countDistinct("own").alias("windows"), F.min("edits").alias("edits"))  # an item is in one block


def keep_clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """`docs` without the rows that hold a passage of an item, all columns as they are."""
    for load in _blocks(benchmark):

        def run(batches: Iterator[pa.RecordBatch], load=load) -> Iterator[pa.RecordBatch]:
            index = load()
            for batch in portions(batches):
                yield batch.filter(pa.array([not index.search(t) for t in batch["text"].to_pylist()], pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
