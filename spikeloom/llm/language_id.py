"""Language ID with hyperdimensional profiles.

Every letter has a random vector of +1/-1 drawn from its code point. A trigram is the product of its letters' vectors,
the first rotated twice and the second once; a text is the sum of its trigrams (words are padded by one blank on either
side); a language's prototype is the sum of its training texts. A text gets the language whose prototype has the
largest cosine with it, the first in alphabetical order on ties.

Prototypes are bundled over every training row: each task sums its rows by language, Spark adds the sums, and DIMENSIONS
numbers for each learned language reach the driver. A null text or one without letters (characters that str.isalpha() takes; other numbers
than digits, as in "\u00b2", are none) gets `und` and score 0, as does every text if nothing could be learned. The score is (1 + cosine) / 2.
Very long texts are taken in pieces. Rows with a null doc_id teach nothing, aren't held out, and get a result; of repeated ids each row gets one.
Other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import U64, mixed, portions, remainder

DIMENSIONS = 1024
PIECE = 1 << 20
_NOT_LETTERS = re.compile(r"[\W\d_]+")
#: Characters that count as part of a word, but are no letters: numbers that aren't digits. Those of the first plane are one set, which is a fast test.
_NUMBER = re.compile("[" + "".join(c for c in map(chr, range(0x80, 0xD800)) if c.isalnum() and not c.isalpha() and not c.isdecimal()) + "]")
_BEYOND = re.compile("[\uE000-\U0010FFFF]")


def letters(text: str, blank: str = "") -> str:
    """A text with `blank` for every run of characters that are no letters."""
    if not text.isascii():
        text = _NUMBER.sub(" ", text)
        if _BEYOND.search(text):
            text = "".join(c if c < "\uE000" or c.isalpha() else " " for c in text)
    return _NOT_LETTERS.sub(blank, text)


def letter_vectors(points: np.ndarray) -> np.ndarray:
    """(n, DIMENSIONS) of +1/-1: bit i of the hashes of a code point."""
    words = mixed(points.astype(np.uint64)[:, None] * U64(0x9E3779B97F4A7C15) + mixed(np.arange(1, DIMENSIONS // 64 + 1, dtype=np.uint64))[None, :])
    return np.unpackbits(words.view(np.uint8).reshape(len(points), -1), axis=1).astype(np.int8) * 2 - 1


def trigrams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The distinct trigrams of a text as 63-bit codes, and their counts."""
    codes, counts = [], []
    for k in range(0, max(len(text), 1), PIECE):  # a trigram over a piece's border belongs to the earlier piece
        lead = text[max(0, k - 1) : k] if k else ""
        words = letters((lead + text[k : k + PIECE + 1 if k + PIECE < len(text) else None]).lower(), " ")
        if not words.strip():
            continue
        words = words if k else " " + words.lstrip(" ")
        words = words if k + PIECE < len(text) else words.rstrip(" ") + " "
        p = np.frombuffer(words.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.int64)
        if len(p) < 3:
            continue
        grams = (p[:-2] << 42) | (p[1:-1] << 21) | p[2:]
        code, n = np.unique(grams[p[1:-1] != 32], return_counts=True)
        codes.append(code)
        counts.append(n)
    if not codes:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    if len(codes) == 1:
        return codes[0], counts[0]
    code, where = np.unique(np.concatenate(codes), return_inverse=True)
    return code, np.bincount(where, weights=np.concatenate(counts)).astype(np.int64)


def gram_vectors(codes: np.ndarray) -> np.ndarray:
    mask = (1 << 21) - 1
    points = [(codes >> 42) & mask, (codes >> 21) & mask, codes & mask]
    known, where = np.unique(np.concatenate(points), return_inverse=True)
    letters = letter_vectors(known)
    a, b, c = (letters[w] for w in np.split(where, 3))
    return np.roll(a, 2, axis=1) * np.roll(b, 1, axis=1) * c


class Bundler:
    """Bundles trigram counts; keeps the vectors of up to `room` trigrams of this task."""

    def __init__(self, room: int = 60_000):
        self.room, self.index, self.rows = room, {}, np.empty((0, DIMENSIONS), np.int8)
        self.codes = np.empty(0, np.int64)

    def add(self, codes: np.ndarray) -> None:
        if len(self.codes) + len(codes) > self.room:
            self.codes, self.rows = np.empty(0, np.int64), np.empty((0, DIMENSIONS), np.int8)
        fresh = codes if not len(self.codes) else codes[self.codes[np.minimum(np.searchsorted(self.codes, codes), len(self.codes) - 1)] != codes]
        if len(fresh):
            at = np.searchsorted(self.codes, fresh)
            self.codes, self.rows = np.insert(self.codes, at, fresh), np.insert(self.rows, at, gram_vectors(fresh), axis=0)

    def bundle(self, codes: np.ndarray, counts: np.ndarray) -> np.ndarray:
        out = np.zeros(DIMENSIONS, np.float32)
        for k in range(0, len(codes), self.room // 2):
            part = codes[k : k + self.room // 2]
            out += counts[k : k + self.room // 2].astype(np.float32) @ self.rows[np.searchsorted(self.codes, part)].astype(np.float32)
        return out


def bundles(texts: list[str], bundler: Bundler) -> np.ndarray:
    """(n, DIMENSIONS), the sums of the texts' trigram vectors."""
    out = np.zeros((len(texts), DIMENSIONS), np.float32)
    grams = [trigrams(t) for t in texts]
    if every := [c for c, _ in grams if len(c)]:
        bundler.add(np.unique(np.concatenate(every))[: bundler.room])
    for i, (codes, counts) in enumerate(grams):
        if len(codes):
            at = np.minimum(np.searchsorted(bundler.codes, codes), len(bundler.codes) - 1)
            if (bundler.codes[at] != codes).any():  # more trigrams in one batch than there is room for
                for k in range(0, len(codes), 4096):
                    out[i] += counts[k : k + 4096].astype(np.float32) @ gram_vectors(codes[k : k + 4096]).astype(np.float32)
            else:
                out[i] = counts.astype(np.float32) @ bundler.rows[at].astype(np.float32)
    return out


def prototypes(training: DataFrame) -> dict[str, np.ndarray]:
    """Unit prototypes by language from all rows (text, lang); rows with a null lang don't count."""

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        bundler = Bundler()
        for batch in portions(batches):
            by: dict[str, list] = {}
            for lang, text in zip(batch["lang"].to_pylist(), batch["text"].to_pylist(), strict=True):
                by.setdefault(lang, []).append(text or "")
            for lang, texts in by.items():
                grams = [g for g in map(trigrams, texts) if len(g[0])]
                if not grams:
                    continue
                code, where = np.unique(np.concatenate([c for c, _ in grams]), return_inverse=True)
                counts = np.bincount(where, weights=np.concatenate([n for _, n in grams]))
                total = sums.setdefault(lang, np.zeros(DIMENSIONS, np.float64))
                for k in range(0, len(code), bundler.room // 2):
                    part = code[k : k + bundler.room // 2]
                    bundler.add(part)
                    total += counts[k : k + bundler.room // 2].astype(np.float32) @ bundler.rows[np.searchsorted(bundler.codes, part)].astype(np.float32)
        for lang, total in sums.items():
            yield pa.RecordBatch.from_pydict({"lang": pa.array([lang] * DIMENSIONS), "d": pa.array(np.arange(DIMENSIONS, dtype=np.int32)), "v": pa.array(total)})

    rows = training.where("lang IS NOT NULL").select("lang", "text").mapInArrow(summed, "lang string, d int, v double")
    found: dict[str, np.ndarray] = {}
    for lang, d, v in rows.groupBy("lang", "d").agg(F.sum(F.col("v").cast("decimal(38,0)")).cast("double")).collect():  # DIMENSIONS numbers a language
        found.setdefault(lang, np.zeros(DIMENSIONS))[d] = v
    return {k: (v / n).astype(np.float32) for k, v in sorted(found.items()) if (n := np.linalg.norm(v))}


def labeller(model: dict[str, np.ndarray]) -> Callable[[list[str | None]], tuple[list[str], np.ndarray]]:
    """A function from texts to their languages and scores, for one task."""
    langs, matrix, bundler = list(model), np.array(list(model.values()), np.float32).reshape(len(model), DIMENSIONS).T, Bundler()

    def label(texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        sums = bundles([t or "" for t in texts], bundler)
        norms = np.linalg.norm(sums, axis=1)
        cosines = (sums @ matrix) / np.maximum(norms, 1e-9)[:, None] if langs else np.zeros((len(sums), 1))
        best = cosines.argmax(axis=1)
        some = (norms > 0) & bool(langs)
        score = np.where(some, np.clip((1 + cosines[np.arange(len(best)), best]) / 2, 0, 1), 0).astype(np.float64)
        return [langs[b] if s else "und" for b, s in zip(best, some, strict=True)], score

    return label


def identify(docs: DataFrame, model: dict[str, np.ndarray]) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        label = labeller(model)
        for batch in portions(batches):
            names, score = label(batch["text"].to_pylist())
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["held_out"], pa.array(names, pa.string()), pa.array(score)], names=["doc_id", "held_out", "lang_pred", "score"])

    rows = docs.select("doc_id", F.coalesce(remainder("doc_id", 3) == 1, F.lit(False)).alias("held_out"), "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, held_out boolean, lang_pred string, score double")


def predict_languages(docs: DataFrame) -> DataFrame:
    """Learns from the rows that are not held out, then predicts every row."""
    model = prototypes(docs.where(F.coalesce(remainder("doc_id", 3) != 1, F.lit(False))))
    return identify(docs, model)


def keep_identified(docs: DataFrame) -> DataFrame:
    """`docs` without null texts and texts without letters. No score rejects a text, and where nothing could be learned those with letters stay."""
    model = prototypes(docs.where(F.coalesce(remainder("doc_id", 3) != 1, F.lit(False))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        label = labeller(model)
        for batch in portions(batches):
            texts = batch["text"].to_pylist()
            names, _ = label(texts)
            yield batch.filter(pa.array([n != "und" or bool(letters(t or "")) for n, t in zip(names, texts, strict=True)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
