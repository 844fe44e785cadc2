"""Cross-tokenizer alignment: which tokens of two tokenizers cover the same bytes.

Each text, a blank in front, is encoded by a byte-level BPE (A, `tokenizers`) and a piece BPE (B, `sentencepiece`). The character
offsets of A's encoding and the spans of B's immutable proto are coarse cuts: a token whose span has as many bytes as the token itself ends
where its span ends. The others (tokens that end inside a character, byte-fallback pieces, the blank that B adds) are refined by
the bytes they decode to. Offsets where tokens of both end cut a text into groups; two tokens are linked if their bytes overlap.

Neither tokenizer merges across a blank that follows a character other than a blank (which is checked when they are loaded), so texts are
cut there into chunks, and a chunk's tokens, groups and links are those of the text. Chunks met for the first time are joined and
encoded many at a time; recent ones are kept, ROOM of them at most, the more frequent ones longer.

1. Each row's numbers, digest and distinct linked id pairs (sorted, with how often each occurs) are stored.
2. An id pair's count is the number of rows that hold it linked: counted in each task first, then summed by Spark. The highest
   count of each A id comes from that table.
3. A counts table of up to PAIRS pairs (its size is counted first) is broadcast, and each row adds up its own pairs. A larger one is joined
   with the rows' pairs by Spark; it may be as large as the product of the vocabularies.

Null and empty texts, and texts whose joined token bytes differ from the text (U+2581, which B writes for blanks) have no tokens: zeros, and an empty digest.
Every row is a document of its own, rows with null or repeated ids too. Texts of any length are taken whole. Other columns are ignored. An empty
table gives an empty result.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, portions, stored

BYTE_BPE, PIECE_BPE = "/opt/tokenizers/byte_bpe_50k.json", "/opt/tokenizers/piece_bpe_32k.model"
#: Chunks that a worker keeps, and the most pairs and bytes they hold.
ROOM, WEIGHT = 250_000, 1 << 26
#: Pairs of a counts table that is broadcast, 16 bytes each.
PAIRS = 1 << 22
#: Characters of joined chunks that are encoded at once.
JOINED = 4096
#: White space of either tokenizer and more: a blank after one of these, or at the end, begins no chunk.
GAP = "".join(f"{chr(a)}-{chr(b)}" for a, b in ((0, 0x20), (0x7F, 0xA0), (0x1680, 0x1680), (0x2000, 0x200F), (0x2028, 0x202F), (0x205F, 0x205F), (0x2581, 0x2581), (0x3000, 0x3000), (0xFEFF, 0xFEFF)))
_GLUED, _ENDS = re.compile(f"[{GAP}] | $"), re.compile(f"[{GAP}]$")
_CUT = re.compile(f"(?<=[^{GAP}])(?= .)", re.DOTALL)


def byte_symbols() -> dict[str, int]:
    """The character of byte-level BPE vocabularies -> its byte: printable Latin-1 characters stand for themselves, the other bytes follow from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class Aligner:
    """Both tokenizers, and the chunks that they have encoded."""

    def __init__(self, byte_bpe: bytes, piece_bpe: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark deals the work
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(byte_bpe.decode())
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=piece_bpe)
        symbols, vocabulary = byte_symbols(), self.a.get_vocab(with_added_tokens=True)
        a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            a_bytes[i] = bytes(symbols[c] for c in token) if all(c in symbols for c in token) else token.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.bytes = a_bytes, b_bytes
        self.sizes = tuple(np.array([len(x) for x in own], np.int64) for own in self.bytes)
        self.names = [[f"{i}{end}".encode() for i in range(len(own))] for own in self.bytes for end in ",|;"]  # A: 0 to 2, B: 3 to 5
        model = json.loads(byte_bpe)
        before = model.get("pre_tokenizer") or {}
        self.cuttable = (before.get("type"), before.get("use_regex", True), before.get("add_prefix_space"), model.get("normalizer")) == ("ByteLevel", True, False, None) and not any(re.search("[^▁]▁", p) for p in pieces)
        self.index: dict[str, int] = {}
        self.numbers, self.seen, self.start = np.zeros((0, 5), np.int64), np.zeros(0, np.int64), np.zeros(1, np.int64)
        self.codes, self.digests = np.zeros(0, np.int64), []

    @property
    def code_type(self) -> str:
        return "int" if len(self.bytes[0]) * len(self.bytes[1]) < 1 << 31 else "long"

    def chunks(self, text: str) -> list[str]:
        """The text's chunks, each without the blank that it begins with."""
        if not self.cuttable:
            return [text]
        if not _GLUED.search(f" {text}"):
            return text.split(" ")
        return [c[1:] for c in _CUT.split(f" {text}")]

    def _ends(self, side: int, ids: np.ndarray, begin: np.ndarray, end: np.ndarray, data: bytes) -> np.ndarray | None:
        """Where tokens end in a text's bytes; begin, end: their spans in bytes. None if they don't spell the text."""
        refined = np.cumsum(self.sizes[side][ids])
        own = self.bytes[side]
        if b"".join([own[i] for i in ids.tolist()]) != data:
            return None
        found = np.where(end - begin == self.sizes[side][ids], end, refined)
        return found if np.array_equal(found, refined) else refined

    def _encoded(self, texts: list[str]) -> list[tuple[np.ndarray, ...] | None]:
        """(ids and byte ends of A, of B) of each text; None if one of them doesn't spell the text. Texts begin with a blank."""
        out = []
        left = self.a.encode_batch(texts, add_special_tokens=False)
        right = self.b.encode([t[1:] for t in texts], return_type="proto", num_threads=1)
        for text, x, y in zip(texts, left, right, strict=True):
            data, pieces = text.encode("utf-8", "replace"), list(y.pieces)
            of_char = np.append(np.flatnonzero((np.frombuffer(data, np.uint8) & 0xC0) != 0x80), len(data))
            a, spans = np.array(x.ids, np.int64), of_char[np.array(x.offsets, np.int64).reshape(-1, 2)]
            b = np.array([p.id for p in pieces], np.int64)
            begin, end = (np.array([getattr(p, side) for p in pieces], np.int64) + 1 for side in ("begin", "end"))  # in bytes, without the blank that B adds
            begin[:1] = 0
            ends = self._ends(0, a, *spans.T, data), self._ends(1, b, begin, end, data)
            out.append(None if ends[0] is None or ends[1] is None else (a, ends[0], b, ends[1]))
        return out

    def learn(self, fresh: list[str]) -> None:
        """Encode chunks and keep what is needed of them."""
        joined: list[list[str]] = []
        length = JOINED
        for c in fresh:
            alone = not self.cuttable or bool(_ENDS.search(c))
            if alone or length + len(c) >= JOINED:
                joined.append([])
                length = JOINED if alone else 0
            joined[-1].append(c)
            length += len(c) + 1
        known = list(zip(joined, self._encoded(["".join(f" {c}" for c in own) for own in joined]), strict=True))
        for own, found in [x for x in known if x[1] is None and len(x[0]) > 1]:  # find the chunks that aren't spelt
            known += [([c], alone) for c, alone in zip(own, self._encoded([f" {c}" for c in own]), strict=True)]
        for own, found in known:
            if found is None and len(own) == 1:
                self._keep(own, np.array([[0, 0, 0, 0, 1]]), np.zeros(1, np.int64), np.zeros(0, np.int64), [b""])
        good = [x for x in known if x[1] is not None]
        if not good:
            return
        names = [c for own, _ in good for c in own]
        size = np.array([len(c.encode("utf-8", "replace")) + 1 for c in names], np.int64)
        ends = np.cumsum(size)
        base = np.concatenate([[0], np.cumsum([found[1][-1] for _, found in good])])[:-1]
        a, b = (np.concatenate([found[k] for _, found in good]) for k in (0, 2))
        end_a, end_b = (np.concatenate([found[k] + at for at, (_, found) in zip(base, good, strict=True)]) for k in (1, 3))
        common = np.intersect1d(end_a, end_b, assume_unique=True)
        if not np.isin(ends, common, assume_unique=True).all():
            raise RuntimeError("a token crosses the border of chunks")
        begin_a = np.concatenate([[0], end_a[:-1]])
        first, last = np.searchsorted(end_b, begin_a, "right"), np.searchsorted(end_b, end_a, "left")
        n = last - first + 1
        whose = np.repeat(np.arange(len(a)), n)
        other = first[whose] + np.arange(len(whose)) - np.repeat(np.cumsum(n) - n, n)
        codes = a[whose] * len(self.bytes[1]) + b[other]
        upto = [np.searchsorted(x, ends, "right") for x in (end_a, end_b, common)]
        links = np.concatenate([[0], np.cumsum(n)])[upto[0]]
        counts = np.stack([np.diff(x, prepend=0) for x in (*upto, links)] + [np.zeros(len(names), np.int64)], axis=1)
        # text of the groups: each group's A tokens, then its B tokens, with what stands behind each
        group = [np.searchsorted(common, x) for x in (end_a, end_b)]
        closing = [np.isin(x, common, assume_unique=True) for x in (end_a, end_b)]
        kind = np.concatenate([np.where(closing[0], 1, 0), np.where(closing[1], 5, 3)])
        order = np.argsort(np.concatenate([2 * group[0], 2 * group[1] + 1]), kind="stable")
        parts = [self.names[k][i] for k, i in zip(kind[order].tolist(), np.concatenate([a, b])[order].tolist(), strict=True)]
        cuts = (upto[0] + upto[1]).tolist()
        self._keep(names, counts, np.diff(links, prepend=0), codes, [b"".join(parts[i:j]) for i, j in zip([0, *cuts], cuts)])

    def _keep(self, names: list[str], numbers: np.ndarray, n_codes: np.ndarray, codes: np.ndarray, digests: list[bytes]) -> None:
        self.index.update(zip(names, range(len(self.digests), len(self.digests) + len(names))))
        self.numbers = np.concatenate([self.numbers, numbers])
        self.seen = np.concatenate([self.seen, np.zeros(len(names), np.int64)])
        self.start = np.concatenate([self.start, self.start[-1] + np.cumsum(n_codes)])
        self.codes = np.concatenate([self.codes, codes])
        self.digests += digests

    def forget(self) -> None:
        """Keep the more frequent half of the chunks once there are too many."""
        if len(self.index) <= ROOM and 8 * len(self.codes) + sum(map(len, self.digests)) <= WEIGHT:
            return
        kept = np.argsort(-self.seen, kind="stable")[: min(ROOM, len(self.seen)) // 2]
        kept = np.sort(kept[self.seen[kept] > 1])
        n = np.diff(self.start)[kept]
        if 8 * n.sum() > WEIGHT // 2:
            kept, n = kept[:0], n[:0]
        names = list(self.index)  # in the order of their numbers
        codes = self.codes[np.repeat(self.start[kept], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)]
        digests, numbers, seen = [self.digests[k] for k in kept.tolist()], self.numbers[kept], self.seen[kept] // 2
        self.index, self.digests, self.numbers, self.start, self.codes = {}, [], self.numbers[:0], np.zeros(1, np.int64), self.codes[:0]
        self.seen = self.seen[:0]
        self._keep([names[k] for k in kept.tolist()], numbers, n, codes, digests)
        self.seen = seen

    def rows(self, texts: list[str | None]) -> tuple[np.ndarray, list[str], np.ndarray, np.ndarray, np.ndarray]:
        """Of each text: (n_a, n_b, n_groups, n_links), digest, how many distinct pairs it has; all pairs' codes, and how often each occurs."""
        self.forget()
        own = [self.chunks(t) if t else [] for t in texts]
        flat = [c for x in own for c in x]
        if fresh := list(set(flat).difference(self.index)):
            self.learn(fresh)
        at = np.fromiter(map(self.index.__getitem__, flat), np.int64, len(flat))
        np.add.at(self.seen, at, 1)
        ends = np.cumsum([len(x) for x in own])
        total = np.concatenate([np.zeros((1, 5), np.int64), np.cumsum(self.numbers[at], axis=0)])
        numbers = total[ends] - total[np.concatenate([[0], ends[:-1]])]
        numbers[numbers[:, 4] > 0] = 0  # texts that aren't spelt
        digests, places = [], at.tolist()
        for k, (low, high) in enumerate(zip([0, *ends.tolist()], ends.tolist())):
            joined = b"".join([self.digests[p] for p in places[low:high]]) if numbers[k, 0] else b""
            digests.append(hashlib.sha256(joined[:-1]).hexdigest() if joined else "")
        row = np.repeat(np.arange(len(own)), [len(x) for x in own])
        on = numbers[row, 0] > 0
        chunk, times = np.unique(row[on] << 32 | at[on], return_counts=True)
        row, at = chunk >> 32, chunk & 0xFFFFFFFF
        n = self.start[at + 1] - self.start[at]
        code = self.codes[np.repeat(self.start[at], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)]
        times, row = np.repeat(times, n), np.repeat(row, n)
        order = np.lexsort((code, row)) if len(self.bytes[0]) * len(self.bytes[1]) >= 1 << 32 else np.argsort(row << 32 | code)
        code, row, times = code[order], row[order], times[order]
        new = np.flatnonzero(np.concatenate([[True], (code[1:] != code[:-1]) | (row[1:] != row[:-1])])) if len(code) else np.zeros(0, np.int64)
        return numbers[:, :4], digests, np.bincount(row[new], minlength=len(own)), code[new], np.add.reduceat(times, new) if len(new) else times


_loaded: dict[bytes, Aligner] = {}


def aligner(models: tuple[bytes, bytes]) -> Aligner:
    key = hashlib.sha256(models[0] + b"\0" + models[1]).digest()
    if key not in _loaded:
        _loaded.clear()
        _loaded[key] = Aligner(*models)
    return _loaded[key]


def _file(path: str) -> bytes:
    with open(path, "rb") as f:  # on the driver; a vocabulary, sent to the executors once
        return f.read()


def _listed(values: np.ndarray, sizes: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), pa.array(values, kind))


def aligned(docs: DataFrame, byte_bpe: str = BYTE_BPE, piece_bpe: str = PIECE_BPE) -> DataFrame:
    """doc_id, row (a number of its own), n_a, n_b, n_groups, n_links, groups_sha256, codes, times; a code is A's id * size of B's vocabulary + B's id."""
    spark = docs.sparkSession
    models = _file(byte_bpe), _file(piece_bpe)
    sent, code = spark.sparkContext.broadcast(models), aligner(models).code_type
    kind = pa.int32() if code == "int" else pa.int64()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both, row = aligner(sent.value), TaskContext.get().partitionId() << 40
        for batch in portions(batches):
            numbers, digests, sizes, codes, times = both.rows(batch["text"].to_pylist())
            columns = [batch["doc_id"], pa.array(row + np.arange(len(batch))), *(pa.array(numbers[:, k]) for k in range(4)), pa.array(digests, pa.string()), _listed(codes, sizes, kind), _listed(times, sizes, pa.int32())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "row", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "codes", "times"])
            row += len(batch)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(run, f"doc_id long, row long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, codes array<{code}>, times array<int>")


def pair_counts(rows: DataFrame, size_b: int) -> DataFrame:
    """code, n (rows of `aligned` that hold it) and best: whether no pair of the same A id has more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, counts, waiting, held = np.zeros(0, np.int64), np.zeros(0, np.int64), [], 0

        def folded() -> tuple[np.ndarray, np.ndarray]:
            every = np.concatenate([codes, *waiting])
            found, where = np.unique(every, return_inverse=True)
            return found, np.bincount(where, np.concatenate([counts, np.ones(len(every) - len(counts))]), len(found)).astype(np.int64)

        for batch in batches:
            waiting.append(batch["codes"].flatten().to_numpy(zero_copy_only=False).astype(np.int64))
            held += len(waiting[-1])
            if held > PAIRS:
                (codes, counts), waiting, held = folded(), [], 0
            if len(codes) > PAIRS:
                yield pa.RecordBatch.from_arrays([pa.array(codes), pa.array(counts)], names=["code", "n"])
                codes, counts = codes[:0], counts[:0]
        codes, counts = folded()
        yield pa.RecordBatch.from_arrays([pa.array(codes), pa.array(counts)], names=["code", "n"])

    n = rows.select("codes").mapInArrow(run, "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))
    owned = cut(n.withColumn("a", F.expr(f"code div {size_b}")))
    most = owned.groupBy("a").agg(F.max("n").alias("most"))
    return cut(owned.join(most, "a").select("code", "n", (F.col("n") == F.col("most")).alias("best")))


def _by_broadcast(rows: DataFrame, counts: DataFrame) -> DataFrame:
    table = counts.toArrow()  # PAIRS at most
    code = np.array(table["code"], np.int64)
    order = np.argsort(code)
    sent = rows.sparkSession.sparkContext.broadcast((code[order], np.array(table["n"], np.int64)[order], np.array(table["best"], bool)[order]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, n, best = sent.value
        for batch in batches:
            own, times = (batch[c].flatten().to_numpy(zero_copy_only=False).astype(np.int64) for c in ("codes", "times"))
            at = np.searchsorted(code, own)
            ends = np.cumsum(np.array(batch["codes"].value_lengths(), np.int64))
            sums = [np.concatenate([[0], np.cumsum(x)]) for x in (times * best[at], times * n[at])] if len(code) else [np.zeros(1, np.int64)] * 2
            parts = [pa.array(s[ends] - s[np.concatenate([[0], ends[:-1]])]) for s in sums]
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in FIRST), *parts, batch["groups_sha256"]], names=[*FIRST, "n_best", "count_sum", "groups_sha256"])

    return rows.mapInArrow(run, "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")


def _by_join(rows: DataFrame, counts: DataFrame) -> DataFrame:
    """The same by a join; a pair that many rows hold is met by them in several partitions."""
    salts = 16
    each = rows.select("row", F.explode(F.arrays_zip("codes", "times")).alias("x")).select("row", F.col("x.codes").cast("long").alias("code"), F.col("x.times").alias("t"), F.pmod(F.xxhash64("row"), F.lit(salts)).alias("salt"))
    spread = counts.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))))
    sums = each.join(spread, ["code", "salt"]).groupBy("row").agg(F.sum(F.when(F.col("best"), F.col("t")).otherwise(0)).alias("n_best"), F.sum(F.col("t") * F.col("n")).alias("count_sum"))
    whole = rows.select("row", *FIRST, "groups_sha256").join(sums, "row", "left")
    return whole.select(*FIRST, *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_best", "count_sum")), "groups_sha256")


FIRST = ["doc_id", "n_a", "n_b", "n_groups", "n_links"]


def links(docs: DataFrame, byte_bpe: str = BYTE_BPE, piece_bpe: str = PIECE_BPE) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 for every row."""
    rows = stored(aligned(docs, byte_bpe, piece_bpe), "aligned")
    counts = pair_counts(rows, len(aligner((_file(byte_bpe), _file(piece_bpe))).bytes[1]))
    return (_by_broadcast if counts.count() <= PAIRS else _by_join)(rows, counts)
