"""SentencePiece encoding and decoding by weighted finite-state transducers.

Three transducers are composed, of which the pieces' one is compiled from the model file and the others are rules of one state:

* The normaliser writes U+2581 for every blank and puts one in front of a text that is not empty.
* The piece transducer reads characters down a trie and, where a piece ends, writes its id with the weight -score. In a
  unigram model it goes back to its start. In a merge model its state remembers the last piece, and an arc that leads
  to a piece that may not follow has infinite weight: the merges of the two strings joined must make these two pieces.
* The fallback reads any character outside the vocabulary and writes its UTF-8 bytes as byte pieces.

Composing them with a text gives a graph of arcs between its positions. Its shortest path in the tropical semiring (costs add
along a path, the least one counts) is found by relaxing all arcs in the order of positions, and is the text's encoding: in a unigram model
by its scores; in a merge model one sequence of pieces alone has a finite cost, which is that of the model's own merges. The
tests hold both against the public library.

No piece crosses the borders of certain chunks (which is checked when a model is compiled), so the path of a text is that of its chunks
in a row. Chunks that are met for the first time are composed and relaxed many at a time; the paths of recent ones are
kept, a bounded number of them. Models of another type, with a character map, or without byte pieces are refused.

Null texts count as empty and give no pieces. U+2581 in a text comes back as a blank, as the format has it. Texts of any
length are taken whole; rows with null or repeated ids get results like others; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mixed, portions

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
ROOM = 300_000
#: Rows that are decoded at a time.
ROWS = 256
#: Chunks of more characters are relaxed one by one.
LONG = 48
UNIGRAM, MERGES = 1, 2
#: Fixed value: by how much an unknown character costs more than the costliest piece of a unigram model.
UNKNOWN = 10.0


def chunker(spaced: list[str]):
    """Cuts a text where no piece ever crosses: letters and digits, other characters, each with the blanks in front.

    Characters of pieces that would cross count as other ones; if pieces still cross, only blanks begin a chunk.
    """
    odd = ""
    for _ in range(2):
        cut = re.compile(rf" *[^\W_{odd}]+| *(?:[^\w ]|[_{odd}])+| +")
        crossing = [p for p in spaced if not cut.fullmatch(p)]
        if not crossing:
            return cut.findall
        odd = "".join(re.escape(c) for c in sorted({c for p in crossing for c in p} - {" "}))
    return re.compile(r" +[^ ]*").findall if all(" " not in p.lstrip(" ") for p in spaced) else lambda text: [text]


def _fields(data: bytes) -> Iterator[tuple[int, int, bytes | int]]:
    """(number, wire type, value) of each field of a protocol-buffer message."""

    def varint(k: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            value |= (data[k] & 127) << shift
            shift += 7
            k += 1
            if data[k - 1] < 128:
                return value, k

    k = 0
    while k < len(data):
        key, k = varint(k)
        if key & 7 == 0:
            value, k = varint(k)
        elif key & 7 == 2:
            n, k = varint(k)
            value, k = data[k : k + n], k + n
        else:
            n = 4 if key & 7 == 5 else 8
            value, k = data[k : k + n], k + n
        yield key >> 3, key & 7, value


def _varied(data: bytes) -> dict[int, bytes | int]:
    return {n: v for n, _, v in _fields(data)}


def read_model(data: bytes) -> tuple[list[tuple[str, float, int]], int, bool]:
    """((piece, score, kind) in the order of ids, model type, whether a blank is put in front); kinds: 1 normal, 2 unknown, 3 control, 6 byte."""
    pieces, trainer, normaliser = [], {}, {}
    for number, _, value in _fields(data):
        if number == 1:
            own = _varied(value)
            pieces.append((own[1].decode(), float(np.frombuffer(own.get(2, b"\0\0\0\0"), "<f4")[0]), own.get(3, 1)))
        elif number == 2:
            trainer = _varied(value)
        elif number == 3:
            normaliser = _varied(value)
    kind = trainer.get(3, UNIGRAM)
    faults = {
        f"model type {kind}": kind not in (UNIGRAM, MERGES), "a character map": bool(normaliser.get(2)), "blanks that are removed": bool(normaliser.get(4, 1)),
        "blanks that stay": not normaliser.get(5, 1), "blanks as suffixes": bool(trainer.get(24)), "user-defined pieces": any(k == 4 for *_, k in pieces), "no byte pieces": sum(k == 6 for *_, k in pieces) != 256,
    }
    if any(faults.values()):
        raise ValueError(f"this model can't be encoded here: {', '.join(k for k, v in faults.items() if v)}")
    return pieces, kind, bool(normaliser.get(3, 1))


class Table:
    """A map from 64-bit keys to numbers for arrays of keys: open addressing, at most half full, and emptied beyond `most` places."""

    def __init__(self, bits: int = 16, most: int = 22):
        self.most = most
        self._clear(bits)

    def _clear(self, bits: int) -> None:
        self.keys, self.values, self.used = np.full(1 << bits, -1, np.int64), np.zeros(1 << bits, np.int32), 0

    def _place(self, keys: np.ndarray) -> np.ndarray:
        return (mixed(keys.view(np.uint64)) & np.uint64(len(self.keys) - 1)).astype(np.int64)

    def get(self, keys: np.ndarray) -> np.ndarray:
        """The value of each key, -1 where there is none."""
        at = self._place(keys)
        found = self.keys[at]
        out = np.where(found == keys, self.values[at], -1)
        left = np.flatnonzero((found != keys) & (found >= 0))
        while len(left):
            at[left] = (at[left] + 1) & (len(self.keys) - 1)
            found = self.keys[at[left]]
            hit = found == keys[left]
            out[left[hit]] = self.values[at[left[hit]]]
            left = left[~hit & (found >= 0)]
        return out

    def put(self, keys: np.ndarray, values: np.ndarray) -> None:
        """Adds distinct keys that aren't there yet."""
        bits = len(self.keys).bit_length() - 1
        if self.used + len(keys) > len(self.keys) // 2:
            have = np.flatnonzero(self.keys >= 0)
            old = self.keys[have], self.values[have]
            grown = (self.used + len(keys)).bit_length() + 1
            self._clear(max(bits, grown) if grown <= self.most else max(bits, (len(keys)).bit_length() + 1))
            if grown <= self.most:
                self.put(*old)
        self.used += len(keys)
        at, left = self._place(keys), np.arange(len(keys))
        while len(left):
            free = left[self.keys[at[left]] < 0]
            self.keys[at[free]] = keys[free]  # of keys that want one place, one gets it
            self.values[at[free]] = values[free]
            left = left[self.keys[at[left]] != keys[left]]
            at[left] = (at[left] + 1) & (len(self.keys) - 1)
            taken = left[self.keys[at[left]] == keys[left]]
            left = np.setdiff1d(left, taken, assume_unique=True) if len(taken) else left


class Transducer:
    """The compiled model of one Python worker."""

    def __init__(self, vocabulary: list[tuple[str, float, int]], kind: int = MERGES, blank_first: bool = True):
        self.strings, self.merges, self.lead = [p for p, _, _ in vocabulary], kind == MERGES, " " if blank_first else ""
        self.ids = {p: i for i, (p, _, k) in enumerate(vocabulary) if k == 1}
        self.weight = [-s for _, s, _ in vocabulary]
        self.weights = np.array(self.weight)
        self.byte = [0] * 256
        for i, (p, _, k) in enumerate(vocabulary):
            if k == 6:
                self.byte[int(p[1:-1], 16)] = i
        if self.merges and (missing := {c for p in self.ids for c in p} - set(self.ids)):
            raise ValueError(f"characters of pieces that are no pieces: {len(missing)}")
        self.unknown = UNKNOWN + max((self.weight[i] for i in self.ids.values()), default=0.0)
        self.chunks = chunker([p.replace("▁", " ") for p in self.ids])
        self.longest = max(map(len, self.ids), default=1)
        self._compile()
        self.fits: dict[int, bool] = {}
        self.pairs = Table()
        self.paths: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        spelled = [bytes([int(p[1:-1], 16)]) if k == 6 else b"" if k == 3 else p.replace("▁", " ").encode() for p, _, k in vocabulary]
        self.blob = np.frombuffer(b"".join(spelled), np.uint8)
        self.size = np.array([len(x) for x in spelled], np.int64)
        self.start = np.cumsum(self.size) - self.size

    def _compile(self) -> None:
        """The pieces' trie: next node by (node, character), and the piece that ends at a node or -1."""
        children, final = {}, [-1]
        for p, i in self.ids.items():
            node = 0
            for c in p:
                key = node << 21 | ord(c)
                if (to := children.get(key)) is None:
                    to = children[key] = len(final)
                    final.append(-1)
                node = to
            final[node] = i
        self.children, self.final = children, np.array(final, np.int64)
        self.trie = Table(most=40)
        self.trie.put(np.array(list(children), np.int64), np.array(list(children.values()), np.int32))

    def unmerged(self, a: str, b: str) -> bool:
        """Whether the model's merges of a + b make a and b, and never join across."""
        parts, ids, weight, border = list(a + b), self.ids, self.weight, len(a)
        costs = [weight[i] if (i := ids.get(x + y)) is not None else None for x, y in zip(parts, parts[1:])]
        while True:
            best, at = None, -1
            for k, w in enumerate(costs):
                if w is not None and (best is None or w < best):
                    best, at = w, k
            if at == border - 1:
                return False
            if at < 0:
                return border == 1 and len(parts) == 2
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            del costs[at]
            border -= at < border
            for k in (at - 1, at):
                if 0 <= k < len(costs):
                    i = ids.get(parts[k] + parts[k + 1])
                    costs[k] = None if i is None else weight[i]

    def follows(self, a: int, b: int) -> bool:
        """Whether the arc from piece a to piece b has a finite weight."""
        key = a << 20 | b
        known = self.fits.get(key)
        if known is None:
            if len(self.fits) > 4 * ROOM:
                self.fits.clear()
            known = self.fits[key] = self.unmerged(self.strings[a], self.strings[b])
        return known

    def all_follow(self, before: np.ndarray, after: np.ndarray) -> np.ndarray:
        """`follows` for arrays; -1 stands for a start or an unknown character, which anything may follow."""
        keys = before << 20 | after
        keys[before < 0] = 0
        known = self.pairs.get(keys)
        known[before < 0] = 1
        if (known < 0).any():
            fresh = np.unique(keys[known < 0])
            names = self.strings
            self.pairs.put(fresh, np.array([self.unmerged(names[k >> 20], names[k & 0xFFFFF]) for k in fresh.tolist()], np.int32))
            at = np.flatnonzero(known < 0)
            known[at] = self.pairs.get(keys[at])
        return known > 0

    def shortest(self, chunk: str) -> list[int]:
        """The ids of the cheapest path that spells `chunk`."""
        n, children, final, weight = len(chunk), self.children, self.final, self.weight
        cost, last, back = array("d", [np.inf]) * (n + 1), array("i", [-1]) * (n + 1), array("i", [0]) * (n + 1)
        cost[0] = 0.0
        for start in range(n):
            node, end = children.get(ord(chunk[start])), start + 1
            if chunk[start] not in self.ids and cost[start] + self.unknown < cost[end]:
                cost[end], last[end], back[end] = cost[start] + self.unknown, -1, start
            while node is not None:
                i = final[node]
                if i >= 0 and cost[start] + weight[i] < cost[end] and (not self.merges or last[start] < 0 or self.follows(last[start], int(i))):
                    cost[end], last[end], back[end] = cost[start] + weight[i], i, start
                node = children.get(node << 21 | ord(chunk[end])) if end < n else None
                end += 1
        out, end = [], n
        while end:
            out.append([last[end]] if last[end] >= 0 else [self.byte[b] for b in chunk[back[end] : end].encode("utf-8", "replace")])
            end = back[end]
        return [i for ids in reversed(out) for i in ids]

    def all_shortest(self, chunks: list[str]) -> list[bytes]:
        """The shortest paths of many chunks, as little-endian 32-bit ids."""
        size = np.array([len(c) for c in chunks], np.int64)
        points = np.frombuffer("".join(chunks).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
        begin = np.cumsum(size) - size  # of a chunk's characters; its states are begin + chunk .. begin + chunk + size
        chunk = np.repeat(np.arange(len(chunks)), size)
        place = np.arange(len(points)) - begin[chunk]
        left = size[chunk] - place
        state = np.arange(len(points)) + chunk
        # composition: the arcs that begin at each character, by their length
        arcs, at, node = [], np.arange(len(points)), np.zeros(len(points), np.int64)
        for length in range(1, self.longest + 1):
            node = self.trie.get(node << 21 | points[at + length - 1]).astype(np.int64)
            on = node >= 0
            at, node = at[on], node[on]
            piece = self.final[node]
            ends = piece >= 0
            arcs.append((at[ends], piece[ends]))
            if length == 1:  # the fallback's arcs
                lone = np.setdiff1d(np.arange(len(points)), arcs[0][0], assume_unique=True)
                arcs[0] = np.concatenate([arcs[0][0], lone]), np.concatenate([arcs[0][1], np.full(len(lone), -1)])
            on = left[at] > length
            at, node = at[on], node[on]
        start, piece = (np.concatenate(x) for x in zip(*arcs, strict=True))
        length = np.repeat(np.arange(1, len(arcs) + 1), [len(x) for x, _ in arcs])
        # relaxation: positions upwards, and at each position one length after the other, so that no two arcs meet
        step = place[start] * (self.longest + 1) + length
        order = np.argsort(step, kind="stable")
        start, piece, length, step = start[order], piece[order], length[order], step[order]
        weight = np.where(piece >= 0, self.weights[piece], self.unknown)
        source, target = state[start], state[start] + length
        cost, last, back = np.full(len(points) + len(chunks), np.inf), np.full(len(points) + len(chunks), -1), np.zeros(len(points) + len(chunks), np.int64)
        cost[begin + np.arange(len(chunks))] = 0.0
        cuts = np.append(0, np.flatnonzero(step[1:] != step[:-1]) + 1)
        for low, high in zip(cuts.tolist(), [*cuts[1:].tolist(), len(step)]):
            s, t, p = source[low:high], target[low:high], piece[low:high]
            total = cost[s] + weight[low:high]
            better = total < cost[t]
            if self.merges:
                k = np.flatnonzero(better & (last[s] >= 0) & (p >= 0))
                better[k] = self.all_follow(last[s[k]], p[k])
            s, t = s[better], t[better]
            cost[t], last[t], back[t] = total[better], p[better], s
        # the paths, from their ends
        end, own, out = begin + np.arange(len(chunks)) + size, np.arange(len(chunks)), []
        while len(own):
            going = end > begin[own] + own
            end, own = end[going], own[going]
            out.append((own, last[end], end - own - 1))
            end = back[end]
        whose, ids, character = (np.concatenate(x)[::-1] for x in zip(*out, strict=True))
        order = np.argsort(whose, kind="stable")
        whose, ids, character = whose[order], ids[order], character[order]
        spelled = np.flatnonzero(ids < 0)
        if len(spelled):
            as_bytes = [chr(c).encode("utf-8", "replace") for c in points[character[spelled]].tolist()]
            n = np.ones(len(ids), np.int64)
            n[spelled] = [len(x) for x in as_bytes]
            whose, ids = np.repeat(whose, n), np.repeat(ids, n)
            ids[ids < 0] = np.array(self.byte)[np.frombuffer(b"".join(as_bytes), np.uint8)]
        cuts = np.searchsorted(whose, np.arange(len(chunks) + 1)) * 4
        raw = ids.astype("<i4").tobytes()
        return [raw[a:b] for a, b in zip(cuts.tolist(), cuts[1:].tolist())]

    def encode_all(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text, as little-endian 32-bit integers."""
        lists = [self.chunks(self.lead + t.replace("▁", " ")) if t else () for t in texts]
        here, fresh, long = {}, [], []
        for c in {c for own in lists for c in own}:
            known = self.paths.get(c) or self.older.get(c)
            if known:
                here[c] = self.paths[c] = known
            else:
                (fresh if len(c) <= LONG else long).append(c)
        for k in range(0, len(fresh), 1 << 16):
            part = fresh[k : k + (1 << 16)]
            found = dict(zip(part, self.all_shortest([c.replace(" ", "▁") for c in part]), strict=True))
            here |= found
            self.paths |= found
        here |= {c: array("i", self.shortest(c.replace(" ", "▁"))).tobytes() for c in long}
        if len(self.paths) > ROOM:  # chunks not met since the last exchange go
            self.older, self.paths = self.paths, {}
        return [b"".join(map(here.__getitem__, own)) for own in lists]

    def encode(self, text: str) -> bytes:
        return self.encode_all([text])[0]

    def decode(self, ids: np.ndarray) -> str:
        size = self.size[ids]
        at = np.repeat(self.start[ids] - (np.cumsum(size) - size), size) + np.arange(size.sum())
        data = self.blob[at].tobytes()
        return (data[1:] if self.lead and data[:1] == b" " else data).decode("utf-8", "replace")


_compiled: dict[str, Transducer] = {}


def transducer(data: bytes) -> Transducer:
    """Compiled once for each Python worker and model file."""
    key = hashlib.sha256(data).hexdigest()
    if key not in _compiled:
        _compiled.clear()
        _compiled[key] = Transducer(*read_model(data))
    return _compiled[key]


def _model(df: DataFrame, path: str):
    with open(path, "rb") as f:  # a vocabulary file on the driver; its few hundred KB go to the executors
        data = f.read()
    read_model(data)  # refuses what can't be encoded before a job begins
    return df.sparkSession.sparkContext.broadcast(data)


def encode(docs: DataFrame, path: str = MODEL) -> DataFrame:
    """`docs` with a column `ids` array<int> in place of `text`."""
    model, others = _model(docs, path), [c for c in docs.columns if c not in ("text", "ids")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fst = transducer(model.value)
        for batch in portions(batches):
            coded = [np.frombuffer(x, "<i4") for x in fst.encode_all(batch["text"].to_pylist())]
            offsets = np.concatenate([[0], np.cumsum([len(x) for x in coded])]).astype(np.int32)
            ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([*coded, np.empty(0, "<i4")])))
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in others), ids], names=[*others, "ids"])

    kept = docs.select(*others, "text")
    schema = kept.drop("text").withColumn("ids", F.lit(None).cast("array<int>")).schema
    return kept.mapInArrow(run, schema)


def decode(encoded: DataFrame, path: str = MODEL) -> DataFrame:
    """`encoded` with `text` in place of `ids`; null ids give an empty text."""
    model, others = _model(encoded, path), [c for c in encoded.columns if c not in ("text", "ids")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fst = transducer(model.value)
        for batch in (own.slice(k, ROWS) for own in batches for k in range(0, len(own), ROWS)):
            texts = [fst.decode(np.asarray(x or [], np.int64)) for x in batch["ids"].to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in others), pa.array(texts, pa.string())], names=[*others, "text"])

    kept = encoded.select(*others, "ids")
    return kept.mapInArrow(run, kept.drop("ids").withColumn("text", F.lit(None).cast("string")).schema)


def digests(docs: DataFrame, path: str = MODEL) -> DataFrame:
    """doc_id, n_pieces, n_byte_pieces, ids_sha256 (ids as little-endian int32), decoded_sha256, round_trip for every row."""
    model = _model(docs, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fst = transducer(model.value)
        is_byte = np.zeros(len(fst.strings), bool)
        is_byte[fst.byte] = True
        for batch in portions(batches):
            out, texts = [], batch["text"].to_pylist()
            for text, coded in zip(texts, fst.encode_all(texts), strict=True):
                ids = np.frombuffer(coded, "<i4")
                back = fst.decode(ids)
                out.append((len(ids), int(is_byte[ids].sum()), hashlib.sha256(coded).hexdigest(), hashlib.sha256(back.encode()).hexdigest(), back == (text or "")))
            columns = list(zip(*out, strict=True)) or [[]] * 5
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.bool_()]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))], names=NAMES)

    rows = docs.select("doc_id", "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, n_pieces long, n_byte_pieces long, ids_sha256 string, decoded_sha256 string, round_trip boolean")


NAMES = ["doc_id", "n_pieces", "n_byte_pieces", "ids_sha256", "decoded_sha256", "round_trip"]
