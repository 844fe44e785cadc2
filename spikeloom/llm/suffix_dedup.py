"""Suffix-array dedup across documents by two-stage suffix sorting.

A string of LENGTH bytes has one minimiser: its K-byte substring with the smallest hash, the first on ties. So equal strings
have equal minimisers, and all that must be sorted together are the stretches of text around equal minimisers.

1. Each document's distinct minimiser hashes go, packed for each slot and portion of text, to the slot of their hash. A hash that
   several documents of a portion have is sent once for all of them. Slots tell documents which of their hashes others have as well.
2. Those documents cut the stretches (runs of strings with one minimiser, 50 to 2 * 50 - K bytes) around such hashes. A task sends
   a stretch's bytes once, with the smallest doc_id that it knows of, and the places where it stands beside them.
3. A slot's stretches are sorted by suffixes in two stages. Suffixes smaller than their successors are sorted directly, by
   words of eight bytes; scanning the buckets of first bytes upwards then induces the order of the others, because a
   suffix of theirs stands in its bucket in the order of the suffix that follows it. Suffixes that neither begin a string nor
   induce one that does are left out. Common prefixes of adjacent suffixes then delimit the groups of equal LENGTH-byte strings, and a
   group's smallest doc_id is known for each of its members.
4. A slot's places follow its stretches as a stream and are told which of their strings a smaller doc_id has; a
   document drops these.

A slot's stretches are sorted about SORTED bytes at a time, by minimiser. A minimiser that is in more than HOT documents and makes up
a large part of its slot is no unit of work: its strings are dealt one by one, by a hash of their own bytes. There are at most SHARE such
minimisers for each slot, and only their hashes reach the driver.

Texts are taken whole as UTF-8. Null texts are empty; texts below LENGTH bytes keep all. Rows with equal doc_id are one
document: they don't remove each other's strings, and each gets a result of its own; null ids lose nothing and cause no loss.
Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import U64, blobs, mixed, portions, powers, prefix_hash, remove_folder, shared_folder, texts_of, width

LENGTH, K = 50, 20
PIECE = 1 << 16
REMEMBERED = 1_000_000
SORTED = 1 << 21
HOT, SHARE = 1 << 20, 8
_HIGH = U64(0xFFFFFFFFFF000000)
_CODE = U64((1 << 32) - 1)  # of a hash in its slot; equal codes of different hashes only cost work
_SECOND = U64(0xC2B2AE3D27D4EB4F)


def stretches(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, int, np.ndarray]]:
    """(text number, hash, first, last, where the piece begins, the piece's bytes) of texts that lie in a row in `data`:
    runs of string starts first..last, as positions in `data`, whose strings have the same occurrence of a minimiser.

    Long texts are cut at multiples of PIECE from their own beginnings, so a text's runs don't depend on its neighbours.
    """
    long = np.flatnonzero(np.diff(offsets) > PIECE)
    borders = np.unique(np.concatenate([offsets, *(np.arange(offsets[d], offsets[d + 1], PIECE) for d in long)]))
    begin = borders[0]
    while begin < borders[-1]:
        end = borders[min(np.searchsorted(borders, begin + PIECE), len(borders) - 1)]
        a = data[begin : min(end + LENGTH - 1, offsets[-1])]
        if len(a) >= LENGTH:
            n = len(a) - K + 1
            c = prefix_hash(a)
            h = mixed((c[K:] - c[:-K]) * powers(len(a))[1][:n])
            v = (h & _HIGH) | np.arange(n, dtype=np.uint64)
            w, span = LENGTH - K + 1, 1
            while span * 2 <= w:
                v = np.minimum(v[:-span], v[span:])
                span *= 2
            if span < w:
                v = np.minimum(v[: len(v) - (w - span)], v[w - span :])
            at = (v & ~_HIGH).astype(np.int64)[: end - begin]
            edge = np.ones(len(at), bool)
            edge[1:] = at[1:] != at[:-1]
            inner = borders[(borders > begin) & (borders < begin + len(at))] - begin
            edge[inner] = True
            ends = offsets[(offsets >= begin + LENGTH) & (offsets < begin + len(at) + LENGTH - 1)] - begin - LENGTH + 1
            edge[ends] = True  # strings from here on would leave their text
            first = np.flatnonzero(edge)
            last = np.append(first[1:], len(at)) - 1
            text = np.searchsorted(offsets, first + begin, "right") - 1
            whole = first + begin + LENGTH <= offsets[text + 1]
            text, first, last = text[whole], first[whole], last[whole]
            yield text, h[at[first]], first + begin, last + begin, int(begin), a
        begin = end


def suffix_array(text: np.ndarray, words: np.ndarray, wanted: np.ndarray | None = None) -> np.ndarray:
    """The sorted suffixes of `text` (values 1 to 256, and 0 at the end of each stretch; a suffix ends at its first 0).

    words: the eight values from each position on, as one number. wanted: the suffixes asked for; others that they
    follow from are in the result as well. Equal suffixes come in no certain order.
    """
    n = len(text)
    turn = np.flatnonzero(text[1:] != text[:-1])  # the last place of each run of equal values
    turn = np.append(turn, n - 1)
    up = np.append(text[turn[:-1]] < text[turn[1:]], False) | (text[turn] == 0)
    rising = np.repeat(up, np.diff(turn, prepend=-1))  # smaller than its successor, runs included
    if wanted is None:
        within = np.ones(n, bool)
    else:  # a falling suffix follows from the next one, so all up to the next rising one
        stops = np.flatnonzero(rising)
        till = stops[np.searchsorted(stops, np.flatnonzero(wanted & np.append(~wanted[1:], True)))]
        begins = np.flatnonzero(wanted & np.append(True, ~wanted[:-1]))
        steps = np.bincount(begins, minlength=n + 1) - np.bincount(till + 1, minlength=n + 1)
        within = np.cumsum(steps[:n]) > 0
    # directly: ties are sorted again by the next eight values, until their stretches end
    direct = np.flatnonzero(rising & within)
    key = words[direct]
    order = np.argsort(key)
    direct, key = direct[order], key[order]
    tied = np.append(False, key[1:] == key[:-1])
    depth, going = 8, ~_ended(words)
    while True:
        tied &= going[np.minimum(direct + (depth - 8), n - 1)]
        where = np.flatnonzero(tied | np.append(tied[1:], False))
        if not len(where):
            break
        group = np.cumsum(~tied[where])
        key = words[np.minimum(direct[where] + depth, n - 1)]
        order = np.lexsort((key, group))
        direct[where] = direct[where][order]
        key, group = key[order], group[order]
        tied = np.zeros(len(direct), bool)
        tied[where] = np.append(False, (key[1:] == key[:-1]) & (group[1:] == group[:-1]))
        depth += 8
    # induced: each bucket's falling suffixes come from buckets scanned before, or from its own front
    heads = np.split(direct, np.searchsorted(text[direct], np.arange(1, 257)))
    falling = ~rising & within
    induced: list[list[np.ndarray]] = [[] for _ in range(257)]
    out = []
    for c in range(257):
        own, wave = [], np.concatenate(induced[c]) if induced[c] else np.empty(0, np.int64)
        while len(wave):
            own.append(wave)
            before = wave[wave > 0] - 1
            wave = before[(text[before] == c) & falling[before]]
        bucket = np.concatenate([*own, heads[c]]) if own else heads[c]
        if not len(bucket):
            continue
        out.append(bucket)
        before = bucket[bucket > 0] - 1
        before = before[falling[before]]
        values = text[before]
        more = values > c
        values, before = values[more], before[more]
        order = np.argsort(values, kind="stable")
        for value, part in _runs(values[order], before[order]):
            induced[value].append(part)
    return np.concatenate(out) if out else np.empty(0, np.int64)


def _runs(values: np.ndarray, members: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """The members of each run of equal values."""
    if len(values):
        cuts = np.flatnonzero(values[1:] != values[:-1]) + 1
        yield from zip(values[np.append(0, cuts)].tolist(), np.split(members, cuts), strict=True)


def _words(text: np.ndarray) -> np.ndarray:
    """Eight values from each position on, as one number (values fit a byte, as UTF-8 has no byte 255)."""
    out = np.concatenate([text, np.zeros(8, text.dtype)]).astype(np.uint64)
    for k in (1, 2, 4):
        out[:-k] = (out[:-k] << U64(8 * k)) | out[k:]
    return out[: len(text)]


def _ended(words: np.ndarray) -> np.ndarray:
    """Whether a stretch ends within the eight values (the public zero-byte test)."""
    return ((words - U64(0x0101010101010101)) & ~words & U64(0x8080808080808080)) != 0


def _from(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The positions starts[k] .. starts[k] + sizes[k] - 1 of all k in a row."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)


def equal_strings(joined: np.ndarray, size: np.ndarray, owners: np.ndarray) -> np.ndarray:
    """The smallest owner of every LENGTH-byte string of stretches that lie in a row in `joined`, in their order."""
    end = np.cumsum(size)
    text = np.zeros(len(joined) + len(size), np.uint8)
    text[_from(end - size + np.arange(len(size)), size)] = joined + np.uint8(1)  # 0 ends a stretch
    begin = end - size + np.arange(len(size))
    strings = _from(begin, size - LENGTH + 1)
    wanted = np.zeros(len(text), bool)
    wanted[strings] = True
    words = _words(text)
    order = suffix_array(text, words, wanted)
    order = order[wanted[order]]
    same = np.ones(max(len(order) - 1, 0), bool)  # a common prefix of LENGTH bytes with the one before
    for k in range(0, LENGTH, 8):
        w = words[order + k] if k + 8 <= LENGTH else words[order + k] >> U64(8 * (k + 8 - LENGTH))
        same &= w[1:] == w[:-1]
    starts = np.append(0, np.flatnonzero(~same) + 1)
    owner = np.repeat(owners, size + 1)[order]
    by_start = np.zeros(len(text), np.int64)
    by_start[order] = np.repeat(np.minimum.reduceat(owner, starts), np.diff(np.append(starts, len(order))))
    return by_start[strings]


# --- packed arrays --------------------------------------------------------------------------------------------------
def _planes(x: np.ndarray) -> bytes:
    """First bytes of all numbers, then second bytes and so on, which compress better."""
    return np.ascontiguousarray(x.view(np.uint8).reshape(-1, x.itemsize).T).tobytes()


def _numbers(data: bytes, kind: str, n: int, at: int) -> np.ndarray:
    """n numbers of `_planes` that begin at byte `at`."""
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8, n * size, at).reshape(size, n).T).reshape(-1).view(kind)


def _joined(column: pa.ChunkedArray, kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind)


def _table(rows: list[tuple], schema: str) -> pa.RecordBatch:
    """Rows as a batch; schema: 'name kind, ...' with kinds int, long and binary."""
    fields = [x.split() for x in schema.split(", ")]
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    columns = list(zip(*rows, strict=True)) or [[]] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields, strict=True)], names=[n for n, _ in fields])


def _buckets(ids: np.ndarray, n: int) -> np.ndarray:
    return (mixed(ids.view(np.uint64)) % U64(n)).astype(np.int64)


REPLIES = "bucket int, ids binary, counts binary, codes binary"
SPANS = "bucket int, ids binary, tags binary, counts binary, starts binary, ends binary"


def _by_document(group: pa.Table, *columns: tuple[str, str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[np.ndarray]]:
    """(ids, tags) of a group's documents, the number of each entry's document, and the entries of `columns`."""
    ids, counts = _joined(group["ids"], "<i8"), _joined(group["counts"], "<i4")
    tags = _joined(group["tags"], "<i4") if "tags" in group.column_names else np.zeros(len(ids), np.int32)
    order = np.lexsort((tags, ids))
    fresh = np.append(True, (ids[order][1:] != ids[order][:-1]) | (tags[order][1:] != tags[order][:-1]))[: len(ids)]
    number = np.empty(len(ids), np.int64)
    number[order] = np.cumsum(fresh) - 1
    first = order[np.flatnonzero(fresh)]
    return ids[first], tags[first], np.repeat(number, counts), [_joined(group[c], k) for c, k in columns]


def _texts(docs: DataFrame) -> DataFrame:
    """doc_id, tag (a hash of the text, which tells rows with equal ids apart) and text of the rows with an id."""
    text = F.coalesce("text", F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.hash(text).alias("tag"), text.alias("text")).where("doc_id IS NOT NULL")


def shared_hashes(texts: DataFrame, slots: int, folder: str) -> tuple[DataFrame, np.ndarray]:
    """(doc_id, codes): each document's minimiser hashes that other documents have as well, written to `folder`; and the
    codes of hot ones."""

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches):
            ids = np.array(batch["doc_id"], np.int64)
            found = list(stretches(*texts_of(batch["text"])))
            if not found:
                continue
            which, h = (np.concatenate(x) for x in list(zip(*found, strict=True))[:2])
            order = np.lexsort((which, h))
            which, h = which[order], h[order]
            again = np.append(False, h[1:] == h[:-1])
            keep = ~again | np.append(True, which[1:] != which[:-1])
            which, h, again = which[keep], h[keep], again[keep]
            start = np.flatnonzero(~again)
            n = np.diff(np.append(start, len(h)))
            least, most = np.minimum.reduceat(ids[which], start), np.maximum.reduceat(ids[which], start)
            several = least < most
            told = np.repeat(several, n)  # these documents needn't wait for the slot's answer
            code = mixed(h) & _CODE
            rows = [(-1 - b, *x, None) for b, *x in _replies(ids, which[told], code[told], slots)]
            one = ~told | ~again  # all of those that have no other document here, the first one of the others
            slot, weight = (h % U64(slots)).astype(np.int64)[one], np.where(several, np.ceil(np.log2(np.maximum(n, 2))), 0).astype(np.uint8)[np.cumsum(~again) - 1][one]
            which, code = which[one], code[one]
            order = np.lexsort((which, slot))
            for s, at in _runs(slot[order], order):
                cuts = np.flatnonzero(np.append(True, which[at][1:] != which[at][:-1]))
                own = which[at][cuts]
                rows.append((s, ids[own].tobytes(), np.diff(np.append(cuts, len(at))).astype("<i4").tobytes(), code[at].astype("<u4").tobytes(), weight[at].tobytes()))
            yield _table(rows, "slot int, ids binary, counts binary, codes binary, weights binary")

    def shared(group: pa.Table) -> pa.Table:
        slot = group["slot"][0].as_py()
        if slot < 0:  # answers given beforehand
            return pa.table([pa.array([-1 - slot] * len(group), pa.int32()), *(group[c] for c in ("ids", "counts", "codes"))], names=[x.split()[0] for x in REPLIES.split(", ")])
        ids, _, number, (code, weight) = _by_document(group, ("codes", "<u4"), ("weights", "u1"))
        order = np.lexsort((ids[number], code))
        c, d, w = code[order], number[order], weight[order].astype(np.int64)
        start = np.flatnonzero(np.append(True, c[1:] != c[:-1]))
        size = np.diff(np.append(start, len(c)))
        several = (ids[d[start]] != ids[d[start + size - 1]]) | (np.maximum.reduceat(w, start) > 0)
        keep = np.repeat(several, size) & (w == 0)
        documents = np.add.reduceat(1 << w, start)
        hot = c[start[(documents > HOT) & (documents * SHARE > documents.sum())]]
        rows = _replies(ids, d[keep], c[keep], slots)
        return pa.Table.from_batches([_table([(-1, b"", b"", hot.astype("<u4").tobytes())] * (len(hot) > 0) + rows, REPLIES)])

    def gathered(group: pa.Table) -> pa.Table:
        if group["bucket"][0].as_py() < 0:
            codes = b"".join(group["codes"].to_pylist())
            return pa.table({"doc_id": pa.array([None], pa.int64()), "codes": pa.array([codes], pa.binary())})
        ids, _, number, (code,) = _by_document(group, ("codes", "<u4"))
        order = np.lexsort((code, number))
        number, code = number[order], code[order]
        keep = np.append(True, (number[1:] != number[:-1]) | (code[1:] != code[:-1]))
        ends = np.cumsum(np.bincount(number[keep], minlength=len(ids)))
        return pa.table({"doc_id": ids, "codes": blobs(code[keep], ends)})

    packs = texts.where(F.octet_length("text") >= LENGTH).mapInArrow(packed, "slot int, ids binary, counts binary, codes binary, weights binary")
    found = packs.groupBy("slot").applyInArrow(shared, REPLIES).groupBy("bucket").applyInArrow(gathered, "doc_id long, codes binary")
    found.write.parquet(folder)
    spark = texts.sparkSession
    again = spark.read.schema("doc_id long, codes binary").parquet(folder)
    hot = [np.frombuffer(r.codes, "<u4") for r in again.where("doc_id IS NULL").select("codes").collect()]  # at most SHARE numbers for each slot
    return again.where("doc_id IS NOT NULL"), np.unique(np.concatenate([*hot, np.empty(0, "<u4")]))


def _replies(ids: np.ndarray, which: np.ndarray, code: np.ndarray, buckets: int) -> list[tuple]:
    """Packed (bucket, ids, counts, codes) rows that tell documents their codes."""
    bucket = _buckets(ids, buckets)[which] if len(which) else which
    order, out = np.lexsort((which, bucket)), []
    for b, at in _runs(bucket[order], order):
        cuts = np.flatnonzero(np.append(True, which[at][1:] != which[at][:-1]))
        own = which[at][cuts]
        out.append((b, ids[own].tobytes(), np.diff(np.append(cuts, len(at))).astype("<i4").tobytes(), code[at].astype("<u4").tobytes()))
    return out


class _Cutter:
    """Cuts the stretches of a task's portions of text."""

    def __init__(self, slots: int, hot: np.ndarray):
        self.slots, self.hot = slots, hot
        self.forget()

    def forget(self) -> None:
        """Begins anew: a slot's stretches are counted from 0 on, under another name of the sender."""
        self.sender, self.sent = uuid.uuid4().bytes, np.zeros(self.slots, np.int64)
        self.keys, self.more, self.owners, self.several, self.index = np.empty(0, np.uint64), np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, bool), np.empty(0, np.int64)

    def cut(self, batch: pa.RecordBatch) -> list[tuple[int, int, bytes]]:
        """(slot, kind, blob) rows: stretches that tell the slot something new as kind 0, places as kind 1."""
        ids, tags = np.array(batch["doc_id"], np.int64), np.array(batch["tag"], np.int32)
        data, offsets = texts_of(batch["text"])
        codes, ends = texts_of(batch["codes"])
        known = np.sort(np.repeat(np.arange(len(ids), dtype=np.uint64) << U64(48), np.diff(ends) // 4) | codes[ends[0] : ends[-1]].view("<u4"))
        found = []
        for text, h, first, last, begin, a in stretches(data, offsets):
            code = mixed(h) & _CODE
            own = text.astype(np.uint64) << U64(48) | code
            at = np.flatnonzero(known[np.minimum(np.searchsorted(known, own), len(known) - 1)] == own) if len(known) else []
            if not len(at):
                continue
            text, h, first, last, code = text[at], h[at], first[at], last[at], code[at]
            single = np.isin(code, self.hot) if len(self.hot) else np.zeros(len(at), bool)
            if single.any():  # a stretch for each string of a hot minimiser
                n = np.where(single, last - first + 1, 1)
                k, first = np.repeat(np.arange(len(at)), n), _from(first, n)
                last, text, h, single = np.where(single[k], first, last[k]), text[k], h[k], single[k]
            s, e = first - begin, last - begin + LENGTH
            up, down = powers(len(a) + 1)
            c, d = prefix_hash(a), np.zeros(len(a) + 1, np.uint64)
            np.cumsum(mixed((a.astype(np.uint64) + U64(1)) * _SECOND) * up[: len(a)], out=d[1:])
            key = mixed((c[e] - c[s]) * down[s] + (e - s).astype(np.uint64))
            more = mixed((d[e] - d[s]) * down[s]) >> U64(32)
            found.append((text, np.where(single, key, h), key, more, first, last))
        if not found:
            return []
        text, h, key, more, first, last = (np.concatenate(x) for x in zip(*found, strict=True))
        slot = h % U64(self.slots)
        order = np.lexsort((key, slot))
        text, h, key, more, first, last, slot = (x[order] for x in (text, h, key, more, first, last, slot))
        start = np.flatnonzero(np.append(True, (key[1:] != key[:-1]) | (more[1:] != more[:-1])))
        size = np.diff(np.append(start, len(key)))
        owner = np.minimum.reduceat(ids[text], start)
        several = owner < np.maximum.reduceat(ids[text], start)
        if len(self.keys) > REMEMBERED:
            self.forget()
        before = self.sent.copy()
        told, owner, several, index = self._fresh(key[start], more[start], slot[start], owner, several)
        rows, cuts = [], np.flatnonzero(np.append(True, slot[start][1:] != slot[start][:-1]))
        for low, high in zip(cuts.tolist(), [*cuts[1:].tolist(), len(start)]):
            k = start[low:high]
            n = np.flatnonzero(told[low:high])
            s = int(slot[k[0]])
            if len(n):
                own = k[n]
                length = last[own] - first[own] + LENGTH
                head = [length.astype("u1"), several[low:high][n].astype("u1"), (h[own] // U64(self.slots) % U64(1 << 16)).astype("<u2"), owner[low:high][n].astype("<i8")]
                rows.append((s, 0, self.sender + np.array([before[s], len(n)], "<i4").tobytes() + zstandard.compress(b"".join(map(_planes, head)) + data[_from(first[own], length)].tobytes(), 9)))
            at = slice(k[0], start[high] if high < len(start) else len(key))
            whose, which = np.unique(text[at], return_inverse=True)
            place = (first[at] - offsets[text[at]]).astype("<i4")
            parts = [index[low:high].astype("<i4"), size[low:high].astype("<i4"), ids[whose], tags[whose], place, which.astype("<i4")]
            rows.append((s, 1, self.sender + np.array([high - low, len(whose), len(which)], "<i4").tobytes() + zstandard.compress(b"".join(map(_planes, parts)), 3)))
        return rows

    def _fresh(self, key: np.ndarray, more: np.ndarray, slot: np.ndarray, owner: np.ndarray, several: np.ndarray) -> tuple[np.ndarray, ...]:
        """Which stretches tell more than has been sent before, what is known of them by now, and their numbers among those sent to their slots."""
        near = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        old = (self.keys[near] == key) & (self.more[near] == more) if len(self.keys) else np.zeros(len(key), bool)
        told, index = ~old, np.zeros(len(key), np.int64)
        k = near[old]
        several[old] |= self.several[k] | (self.owners[k] != owner[old]) if len(k) else False
        owner[old] = np.minimum(owner[old], self.owners[k]) if len(k) else owner[old]
        told[old] = (owner[old] != self.owners[k]) | (several[old] != self.several[k]) if len(k) else False
        index[old] = self.index[k] if len(k) else 0
        fresh = slot[told]  # slots in order
        begin = np.flatnonzero(np.append(True, fresh[1:] != fresh[:-1]))[: len(fresh)]
        count = np.diff(np.append(begin, len(fresh)))
        index[told] = self.sent[fresh] + np.arange(len(fresh)) - np.repeat(begin, count)
        self.sent[fresh[begin]] += count
        if len(k):
            self.owners[k], self.several[k], self.index[k] = owner[old], several[old], index[old]
        new = np.flatnonzero(~old)
        new = new[np.argsort(key[new])]
        place = np.searchsorted(self.keys, key[new])
        self.keys, self.more, self.index = np.insert(self.keys, place, key[new]), np.insert(self.more, place, more[new]), np.insert(self.index, place, index[new])
        self.owners, self.several = np.insert(self.owners, place, owner[new]), np.insert(self.several, place, several[new])
        return told, owner, several, index


class _Slot:
    """What is known of a slot's stretches: runs of strings that some document with a smaller id has."""

    def __init__(self, packs: list[bytes]):
        packs = sorted(packs, key=lambda x: (x[:16], int.from_bytes(x[16:20], "little")))
        kinds, heads, data, self.begin, n = ("u1", "u1", "<u2", "<i8"), [], [], {}, 0
        for blob in packs:
            self.begin.setdefault(blob[:16], n)
            own, raw, at = int.from_bytes(blob[20:24], "little"), zstandard.decompress(blob[24:]), 0
            n += own
            head = []
            for kind in kinds:
                head.append(_numbers(raw, kind, own, at))
                at += head[-1].nbytes
            heads.append(head)
            data.append(np.frombuffer(raw, np.uint8, offset=at))
        length, several, sub, owner = (np.concatenate(x) for x in zip(*heads, [np.empty(0, k) for k in kinds], strict=True))
        data, length = np.concatenate([*data, np.empty(0, np.uint8)]), length.astype(np.int64)
        begin = np.cumsum(length) - length
        order = np.argsort(sub, kind="stable")
        upto = np.append(np.flatnonzero(sub[order][1:] != sub[order][:-1]) + 1, n)
        ends, at, low, folded = np.cumsum(length[order]), 0, 0, 0
        self.part, found = np.empty(n, np.int64), []
        while low < n:
            before = ends[low] - length[order[low]]
            at = max(at + 1, int(np.searchsorted(ends[upto - 1], before + SORTED, "right")))
            k = order[low : upto[at - 1]]
            joined = data[_from(begin[k], length[k])]
            which, first = _equal(joined, length[k])
            self.part[k] = which + folded
            own = np.argsort(which, kind="stable")
            starts = np.searchsorted(which[own], np.arange(len(first)))
            least, most = np.minimum.reduceat(owner[k][own], starts), np.maximum.reduceat(owner[k][own], starts)
            shared = (np.maximum.reduceat(several[k][own], starts) > 0) | (least != most)
            offset = np.cumsum(length[k]) - length[k]
            found.append(self._runs(joined[_from(offset[first], length[k][first])], length[k][first], least, shared, folded))
            low, folded = upto[at - 1], folded + len(first)
        part, self.low, self.high, self.least = (np.concatenate(x) for x in zip(*found, strict=True)) if found else [np.empty(0, np.int64)] * 4
        self.count = np.bincount(part, minlength=folded)
        self.run = np.cumsum(self.count) - self.count

    @staticmethod
    def _runs(joined: np.ndarray, size: np.ndarray, owner: np.ndarray, several: np.ndarray, offset: int) -> tuple[np.ndarray, ...]:
        """(stretch, first, last, least): runs of equal smallest owners, but for those that only the stretch's one document has."""
        least = equal_strings(joined, size, owner)
        n = size - LENGTH + 1
        begin = np.cumsum(n) - n
        part = np.repeat(np.arange(len(n)), n)
        edge = np.append(True, (least[1:] != least[:-1]) | (part[1:] != part[:-1]))
        s = np.flatnonzero(edge)
        e = np.append(s[1:], len(least))
        k = part[s]
        keep = several[k] | (least[s] < owner[k])
        s, e, k = s[keep], e[keep], k[keep]
        return k + offset, s - begin[k], e - 1 - begin[k], least[s]

    def spans(self, blob: bytes) -> tuple[np.ndarray, ...]:
        """(ids, tags, number, start, end): the bytes that the places of a blob lose; number counts in ids and tags."""
        m, documents, places = np.frombuffer(blob, "<i4", 3, 16).tolist()
        raw, at, own = zstandard.decompress(blob[28:]), 0, []
        for kind, n in (("<i4", m), ("<i4", m), ("<i8", documents), ("<i4", documents), ("<i4", places), ("<i4", places)):
            own.append(_numbers(raw, kind, n, at))
            at += own[-1].nbytes
        index, size, ids, tags, start, which = own
        k = self.part[self.begin[blob[:16]] + index.astype(np.int64)]
        n = np.repeat(self.count[k], size)
        run = _from(np.repeat(self.run[k], size), n)
        start, which = np.repeat(start, n).astype(np.int64), np.repeat(which, n)
        lost = self.least[run] < ids[which]
        run, start, which = run[lost], start[lost], which[lost]
        return ids, tags, which, start + self.low[run], start + self.high[run] + LENGTH


def _equal(joined: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The number of each stretch among the different ones, and one stretch of each number; hashes propose, bytes decide."""
    end = np.cumsum(size)
    c = prefix_hash(joined)
    h = (c[end] - c[end - size]) * powers(len(joined) + 1)[1][end - size]
    order = np.lexsort((size, h))
    a, b = order[:-1], order[1:]
    same = np.flatnonzero((h[a] == h[b]) & (size[a] == size[b]))
    again = np.zeros(len(size), bool)
    if len(same):
        a, b, n = a[same], b[same], size[order[same]]
        equal = joined[_from((end - size)[a], n)] == joined[_from((end - size)[b], n)]
        again[same + 1] = np.logical_and.reduceat(equal, np.cumsum(n) - n)
    number = np.empty(len(size), np.int64)
    number[order] = np.cumsum(~again) - 1
    return number, order[~again]


def _merged(number: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spans of numbered documents in order, those that overlap or touch as one."""
    order = np.lexsort((start, number))
    number, start, end = number[order], start[order], end[order]
    if not len(number):
        return number, start, end
    far = int(end.max()) + 1
    reach = np.maximum.accumulate(number * far + end)
    first = np.flatnonzero(np.append(True, number[1:] * far + start[1:] > reach[:-1]))
    return number[first], start[first], reach[np.append(first[1:], len(reach)) - 1] - number[first] * far


def _span_rows(found: list[tuple[np.ndarray, ...]], buckets: int) -> pa.RecordBatch:
    sizes = [len(x[0]) for x in found]
    ids, tags = (np.concatenate([x[k] for x in found]) for k in (0, 1))
    number = np.concatenate([x[2] + before for x, before in zip(found, np.cumsum([0, *sizes[:-1]]), strict=True)])
    number, start, end = _merged(number.astype(np.int64), *(np.concatenate([x[k] for x in found]) for k in (3, 4)))
    bucket, rows = _buckets(ids, buckets)[number], []
    order = np.argsort(bucket, kind="stable")
    for b, at in _runs(bucket[order], order):
        cuts = np.flatnonzero(np.append(True, number[at][1:] != number[at][:-1]))
        own = number[at][cuts]
        rows.append((b, ids[own].tobytes(), tags[own].tobytes(), np.diff(np.append(cuts, len(at))).astype("<i4").tobytes(), start[at].astype("<i4").tobytes(), end[at].astype("<i4").tobytes()))
    return _table(rows, SPANS)


def covered(texts: DataFrame, folder: str) -> DataFrame:
    """(doc_id, tag, spans): the removed byte ranges of documents that lose any, merged, as pairs of 32-bit numbers."""
    slots = width(texts.sparkSession)
    again, hot = shared_hashes(texts, slots, folder)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter = _Cutter(slots, hot)
        for batch in portions(batches):
            yield _table(cutter.cut(batch), "slot int, kind int, pack binary")

    def resolved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A partition is a slot, whose stretches come before their places."""
        packs, slot, found, n = [], None, [], 0
        for batch in portions(batches, "pack"):
            for kind, pack in zip(batch["kind"].to_pylist(), batch["pack"].to_pylist(), strict=True):
                if kind == 0:
                    packs.append(pack)
                    continue
                if slot is None:
                    slot, packs = _Slot(packs), []
                found.append(slot.spans(pack))
                n += len(found[-1][0]) + len(found[-1][3])
                if n > 1_000_000:
                    yield _span_rows(found, slots)
                    found, n = [], 0
        if found:
            yield _span_rows(found, slots)

    def gathered(group: pa.Table) -> pa.Table:
        ids, tags, number, (start, end) = _by_document(group, ("starts", "<i4"), ("ends", "<i4"))
        number, start, end = _merged(number, start.astype(np.int64), end.astype(np.int64))
        pairs = np.stack([start, end], axis=1).astype("<i4")
        return pa.table({"doc_id": ids, "tag": tags, "spans": blobs(pairs.reshape(-1).view("<i8"), np.cumsum(np.bincount(number, minlength=len(ids))))})

    rows = texts.join(again, "doc_id").mapInArrow(cut, "slot int, kind int, pack binary")
    spans = rows.repartitionById(slots, "slot").sortWithinPartitions("kind").select("kind", "pack").mapInArrow(resolved, SPANS)
    return spans.groupBy("bucket").applyInArrow(gathered, "doc_id long, tag int, spans binary")


def strip_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 for every row."""
    texts, spark = _texts(docs), docs.sparkSession
    lost = covered(texts, shared_folder(spark, "shared-hashes"))
    alone = docs.where("doc_id IS NULL").select(F.col("doc_id").cast("long").alias("doc_id"), F.lit(0).alias("tag"), F.coalesce("text", F.lit("")).alias("text"), F.lit(None).cast("binary").alias("spans"))
    rows = texts.join(lost, ["doc_id", "tag"], "left").unionByName(alone)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches):
            data, offsets = texts_of(batch["text"])
            raw, ends = memoryview(data), offsets.tolist()
            out = []
            for k, own in enumerate(batch["spans"].to_pylist()):
                low, high = ends[k], ends[k + 1]
                if not own:
                    out.append((high - low, 0, 0, hashlib.sha256(raw[low:high]).hexdigest()))
                    continue
                spans, at, gone, digest = np.frombuffer(own, "<i4").reshape(-1, 2).tolist(), low, 0, hashlib.sha256()
                for s, e in spans:
                    digest.update(raw[at : low + s])
                    at = low + e
                    gone += e - s
                digest.update(raw[at:high])
                out.append((high - low, gone, len(spans), digest.hexdigest()))
            columns = list(zip(*out, strict=True)) or [[]] * 4
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return rows.mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
