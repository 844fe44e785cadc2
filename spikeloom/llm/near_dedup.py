"""MinHash near-dedup by fast similarity sketching, banding and exact verification.

A document's set holds the 64-bit hashes of its distinct five-word shingles (of its whole sequence, if it has fewer
words). Sets are sketched by rounds of hashed bin placement: in each of the first T rounds every element falls into a
random one of T bins, in round T + b all fall into bin b, and a bin keeps its first round's smallest hash; so every coordinate
fills within 2T rounds, and two sets agree in the expected share J of coordinates with concentration as for T
independent samples.

1. Documents with equal sets are folded into one class, which has a number of its own and the smallest id of its documents.
2. Classes that share a band of 4 coordinates meet in a bucket. A bucket's task compares whole sketches (a byte for
   each coordinate), and links those that agree well enough for J >= 0.75 breadth-first, so it returns no more edges
   than it has members. Buckets with the same members (by count, ends and 128 bits of their ids) are looked at once. A bucket of more than
   BUCKET members is linked to its smallest one without a look, which makes regions larger, never smaller.
3. Connected components of these edges are the regions within which any link can lie. Inside each, full sets are compared if they share
   one of their rarest shingles, which all that link do (`_Joiner`), and only until their components meet. So neither unlike texts
   with common shingles nor copies cost pairs; what does is texts that share rare shingles and yet don't link.
4. A region of more than BLOCK shingles is dealt over blocks by id. Each block is joined as in step 3, then the blocks'
   heads are dealt and joined again while that leaves fewer of them. What is still apart meets by its rarest shingles in the whole
   region (`_postings`), in cells of about BLOCK shingles.

With J = 0.75 a pair shares no band with probability (1 - 0.75**4)**32 < 6e-6, and falls below the sketch threshold with
less. Null, empty and blank texts have an empty set and link with nothing. Texts of any length are taken whole, in pieces.
Every row is a document of its own: rows with equal doc_id and different texts are linked by their texts only. Rows with a null
doc_id link with nothing, have a null component and aren't kept; `keep_one` gives them ids of their own, behind all others. Other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import U64, components, cut, mixed, portions, powers, prefix_hash, texts_of, utf8, width

WORDS, PERCENT = 5, 75
COORDINATES, ROWS = 128, 4
#: A pair with J = 0.75 agrees in fewer coordinates than this with probability under 1e-6.
SKETCH_SHARE = 0.55
PIECE = 1 << 22
#: The shingles in a block of a large region, and the documents of a bucket that one task compares.
BLOCK, BUCKET = 1 << 20, 1 << 8
_BLANK = re.compile(rb"[ \t-\r]")
_SEEDS = mixed(np.arange(1, 2 * COORDINATES + 1, dtype=np.uint64) * U64(0xD1342543DE82EF95))
_LOW = U64((1 << 48) - 1)


def word_hashes(data: bytes) -> np.ndarray:
    """A hash of each word of a text, A-Z in lower case; words end at the characters \\x20 and \\x09 to \\x0D."""
    out, begin = [], 0
    while begin < len(data):
        found = _BLANK.search(data, begin + PIECE)
        end = found.start() if found else len(data)
        a = np.frombuffer(data, np.uint8, end - begin, begin)
        a = a + ((a >= 65) & (a <= 90)).astype(np.uint8) * np.uint8(32)
        blank = np.concatenate([[True], (a == 32) | ((a >= 9) & (a <= 13)), [True]])
        edge = np.flatnonzero(blank[1:] != blank[:-1])
        s, e = edge[::2], edge[1::2]
        c = prefix_hash(a)
        out.append(mixed((c[e] - c[s]) * powers(len(a) + 1)[1][s] + (e - s).astype(np.uint64)))
        begin = end
    return np.concatenate(out) if out else np.empty(0, np.uint64)


def shingles(data: bytes, words: int = WORDS) -> np.ndarray:
    """The sorted distinct shingle hashes of a text in UTF-8."""
    w = word_hashes(data)
    if not len(w):
        return w
    n = min(words, len(w))
    total = np.full(len(w) - n + 1, n, dtype=np.uint64)
    for k in range(n):
        total = mixed(total * U64(0x9E3779B97F4A7C15) + w[k : len(w) - n + 1 + k])
    return np.unique(total)


def sketch(elements: np.ndarray) -> np.ndarray:
    """COORDINATES 64-bit values: the round in the high bits, the smallest hash of that round in the low ones."""
    t, out = COORDINATES, np.full(COORDINATES, np.iinfo(np.uint64).max)
    done, some = 0, max(1, 1024 // len(elements))
    while done < 2 * t:
        upto = min(2 * t, done + some) if done >= t else min(t, done + some)
        h = mixed(elements[None, :] ^ _SEEDS[done:upto, None])
        rounds = np.arange(done, upto, dtype=np.uint64)[:, None]
        value = (rounds << U64(48)) | (h & _LOW)
        if done < t:
            np.minimum.at(out, (h >> U64(57)).astype(np.int64).ravel(), value.ravel())
        else:
            out[done - t : upto - t] = np.minimum(out[done - t : upto - t], value.min(axis=1))
        done = upto
        if out.max() < np.iinfo(np.uint64).max:
            break
    return out


def bands(values: np.ndarray) -> np.ndarray:
    """A key for each band of ROWS coordinates."""
    parts = values.reshape(-1, ROWS)
    key = np.arange(1, len(parts) + 1, dtype=np.uint64)
    for k in range(ROWS):
        key = mixed(key * U64(0x9E3779B97F4A7C15) + parts[:, k])
    return key.view(np.int64)


def _spread(start: int, candidates: np.ndarray, near) -> Iterator[tuple[int, np.ndarray]]:
    """Breadth-first from `start` over `candidates`: yields (from, reached) until no more is reached."""
    queue = [start]
    while queue and len(candidates):
        at = queue.pop()
        hit = near(at, candidates)
        if hit.any():
            reached = candidates[hit]
            candidates = candidates[~hit]
            queue.extend(reached.tolist())
            yield at, reached


def _regions(n: int, near) -> np.ndarray:
    """The index of the first member of each member's component under `near`."""
    region = np.full(n, -1)
    for i in range(n):
        if region[i] < 0:
            region[i] = i
            rest = np.flatnonzero(region < 0)
            for _, reached in _spread(i, rest, near):
                region[reached] = i
    return region


def _split(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order by keys (the first one counts most), and where runs of the first key begin and end in it."""
    order = np.lexsort(keys[::-1])
    first = keys[0][order]
    return order, np.concatenate([[0], np.flatnonzero(first[1:] != first[:-1]) + 1, [len(first)]])


def _bucket(group: pa.Table) -> pa.Table:
    """Edges from the members of a slot's buckets to the first member of their region; one bucket after the other."""
    ids, bands = np.array(group["id"], np.int64), np.array(group["band"], np.int64)
    order, cuts = _split(bands, ids)
    ids, sizes = ids[order], np.array(group["n"], np.int64)[order]
    codes = np.frombuffer(b"".join(group["code"].to_pylist()), np.uint8).reshape(len(ids), COORDINATES)[order]
    least, region = SKETCH_SHARE * COORDINATES, np.arange(len(ids))
    for low, high in zip(cuts, cuts[1:]):

        def near(at: int, rest: np.ndarray, n=sizes[low:high], code=codes[low:high]) -> np.ndarray:
            return (100 * np.minimum(n[rest], n[at]) >= PERCENT * np.maximum(n[rest], n[at])) & ((code[rest] == code[at]).sum(axis=1) >= least)

        region[low:high] = low + _regions(high - low, near)
    far = region != np.arange(len(ids))
    return pa.table({"a": ids[region[far]], "b": ids[far]})


class _Joiner:
    """Exact links among some sets, found by a prefix filter; sets with equal labels are joined from the start.

    Elements are ordered by rarity. Two sets that link share PERCENT of the larger one, so they share one of the first
    n - ceil(n * PERCENT / 100) + 1 elements of each; sets are compared only if they do, and only until their components meet.
    """

    def __init__(self, sets: list[np.ndarray], label: np.ndarray):
        self.size = np.array([len(x) for x in sets], np.int64)
        self.start = np.cumsum(self.size) - self.size
        _, self.element, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        self.mark = np.zeros(len(count), bool)
        _, first, same = np.unique(label, return_index=True, return_inverse=True)
        self.parent, self.links = first[same], []
        self.weight = np.bincount(self.parent, minlength=len(sets))
        owner = np.repeat(np.arange(len(sets)), self.size)
        order = np.lexsort((self.element, count[self.element], owner))
        early = np.arange(len(owner)) - self.start[owner] <= (self.size + -PERCENT * self.size // 100)[owner]
        kept = order[early & (count[self.element[order]] > 1)]
        kept = kept[np.argsort(self.element[kept], kind="stable")]
        self.owner, of = owner[kept], self.element[kept]
        cuts = np.concatenate([[0], np.flatnonzero(of[1:] != of[:-1]) + 1, [len(of)]]) if len(of) else np.zeros(1, np.int64)
        self.postings = [(a, b) for a, b in zip(cuts.tolist(), cuts[1:].tolist()) if b - a > 1]

    def roots(self, some: np.ndarray) -> np.ndarray:
        at = self.parent[some]
        while True:
            up = self.parent[at]
            if np.array_equal(up, at):
                self.parent[some] = at
                return at
            at = up

    def union(self, a: int, others: np.ndarray) -> None:
        for b in others.tolist():
            x, y = self.roots(np.array([a, b])).tolist()
            if x != y:
                x, y = (x, y) if self.weight[x] >= self.weight[y] else (y, x)
                self.parent[y] = x
                self.weight[x] += self.weight[y]
                self.links.append((a, b))

    def near(self, at: int, rest: np.ndarray) -> np.ndarray:
        """Those of `rest` that link with a set."""
        n = self.size[rest]
        rest = rest[100 * np.minimum(n, self.size[at]) >= PERCENT * np.maximum(n, self.size[at])]
        if not len(rest):
            return rest
        n = self.size[rest]
        begin = np.cumsum(n) - n
        own = self.element[self.start[at] : self.start[at] + self.size[at]]
        self.mark[own] = True
        common = np.add.reduceat(self.mark[self.element[np.repeat(self.start[rest] - begin, n) + np.arange(n.sum())]].astype(np.int64), begin)
        self.mark[own] = False
        return rest[100 * common >= PERCENT * (n + self.size[at] - common)]

    def run(self) -> list[tuple[int, int]]:
        """A link for each pair of components that one joins."""
        for low, high in sorted(self.postings, key=lambda x: x[0] - x[1]):  # many sets at once, where there are many
            if high - low > 8:
                own = self.owner[low:high]
                root = self.roots(own)
                if (root != root[0]).any():
                    self.union(int(own[0]), self.near(int(own[0]), own[root != root[0]]))
        asks: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        for low, high in self.postings:  # sets outside a posting's largest component look at those inside, and at later ones outside
            own = self.owner[low:high]
            root = self.roots(own)
            if (root != root[0]).any():
                names, n = np.unique(root, return_counts=True)
                inside = root == names[n.argmax()]
                for x in own[~inside].tolist():
                    asks.setdefault(x, []).append((own, inside))
        for x, where in asks.items():
            rest, step = np.unique(np.concatenate([own[inside | (own > x)] for own, inside in where])), 16
            while len(rest := rest[self.roots(rest) != self.roots(np.array([x]))[0]]):
                self.union(x, self.near(x, rest[:step]))
                rest, step = rest[step:], 2 * step
        return self.links


def _verified(group: pa.Table) -> pa.Table:
    """The smallest id reachable over exact links for the members of a slot's blocks; one block after the other."""
    ids, regions = np.array(group["id"], np.int64), np.array(group["block"], np.int64)
    order, cuts = _split(regions, ids)
    ids, every, out = ids[order], group["elements"], []
    for low, high in zip(cuts, cuts[1:]):
        joiner = _Joiner([np.frombuffer(every[int(k)].as_py(), np.uint64) for k in order[low:high]], np.arange(high - low))
        joiner.run()
        _, first, same = np.unique(joiner.roots(np.arange(high - low)), return_index=True, return_inverse=True)
        out.append(ids[low + first[same]])
    return pa.table({"id": ids, "component": np.concatenate(out)})


def _across(group: pa.Table) -> pa.Table:
    """Exact links between members of two blocks (or of one) that join different components."""
    ids, label = np.array(group["id"], np.int64), np.array(group["label"], np.int64)
    links = _Joiner([np.frombuffer(x.as_py(), np.uint64) for x in group["elements"]], label).run()
    return pa.table({"a": ids[[a for a, _ in links]].astype(np.int64), "b": ids[[b for _, b in links]].astype(np.int64)}) if links else pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})


def _dealt(members: DataFrame, by: list[str], turn: int = 0) -> DataFrame:
    """`members` (id, size and the columns `by`) with a block each: about BLOCK shingles of the same `by`."""
    n = members.groupBy(*by).agg(F.ceil(F.sum("size") / F.lit(BLOCK)).alias("blocks"))
    return members.join(n, by).withColumn("block", F.xxhash64(*by, F.pmod(F.xxhash64("id", F.lit(turn)), "blocks"))).drop("blocks")


def _elements(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each element of each set."""
    for batch in portions(batches, "elements"):
        flat, ends = texts_of(batch["elements"])
        n = np.diff(ends) // 8
        which = np.repeat(np.arange(len(batch)), n)
        names = ["region", "id", "label", "size"]
        yield pa.RecordBatch.from_arrays([*(batch[c].take(pa.array(which)) for c in names), pa.array(flat[ends[0] : ends[-1]].view(np.int64))], names=[*names, "element"])


def _postings(sets: DataFrame, members: DataFrame) -> DataFrame:
    """Links (a, b) between members (region, id, size, label) of different labels, by the prefix filter of `_Joiner` over whole regions.

    Members of different labels that share one of their rarest elements meet, and no others. The postings of many elements make a cell of about
    BLOCK shingles; one of more than BLOCK is dealt over blocks, which meet in pairs, but for those that hold the same label alone.
    """
    each = sets.select("id", "elements").join(members, "id").select("region", "id", "label", "size", "elements").mapInArrow(_elements, "region long, id long, label long, size long, element long")
    counts = each.groupBy("region", "element").agg(F.count("*").alias("c"))
    ranked = each.join(counts, ["region", "element"]).groupBy("region", "id", "label", "size").agg(F.sort_array(F.collect_list(F.struct("c", "element"))).alias("x"))  # a document's own elements
    early = F.slice("x", F.lit(1), (F.col("size") - F.ceil(F.col("size") * PERCENT / 100) + 1).cast("int"))
    prefix = ranked.select("region", "id", "label", "size", F.explode(early).alias("x")).where("x.c > 1").select("region", "id", "label", "size", "x.element")
    prefix = cut(prefix)
    shared = prefix.groupBy("region", "element").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.sum("size").alias("total")).where("low <> high").select("region", "element", (F.col("total") > BLOCK).alias("hot"))
    kept = cut(prefix.join(shared, ["region", "element"]))
    cells = max(1, -(-(kept.where("NOT hot").agg(F.sum("size")).first()[0] or 0) // BLOCK))
    usual = kept.where("NOT hot").select(F.pmod(F.xxhash64("region", "element"), F.lit(cells)).alias("block"), "id").distinct()
    found = sets.select("id", "elements").join(usual, "id").groupBy("block").applyInArrow(_verified, "id long, component long").select(F.col("component").alias("a"), F.col("id").alias("b")).where("a <> b")
    hot = kept.where("hot")
    if hot.isEmpty():
        return found
    places = cut(_dealt(hot, ["region", "element"]))
    blocks = places.groupBy("region", "element", "block").agg(F.min("label").alias("low"), F.max("label").alias("high"))
    x, y = blocks.alias("x"), blocks.alias("y")
    alike = (F.col("x.low") == F.col("x.high")) & (F.col("y.low") == F.col("y.high")) & (F.col("x.low") == F.col("y.low"))
    pairs = x.join(y, (F.col("x.region") == F.col("y.region")) & (F.col("x.element") == F.col("y.element")) & (F.col("x.block") <= F.col("y.block")) & ~alike).select(F.col("x.block").alias("low"), F.col("y.block").alias("high"))
    sides = pairs.select("low", "high", F.explode(F.array_distinct(F.array("low", "high"))).alias("block"))
    shown = places.select("id", "label", "block").join(sides, "block").join(sets.select("id", "elements"), "id")
    return found.unionByName(shown.select("low", "high", "id", "label", "elements").groupBy("low", "high").applyInArrow(_across, "a long, b long"))


def _large(sets: DataFrame, first: DataFrame) -> DataFrame:
    """id, component of the members of large regions, from their sets (region, id, size, elements) and their blocks' components."""
    own = sets.select("region", "id", "size")
    links, heads, before, turn = first, first.select(F.col("component").alias("id")).distinct(), None, 0
    while before is None or 10 * now < 9 * before:
        turn += 1
        blocks = _dealt(own.join(heads, "id", "left_semi"), ["region"], turn).select("id", "block")
        more = cut(sets.select("id", "elements").join(blocks, "id").groupBy("block").applyInArrow(_verified, "id long, component long"))
        before, links = more.count(), links.unionByName(more)
        heads = more.select(F.col("component").alias("id")).distinct()
        now = heads.count()
    named = components(links.toDF("b", "a")).toDF("id", "label")
    own = cut(own.join(named, "id", "left").select("region", "id", "size", F.coalesce("label", "id").alias("label")))
    apart = own.groupBy("region").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low <> high").select("region")
    crossing = _postings(sets, own.join(apart, "region", "left_semi"))
    final = components(links.toDF("b", "a").unionByName(crossing)).toDF("id", "component")
    return own.select("id").join(final, "id", "left").select("id", F.coalesce("component", "id").alias("component"))


def _grouped(rows: DataFrame) -> DataFrame:
    """doc_id, tag, n_shingles, component_id, component, kept for every row of (doc_id, tag, text); component is a number of
    the component, null for rows that can't link."""

    def sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches):
            n, keys, codes, marks = [], [], [], []
            for data in utf8(batch["text"]):
                own = shingles(data)
                n.append(len(own))
                if not len(own):
                    keys.append(b"")
                    codes.append(None)
                    marks.append(None)
                    continue
                keys.append(xxhash.xxh3_128_digest(own.tobytes()))
                values = sketch(own)
                codes.append((mixed(values) & U64(255)).astype(np.uint8).tobytes())
                marks.append(bands(values))
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["tag"], pa.array(n, pa.int64()), pa.array(keys, pa.binary()), pa.array(codes, pa.binary()), pa.array(marks, pa.list_(pa.int64()))], names=["doc_id", "tag", "n", "set_key", "code", "bands"])

    base = cut(rows.mapInArrow(sketched, "doc_id long, tag long, n long, set_key binary, code binary, bands array<long>"))
    folded = base.where("n > 0 AND doc_id IS NOT NULL").groupBy("set_key", "n").agg(F.min("doc_id").alias("doc_id"), F.first("code").alias("code"), F.first("bands").alias("bands"))
    classes = cut(folded.withColumn("id", F.monotonically_increasing_id()))  # fixed by being stored

    marked = classes.select("id", F.explode("bands").alias("band"))
    buckets = marked.groupBy("band").agg(F.count("*").alias("m"), F.bit_xor(F.xxhash64("id")).alias("s"), F.bit_xor(F.xxhash64("id", F.lit(1))).alias("s1"), F.min("id").alias("low"), F.max("id").alias("high")).where("m > 1")
    distinct = buckets.groupBy("m", "s", "s1", "low", "high").agg(F.min("band").alias("band")).select("band", "m", "low")
    found = marked.join(distinct, "band")
    members = found.where(F.col("m") <= BUCKET).select("id", "band").join(classes.select("id", "n", "code"), "id")
    stars = found.where(F.col("m") > BUCKET).select(F.col("low").alias("a"), F.col("id").alias("b"))
    slots = 8 * width(rows.sparkSession)
    edges = members.groupBy(F.pmod(F.xxhash64("band"), F.lit(slots)).alias("slot")).applyInArrow(_bucket, "a long, b long").unionByName(stars).distinct()
    regions = cut(components(edges).toDF("id", "region").join(classes.select("id", "doc_id", "set_key", "n"), "id"))
    sized = regions.groupBy("region").agg(F.ceil(F.sum("n") / F.lit(BLOCK)).alias("blocks"))
    large = cut(sized.where("blocks > 1"))
    some = not large.isEmpty()

    def full_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches):
            sets = [shingles(data).tobytes() for data in utf8(batch["text"])]
            own = pa.array([xxhash.xxh3_128_digest(x) == k for x, k in zip(sets, batch["set_key"].to_pylist(), strict=True)], pa.bool_())  # not those of other rows with this doc_id
            yield pa.RecordBatch.from_arrays([batch["region"], batch["id"], pa.array(sets, pa.binary())], names=["region", "id", "elements"]).filter(own)

    def sets_of(some_regions: DataFrame) -> DataFrame:
        return rows.join(some_regions.drop("n"), "doc_id").select("region", "id", "set_key", "text").mapInArrow(full_sets, "region long, id long, elements binary")

    usual = regions.join(large, "region", "left_anti") if some else regions
    linked = sets_of(usual).withColumnRenamed("region", "block").groupBy(F.pmod(F.xxhash64("block"), F.lit(slots)).alias("slot")).applyInArrow(_verified, "id long, component long")
    if some:
        whole = sets_of(regions.join(large, "region", "left_semi"))
        whole = cut(whole.withColumn("size", F.expr("length(elements) div 8")).dropDuplicates(["id"]))
        blocks = _dealt(whole.select("region", "id", "size"), ["region"]).select("id", "block")
        linked = linked.unionByName(_large(whole, cut(whole.select("id", "elements").join(blocks, "id").groupBy("block").applyInArrow(_verified, "id long, component long"))))
    linked = cut(linked.groupBy("id").agg(F.min("component").alias("component")).join(regions.select("id", "doc_id", "set_key", "n"), "id"))
    smallest = linked.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    named = linked.join(smallest, "component").select("set_key", "n", "component_id", "component")
    alone = classes.join(regions.select("id"), "id", "left_anti").select("set_key", "n", F.col("doc_id").alias("component_id"), F.col("id").alias("component"))
    return (
        base.select("doc_id", "tag", "n", F.when(F.col("doc_id").isNotNull(), F.col("set_key")).alias("set_key"))
        .join(named.unionByName(alone), ["set_key", "n"], "left")
        .select("doc_id", "tag", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"), "component")
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))
    )


def near_groups(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row."""
    return _grouped(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.lit(0).cast("long").alias("tag"), "text")).drop("tag", "component")


def keep_one(docs: DataFrame) -> DataFrame:
    """`docs` with one row of each near-duplicate group, all columns as they are; texts without shingles all stay."""
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(1 << 62) + F.pmod(F.xxhash64("text"), F.lit(1 << 62)))  # of the text, so that it's the same in each scan
    own = docs.select(F.struct(*docs.columns).alias("row"), key.alias("key"), F.xxhash64("text", F.lit("row")).alias("tag"))  # a tag tells rows with equal ids apart
    groups = _grouped(own.select(F.col("key").alias("doc_id"), "tag", F.col("row.text").alias("text")))
    first = groups.where("kept AND component IS NOT NULL").groupBy("component").agg(F.min(F.struct(F.col("doc_id").alias("key"), "tag")).alias("x")).select("x.*", F.lit(True).alias("one"))
    staying = first.unionByName(groups.where("component IS NULL").select(F.col("doc_id").alias("key"), "tag", F.lit(False).alias("one")).distinct())
    again = Window.partitionBy("key", "tag").orderBy("key")
    return own.join(staying, ["key", "tag"]).withColumn("place", F.row_number().over(again)).where("place = 1 OR NOT one").select("row.*")
