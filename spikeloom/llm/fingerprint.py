"""Document fingerprints: a homomorphic multiset hash of paragraphs, by built-in functions only.

A document is the multiset of its paragraphs (what stands between line ends; an empty text is one empty paragraph). Each paragraph
is hashed to a wide vector, and a document's fingerprint is the sum of its paragraphs' vectors modulo 2**32 in every lane. So the
order of paragraphs doesn't count, and `added` and `removed` insert and delete paragraphs by their own fingerprint, without the text.

A vector has COUNTERS lanes (1 for a paragraph, the number of its shingles), WIDE lanes of SHA-256 digests of the paragraph, which
decide equality, and SOFT lanes for likeness: lane k counts the paragraph's shingles (WORDS words, split at single blanks; a shorter paragraph is one
shingle) whose MD5 digest has bit k. Twice a soft lane less the number of shingles is a sum of random signs, so the
cosine of two such vectors estimates the cosine of the two multisets of shingles, with an error of about 1/sqrt(SOFT); `likeness` is that, cut to
0..1, and 1 for equal fingerprints. Two lanes share a 64-bit number; no count of a text below 2 GB reaches 2**31.

Documents follow each other by descending doc_id. Ids and hashes, a narrow table, are sorted by ranges; the ranges' first keys, one a
bucket, reach the driver. Each row goes to its bucket, the first row of a bucket also to the bucket before it, so texts are shuffled once and
everything after that (the next document, edited text, sums, likeness) happens inside buckets. Paragraphs and shingles are folded as they are made.

Null texts count as empty. Rows with equal ids follow each other by a hash of their text, then the text; rows with a null id come after all others.
A document that is alone is its own next one. An empty table gives an empty result. Columns other than doc_id and text are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import width

WORDS = 3
#: Lanes of a vector, and hexadecimal digits that soft lanes are read from at a time (60 bits, two numbers of 30 lanes each).
COUNTERS, WIDE, SOFT, DIGITS = 2, 16, 120, 15
#: Buckets of documents for each shuffle partition.
BUCKETS = 4
LOW = 0xFFFFFFFF
HEAD = (COUNTERS + WIDE) // 2


def _number(digest: Column, place: int, digits: int) -> Column:
    return F.conv(F.substring(digest, place, digits), 16, 10).cast("long")


def summed(rows: DataFrame, *keys: str) -> DataFrame:
    """`keys` and `v`, the vector of packed lanes, for each value of `keys`; rows: keys and text (not null), one row for each value."""
    whole = rows.select(*keys, F.explode(F.split("text", "\n")).alias("par"))
    hashed = whole.select(*keys, F.sha2("par", 256).alias("d0"), F.sha2(F.concat("par", F.lit("\n")), 256).alias("d1"), F.split("par", " ").alias("words"))  # no paragraph holds a line end
    places = hashed.select(*keys, "d0", "d1", "words", F.explode(F.sequence(F.lit(0), F.greatest(F.size("words") - WORDS, F.lit(0)))).alias("from_word"))
    shingle = F.concat_ws(" ", *(F.get("words", F.col("from_word") + k) for k in range(WORDS)))
    marked = places.select(*keys, "d0", "d1", "from_word", F.md5(shingle).alias("m"))
    first = F.col("from_word") == 0
    wide = [F.when(first, _number(F.col(d), 1 + 8 * k, 8)).otherwise(0).alias(f"w{d}{k}") for d in ("d0", "d1") for k in range(WIDE // 2)]
    numbers = marked.select(*keys, "from_word", *wide, *(_number(F.col("m"), 1 + DIGITS * k, DIGITS).alias(f"m{k}") for k in range(SOFT // (4 * DIGITS))))
    half = 2 * DIGITS
    soft = [F.shiftright(F.col(f"m{k}"), b).bitwiseAND(1) + F.shiftleft(F.shiftright(F.col(f"m{k}"), b + half).bitwiseAND(1), 32) for k in range(SOFT // (4 * DIGITS)) for b in range(half)]
    names = [f"w{d}{k}" for d in ("d0", "d1") for k in range(WIDE // 2)]
    sums = numbers.groupBy(*keys).agg(F.sum(F.when(first, 1).otherwise(0)).alias("paragraphs"), F.count("*").alias("n"), *(F.sum(x).alias(x) for x in names), *(F.sum(x).alias(f"s{k}") for k, x in enumerate(soft)))
    packed = [F.shiftleft(F.col(a).bitwiseAND(LOW), 32).bitwiseOR(F.col(b).bitwiseAND(LOW)) for a, b in zip(["paragraphs", *names[::2]], ["n", *names[1::2]], strict=True)]
    return sums.select(*keys, F.array(*packed, *(F.col(f"s{k}") for k in range(len(soft)))).alias("v"))


def _lanes(x: Column) -> tuple[Column, Column]:
    return F.shiftrightunsigned(x, 32), x.bitwiseAND(LOW)


def _combined(a: Column | str, b: Column | str, sign: int) -> Column:
    def both(x: Column, y: Column) -> Column:
        high, low = ((p + sign * q).bitwiseAND(LOW) for p, q in zip(_lanes(x), _lanes(y), strict=True))
        return F.shiftleft(high, 32).bitwiseOR(low)

    return F.zip_with(a, b, both)


def added(a: Column | str, b: Column | str) -> Column:
    """The vector of a document with the paragraphs of another one inserted."""
    return _combined(a, b, 1)


def removed(a: Column | str, b: Column | str) -> Column:
    """The vector of a document with the paragraphs of another one deleted."""
    return _combined(a, b, -1)


def text_form(v: Column | str) -> Column:
    """Hexadecimal, 16 digits for two lanes."""
    return F.array_join(F.transform(v, lambda x: F.lpad(F.lower(F.hex(x)), 16, "0")), "")


def _signs(v: Column | str) -> Column:
    """Soft lanes as sums of signs."""
    n = _lanes(F.element_at(v, 1))[1]
    return F.flatten(F.transform(F.slice(v, HEAD + 1, SOFT // 2), lambda x: F.array(*((2 * y - n).cast("double") for y in _lanes(x)))))


def _product(a: Column | str, b: Column | str) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def likeness(v: Column | str, signs: Column | str, length: Column | str, other: Column | str, other_signs: Column | str, other_length: Column | str) -> Column:
    """Estimated cosine of the shingles of two documents, from their vectors, the vectors' signs and squared lengths."""
    v, other, product = F.col(v), F.col(other), _product(signs, other_signs)
    cosine = F.try_divide(product, F.sqrt(F.col(length)) * F.sqrt(F.col(other_length)))
    return F.when(v == other, F.lit(1.0)).otherwise(F.coalesce(F.greatest(F.lit(0.0), F.least(F.lit(1.0), cosine)), F.lit(0.0)))


def _bucketed(docs: DataFrame) -> DataFrame:
    """bucket, ghost, the sort key and text of every row; a bucket's first row is also the ghost at the end of the bucket before."""
    text = F.coalesce("text", F.lit(""))
    id_ = F.col("doc_id").cast("long")
    key = F.struct(id_.isNull().alias("last"), F.coalesce(F.bitwise_not(id_), F.lit(0)).alias("down"), F.xxhash64(text).alias("h"))
    rows = docs.select(F.col("doc_id"), text.alias("text"), key.alias("key"))
    ranges = rows.select("key").repartitionByRange(BUCKETS * width(docs.sparkSession), "key").groupBy(F.spark_partition_id().alias("part")).agg(F.min("key").alias("key"))
    bounds = sorted(r.key for r in ranges.collect())
    if not bounds:
        return rows.withColumns({"bucket": F.lit(0), "ghost": F.lit(False)})
    limits = F.array(*(F.struct(F.lit(last).alias("last"), F.lit(down).cast("long").alias("down"), F.lit(h).cast("long").alias("h")) for last, down, h in bounds))
    n, steps = len(bounds), [1 << k for k in reversed(range(len(bounds).bit_length()))]
    below = lambda at, step: (at + step <= n) & (F.get(limits, at + step - 1) <= F.col("key"))
    held = rows.withColumn("bucket", F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), lambda at, step: F.when(below(at, step), at + step).otherwise(at)) - 1)  # a search by halves
    before = F.struct(F.pmod(F.col("bucket") - 1, F.lit(n)).alias("bucket"), F.lit(True).alias("ghost"))
    own = F.struct("bucket", F.lit(False).alias("ghost"))
    places = F.when(F.get(limits, F.col("bucket")) == F.col("key"), F.array(own, before)).otherwise(F.array(own))
    return held.select("doc_id", "text", "key", F.explode(places).alias("place")).select("doc_id", "text", "key", "place.*")


def edited_and_next(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next for every row."""
    follow = Window.partitionBy("bucket").orderBy("ghost", "key", "text")
    rows = _bucketed(docs).withColumns({"at": F.row_number().over(follow), "after": F.lead("text").over(follow), "n_chars": F.char_length("text").cast("long")})
    share = F.floor(F.col("n_chars") / 3).cast("int")
    edited = F.concat(F.left("text", F.col("n_chars").cast("int") - share), F.left(F.coalesce("after", F.lit("")), share))
    versions = F.array(F.struct(F.lit(0).alias("version"), F.col("text").alias("text")), F.struct(F.lit(1).alias("version"), F.when(~F.col("ghost"), edited).alias("text")))
    texts = rows.select("bucket", "at", "ghost", "doc_id", "n_chars", F.explode(versions).alias("x")).select("bucket", "at", "ghost", "doc_id", "n_chars", "x.*").where("text IS NOT NULL")
    keys = ["bucket", "at", "version", "ghost", "doc_id", "n_chars", "edited_sha256"]
    vectors = summed(texts.withColumn("edited_sha256", F.when(F.col("version") == 1, F.sha2("text", 256))), *keys)
    signs = vectors.withColumn("signs", _signs("v")).withColumn("square", _product("signs", "signs"))
    order = Window.partitionBy("bucket").orderBy("at", "version")
    beside = {f"{c}_{k}": F.lead(c, k).over(order) for k in (1, 2) for c in ("v", "signs", "square")} | {"sha": F.lead("edited_sha256").over(order)}
    final = signs.withColumns(beside).where("version = 0 AND NOT ghost")
    near = [likeness("v", "signs", "square", f"v_{k}", f"signs_{k}", f"square_{k}") for k in (1, 2)]
    return final.select("doc_id", "n_chars", F.col("sha").alias("edited_sha256"), text_form("v").alias("fingerprint"), text_form("v_1").alias("edited_fingerprint"), near[0].alias("near_edited"), near[1].alias("near_next"))


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, v (the packed lanes) and fingerprint for every row."""
    rows = _bucketed(docs).where("NOT ghost").withColumn("at", F.row_number().over(Window.partitionBy("bucket").orderBy("key", "text")))
    return summed(rows, "bucket", "at", "doc_id").select("doc_id", "v", text_form("v").alias("fingerprint"))


def _oracle() -> str:
    hexed = lambda d, at, n: f"CAST('0x' || substr({d}, {at}, {n}) AS BIGINT)"
    wide = [(d, 1 + 8 * k) for d in ("d0", "d1") for k in range(WIDE // 2)]
    half, wides = 2 * DIGITS, ", ".join(f"sum({hexed(d, at, 8)}) & {LOW} AS w{k}" for k, (d, at) in enumerate(wide))
    soft = [(k, b) for k in range(SOFT // (4 * DIGITS)) for b in range(half)]
    bits = ", ".join(f"sum(((m{k} >> {b}) & 1) + (((m{k} >> {b + half}) & 1) << 32))::BIGINT AS s{j}" for j, (k, b) in enumerate(soft))
    numbers = ", ".join(f"{hexed('m', 1 + DIGITS * k, DIGITS)} AS m{k}" for k in range(SOFT // (4 * DIGITS)))
    longs = ", ".join(["(paragraphs::BIGINT << 32) | n::BIGINT", *(f"(w{k}::HUGEINT * 4294967296 + w{k + 1}::HUGEINT)" for k in range(0, WIDE, 2)), *(f"s{j}" for j in range(len(soft)))])
    signs = ", ".join(f"(2 * (s{j} >> 32) - n)::DOUBLE, (2 * (s{j} & {LOW}) - n)::DOUBLE" for j in range(len(soft)))
    near = lambda other: f"CASE WHEN {other}.fingerprint = a.fingerprint THEN 1.0 ELSE coalesce(greatest(0.0, least(1.0, list_dot_product(a.signs, {other}.signs) / nullif(sqrt(list_dot_product(a.signs, a.signs)) * sqrt(list_dot_product({other}.signs, {other}.signs)), 0))), 0.0) END"
    return f"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, '')) AS n FROM documents),
o AS (SELECT *, coalesce(lead(text) OVER w, first_value(text) OVER w) AS after, coalesce(lead(doc_id) OVER w, first_value(doc_id) OVER w) AS next_id FROM t WINDOW w AS (ORDER BY doc_id DESC ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)),
v AS (SELECT doc_id, 0 AS version, text FROM o UNION ALL SELECT doc_id, 1, substr(text, 1, n - n // 3) || substr(after, 1, n // 3) FROM o),
p AS (SELECT doc_id, version, x.place, x.par, string_split(x.par, ' ') AS words FROM (SELECT doc_id, version, unnest(list_transform(string_split(text, chr(10)), lambda y, i: {{'place': i, 'par': y}})) AS x FROM v)),
h AS (SELECT doc_id, version, count(*) AS paragraphs, {wides} FROM (SELECT *, sha256(par) AS d0, sha256(par || chr(10)) AS d1 FROM p) GROUP BY ALL),
k AS (SELECT doc_id, version, unnest(list_transform(range(0, greatest(len(words) - {WORDS}, 0) + 1), lambda i: md5(array_to_string(words[i + 1 : i + {WORDS}], ' ')))) AS m FROM p),
s AS (SELECT doc_id, version, count(*) AS n, {bits} FROM (SELECT doc_id, version, {numbers} FROM k) GROUP BY ALL),
f AS (SELECT doc_id, version, array_to_string(list_transform([{longs}], lambda x: lpad(format('{{:x}}', x::UHUGEINT), 16, '0')), '') AS fingerprint, [{signs}] AS signs FROM h JOIN s USING (doc_id, version))
SELECT o.doc_id, o.n AS n_chars, sha256(v.text) AS edited_sha256, a.fingerprint, b.fingerprint AS edited_fingerprint, {near("b")} AS near_edited, {near("c")} AS near_next
FROM o JOIN v ON v.doc_id = o.doc_id AND v.version = 1 JOIN f a ON a.doc_id = o.doc_id AND a.version = 0 JOIN f b ON b.doc_id = o.doc_id AND b.version = 1 JOIN f c ON c.doc_id = o.next_id AND c.version = 0
"""


ORACLE_SQL = _oracle()
