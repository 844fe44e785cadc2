"""Fingerprints against a plain recomputation, and what the hash promises: order, insertion, deletion, likeness."""

import hashlib
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from spikeloom.llm import fingerprint

from test_operators import prose

SCHEMA = "doc_id long, text string, v string, key long, bucket int, at int, n long"


def vector(text):
    """The lanes of a text's vector, by pairs."""
    paragraphs, lanes = text.split("\n"), [0] * (fingerprint.COUNTERS + fingerprint.WIDE + fingerprint.SOFT)
    for p in paragraphs:
        words = p.split(" ")
        shingles = [" ".join(words[k : k + fingerprint.WORDS]) for k in range(max(0, len(words) - fingerprint.WORDS) + 1)]
        own = [1, len(shingles)] + [int(hashlib.sha256(x.encode()).hexdigest()[k : k + 8], 16) for x in (p, p + "\n") for k in range(0, 64, 8)]
        soft = [0] * fingerprint.SOFT
        for s in shingles:
            digest = hashlib.md5(s.encode()).hexdigest()
            for half in range(2):
                number = int(digest[15 * half : 15 * half + 15], 16)
                for bit in range(30):
                    soft[60 * half + 2 * bit] += number >> (bit + 30) & 1
                    soft[60 * half + 2 * bit + 1] += number >> bit & 1
        lanes = [(a + b) % 2**32 for a, b in zip(lanes, own + soft, strict=True)]
    return lanes


def form(lanes):
    return "".join(f"{x:08x}" for x in lanes)


def alike(a, b):
    if a == b:
        return 1.0
    x, y = ([2 * s - v[1] for s in v[fingerprint.COUNTERS + fingerprint.WIDE :]] for v in (a, b))
    dot = lambda p, q: sum(i * j for i, j in zip(p, q))
    norm = dot(x, x) ** 0.5 * dot(y, y) ** 0.5
    return min(1.0, max(0.0, dot(x, y) / norm)) if norm else 0.0


def texts():
    r = random.Random(4)
    out = [None, "", " ", "\n", "\n\n", "a", "a b", "a b c", "a  b", "日本語 \U0001f600", "x" * 4000, "w " * 3000]
    out += ["\n".join(prose(r, r.randint(0, 30)) for _ in range(r.randint(1, 8))) for _ in range(40)]
    return out + [out[20], "\n".join(reversed(out[20].split("\n"))), out[21]]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(7 * k - 90, t, "clash", 1, 2, 3, 4) for k, t in enumerate(texts())]
    random.Random(2).shuffle(rows)
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def test_every_row(docs):
    rows = sorted(((r.doc_id, r.text or "") for r in docs.collect()), reverse=True)
    want = {}
    for k, (i, text) in enumerate(rows):
        after = rows[(k + 1) % len(rows)][1]
        share = len(text) // 3
        edited = text[: len(text) - share] + after[:share]
        own, changed, other = vector(text), vector(edited), vector(after)
        want[i] = (len(text), hashlib.sha256(edited.encode()).hexdigest(), form(own), form(changed), alike(own, changed), alike(own, other))
    got = {r.doc_id: tuple(r)[1:] for r in fingerprint.edited_and_next(docs).collect()}
    assert got.keys() == want.keys()
    for i, w in want.items():
        assert got[i][:4] == w[:4] and got[i][4:] == pytest.approx(w[4:], abs=1e-12)
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", [(r.doc_id, r.text) for r in docs.collect()])
    assert {r[0]: r[1:4] for r in con.execute(fingerprint.ORACLE_SQL).fetchall()} == {i: w[:3] for i, w in want.items()}


def test_order_insertion_and_deletion(docs):
    rows = {r.doc_id: r for r in fingerprint.fingerprints(docs).collect()}
    text = {r.doc_id: r.text or "" for r in docs.collect()}
    multiset = {}
    for i, r in rows.items():
        assert multiset.setdefault(tuple(sorted(text[i].split("\n"))), r.fingerprint) == r.fingerprint
    assert len({r.fingerprint for r in rows.values()}) == len(multiset)
    spark, ids = docs.sparkSession, [i for i in rows if len(text[i]) > 20][:8]
    pairs = [(rows[a].v, rows[b].v, form(vector(text[a] + "\n" + text[b]))) for a in ids for b in ids]
    out = spark.createDataFrame(pairs, "a array<long>, b array<long>, both string").withColumn("sum", fingerprint.added("a", "b"))
    out = out.select("a", "both", fingerprint.text_form("sum").alias("sum"), fingerprint.text_form(fingerprint.removed("sum", "b")).alias("less"), fingerprint.text_form("a").alias("own"))
    for r in out.collect():
        assert r["sum"] == r.both and r.less == r.own


def test_odd_ids_and_small_tables(spark, docs):
    one = fingerprint.edited_and_next(docs.where("text LIKE 'a b c'")).collect()
    assert [(r.near_next, r.edited_sha256) for r in one] == [(1.0, hashlib.sha256(b"a b a").hexdigest())]
    assert fingerprint.edited_and_next(docs.limit(0)).count() == 0 and fingerprint.fingerprints(docs.limit(0)).count() == 0
    many = docs.select(F.when(F.col("doc_id") % 3 == 0, F.col("doc_id")).when(F.col("doc_id") % 3 == 1, 5).alias("doc_id"), "text")
    many = many.unionByName(many)
    out = fingerprint.edited_and_next(many).collect()
    assert sorted(str((r.doc_id, r.n_chars)) for r in out) == sorted(str((r.doc_id, len(r.text or ""))) for r in many.collect())
    same = {r.fingerprint for r in out if r.n_chars == 0}
    assert len(same) == 1
