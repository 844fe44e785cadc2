"""Every operator against a brute-force version or a public library, on small fixtures with the awkward cases."""

import hashlib
import math
import random
import re
import time

import duckdb
import numpy as np
import pytest

from spikeloom.llm import arc, chat, decontaminate, exact_dedup, language_id, near_dedup, pieces, pii, suffix_dedup, toxicity

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, h string, norm string, keep_id long"


def prose(r, n, words=None):
    return " ".join(r.choice(words) if words else "".join(r.choice("abcdeimnorst") for _ in range(r.randint(1, 8))) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    r = random.Random(5)
    base = [prose(r, n) for n in (0, 1, 3, 5, 40, 120, 300, 80, 80, 2000)]
    texts = [*base, base[5], base[6] + "\n", base[6].replace(" ", "  "), None, None, "", " \t\n", "Ünï©ode ﬁ 日本語 " + base[4], base[6][:900] + prose(r, 30), "12 34 !!", base[7].upper(), "x" * 30000]
    w = base[8].split()
    texts += [" ".join(w[:k] + ["changed"] + w[k + 1 :]) for k in (10, 30, 50, 70)]
    out = [(k * 3, t, ["en", "fr", None][k % 3], "s", None, "clash", "clash", k) for k, t in enumerate(texts)]
    r.shuffle(out)
    return out


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def test_exact_groups(docs, rows, empty):
    want, groups = {}, {}
    for i, t, *_ in rows:
        groups.setdefault(re.sub("[\x20\x09-\x0d]", "", t or ""), []).append((-len(t or ""), i))
    for norm, members in groups.items():
        keep = min(members)[1]
        want |= {i: (keep, len(members), i == keep, hashlib.sha256(norm.encode()).hexdigest()) for _, i in members}
    got = {r.doc_id: (r.keep_id, r.group_size, r.kept, r.text_sha256) for r in exact_dedup.exact_groups(docs).collect()}
    assert got == want
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", [(i, t) for i, t, *_ in rows])
    cur = con.execute(exact_dedup.ORACLE_SQL)
    names = [c[0] for c in cur.description]
    assert {x["doc_id"]: (x["keep_id"], x["group_size"], x["kept"], x["text_sha256"]) for x in (dict(zip(names, v)) for v in cur.fetchall())} == want
    assert exact_dedup.exact_groups(empty).count() == 0
    assert exact_dedup.keep_one(docs).columns == docs.columns and exact_dedup.keep_one(docs).count() == len(groups)


def test_exact_dedup_of_null_and_repeated_ids(spark):
    rows = [(None, "a b ", "x"), (7, "ab", "y"), (None, "alone", "x"), (None, "twice", "x"), (None, "twice", "x"), (3, "same", "x"), (3, "same", "x"), (3, "other", "x"), (4, "other", "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = sorted((r.text, r.doc_id) for r in exact_dedup.keep_one(docs).collect())
    assert got == [("ab", 7), ("alone", None), ("other", 3), ("same", 3), ("twice", None)]  # a row with an id stays
    assert {r.keep_id for r in exact_dedup.exact_groups(docs).where("doc_id = 7").collect()} == {7}


def shingle_sets(rows):
    out = {}
    for i, t, *_ in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        out[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    return out


def reachable(nodes, linked):
    part = {n: n for n in nodes}

    def top(x):
        while part[x] != x:
            x = part[x]
        return x

    for a in nodes:
        for b in nodes:
            if a < b and linked(a, b):
                x, y = top(a), top(b)
                part[max(x, y)] = min(x, y)
    return {n: top(n) for n in nodes}


def test_near_groups(docs, rows, empty):
    sets = shingle_sets(rows)
    want = reachable(list(sets), lambda a, b: bool(sets[a]) and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]))
    got = near_dedup.near_groups(docs).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got} == {i: (len(sets[i]), c, c == i) for i, c in want.items()}
    assert near_dedup.near_groups(empty).count() == 0


def test_near_dedup_of_null_and_repeated_ids(spark):
    r = random.Random(8)
    a, b, c = prose(r, 90), prose(r, 90), prose(r, 90)
    rows = [(None, a), (5, a + " end"), (None, b), (None, b + " end"), (6, c), (6, c), (None, None), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    got = [(x.doc_id, x.text) for x in near_dedup.keep_one(docs).collect()]
    assert len(got) == 5 and (5, a + " end") in got and (6, c) in got and got.count((None, None)) == 2
    assert sum(x in got for x in ((None, b), (None, b + " end"))) == 1


def test_large_regions_and_buckets(spark, docs, rows, monkeypatch):
    r, more = random.Random(6), []
    for g in range(3):  # chains, whose ends don't link with each other
        w = [prose(r, 1) for _ in range(100)]
        for k in range(40):
            w = list(w)
            w[r.randrange(100)] = prose(r, 1) + str(k)
            more.append((1000 + 40 * g + k, " ".join(w)))
    more += [(2000 + k, t + " " + prose(r, n)) for k, (t, n) in enumerate([(more[0][1], 30), (more[0][1], 40), (more[5][1], 60)])]
    sets = shingle_sets(rows + more)
    want = reachable(list(sets), lambda a, b: bool(sets[a]) and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]))
    monkeypatch.setattr(near_dedup, "BLOCK", 500)
    monkeypatch.setattr(near_dedup, "BUCKET", 3)
    every = docs.select("doc_id", "text").union(spark.createDataFrame(more, "doc_id long, text string"))
    assert {x.doc_id: x.component_id for x in near_dedup.near_groups(every).collect()} == want


def test_repetitive_texts_and_items_cost_what_differs_in_them():
    for unit in ("a", "ab cd", "abcdefg hij klmno pqrs tuvwxyz 0123456789 "):
        began = time.time()
        found = decontaminate.Index([(1, unit * (100_000 // len(unit)))]).search(unit * (20_000 // len(unit)))
        assert time.time() - began < 10 and found[1][1] == 0 and len(found[1][0]) > 12_000


def test_prefix_filter_finds_the_components_of_all_pairs():
    r = random.Random(1)
    for _ in range(60):
        base, sets = [r.sample(range(60), r.randint(3, 30)) for _ in range(4)], []
        for _ in range(r.randint(2, 50)):
            own = list(r.choice(base))
            for _ in range(r.randint(0, 5)):
                own[r.randrange(len(own))] = r.randint(0, 90)
            sets.append(frozenset(own if r.random() < 0.8 else own[: r.randint(1, len(own))]))
        want = reachable(range(len(sets)), lambda a, b: 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]))
        label = [want[k] if r.random() < 0.3 else -1 - k for k in range(len(sets))]
        for start in (np.arange(len(sets)), np.array(label)):
            joiner = near_dedup._Joiner([np.array(sorted(x), np.uint64) for x in sets], start)
            links, root = joiner.run(), joiner.roots(np.arange(len(sets)))
            assert {(a, b): root[a] == root[b] for a in want for b in want} == {(a, b): want[a] == want[b] for a in want for b in want}
            assert len(links) == len(set(start.tolist())) - len(set(want.values()))


def test_unlike_texts_and_copies_cost_no_pairs():
    r = np.random.default_rng(0)
    core = r.integers(0, 1 << 60, 100).astype(np.uint64)
    short = [np.unique(np.array([1, 2, *r.integers(1000, 1 << 60, 2)], np.uint64)) for _ in range(64_000)]
    copies = [np.unique(np.concatenate([core[r.permutation(100)[:95]], r.integers(0, 1 << 60, 5).astype(np.uint64)])) for _ in range(5_000)]
    for sets, links in ((short, 0), (copies, 4_999)):
        began = time.time()
        assert len(near_dedup._Joiner(sets, np.arange(len(sets))).run()) == links
        assert time.time() - began < 10


def test_sketch_fills_and_estimates():
    r = np.random.default_rng(3)
    for n in (1, 2, 7, 100, 3000):
        assert near_dedup.sketch(r.integers(0, 2**63, n).astype(np.uint64)).max() < 2**63
    errors = []
    for _ in range(200):
        x = r.integers(0, 2**63, 400).astype(np.uint64)
        a, b = near_dedup.sketch(x[:350]), near_dedup.sketch(x[50:])
        errors.append((a == b).mean() - 0.75)
    assert abs(np.mean(errors)) < 0.01 and np.std(errors) < 0.05


def test_suffix_array_sorts(spark):
    r = np.random.default_rng(0)
    for _ in range(60):
        parts = [bytes(r.integers(97, 97 + r.integers(1, 5), r.integers(50, 90)).astype(np.uint8)) for _ in range(r.integers(1, 20))]
        text = (np.frombuffer(b"\xff".join(parts) + b"\xff", np.uint8) + np.uint8(1)).astype(np.uint8)
        words = suffix_dedup._words(text)
        order, raw = suffix_dedup.suffix_array(text, words), text.tobytes()
        suffixes = [raw[k : raw.index(b"\0", k) + 1] for k in order]
        assert sorted(order.tolist()) == list(range(len(text))) and all(a <= b for a, b in zip(suffixes, suffixes[1:]))
        wanted = r.random(len(text)) < 0.3
        some = suffix_dedup.suffix_array(text, words, wanted)
        suffixes = [raw[k : raw.index(b"\0", k) + 1] for k in some]
        assert set(np.flatnonzero(wanted)) <= set(some.tolist()) and len(set(some.tolist())) == len(some) and all(a <= b for a, b in zip(suffixes, suffixes[1:]))


def stripped(rows):
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of each row, by brute force."""
    first, want = {}, []
    data = [(i, (t or "").encode()) for i, t in rows]
    for i, b in data:
        for k in range(len(b) - 49):
            first[b[k : k + 50]] = min(i, first.get(b[k : k + 50], i)) if i is not None else first.get(b[k : k + 50], 1 << 60)
    for i, b in data:
        gone = np.zeros(len(b), bool)
        for k in range(len(b) - 49):
            if i is not None and first[b[k : k + 50]] < i:
                gone[k : k + 50] = True
        kept = bytes(np.frombuffer(b, np.uint8)[~gone]) if len(b) else b""
        want.append((i, len(b), int(gone.sum()), int((np.diff(gone.astype(int), prepend=0) == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return sorted(want, key=str)


def strips(docs):
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.strip_repeats(docs).collect()), key=str)


def test_stretches_cover_all_strings(monkeypatch):
    r = random.Random(12)
    texts = [prose(r, n).encode() for n in (60, 9, 200, 30, 15)] + [b"", b"short", b"ab" * 300]
    offsets = np.cumsum([0, *map(len, texts)])
    for piece in (100, 1 << 16):
        monkeypatch.setattr(suffix_dedup, "PIECE", piece)
        seen = {}
        for text, h, first, last, *_ in suffix_dedup.stretches(np.frombuffer(b"".join(texts), np.uint8), offsets):
            for d, x, s, e in zip(text, h, first, last):
                for k in range(s, e + 1):
                    assert (d, k) not in seen
                    seen[d, k] = x
        assert set(seen) == {(d, int(offsets[d]) + k) for d, t in enumerate(texts) for k in range(len(t) - 49)}
        by = {}
        for (d, k), x in seen.items():
            assert by.setdefault(texts[d][k - offsets[d] : k - offsets[d] + 50], x) == x  # equal strings have equal minimisers


@pytest.mark.parametrize("hot", [1 << 20, 1])
def test_strip_repeats(spark, docs, rows, empty, monkeypatch, hot):
    """Also with all minimisers of several documents as hot ones."""
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    monkeypatch.setattr(suffix_dedup, "SHARE", 1 << 20)
    own = [(i, t) for i, t, *_ in rows]
    long = next(t for _, t in own if t and len(t.split()) == 2000)
    own += [(None, long), (3, long[500:900]), (3, long[700:1200]), (3, long[700:1200]), (1, "ab" * 90 + long[:300]), (2, "ab" * 50), (500, long[::-1] + long[3000:])]
    want = stripped(own)
    assert strips(spark.createDataFrame(own, "doc_id long, text string").repartition(3)) == want and sum(v[2] for v in want) > 1000
    assert suffix_dedup.strip_repeats(empty).count() == 0 and suffix_dedup.strip_repeats(docs).count() == len(rows)


def plain_spans(text):
    out = []
    for k, p in enumerate([r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"]):
        for m in re.finditer(p, text):
            d = re.sub("[^0-9]", "", m[0])
            if (k != 1 or all(int(x) <= 255 for x in m[0].split("."))) and (k != 2 or 14 <= len(d) <= 19 and pii.luhn(d)) and (k != 3 or 10 <= len(d) <= 15):
                out.append((*m.span(), k))
    return sorted(out, key=lambda x: (x[0], x[2]))


def test_pii(spark, docs, rows, empty):
    r = random.Random(3)
    for _ in range(20000):
        t = "".join(r.choice("a1.@+- 2()") for _ in range(r.randint(0, 26)))
        assert pii.base_spans(t) == plain_spans(t), t
    weights = pii.train(pii.training_sentences())
    fresh = pii.training_sentences(300, 99)
    found = [set(pii.best_segments(t, weights)) for t, _ in fresh]
    right = sum(len(f & set(g)) for f, (_, g) in zip(found, fresh))
    assert right >= 0.95 * sum(len(g) for _, g in fresh) and right >= 0.95 * sum(map(len, found))
    special = spark.createDataFrame([(1, "call +1 (269) 555-3296 4111111111111111 now"), (2, None), (3, 'token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff" ok'), (4, "clean words only 2024-01-02")], "doc_id long, text string")
    got = {x.doc_id: x for x in pii.digests(pii.find(special, weights)).collect()}
    assert got[1].spans == "phone:5:22,card:23:39" and got[1].n_card == 0
    assert got[2].spans == "" and got[2].base_sha256 == hashlib.sha256(b"").hexdigest()
    assert got[3].spans.startswith("secret:9:") and got[3].n_added == 1 and got[4].spans == ""
    assert pii.digests(pii.find(docs, weights)).count() == len(rows) and pii.find(empty, weights).count() == 0


def test_pii_of_long_keys():
    r, weights = random.Random(9), pii.train(pii.training_sentences())
    for n in (97, 128, 200, 5000):
        for letters in ("0123456789abcdef", "ABCDEFabcdefghijkXYZ0123456789"):
            key = "".join(r.choice(letters) for _ in range(n - 2)) + "a7"
            for before, after in (('token = "', '" ok'), ("words api_key: ", " and then")):
                _, every = pii.all_spans(before + key + after, weights)
                assert (len(before), len(before) + n, 4) in every, (n, every)
    for text in ("x1234567" * 200_000, ("x1234567" * 40 + " ") * 2000):
        assert len(pii.stretches_around(text)) == 1  # in linear time


def test_arc(spark, tmp_path):
    pages = [(1, "http://a/x y", "<p>é</p>"), (2, None, None), (3, "http://b", "<p>é</p>"), (4, "http://c", ""), (5, "http://d", "WARC/1.1\r\n\r\nx\r\n\r\n"), (6, "http://e", "z" * 200000)]
    got = {r.page_id: r for r in arc.archive(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    assert {i: (r.record_type, r.refers_to) for i, r in got.items()} == {1: ("response", None), 2: ("response", None), 3: ("revisit", 1), 4: ("revisit", 2), 5: ("response", None), 6: ("response", None)}
    assert all((got[i].payload_bytes, got[i].payload_digest) == (len((h or "").encode()), arc.base32_sha1((h or "").encode())) for i, _, h in pages)
    assert arc.archive(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0
    for version in (1, 2):
        data = arc.arc_head(version, "f") + arc.arc_record(version, "http://u/a b", "1.2.3.4", "20010203040506", "text/html", b"a\n\nb") + arc.arc_record(version, "u", "-", "20010203040506", "x", b"")
        assert [(r["url"], r["body"], r["status"]) for r in arc.parse_arc(data) if not r["version"]] == [("http://u/a b", b"a\n\nb", "200" if version == 2 else None), ("u", b"", "200" if version == 2 else None)]
    with pytest.raises(ValueError):
        list(arc.parse_arc(arc.arc_head(1, "f") + b"u - 20010203040506 x 99\nshort\n"))


def test_arc_files_of_others(spark, tmp_path, monkeypatch):
    """ARC files read by Spark, with bodies that are no UTF-8, into WARC files of a few records each."""
    monkeypatch.setattr(arc, "FILE_BYTES", 300)
    page = b"HTTP/1.0 200 OK\r\nA: b\r\n\r\n" + "é".encode("latin-1") * 50
    bodies = [("http://a/", page), ("http://b/ c", page), ("dns:c", b"1.2.3.4"), ("ftp://d", bytes(range(256)) * 4), ("http://e/", b"HTTP/1.0 404\r\n\r\n")]
    for version in (1, 2):
        (tmp_path / f"{version}.arc").write_bytes(arc.arc_head(version, "f") + b"".join(arc.arc_record(version, u, "1.2.3.4", "2001020304050" + str(version), "x/y", b) for u, b in bodies))
    records = arc.convert(spark.read.format("binaryFile").load(str(tmp_path)))
    assert sorted((r.kind, bytes(r.block)) for r in records.where("kind <> 'warcinfo'").collect()) == sorted(("response" if b.startswith(b"HTTP/") else "resource", b) for _, b in bodies * 2)
    folder = arc.shared_folder(spark, "test-warc")
    arc.write_warc(records, folder)
    files = [f.content for f in spark.read.format("binaryFile").option("pathGlobFilter", "*.txt").load(folder).collect()]
    every = [x for f in files for x in arc.parse_warc(bytes(f))]
    assert len(files) > 2 and sum(f["WARC-Type"] == "warcinfo" for f, _ in every) == len(files) + 2
    whole = {f["WARC-Record-ID"]: f for f, _ in every if f["WARC-Type"] in ("response", "resource")}
    again = [f for f, b in every if f["WARC-Type"] == "revisit" and not b]
    assert len(whole) == 4 and len(again) == 6
    for f in again:
        first = whole[f["WARC-Refers-To"]]
        assert (f["WARC-Refers-To-Target-URI"], f["WARC-Refers-To-Date"], f["WARC-Payload-Digest"]) == (first["WARC-Target-URI"], first["WARC-Date"], first["WARC-Payload-Digest"])
    got = arc.read_warc(spark, folder).collect()
    assert len(got) == 10 and {r.page_id for r in got} == {None}


def test_arc_of_null_and_repeated_ids(spark):
    rows = [(None, "u", "x"), (7, "u", "x"), (7, "u", "x"), (7, "v", "x"), (9, "u", "x"), (None, None, "alone")]
    got = sorted(((r.page_id, r.record_type, r.refers_to) for r in arc.archive(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()), key=str)
    assert got == sorted([(7, "response", None), (7, "revisit", 7), (7, "revisit", 7), (9, "revisit", 7), (None, "response", None), (None, "revisit", 7)], key=str)


def test_arc_rows_that_repeat_are_records_of_their_own(spark):
    rows = [(k % 3, "u", "x" * (k % 3), "clash", 1) for k in range(9)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, record_id string, copies int").repartition(3)
    folder = arc.shared_folder(spark, "test-warc")
    arc.write_warc(arc.convert(arc.as_arc(pages)), folder)
    files = [bytes(f.content) for f in spark.read.format("binaryFile").option("pathGlobFilter", "*.txt").load(folder).collect()]
    fields = [f for data in files for f, _ in arc.parse_warc(data) if f["WARC-Type"] != "warcinfo"]
    assert len({f["WARC-Record-ID"] for f in fields}) == 9
    whole = {f["X-Page-ID"]: f["WARC-Record-ID"] for f in fields if f["WARC-Type"] == "response"}
    assert len(whole) == 3 and all(f["WARC-Refers-To"] == whole[f["X-Page-ID"]] for f in fields if f["WARC-Type"] == "revisit")


def sellers(p, t):
    c, ramp = np.zeros(len(t) + 1, int), np.arange(len(t) + 1)
    for ch in p:
        step = np.concatenate([[c[0] + 1], np.minimum(c[:-1] + (t != ch), c[1:] + 1)])
        c = np.minimum.accumulate(step - ramp) + ramp
    return int(c.min())


@pytest.mark.parametrize("block", [None, 300])
def test_decontaminate(spark, empty, monkeypatch, block):
    if block:  # several blocks, items with several texts and documents with several rows
        monkeypatch.setattr(decontaminate, "BLOCK", block)
    r = random.Random(1)
    words = [prose(r, 1) for _ in range(60)]
    items = [(i, prose(r, r.randint(4, 40), words)) for i in range(8)] + [(20, None), (21, "tiny"), (22, "ab cd " * 30), (23, "ab cd " * 50)] + [(i, prose(r, 30, words)) for i in (2, 3)]

    def edited(t, n):
        t = list(t)
        for _ in range(n):
            k = r.randrange(len(t))
            t[k : k + 1] = r.choice([[], ["z"], [t[k], "q"]])
        return "".join(t)

    texts = []
    for _ in range(60):
        x = r.choice(items[:8])[1]
        a = r.randrange(max(1, len(x) - 60))
        texts.append(prose(r, r.randint(0, 60), words) + " " + edited(x[a : a + r.randint(60, 140)], r.randint(0, 14)))
    texts += [None, "", "short", "xx " + "ab cd " * 20, items[-1][1] + " z"]
    rows = [*enumerate(texts), (0, items[0][1]), (0, items[-2][1])]
    found = {}
    for name, text in items:
        p = decontaminate.normal(text)
        size = min(decontaminate.WINDOW, len(p))
        for s in sorted({*range(0, len(p) - size + 1, decontaminate.STEP), len(p) - size}) if size >= decontaminate.Q else []:
            for d, t in rows:
                e = sellers(p[s : s + size], decontaminate.normal(t))
                if e <= min(decontaminate.EDITS * size // decontaminate.WINDOW, (size - decontaminate.Q) // decontaminate.Q):
                    found.setdefault((d, name), []).append((text, s, e))
    want = {k: (len({x[:2] for x in v}), min(x[2] for x in v)) for k, v in found.items()}
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(x.doc_id, x.item_id): (x.windows, x.edits) for x in decontaminate.leaks(docs, bench).collect()}
    assert got == want and want
    assert {x.doc_id for x in decontaminate.keep_clean(docs, bench).collect()} - {0} == set(range(1, len(texts))) - {d for d, _ in want}
    assert decontaminate.leaks(empty, bench).count() == 0 and decontaminate.leaks(docs, bench.limit(0)).count() == 0


def a_model(pieces_, kind, **flags):
    """A model file of (piece, score, kind) rows, as the format's messages."""

    def varint(n):
        return bytes([n]) if n < 128 else bytes([n & 127 | 128]) + varint(n >> 7)

    def field(number, value):
        return varint(number << 3 | 2) + varint(len(value)) + value if isinstance(value, bytes) else varint(number << 3) + varint(value)

    rows = b"".join(field(1, field(1, p.encode()) + varint(2 << 3 | 5) + np.float32(s).tobytes() + field(3, k)) for p, s, k in pieces_)
    settings = field(1, b"identity") + field(2, flags.get("charsmap", b"")) + field(3, flags.get("lead", 1)) + field(4, flags.get("squeeze", 0)) + field(5, 1)
    return rows + field(2, field(3, kind) + field(35, 1)) + field(3, settings)


def vocabulary(r, letters="abcdé▁", n=60):
    """Pieces of a made-up model: controls, bytes, letters, and strings that grow from earlier ones."""
    out = [("<unk>", 0, 2), ("<s>", 0, 3), ("</s>", 0, 3)] + [(f"<0x{k:02X}>", 0, 6) for k in range(256)]
    normal = list(letters)
    while len(normal) < n:
        x = r.choice(normal) + r.choice(normal)
        if x not in normal and len(x) < 9 and "▁" not in x[1:]:
            normal.append(x)
    return out, normal


TEXTS = ["  a  b ", "a\tb\nc", "▁x ▁", "<s>hi</s><0x41>", "x² ².", "ab_cd _", "the🤦‍♀️end", "한국어 ไทย", "x" * 300, "ab" * 40 + " " + "é" * 60]


def test_pieces(docs, rows, empty):
    sentencepiece = pytest.importorskip("sentencepiece")
    library = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    texts = [t or "" for _, t, *_ in rows] + TEXTS
    fst = pieces.Transducer(*pieces.read_model(open(pieces.MODEL, "rb").read()))
    for t in texts:
        ids = np.frombuffer(fst.encode(t), "<i4")
        assert ids.tolist() == library.encode(t), t
        assert fst.decode(ids) == library.decode(ids.tolist())
    got = {r.doc_id: r for r in pieces.digests(docs).collect()}
    for i, t, *_ in rows:
        assert got[i].ids_sha256 == hashlib.sha256(np.array(library.encode(t or ""), "<i4").tobytes()).hexdigest() and got[i].round_trip
    back = {r.doc_id: r.text for r in pieces.decode(pieces.encode(docs)).collect()}
    assert back == {i: t or "" for i, t, *_ in rows}
    assert pieces.digests(empty).count() == 0


@pytest.mark.parametrize("kind", [pieces.UNIGRAM, pieces.MERGES])
def test_made_up_models(spark, tmp_path, kind):
    """Both kinds of models against the public library, with and without their weights."""
    sentencepiece = pytest.importorskip("sentencepiece")
    r, changed, differ = random.Random(7), 0, 0
    for turn in range(6):
        head, normal = vocabulary(r, n=r.choice([20, 60, 200]))
        scores = [-float(k) for k in range(len(normal))] if kind == pieces.MERGES else [-8 * r.random() * len(x) ** 0.5 for x in normal]
        if kind == pieces.MERGES:  # letters come last in merge models
            normal = normal[6:] + normal[:6]
        data = a_model([*head, *((p, s, 1) for p, s in zip(normal, scores, strict=True))], kind, lead=turn % 2)
        library = sentencepiece.SentencePieceProcessor(model_proto=data)
        fst, flat = pieces.Transducer(*pieces.read_model(data)), pieces.Transducer(*pieces.read_model(data))
        flat.weight, flat.weights = [0.0] * len(flat.weight), flat.weights * 0
        texts = ["".join(r.choice("abcdé  zß") for _ in range(r.randint(0, 70))) for _ in range(300)] + TEXTS
        for t in texts:
            ids = np.frombuffer(fst.encode(t), "<i4").tolist()
            want = library.encode(t)  # of paths that cost the same in a unigram model, the library's rounding chooses
            cost = [sum(fst.weight[i] if i > 258 else 0.0 for i in x) for x in (ids, want)]
            assert ids == want or kind == pieces.UNIGRAM and abs(cost[0] - cost[1]) < 1e-4, (turn, t)
            differ += ids != want
            assert fst.decode(np.array(ids, np.int64)) == library.decode(ids)
            assert [i for c in fst.chunks(fst.lead + t.replace("▁", " ")) for i in fst.shortest(c.replace(" ", "▁"))] == ids or not t
            changed += ids != np.frombuffer(flat.encode(t), "<i4").tolist()
    assert changed > 50 and differ < 100  # the weights choose the paths
    (tmp_path / "m.model").write_bytes(data)
    docs = spark.createDataFrame([(1, "ab é", "x"), (None, None, "y"), (1, "", "z")], "doc_id long, text string, ids string")
    got = [(x.doc_id, x.round_trip, x.n_pieces) for x in pieces.digests(docs, str(tmp_path / "m.model")).collect()]
    assert (1, True, len(library.encode("ab é"))) in got and (None, True, 0) in got and len(got) == 3


def test_refused_models():
    head, normal = vocabulary(random.Random(1))
    every = [*head, *((p, -1.0, 1) for p in normal)]
    pieces.read_model(a_model(every, 1))
    for bad in (a_model(every, 3), a_model(every, 1, charsmap=b"x"), a_model(every, 1, squeeze=1), a_model(every[3:100], 1), a_model([*every, ("own", 0, 4)], 2)):
        with pytest.raises(ValueError):
            pieces.read_model(bad)


def test_tables():
    r, table, known = np.random.default_rng(2), pieces.Table(4, 12), {}
    for _ in range(40):
        keys = np.unique(r.integers(0, 3000, 50))
        fresh = keys[table.get(keys) < 0]
        table.put(fresh, (fresh % 7).astype(np.int32))
        assert (table.get(keys) == keys % 7).all()


def test_chat(spark):
    rows = [(1, 0, "system", "be \\ nice"), (1, 1, "user", "a<|im_end|>\nb"), (1, 2, "assistant", "</s>\\[INST]"), (2, 0, "assistant", "first"), (2, 1, None, None), (3, 0, "user", ""), (4, None, "user", "x"), (4, None, "user", "x")]
    conv = chat.with_probe(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    got = {r.conv_id: r for r in chat.digests(chat.format_conversations(conv)).collect()}
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", rows)
    cur = con.execute(chat.ORACLE_SQL)
    names = [c[0] for c in cur.description]
    assert {v[0]: v for v in cur.fetchall()} == {i: tuple(r[n] for n in names) for i, r in got.items()}
    assert [got[k].valid for k in (-1, 1, 2, 3, 4)] == [True, True, False, True, False]
    for t in ("", "\\", "<s", "<|im_start|>", "\\<s>", "<\\s>", "a\\\nb"):
        assert chat.unescaped(chat.escaped(t)) == t and not any(c in chat.escaped(t) for c in chat.TEMPLATE["control"])


def test_language(spark, empty):
    r = random.Random(2)
    kinds = {"aa": "abcdeo", "bb": "stuvwi", "cc": "klmnéa"}
    rows = [(i, " ".join("".join(r.choice(kinds[g]) for _ in range(5)) for _ in range(r.randint(5, 60))), g) for i in range(300) for g in [r.choice(list(kinds))]]
    rows += [(1000, None, "aa"), (1001, "12 !", "aa"), (1002, "abcde " * 400_000, None), (1003, "stuv", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {x.doc_id: x for x in language_id.predict_languages(docs).collect()}
    assert len(got) == len(rows) and {got[i].lang_pred for i in (1000, 1001)} == {"und"} and got[1002].lang_pred == "aa"
    held = [(got[i].lang_pred, g) for i, t, g in rows[:300] if got[i].held_out]
    assert len(held) > 50 and np.mean([a == b for a, b in held]) > 0.97
    assert all(0 <= x.score <= 1 for x in got.values())
    assert {x.doc_id for x in language_id.keep_identified(docs).collect()} == {i for i, *_ in rows} - {1000, 1001}
    assert language_id.predict_languages(empty).count() == 0
    code, n = language_id.trigrams("ab " * 700_000)
    assert n.sum() == 2 * 700_000  # pieces lose no trigram at their borders


def test_texts_with_letters_stay_where_nothing_is_learned(spark):
    docs = spark.createDataFrame([(1, "some words", None), (2, "12 !", None), (3, None, None), (4, "日本語", None)], "doc_id long, text string, lang string")
    assert {x.doc_id for x in language_id.keep_identified(docs).collect()} == {1, 4}


def test_toxicity(spark, empty):
    r = random.Random(4)
    words = [prose(r, 1) for _ in range(300)]
    rows, labels = [], []
    for i in range(500):
        t, toxic = prose(r, r.randint(20, 80), words), int(r.random() < 0.3)
        if toxic:
            w = t.split()
            for _ in range(3):
                w.insert(r.randrange(len(w)), r.choice(["idiot", "zorbling", "zorblat"]))
            t = " ".join(w)
        rows.append((i, t))
        labels.append((i, toxic))
    rows += [(900, None), (901, ""), (902, "you IDIOT!!! " * 2000)]
    docs, known = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels + labels[:5] + [(7777, 1), (3, None)], "doc_id long, toxic int")
    got = {x.doc_id: x for x in toxicity.predict(docs, known).collect()}
    assert len(got) == len(rows)
    held = [(got[i].predicted, y) for i, y in labels if got[i].held_out]
    assert len(held) > 80 and np.mean([a == b for a, b in held]) > 0.95
    assert all(0 <= x.score <= 1 and x.predicted == int(x.score >= 0.3) for x in got.values())
    assert {x.score for x in toxicity.predict(docs, known.limit(0)).collect()} == {0.0}
    assert toxicity.predict(empty, known).count() == 0


def test_toxicity_lexicon_and_calibration_are_recomputed(spark, monkeypatch):
    """The lexicon by plain counting, and the calibrated scores by pooling adjacent violators over the margins of the last fifth."""
    r = random.Random(14)
    words, rows, labels = [prose(r, 1) for _ in range(200)], [], {}
    for i in range(700):
        labels[i] = int(r.random() < 0.4)
        t = prose(r, r.randint(10, 40), words).split()
        for _ in range(r.choice([0, 1, 2]) if labels[i] else r.choice([0, 0, 0, 1])):
            t.insert(r.randrange(len(t)), r.choice(["idiot", "zorbling", "you"]))
        rows.append((i, " ".join(t)))
    docs, known = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(list(labels.items()), "doc_id long, toxic int")
    fold = {x.doc_id: x.f == 4 for x in docs.selectExpr("doc_id", "pmod(xxhash64(doc_id, 'fold'), 5) AS f").collect()}
    seen = {}
    monkeypatch.setattr(toxicity, "learn_lexicon", lambda sample, learn=toxicity.learn_lexicon: seen.setdefault("lexicon", learn(sample)))
    monkeypatch.setattr(toxicity, "TIE_SHARE", 1.0)
    raw = {x.doc_id: x for x in toxicity.predict(docs, known).collect()}
    monkeypatch.setattr(toxicity, "TIE_SHARE", 0.0)
    got = {x.doc_id: x.score for x in toxicity.predict(docs, known).collect()}
    held = {i for i in labels if raw[i].held_out}
    count, total = ({}, {}), [0, 0]
    for i, t in rows:
        if i not in held and not fold[i]:
            total[labels[i]] += 1
            own = set(re.findall(r"[^\W_]+", t.lower()))
            for g in own | {f"{w[:n]}*" for w in own for n in toxicity.STEMS if len(w) > n}:
                count[labels[i]][g] = count[labels[i]].get(g, 0) + 1
    odds = {g: math.log((n + 0.5) / (total[1] + 1)) - math.log((count[0].get(g, 0) + 0.5) / (total[0] + 1)) for g, n in count[1].items() if n >= toxicity.FEWEST}
    assert seen["lexicon"] == {w: 4.0 for w in toxicity.INSULTS} | {g: pytest.approx(o, abs=1e-6) for g, o in odds.items() if o >= toxicity.LEAST}
    margin = {i: math.log(x.score / (1 - x.score)) / 2 for i, x in raw.items()}
    points = {}
    for i in labels:
        if i not in held and fold[i]:
            points.setdefault(round(margin[i], 9), []).append(labels[i])
    pools = []  # [sum, n, first margin, last margin]
    for m in sorted(points):
        pools.append([sum(points[m]), len(points[m]), m, m])
        while len(pools) > 1 and pools[-2][0] / pools[-2][1] >= pools[-1][0] / pools[-1][1]:
            last = pools.pop()
            pools[-1] = [pools[-1][0] + last[0], pools[-1][1] + last[1], pools[-1][2], last[3]]
    curve = [(m, a / n) for a, n, low, high in pools for m in ([low, high] if high > low else [low])]
    want = {i: float(np.interp(m, *zip(*curve))) for i, m in margin.items()}
    assert len(pools) > 1 and all(abs(got[i] - want[i]) < 1e-6 for i in labels)


def test_pipeline(spark, tmp_path, rows):
    import corpus_pipeline

    spark.createDataFrame(rows, SCHEMA).select("doc_id", "text", "lang", "source", "n_chars").write.parquet(f"{tmp_path}/documents.parquet")
    bench = next(t for i, t, *_ in rows if t and len(t.split()) == 300)[:200]
    spark.createDataFrame([(1, bench)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = {r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    left = [x for x in rows if x[1] and re.search(r"[^\W\d_]", x[1])]
    groups = {}
    for i, t, *_ in left:
        groups.setdefault(re.sub("[\x20\x09-\x0d]", "", t), []).append((-len(t), i))
    keep = {min(m)[1] for m in groups.values()}
    left = [x for x in left if x[0] in keep]
    sets = shingle_sets(left)
    part = reachable(list(sets), lambda a, b: bool(sets[a]) and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]))
    left = [x for x in left if part[x[0]] == x[0]]
    index = decontaminate.Index([(1, bench)])
    clean = {i for i, t, *_ in left if all(sellers(index.points[s : s + n], decontaminate.normal(t)) > b for s, n, b in zip(index.starts, index.sizes, index.budgets))}
    assert got == clean and len(clean) < len(left)
