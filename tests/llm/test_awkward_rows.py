"""Null and repeated ids, clashing columns, empty tables, ties and hostile texts, for every operator and pipeline stage."""

import hashlib
import math
import random
import re
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from spikeloom.llm import arc, chat, common, decontaminate, exact_dedup, language_id, near_dedup, pieces, pii, suffix_dedup, toxicity

from test_operators import prose, reachable, shingle_sets

LONG = prose(random.Random(21), 90)
ROWS = [(None, LONG + " one"), (None, None), (5, LONG), (5, LONG), (5, "quite another text, call +1 269 555 3296 now"), (7, ""), (8, LONG.upper()), (9, "½ ² Ⅷ")]
CLASH = "h string, norm string, keep_id long, id long, band long, code string, bands string, features string, label double, last boolean, ids string, spans string, tag long, page_ids string, segments string, kind int, row string, component long"


@pytest.fixture(scope="module")
def docs(spark):
    plain = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in ROWS], "doc_id long, text string, lang string, source string, n_chars long")
    return plain.withColumns({x.split()[0]: F.lit(None).cast(x.split()[1]) for x in CLASH.split(", ")}).repartition(2)


def rows_of(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=str)


def test_clashing_columns_and_ids(spark, docs):
    ids = sorted((str(i) for i, _ in ROWS))
    labels = spark.createDataFrame([(5, 1, "x"), (8, 0, "y"), (None, 1, "z")], "doc_id long, toxic int, features string")
    bench = spark.createDataFrame([(1, LONG, 3), (None, LONG, 4), (1, LONG, 3)], "item_id long, text string, doc_id long")
    weights = pii.train(pii.training_sentences(60))
    for out in (
        pii.digests(pii.find(docs, weights)), suffix_dedup.strip_repeats(docs), toxicity.predict(docs, labels), near_dedup.near_groups(docs), exact_dedup.exact_groups(docs), pieces.digests(docs), language_id.predict_languages(docs),
    ):
        assert sorted(str(r.doc_id) for r in out.collect()) == ids
    found = rows_of(decontaminate.leaks(docs, bench), "doc_id", "item_id", "edits")
    assert found == [(5, 1, 0), (8, 1, 0), (None, 1, 0)]
    assert rows_of(pieces.decode(pieces.encode(docs)), "doc_id", "text") == sorted(((i, t or "") for i, t in ROWS), key=str)
    for stage in (language_id.keep_identified(docs), exact_dedup.keep_one(docs), near_dedup.keep_one(docs), decontaminate.keep_clean(docs, bench)):
        assert stage.columns == docs.columns
        stage.count()


def test_what_null_and_repeated_ids_get(docs):
    n = len(shingle_sets([(0, LONG)])[0])
    assert rows_of(near_dedup.near_groups(docs), "doc_id", "n_shingles", "component_id", "kept")[:5] == [(5, 5, 5, True), (5, n, 5, True), (5, n, 5, True), (7, 0, 7, True), (8, n, 5, False)]
    assert (None, n + 1, None, False) in rows_of(near_dedup.near_groups(docs), "doc_id", "n_shingles", "component_id", "kept")
    kept = rows_of(near_dedup.keep_one(docs), "doc_id", "text")
    assert kept == sorted([(5, LONG), (5, ROWS[4][1]), (7, ""), (9, "½ ² Ⅷ"), (None, None)], key=str)
    exact = rows_of(exact_dedup.exact_groups(docs), "doc_id", "keep_id", "group_size", "kept")
    assert (None, 7, 2, False) in exact and (7, 7, 2, True) in exact and exact.count((5, 5, 2, True)) == 2 and (None, None, 1, False) in exact
    assert exact_dedup.keep_one(docs).count() == 6
    languages = {(r.doc_id, r.lang_pred, r.score > 0, r.held_out) for r in language_id.predict_languages(docs).collect()}
    assert (9, "und", False, False) in languages and (None, "und", False, False) in languages
    assert rows_of(language_id.keep_identified(docs), "doc_id") == [(5,), (5,), (5,), (8,), (None,)]


def test_near_links_of_repeated_ids(spark):
    r = random.Random(31)
    a, b = prose(r, 60), prose(r, 60)
    rows = [(5, a), (5, b), (7, b + " word"), (9, a + " word"), (5, a + " more"), (12, prose(r, 60))]
    got = rows_of(near_dedup.near_groups(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)), "doc_id", "component_id")
    assert got == [(12, 12), (5, 5), (5, 5), (5, 5), (7, 5), (9, 5)]
    kept = rows_of(near_dedup.keep_one(spark.createDataFrame(rows, "doc_id long, text string")), "doc_id", "text")
    assert len(kept) == 3 and (12, rows[5][1]) in kept and (5, b) in kept


@pytest.mark.parametrize("lengths", [False, True])
def test_bytes_decide_exact_groups(spark, docs, monkeypatch, lengths):
    """All texts, or those of one length, share a hash."""
    want = rows_of(exact_dedup.exact_groups(docs), "doc_id", "keep_id", "group_size", "kept", "text_sha256"), rows_of(exact_dedup.keep_one(docs), "doc_id", "text")
    monkeypatch.setattr(exact_dedup, "content_hash", lambda norm: F.char_length(norm).cast("string").cast("binary") if lengths else F.lit(b"x"))
    assert (rows_of(exact_dedup.exact_groups(docs), "doc_id", "keep_id", "group_size", "kept", "text_sha256"), rows_of(exact_dedup.keep_one(docs), "doc_id", "text")) == want


def test_empty_tables(spark, docs):
    none, weights = docs.limit(0), pii.train(pii.training_sentences(30))
    labels, bench = spark.createDataFrame([(1, 1)], "doc_id long, toxic int"), spark.createDataFrame([(1, LONG)], "item_id long, text string")
    for out in (pii.digests(pii.find(none, weights)), suffix_dedup.strip_repeats(none), toxicity.predict(none, labels), toxicity.predict(none, labels.limit(0)), near_dedup.near_groups(none), near_dedup.keep_one(none), decontaminate.leaks(none, bench), decontaminate.keep_clean(docs.limit(0), bench), exact_dedup.exact_groups(none), exact_dedup.keep_one(none), pieces.digests(none), language_id.predict_languages(none), language_id.keep_identified(none)):
        assert out.count() == 0
    assert chat.digests(chat.format_conversations(spark.createDataFrame([], "conv_id long, turn long, role string, text string, turns string"))).count() == 0


def test_pipeline_of_awkward_tables(spark, docs, tmp_path):
    import corpus_pipeline

    for name, table in (("some", docs), ("none", docs.limit(0))):
        table.write.parquet(f"{tmp_path}/{name}/documents.parquet")
        spark.createDataFrame([(1, "nothing alike, " * 9)], "item_id long, text string").write.parquet(f"{tmp_path}/{name}/benchmark.parquet")
    assert sorted(str(r.doc_id) for r in corpus_pipeline.run(spark, f"{tmp_path}/some").collect()) == ["5", "5"]
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").count() == 0


def test_chat_roles_and_ties(spark):
    rows = [(1, 0, "us\ner", "a\nb", "x"), (1, 1, "back\\slash\n\n\\", "c", "x"), (2, 0, "\n", "", "x"), (None, 3, None, None, "x"), (4, 1, "user", "b", "x"), (4, 1, "user", "a", "y")]
    formatted = chat.format_conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, turns string"))
    read = {r.conv_id: chat.read_back(r.formatted) for r in formatted.collect()}
    assert read == {1: [("us\ner", "a\nb"), ("back\\slash\n\n\\", "c")], 2: [("\n", "")], None: [("", "")], 4: [("user", "a"), ("user", "b")]}
    got = {r.conv_id: r for r in chat.digests(formatted).collect()}
    assert got[1].turns_sha256 == hashlib.sha256(b"us\ner\na\nb\nback\\slash\n\n\\\nc\n").hexdigest()
    r = random.Random(3)
    for _ in range(3000):
        turns = [("".join(r.choice(["\\", "\n", "a", "<|im_end|>", "<|im_start|>"]) for _ in range(r.randint(0, 4))), "".join(r.choice(["\\", "\n", "b", "<|im_end|>\n", "</s>"]) for _ in range(r.randint(0, 4)))) for _ in range(r.randint(1, 3))]
        assert chat.read_back("".join(x for x, _ in chat.segments(turns)[0])) == turns


def test_hostile_texts():
    """Texts on which a careless scan takes quadratic time."""
    weights, began = pii.train(pii.training_sentences(60)), time.perf_counter()
    for unit in ("1", "1 ", "a.", "x@", "a at ", "a[at]", "+1", "token = ", "a_", "(", "1-(2) "):
        pii.all_spans(unit * (400_000 // len(unit)), weights)
    index = decontaminate.Index([(1, "spam " * 60), (2, "a" * 400)])
    for text in ("spam " * 1_000_000, "a" * 2_000_000):
        assert len(index.search(text)) == 1
    assert time.perf_counter() - began < 120


def test_addresses_equal_a_plain_scan():
    r, plain = random.Random(4), re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
    for _ in range(3000):
        text = "".join(r.choice(["a", "b1", ".", "@", " ", "-", "com"]) for _ in range(r.randint(0, 20)))
        assert {m.span() for m in plain.finditer(text)} <= pii.addresses(text), text
    for text in ("mail me (at) home (dot) com now", "me at home dot com", "x.y [at] z [dot] org"):
        assert len(pii.addresses(text)) == 1


def test_field_by_enumeration():
    """The best segmentation and the likelihood's gradient against all segmentations of short stretches."""
    weights = pii.train(pii.training_sentences(80))
    for text in ("call (269) 555-3296 now", "host 10.0.0.1 id 4111", "me at home dot com", "token = ab12cd34ef56ab12"):
        spans = pii.proposals(text)

        def score(span):
            total = [0.0] * len(pii.KINDS)
            for f in pii._crossed(pii.segment_features(text, *span)):
                total = [x + y for x, y in zip(total, weights.get(f, [0.0] * len(total)))]
            return total

        scores = {s: score(s) for s in spans}
        best = [0.0, []]

        def walk(at, total, chosen):
            if total > best[0] + 1e-9:
                best[:] = total, chosen
            for s in spans:
                if s[0] >= at:
                    k = int(np.argmax(scores[s]))
                    walk(s[1], total + scores[s][k], [*chosen, (*s, k)])

        walk(0, 0.0, [])
        found = pii.best_segments(text, weights)
        assert math.isclose(sum(max(scores[s[:2]]) for s in found), best[0], abs_tol=1e-6), text


def test_profiles_by_plain_arithmetic(spark):
    """Letter vectors bound, permuted and bundled one by one, and cosines of them, give the operator's labels and scores."""
    r = random.Random(6)
    rows = [(i, " ".join(prose(r, 3, ["abc", "bad", "ça", "dé"] if i % 2 else ["xyz", "zoo", "yes"]) for _ in range(3)), "a" if i % 2 else "b") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")

    def bundle(text):
        total = np.zeros(language_id.DIMENSIONS)
        for word in re.findall(r"[^\W\d_]+", text.lower()):
            for x, y, z in zip(" " + word, word, word[1:] + " "):
                a, b, c = (language_id.letter_vectors(np.array([ord(k)]))[0].astype(int) for k in (x, y, z))
                total += np.roll(a, 2) * np.roll(b, 1) * c
        return total

    import zlib

    held = {i for i, *_ in rows if zlib.crc32(str(i).encode()) % 3 == 1}
    prototypes = {g: sum(bundle(t) for i, t, x in rows if x == g and i not in held) for g in "ab"}
    got = {x.doc_id: x for x in language_id.predict_languages(docs).collect()}
    for i, t, _ in rows:
        v = bundle(t)
        cosines = {g: float(v @ p / np.linalg.norm(v) / np.linalg.norm(p)) for g, p in prototypes.items()}
        best = max(cosines, key=cosines.get)
        assert (got[i].held_out, got[i].lang_pred) == (i in held, best) and abs(got[i].score - (1 + cosines[best]) / 2) < 1e-4


def test_toxicity_features_by_plain_counting():
    """Every feature of a text, counted one by one; the margin is made a probability by a curve that never falls."""
    lexicon = {"idiot": 4.0, "zorb*": 3.0}
    text = "You IDIOT!!! the zorbling is st4pid, i.d.i.o.t and id1ot? Usted no."
    words = ["you", "idiot", "the", "zorbling", "is", "st4pid", "i", "d", "i", "o", "t", "and", "id1ot", "usted", "no"]
    f = dict(zip(toxicity.FEATURES, toxicity.Scorer(lexicon).features(text.encode()), strict=True))
    n, size = len(words), len(text)
    letters, upper = sum(c.isalpha() for c in text), sum(c.isupper() for c in text)
    want = {
        "words": math.log1p(n), "lexicon": 2 / n, "strongest": 4.0, "distinct": math.log1p(2), "near": 2 / n, "nearest": 1 / 2, "second": 2 / n, "capitals": upper / letters, "shouted": 5 / letters, "exclamations": 3 / size,
        "questions": 1 / size, "marks": sum(c in "!?.," for c in text) / size, "digits": 2 / size, "mixed": 3 / n, "undone": 2 / n, "long_runs": 3 / n,
    }
    assert {k: round(v, 6) for k, v in f.items()} == {k: round(v, 6) for k, v in want.items()}


def test_toxicity_scores_rise_with_the_margin(spark):
    """Scores are those of the pool-adjacent-violators curve over the set-aside fifth, so they order texts as margins do."""
    r = random.Random(14)
    words = [prose(r, 1) for _ in range(200)]
    rows, labels = [], []
    for i in range(300):
        toxic = int(r.random() < 0.4)
        rows.append((i, prose(r, 25, words) + (" you moron zorb" if toxic and r.random() < 0.9 else "")))
        labels.append((i, toxic))
    got = toxicity.predict(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")).collect()
    score = {x.doc_id: x.score for x in got}
    marked = np.mean([score[i] for i, t in rows if "moron" in t])
    assert marked > 0.8 and np.mean([score[i] for i, t in rows if "moron" not in t]) < 0.2


def test_components_of_awkward_graphs(spark):
    r = random.Random(17)
    edges = [(k, k + 1) for k in range(60)] + [(500, k) for k in range(400, 460)] + [(7, 7), (900, 900)] + [(r.randrange(600, 700), r.randrange(600, 700)) for _ in range(60)]
    nodes = sorted({x for e in edges if e[0] != e[1] for x in e})
    linked = {frozenset(e) for e in edges}
    want = reachable(nodes, lambda a, b: frozenset((a, b)) in linked)
    got = {x.node: x.component for x in common.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == want


def test_no_session_setting_is_changed(spark, docs):
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    arc.archive(spark.createDataFrame([(1, "u", "h")], "page_id long, url string, html string")).count()
    near_dedup.near_groups(docs).count()
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == before


def test_rows_without_a_conversation_are_conversations_of_their_own(spark):
    import duckdb

    rows = [(None, 1, "user", "a"), (None, 0, "user", "b"), (None, 0, "user", "b"), (3, 1, "assistant", "d"), (3, 0, "user", "c")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = chat.digests(chat.format_conversations(chat.with_probe(df)))
    assert sorted(str((r.conv_id, r.n_turns)) for r in got.collect()) == sorted(map(str, [(None, 1), (None, 1), (None, 1), (3, 2), (-1, 2)]))
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", rows)
    cur = con.execute(chat.ORACLE_SQL)
    names = [c[0] for c in cur.description]
    assert sorted(str(tuple(r[c] for c in names)) for r in got.collect()) == sorted(str(v) for v in cur.fetchall())
