"""Token alignment against a plain walk over both encodings."""

import collections
import hashlib
import random

import pytest
import sentencepiece
from tokenizers import Tokenizer

from spikeloom.llm import alignment

ZERO = (0, 0, 0, 0, 0, 0, "")
COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def plain(texts):
    """What `links` returns for each text, by walking whole encodings of whole texts."""
    a_model = Tokenizer.from_file(alignment.BYTE_BPE)
    a_model.encode_special_tokens = True
    b_model = sentencepiece.SentencePieceProcessor(model_file=alignment.PIECE_BPE)
    symbols, out, counts = alignment.byte_symbols(), [], collections.Counter()
    for text in texts:
        out.append(None)
        if not text:
            continue
        a, b = a_model.encode(f" {text}", add_special_tokens=False).ids, b_model.encode(text)
        a_bytes = [bytes(symbols[c] for c in a_model.id_to_token(i)) for i in a]
        b_bytes = [bytes([int(b_model.id_to_piece(i)[3:5], 16)]) if b_model.is_byte(i) else b_model.id_to_piece(i).replace("▁", " ").encode() for i in b]
        if not b"".join(a_bytes) == b"".join(b_bytes) == f" {text}".encode():
            continue
        ends = []
        for own in (a_bytes, b_bytes):
            at = 0
            ends.append([at := at + len(x) for x in own])
        linked = [(a[i], b[j]) for i in range(len(a)) for j in range(len(b)) if max(ends[0][i] - len(a_bytes[i]), ends[1][j] - len(b_bytes[j])) < min(ends[0][i], ends[1][j])] if len(a) < 300 else list(walked(a, b, *ends))
        groups, low = [], 0
        for cut in sorted(set(ends[0]) & set(ends[1])):
            groups.append("|".join(",".join(str(i) for i, e in zip(own, end) if low < e <= cut) for own, end in ((a, ends[0]), (b, ends[1]))) if len(a) < 300 else None)
            low = cut
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if None not in groups else None
        counts.update(set(linked))
        out[-1] = len(a), len(b), len(groups), linked, digest
    best = collections.Counter()
    for (i, _), n in counts.items():
        best[i] = max(best[i], n)
    return [ZERO if x is None else (*x[:3], len(x[3]), sum(counts[p] == best[p[0]] for p in x[3]), sum(counts[p] for p in x[3]), x[4]) for x in out]


def walked(a, b, end_a, end_b):
    i = j = 0
    while i < len(a) and j < len(b):
        yield a[i], b[j]
        x, y = end_a[i], end_b[j]
        i, j = i + (x <= y), j + (y <= x)


def hostile():
    r = random.Random(3)
    odd = [None, "", " ", "  ", "a  b", "a   b\n\n c \n d", "\n\nx\n y", "foo▁ bar", "▁", "日本語 テスト \U0001f600 \U0001f469‍\U0001f469 x", "<s> </s> <|endoftext|> <unk>", "é ﬁ ½", "x" * 3000, "tab\t x\t\ty   nb  z", "it's don't I'M", "\x00\x01 \x7f q", "a​ b   c", "e" + " " * 40 + "f ", " lead", "trail ", "\r\n \r\nx"]
    odd += ["".join(r.choice("ab 's\n\t é日\U0001f600▁!1 ") for _ in range(r.randint(1, 50))) for _ in range(250)]
    return [*odd, *odd[40:60], "the same words in several rows the same words", "the same words in several rows"]


@pytest.mark.parametrize("small", [False, True])
def test_links(spark, monkeypatch, small):
    if small:  # chunks forgotten again and again, and counts joined instead of broadcast
        monkeypatch.setattr(alignment, "PAIRS", 5)
    texts = hostile()
    want = plain(texts)
    rows = [(k, t, "clash", 1) for k, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, row string, code int").repartition(3)
    got = {r.doc_id: tuple(r[c] for c in COLUMNS) for r in alignment.links(docs).collect()}
    assert [got[k] if w[6] is not None else (*got[k][:6], None) for k, w in enumerate(want)] == want
    assert sum(w != ZERO for w in want) > 80 and sum(w == ZERO for w in want) > 10


def test_chunks_that_are_forgotten(monkeypatch):
    with open(alignment.BYTE_BPE, "rb") as a, open(alignment.PIECE_BPE, "rb") as b:
        models = a.read(), b.read()
    whole, some = alignment.Aligner(*models), alignment.Aligner(*models)
    r, texts, groups = random.Random(5), hostile(), []
    for _ in range(4):
        r.shuffle(texts)
        groups += [texts[k : k + 20] for k in range(0, len(texts), 20)]
    want = [whole.rows(g) for g in groups]
    monkeypatch.setattr(alignment, "ROOM", 40)
    for g, y in zip(groups, want):
        x = some.rows(g)
        assert x[1] == y[1] and all((p == q).all() for p, q in zip((x[0], *x[2:]), (y[0], *y[2:])))
    assert len(some.index) < len(whole.index)


def test_rows_with_odd_ids(spark):
    docs = spark.createDataFrame([(None, "one two"), (5, "one two"), (5, "one two"), (None, None)], "doc_id long, text string")
    got = sorted(((r.doc_id, r.n_a, r.n_best, r.count_sum) for r in alignment.links(docs).collect()), key=str)
    assert got == [(5, 2, 2, 6), (5, 2, 2, 6), (None, 0, 0, 0), (None, 2, 2, 6)]
    assert alignment.links(docs.limit(0)).count() == 0
