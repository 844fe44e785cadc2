"""Personal data: base rules, and a semi-Markov conditional random field that adds spans.

Base rules find e-mail addresses, IP addresses, card and phone numbers in the whole text; a kind's matches are leftmost, don't
overlap and aren't retried when a check fails. Digits and letters are ASCII. The scans start at an @ or at a run of
digits, so long texts without matches cost one pass.

The field then labels stretches of text around anchors (@, spelt-out addresses, longer digit runs, credential words).
Candidate segments end where the text's own boundaries lie, and are at most SPAN characters long but for unbroken runs, which are whole; whole-span features (shape,
groups of digits, checksums, separators, cues before and characters around it) score each candidate for each kind, and dynamic programming over
the candidates' boundaries chooses all segments and kinds of a stretch jointly. Its weights maximise the penalised
likelihood of sentences generated from fixed patterns with a fixed seed, with gradients by the forward-backward recursion. Its spans that
touch no base span are added: further e-mail (spelt out), phone (without +) and `secret` spans. Candidates are looked for around marks, and
no run of characters is scanned more than once for each rule, so the time grows with a text's length whatever it holds.

Null and empty texts have no spans. Every row gets a result, also those with null or repeated doc_id. Other columns are ignored.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import portions

KINDS = ["email", "ip", "card", "phone", "secret"]
BASE = KINDS[:4]
SPAN = 96
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if k % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def _digits(s: str) -> str:
    return re.sub(r"[^0-9]", "", s)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, end, kind) of the base rules, in the order of start and kind."""
    out, at, free = [], text.find("@"), 0
    while at >= 0:
        begin = at
        while begin > free and text[begin - 1] in _LOCAL_CHARS:
            begin -= 1
        if begin < at and (m := _DOMAIN.match(text, at)):
            out.append((begin, m.end(), 0))
            free = m.end()
            at = text.find("@", free)
        else:
            at = text.find("@", at + 1)
    if text.count(".") >= 3:
        out += [(*m.span(), 1) for m in _IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split("."))]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 14 and 14 <= len(d := _digits(m[0])) <= 19 and luhn(d):
            out.append((*m.span(), 2))
    if "+" in text:
        out += [(*m.span(), 3) for m in _PHONE.finditer(text) if 10 <= len(_digits(m[0])) <= 15]
    return sorted(out, key=lambda x: (x[0], x[2]))


# --- the field -----------------------------------------------------------------------------------------------------
_SECRET_WORD = r"(?:api[_ -]?key|access[_ -]?key|secret|token|passw(?:or)?d|credential)"
_ANCHOR = re.compile(rf"@|[0-9](?:[ ().-]{{0,2}}[0-9]){{6}}|[0-9]{{1,3}}\.[0-9]{{1,3}}\.[0-9]|{_SECRET_WORD}|[ \[(]at[ \])]", re.I)
_MAYBE = re.compile(r"[0-9@]|\bat\b|secret|token|passw|key|credential", re.I)
_RUN = re.compile(r"[+(]?[0-9](?:[ ().-]{0,2}[0-9])*")
_MAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_SPELT_AT = r"\s?[\[({]\s?at\s?[\])}]\s?|\sat\s"
_SPELT_DOT = r"\s?[\[({]\s?dot\s?[\])}]\s?|\sdot\s"
_SPELT_MARK = re.compile(_SPELT_AT, re.I)
_BEFORE_AT = re.compile(rf"(?<![A-Za-z0-9_%+-])[A-Za-z0-9_%+-]+(?:(?:{_SPELT_DOT}|\.)[A-Za-z0-9_%+-]+)*\Z", re.I)
_AFTER_AT = re.compile(rf"[A-Za-z0-9-]+(?:(?:{_SPELT_DOT}|\.)[A-Za-z0-9-]+)+", re.I)
_SPELT = re.compile(rf"[A-Za-z0-9_%+-]+(?:(?:{_SPELT_DOT}|\.)[A-Za-z0-9_%+-]+)*(?:{_SPELT_AT})[A-Za-z0-9-]+(?:(?:{_SPELT_DOT}|\.)[A-Za-z0-9-]+)+", re.I)
_KEY = re.compile(r"[A-Za-z0-9_/+-]{12,}={0,2}")
_RUN_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789_/+-=")
_CUES = [
    re.compile(r"(?:mail|contact|write|reach)\W{0,3}(?:\w{1,3}\W{1,2})?\Z", re.I),
    re.compile(r"(?:\bip|host|server|address)\W{0,3}(?:is\W)?\Z", re.I),
    re.compile(r"(?:card|visa|credit|payment)\W{0,3}(?:\w{1,6}\W{1,2})?\Z", re.I),
    re.compile(r"(?:phone|tel|call|mobile|fax|dial)\W{0,3}(?:\w{1,3}\W{1,2})?\Z", re.I),
    re.compile(_SECRET_WORD + r"\W{1,5}(?:is\W{1,3})?\Z", re.I),
    re.compile(r"(?:order|invoice|id|no|number|version|part|date|total|page|isbn)\W{0,3}\Z", re.I),
]


def addresses(text: str) -> set[tuple[int, int]]:
    """Written and spelt-out e-mail addresses of up to SPAN characters; looked for around their marks, so that no run is scanned twice."""
    out, free, at = set(), 0, text.find("@")
    while at >= 0:
        begin = at
        while begin > max(free, at - SPAN) and text[begin - 1] in _LOCAL_CHARS:
            begin -= 1
        m = _DOMAIN.match(text, at, at + SPAN + 1) if begin < at else None
        if m:
            out.add((begin, m.end()))
            free = m.end()
        at = text.find("@", max(at + 1, free))
    free = 0
    for mark in _SPELT_MARK.finditer(text):
        low = max(free, mark.start() - SPAN)
        before = _BEFORE_AT.search(text[low : mark.start()])
        after = before and _AFTER_AT.match(text, mark.end(), mark.end() + SPAN)
        if after and not (before.start() == 0 and low > free):  # else it goes on beyond SPAN
            out.add((low + before.start(), after.end()))
            free = after.end()
    return out


def proposals(text: str) -> list[tuple[int, int]]:
    """Candidate segments of a stretch in the order of their ends: longer runs than SPAN as one each, others up to SPAN characters."""
    long = [m.span() for m in _KEY.finditer(text) if m.end() - m.start() > SPAN]
    if long:  # nothing within a run is a segment of its own, and the other scans stay short
        text = _KEY.sub(lambda m: m[0] if m.end() - m.start() <= SPAN else "\0" * (m.end() - m.start()), text)
    found = {m.span() for m in _KEY.finditer(text)} | addresses(text)
    for m in _RUN.finditer(text):
        groups = [(g.start() + m.start(), g.end() + m.start()) for g in re.finditer(r"[0-9]+", m[0])]
        for i, (s, _) in enumerate(groups):
            digits = 0
            for a, e in groups[i : i + 6]:
                digits += e - a
                if e - s > SPAN:
                    break
                if digits < 7 and "." not in text[s:e]:
                    continue
                found.add((s, e))
                if s > 0 and text[s - 1] in "+(":
                    found.add((s - 1, e))
                if s > 1 and text[s - 2 : s] == "+(":
                    found.add((s - 2, e))
    return sorted([*long, *(x for x in found if 6 <= x[1] - x[0] <= SPAN)], key=lambda x: (x[1], x[0]))


def _bucket(n: int, *edges: int) -> int:
    return sum(n >= e for e in edges)


def segment_features(text: str, start: int, end: int) -> list[str]:
    s = text[start:end]
    digits = _digits(s)
    letters = sum(c.isalpha() for c in s)
    groups = re.findall(r"[0-9]+", s)
    before, after = text[max(0, start - 1) : start], text[end : end + 1]
    out = [
        "bias", f"digits{_bucket(len(digits), 1, 4, 7, 10, 11, 14, 20)}", f"letters{_bucket(letters, 1, 3, 11, 20)}", f"dots{min(4, s.count('.'))}",
        f"groups{min(5, len(groups))}", f"first{s[0] if s[0] in '+(' else 'd' if s[0].isdigit() else 'a'}", f"length{_bucket(end - start, 10, 16, 24, 40)}",
        f"seps{''.join(sorted({c for c in s if c in ' .-()'}))}" if not letters else "seps-letters",
    ]
    if _MAIL.fullmatch(s):
        out.append("mail")
    if "@" not in s and _SPELT.fullmatch(s):
        out += ["spelt", "spelt-mark" if re.search(r"[\[({]", s) else f"spelt-dot{bool(re.search(_SPELT_DOT, s, re.I))}"]
    if re.fullmatch(r"[0-9]+(\.[0-9]+){3}", s):
        out.append("quad-ok" if all(len(g) <= 3 and int(g) <= 255 for g in groups) else "quad-bad")
    if 14 <= len(digits) <= 19 and not letters:
        out.append("luhn-ok" if luhn(digits) else "luhn-bad")
    if 10 <= len(digits) <= 15 and s[0] == "+":
        out.append("international")
    if [len(g) for g in groups] in ([3, 3, 4], [1, 3, 3, 4]):
        out.append("national")
    if letters and len(digits) >= 2 and _KEY.fullmatch(s):
        out.append("key")
        out.append("key-hex" if re.fullmatch(r"[0-9a-f]+|[0-9A-F]+", s) else f"key-case{any(c.isupper() for c in s)}")
        if re.match(r"(?:sk|pk|ghp|gho|xox[bp]|AKIA|AIza)[_-]?", s):
            out.append("key-prefix")
    cue = [k for k, c in enumerate(_CUES) if c.search(text, max(0, start - 24), start)]
    out += [f"cue{k}" for k in cue] or ["cue-none"]
    out.append(f"left-{'word' if before.isalnum() else before if before in '.-+/_@' else 'free'}")
    out.append(f"right-{'word' if after.isalnum() else 'sep' if after and after in '.-/_@' and text[end + 1 : end + 2].isalnum() else 'free'}")
    if re.match(r"[ ().-]{0,2}[0-9]", text[end : end + 3]):
        out.append("more-digits")
    if re.search(r"[0-9][ ().-]{0,2}\Z", text[max(0, start - 3) : start]):
        out.append("digits-before")
    return out


def _crossed(features: list[str]) -> list[str]:
    """The features, and the pairs of them that tell cues from shapes."""
    cues = [f for f in features if f.startswith("cue")]
    return features + [f"{c}&{f}" for c in cues for f in features if f in ("key", "national", "spelt", "luhn-ok", "quad-ok")]


def _lattice(spans: list[tuple[int, int]]) -> tuple[list[int], list[tuple[int, int]]]:
    """The sorted boundaries, and each candidate as (from, to) boundary numbers."""
    nodes = sorted({x for s in spans for x in s})
    number = {x: k for k, x in enumerate(nodes)}
    return nodes, [(number[a], number[b]) for a, b in spans]


def best_segments(text: str, weights: dict[str, list[float]]) -> list[tuple[int, int, int]]:
    """The segmentation of a stretch with the largest score; outside of segments the score is 0."""
    spans = proposals(text)
    if not spans:
        return []
    nodes, arcs = _lattice(spans)
    ending: list[list[int]] = [[] for _ in nodes]
    for k, (_, b) in enumerate(arcs):
        ending[b].append(k)
    best, back = [0.0] * len(nodes), [None] * len(nodes)
    for b in range(1, len(nodes)):
        best[b], back[b] = best[b - 1], (b - 1, None)
        for k in ending[b]:
            a = arcs[k][0]
            total = [0.0] * len(KINDS)
            for f in _crossed(segment_features(text, *spans[k])):
                if w := weights.get(f):
                    total = [x + y for x, y in zip(total, w)]
            score = max(total)
            if best[a] + score > best[b]:
                best[b], back[b] = best[a] + score, (a, (*spans[k], total.index(score)))
    out, b = [], len(nodes) - 1
    while b > 0:
        b, segment = back[b]
        if segment:
            out.append(segment)
    return out[::-1]


def train(sentences: list[tuple[str, list[tuple[int, int, int]]]], rounds: int = 40, penalty: float = 0.02) -> dict[str, list[float]]:
    """Weights by feature for each kind; gold segments that are no candidates are left out."""
    data, names = [], {}
    for text, gold in sentences:
        spans = proposals(text)
        if not spans:
            continue
        nodes, arcs = _lattice(spans)
        ids = [[names.setdefault(f, len(names)) for f in _crossed(segment_features(text, *s))] for s in spans]
        truth = {(a, b): k for a, b, k in gold}
        data.append((len(nodes), arcs, ids, np.array([truth.get(s, -1) for s in spans])))
    w, speed = np.zeros((len(names), len(KINDS))), np.full((len(names), len(KINDS)), 1e-8)
    for _ in range(rounds):
        for n, arcs, ids, truth in data:
            score = np.array([w[i].sum(axis=0) for i in ids])
            total = np.logaddexp.reduce(score, axis=1)
            ahead, behind = np.zeros(n), np.zeros(n)
            ending: list[list[int]] = [[] for _ in range(n)]
            for k, (_, b) in enumerate(arcs):
                ending[b].append(k)
            for b in range(1, n):
                ahead[b] = np.logaddexp.reduce([ahead[b - 1], *(ahead[arcs[k][0]] + total[k] for k in ending[b])])
            behind[:-1] = -np.inf
            for b in range(n - 1, 0, -1):
                behind[b - 1] = np.logaddexp(behind[b - 1], behind[b])
                for k in ending[b]:
                    behind[arcs[k][0]] = np.logaddexp(behind[arcs[k][0]], behind[b] + total[k])
            grad = np.zeros_like(w)
            for k, (a, b) in enumerate(arcs):
                share = -np.exp(ahead[a] + score[k] + behind[b] - ahead[-1])
                if truth[k] >= 0:
                    share[truth[k]] += 1
                if np.abs(share).max() > 1e-4:
                    grad[ids[k]] += share
            grad -= penalty * w * (grad != 0)
            speed += grad**2
            w += 0.3 * grad / np.sqrt(speed)
    return {f: [round(x, 4) for x in w[k].tolist()] for f, k in names.items()}


def training_sentences(n: int = 700, seed: int = 11) -> list[tuple[str, list[tuple[int, int, int]]]]:
    """Generated sentences with their segments: each kind in its usual shapes, and look-alikes that are none."""
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdefghilmnoprstuvy") for _ in range(r.randint(2, 8)))
    number = lambda k: "".join(r.choice("0123456789") for _ in range(k))
    prose = lambda k: " ".join(word() for _ in range(k))

    def card(good: bool) -> str:
        d = number(r.choice([14, 15, 15, 15, 18]))
        last = next(c for c in "0123456789" if luhn(d + c) == good)
        d += last
        sep = r.choice(["", "", " ", "-"])
        return sep.join(d[k : k + 4] for k in range(0, len(d), 4))

    hexes = lambda k: "".join(r.choice("0123456789abcdef") for _ in range(k - 2)) + r.choice(["a7", "3f"])
    mixed = lambda k: "".join(r.choice("ABCDEFabcdefghijkXYZ0123456789") for _ in range(k - 3)) + "x9Q"
    secret_cue = lambda: r.choice(["token = \"", "api_key: ", "secret=", "password: ", "access key ", "token is "])
    domain = lambda: f"{word()}.{r.choice(['com', 'org', 'net', 'example.com'])}"
    makers = [
        (0, lambda: f"{word()}{r.choice(['', '.' + word(), number(2)])}@{domain()}", ["", "mail ", "contact "]),
        (0, lambda: f"{word()} {r.choice(['[at]', '(at)', 'at'])} {word()} {r.choice(['[dot]', '(dot)', 'dot'])} com", ["", "mail ", "contact ", "write to "]),
        (1, lambda: ".".join(str(r.randint(0, 255)) for _ in range(4)), ["", "host ", "ip: "]),
        (2, lambda: card(True), ["", "card ", "visa number "]),
        (3, lambda: f"+{r.randint(1, 99)}{r.choice([' ', '-', ' ('])}{number(3)}{r.choice([' ', '-'])}{number(3)}{r.choice([' ', '-', ''])}{number(4)}", ["", "call ", "phone: "]),
        (3, lambda: f"{r.choice(['(%s) ', '%s-', '%s.'])}" % number(3) + f"{number(3)}{r.choice(['-', '.', ' '])}{number(4)}", ["call ", "phone: ", "tel "]),
        (4, lambda: hexes(r.choice([24, 32, 40])), [secret_cue]),
        (4, lambda: mixed(r.choice([16, 20, 32])), [secret_cue]),
        (4, lambda: r.choice(["sk_", "ghp_", "AKIA"]) + mixed(20), ["", secret_cue]),
        (None, lambda: card(False), ["", "order ", "id ", "card "]),
        (None, lambda: ".".join(number(r.randint(1, 2)) for _ in range(r.choice([2, 3, 5]))), ["version ", ""]),
        (None, lambda: f"{r.randint(256, 999)}.{r.randint(0, 999)}.{number(3)}.{number(2)}", ["", "host "]),
        (None, lambda: f"20{number(2)}-{number(2)}-{number(2)}", ["date ", ""]),
        (None, lambda: number(r.randint(7, 13)), ["id ", "order ", "total ", ""]),
        (None, lambda: f"{number(3)}-{number(3)}-{number(4)}", ["part ", "invoice ", ""]),
        (None, lambda: hexes(r.choice([12, 16, 40])), ["commit ", ""]),
        (None, lambda: f"{word()} at {word()} {word()}", [""]),
        (None, lambda: f"{word()}-{word()}-{word()}{number(1)}", [""]),
        (None, lambda: "".join(word() for _ in range(4)), ["", secret_cue]),
    ]
    out = []
    for _ in range(n):
        text, gold = prose(r.randint(0, 4)), []
        for _ in range(r.choice([1, 1, 2])):
            kind, make, cues = r.choice(makers)
            cue = r.choice(cues)
            text += (" " if text else "") + (cue() if callable(cue) else cue)
            piece = make()
            if kind is not None:
                gold.append((len(text), len(text) + len(piece), kind))
            text += piece + r.choice(["", ".", ",", "\"", "###"]) + " " + prose(r.randint(0, 4))
        out.append((text, gold))
    return out


def stretches_around(text: str) -> list[tuple[int, int]]:
    """Parts of a text in which the field looks for segments: SPAN characters around anchors and on to the ends of runs, overlapping ones joined."""
    out: list[list[int]] = []
    for m in _ANCHOR.finditer(text):
        s, e, done = max(0, m.start() - SPAN), min(len(text), m.end() + SPAN), out[-1][1] if out else 0
        while s > done and (text[s - 1] in _RUN_CHARS or text[s - 1].isalnum() and m.start() - s < 2 * SPAN):
            s -= 1
        while done < e < len(text) and text[e - 1] in _RUN_CHARS and text[e] in _RUN_CHARS:
            e += 1
        if out and s <= out[-1][1]:
            out[-1][1] = max(e, out[-1][1])
        else:
            out.append([s, e])
    return [(s, e) for s, e in out]


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Sorted spans, those that overlap as one."""
    out: list[tuple[int, int]] = []
    for s, e in spans:
        if out and s < out[-1][1]:
            out[-1] = out[-1][0], max(e, out[-1][1])
        else:
            out.append((s, e))
    return out


def all_spans(text: str, weights: dict[str, list[float]]) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """(base spans, base spans and those the field adds)."""
    base = base_spans(text)
    added, taken, at = [], merged([(s, e) for s, e, _ in base]), 0
    if _MAYBE.search(text):
        for s, e in stretches_around(text):
            for a, b, k in best_segments(text[s:e], weights):
                while at < len(taken) and taken[at][1] <= a + s:
                    at += 1
                if at == len(taken) or taken[at][0] >= b + s:
                    added.append((a + s, b + s, k))
    return base, sorted([*base, *added], key=lambda x: (x[0], x[2]))


def find(docs: DataFrame, weights: dict[str, list[float]] | None = None) -> DataFrame:
    """doc_id, spans array<struct<kind,start,end,base>> for every row: code points, end exclusive."""
    w = weights or train(training_sentences())
    cell = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches):
            out = []
            for text in batch["text"].to_pylist():
                base, every = all_spans(text or "", w)
                known = set(base)
                out.append([{"kind": KINDS[k], "start": s, "end": e, "base": (s, e, k) in known} for s, e, k in every])
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(out, cell)], names=["doc_id", "spans"])

    rows = docs.select("doc_id", "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, spans array<struct<kind:string,start:long,end:long,base:boolean>>")


def digests(found: DataFrame) -> DataFrame:
    """Counts and digests of the spans that `find` returns."""
    listed = lambda spans: F.concat_ws(",", F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))))
    base = F.filter("spans", lambda x: x["base"])
    of = lambda kind: F.size(F.filter(base, lambda x: x["kind"] == kind)).cast("long")
    counts = [of(k).alias(f"n_{k}") for k in BASE]
    added = F.size(F.filter("spans", lambda x: ~x["base"])).cast("long").alias("n_added")
    return found.select("doc_id", *counts, F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"), added)
