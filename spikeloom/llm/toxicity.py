"""Toxicity by gradient-boosted trees over dense features, with isotonic calibration.

1. Labels are taken from rows whose crc32(doc_id as text) mod 4 is not 2. SAMPLE of these at most, the first by a hash of the
   id, are the bounded sample everything is fitted on; a fifth of it is set aside for step 4.
2. A lexicon is learned from the other four fifths: words, and stems of STEMS characters, that are far more frequent among toxic
   texts (log odds of LEAST or more, in FEWEST texts or more). A short fixed list of insults is always part of it.
3. A text's features are densities of lexicon words and stems, how near they are to a second person, capitals, punctuation
   and obfuscation rates (digits or marks within words, and lexicon words that appear when these are undone).
4. Trees are boosted on the same four fifths, and their margin is made a probability by isotonic regression on the
   last fifth, which neither lexicon nor trees have seen. A small share of the margin's own probability keeps the order within a step of the isotonic curve.

Null and empty texts have all-zero features and get a score like any other. Without labels of both kinds the score is the
share of label 1, or 0. Repeated labels count by their largest value; repeated ids are scored for each row, and of those with a label
each text teaches it. Rows with a null doc_id teach nothing, aren't held out, and are scored. Other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, portions, remainder, utf8

SAMPLE = 20_000
LEXICON = 4_000
STEMS = (4, 5, 6)
FEWEST, LEAST = 4, 2.5
TREES, DEPTH = 30, 4
THRESHOLD = 0.3
TIE_SHARE = 0.02
#: Common insults, and words for a second person.
INSULTS = "bastard clown coward creep disgusting dumb fool garbage idiot idiotic imbecile jerk loser lowlife moron moronic nasty pathetic pig scum scumbag stupid trash ugly useless vermin vile worthless".split()
SECOND = set("you your yours yourself ya u ur du dich dir dein deine ihr euch tu te toi ton ta vous votre usted tú ti vosotros".split())

_WORD = re.compile(r"[^\W_]+")
_SPELT = re.compile(r"(?<![^\W_])[^\W\d_](?:[.\-_*·][^\W\d_]){3,}(?![^\W_])")
_MIXED = re.compile(r"[^\W\d_]+[0-9@$!|*#]+[^\W\d_]+")
_LEET = str.maketrans("013457@$!|", "oieastasil")
FEATURES = "words lexicon strongest distinct near nearest second capitals shouted exclamations questions marks digits mixed undone long_runs".split()


def _grams(text: str) -> set[str]:
    words = set(_WORD.findall(text.lower()))
    return words | {f"{w[:n]}*" for w in words for n in STEMS if len(w) > n}


def learn_lexicon(sample: DataFrame) -> dict[str, float]:
    """word, or stem with *, -> log odds; at most LEXICON of them. sample: (text, toxic)."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = (Counter(), Counter())
        for batch in portions(batches):
            for text, toxic in zip(batch["text"].to_pylist(), batch["toxic"].to_pylist(), strict=True):
                count[toxic].update(_grams(text or ""))
        keys = list(count[0].keys() | count[1].keys())
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), *(pa.array([count[k][g] for g in keys], pa.int64()) for k in (1, 0))], names=["gram", "pos", "neg"])

    totals = sample.agg(F.sum("toxic").alias("pos"), F.sum(1 - F.col("toxic")).alias("neg")).first()
    odds = F.log((F.col("pos") + 0.5) / (totals.pos + 1)) - F.log((F.col("neg") + 0.5) / (totals.neg + 1))
    grams = sample.select("text", "toxic").mapInArrow(counted, "gram string, pos long, neg long").groupBy("gram").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    top = grams.where(F.col("pos") >= FEWEST).withColumn("odds", odds).where(F.col("odds") >= LEAST).orderBy(F.desc(F.col("odds") * F.log1p("pos")), "gram").limit(LEXICON)
    found = {r.gram: round(r.odds, 6) for r in top.collect()}
    return {w: 4.0 for w in INSULTS} | found


class Scorer:
    """Features of texts under a lexicon."""

    def __init__(self, lexicon: dict[str, float]):
        self.words = {w: o for w, o in lexicon.items() if not w.endswith("*")}
        self.stems = {w[:-1]: o for w, o in lexicon.items() if w.endswith("*")}
        self.starts = {w[: STEMS[0]] for w in self.stems}

    def odds(self, word: str) -> float:
        best = self.words.get(word, 0.0)
        if word[: STEMS[0]] in self.starts:
            best = max(best, *(self.stems.get(word[:n], 0.0) if len(word) > n else 0.0 for n in STEMS))
        return best

    def features(self, data: bytes) -> list[float]:
        text = data.decode("utf-8", "replace")
        words = _WORD.findall(text.lower())
        if not words:
            return [0.0] * len(FEATURES)
        known, starts, n = self.words, self.starts, len(words)
        hits = [(k, o) for k, w in enumerate(words) if (w in known or w[:4] in starts) and (o := self.odds(w)) > 0]
        persons = np.array([k for k, w in enumerate(words) if w in SECOND])
        near = nearest = 0.0
        if hits and len(persons):
            at = np.array([k for k, _ in hits])
            p = np.searchsorted(persons, at)
            gap = np.minimum(np.abs(persons[np.minimum(p, len(persons) - 1)] - at), np.abs(at - persons[np.maximum(p - 1, 0)]))
            near, nearest = float((gap <= 5).sum()) / n, 1.0 / (1.0 + float(gap.min()))
        mixed = _MIXED.findall(text)
        spelt = _SPELT.findall(text)
        undone = sum(1 for w in mixed if self.odds(w.lower().translate(_LEET)) > 0) + sum(1 for w in spelt if self.odds(re.sub(r"[\W_]", "", w.lower())) > 0)
        count = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
        size, letters = len(data), max(1, int(count[65:91].sum() + count[97:123].sum()))
        marks = int(count[33:48].sum() + count[58:65].sum() + count[91:97].sum() + count[123:127].sum())
        shouted = sum(map(len, re.findall(r"\b[A-Z]{3,}\b", text))) if count[65:91].sum() * 10 > letters else 0
        return [
            math.log1p(n), len(hits) / n, max((o for _, o in hits), default=0.0), math.log1p(len({words[k] for k, _ in hits})), near, nearest, len(persons) / n,
            count[65:91].sum() / letters, shouted / letters, count[33] / size, count[63] / size, marks / size, count[48:58].sum() / size,
            (len(mixed) + len(spelt)) / n, undone / n, (count[33] + count[42]) / n,
        ]


def with_features(docs: DataFrame, lexicon: dict[str, float]) -> DataFrame:
    """`docs` with `features` array<double> in place of `text`."""
    others = [c for c in docs.columns if c != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(lexicon)
        for batch in portions(batches):
            rows = [scorer.features(data) for data in utf8(batch["text"])]
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in others), pa.array(rows, pa.list_(pa.float64()))], names=[*others, "features"])

    kept = docs.select(*others, "text")
    return kept.mapInArrow(run, kept.drop("text").withColumn("features", F.lit(None).cast("array<double>")).schema)


def predict(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of `docs`."""
    known = labels.where(F.col("toxic").isin(0, 1) & (remainder("doc_id", 4) != 2)).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE)  # at most SAMPLE rows of two numbers: small enough to broadcast
    one = Window.partitionBy("doc_id").orderBy(F.xxhash64("text"), "text")  # of rows with equal ids one is learned from, so that SAMPLE bounds the rows
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").withColumn("place", F.row_number().over(one)).where("place = 1")
    sample = cut(texts.select("doc_id", "text", F.col("toxic").cast("int").alias("toxic"), (F.pmod(F.xxhash64("doc_id", F.lit("fold")), F.lit(5)) == 4).alias("last")))
    rows = docs.select("doc_id", F.coalesce(remainder("doc_id", 4) == 2, F.lit(False)).alias("held_out"), "text")
    total, pos = sample.agg(F.count("*"), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    final = lambda score: ["doc_id", "held_out", score.alias("score"), F.when(score >= THRESHOLD, 1).otherwise(0).alias("predicted")]
    if pos < 2 or total - pos < 2:
        return rows.select(*final(F.lit(pos / total if total else 0.0)))

    learned = sample.where("NOT last")
    if learned.select("toxic").distinct().count() < 2:
        return rows.select(*final(F.lit(pos / total)))
    lexicon = learn_lexicon(learned)
    vector = lambda df: df.withColumn("features", array_to_vector("features"))
    fitted = cut(with_features(sample, lexicon).withColumn("label", F.col("toxic").cast("double")))
    fitted = vector(fitted)
    trees = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=0.2, minInstancesPerNode=5, seed=7).fit(fitted.where("NOT last"))
    margin = vector_to_array("rawPrediction")[1]
    rest = trees.transform(fitted.where("last")).select("label", margin.alias("margin"))
    curve = IsotonicRegression(featuresCol="margin", labelCol="label", predictionCol="calibrated").fit(rest) if rest.select("label").distinct().count() == 2 else None
    scored = trees.transform(vector(with_features(rows, lexicon))).select("doc_id", "held_out", margin.alias("margin"))
    plain = 1 / (1 + F.exp(-2 * F.col("margin")))
    if curve:
        scored = curve.transform(scored)
    score = (1 - TIE_SHARE) * F.col("calibrated") + TIE_SHARE * plain if curve else plain
    return scored.select(*final(F.greatest(F.lit(0.0), F.least(F.lit(1.0), score))))
