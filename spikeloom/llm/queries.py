"""The registered queries of this subpackage, with the settings used in production, and their SQL."""

from __future__ import annotations

from . import alignment, arc, chat, decontaminate, exact_dedup, fingerprint, language_id, near_dedup, negatives, pieces, pii, suffix_dedup, toxicity
from .common import table


def op1_pii(spark, sf_dir):
    return pii.digests(pii.find(table(spark, sf_dir, "documents")))


def op2_suffix_dedup(spark, sf_dir):
    return suffix_dedup.strip_repeats(table(spark, sf_dir, "documents"))


def op3_toxicity(spark, sf_dir):
    return toxicity.predict(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_arc_to_warc(spark, sf_dir):
    return arc.archive(table(spark, sf_dir, "pages"))


def op5_near_dedup(spark, sf_dir):
    return near_dedup.near_groups(table(spark, sf_dir, "documents"))


def op6_decontaminate(spark, sf_dir):
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_exact_dedup(spark, sf_dir):
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


def op8_sentencepiece(spark, sf_dir):
    return pieces.digests(table(spark, sf_dir, "documents"))


def op9_chat_format(spark, sf_dir):
    return chat.digests(chat.format_conversations(chat.with_probe(table(spark, sf_dir, "conversations"))))


def op10_language_id(spark, sf_dir):
    return language_id.predict_languages(table(spark, sf_dir, "documents"))


def op11_token_alignment(spark, sf_dir):
    return alignment.links(table(spark, sf_dir, "documents"))


def op12_hard_negatives(spark, sf_dir):
    return negatives.hard_negatives(table(spark, sf_dir, "embeddings"))


def op13_fingerprint(spark, sf_dir):
    return fingerprint.edited_and_next(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_pii, op2_suffix_dedup, op3_toxicity, op4_arc_to_warc, op5_near_dedup, op6_decontaminate, op7_exact_dedup, op8_sentencepiece, op9_chat_format, op10_language_id, op11_token_alignment, op12_hard_negatives, op13_fingerprint)}
ORACLES = {"op7_exact_dedup": exact_dedup.ORACLE_SQL, "op9_chat_format": chat.ORACLE_SQL, "op12_hard_negatives": negatives.ORACLE_SQL, "op13_fingerprint": fingerprint.ORACLE_SQL}
