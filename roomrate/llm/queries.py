"""Registered queries of this subpackage: each applies one operator, with
production parameters, to its whole table. ``ORACLE`` has DuckDB SQL where
SQL can state the result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F

from roomrate.llm import (alignment, ann, bpe, decontam, langid, licenses, lines, minhash, oracle, pii, tokens, toxicity,
                          urls, whitening)
from roomrate.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


def bpe_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@query
def op3_bpe_round_trip(spark, sf_dir):
    """Every document encoded and decoded again."""
    return bpe.round_trip(table(spark, sf_dir, "documents"), bpe_vocabulary())


@query
def op7_toxicity(spark, sf_dir):
    """Toxicity scores; labels of one fold in five are held out."""
    docs = table(spark, sf_dir, "documents")
    out = langid.held_out("doc_id", 5, 0)
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), ~out)
    scored = toxicity.score(docs, model)
    return scored.select("doc_id", out.alias("held_out"), "score", "predicted")


@query
def op8_decontamination(spark, sf_dir):
    """Benchmark windows of 10 words in documents."""
    found = decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), "contaminated")


@query
def op9_language(spark, sf_dir):
    """Language of each document; one fold in four is held out of training."""
    docs = table(spark, sf_dir, "documents")
    out = langid.held_out("doc_id", 4, 2)
    scored = langid.predict(docs, langid.fit(docs, ~out))
    return scored.select("doc_id", out.alias("held_out"), "lang_pred", "score",
                         "cross_entropy", "rejected")


@query
def op10_minhash(spark, sf_dir):
    """Near-duplicate groups of documents: 3-word shingles, Jaccard 0.85."""
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, percent=85, rows=6, bands=32)


@query
def op1_personal_data(spark, sf_dir):
    """Personal data in documents."""
    return pii.digest(pii.find(table(spark, sf_dir, "documents")))


@query
def op6_line_dedup(spark, sf_dir):
    """Fuzzy duplicate lines of documents: line numbers that go."""
    return lines.line_report(table(spark, sf_dir, "documents"))


@query
def op2_section_tokens(spark, sf_dir):
    """Tokens of every line of every document, from whole-document encodings."""
    return tokens.section_tokens(table(spark, sf_dir, "documents"), bpe_vocabulary())


@query
def op4_license_scan(spark, sf_dir):
    """License notices in documents."""
    found = licenses.scan(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.size("matches").alias("n_matches"),
                        F.array_join(F.transform("matches", lambda m: F.concat_ws(
                            ":", m["template"], m["first_word"], m["end_word"])), ",").alias("matches"))


@query
def op5_nearest(spark, sf_dir):
    """The 20 nearest vectors of every twentieth vector."""
    return ann.nearest(table(spark, sf_dir, "embeddings"), lambda i: i % 20 == 0, k=20)


#: Rules of the registered URL filter.
URL_RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"),
             ("allow", "com/fr/"), ("block", "com/de/")]


@query
def op11_url_filter(spark, sf_dir):
    """Verdicts on page urls: rules, and blocks propagated to aliases."""
    judged = urls.judge(table(spark, sf_dir, "pages"), urls.rule_table(spark, URL_RULES))
    return judged.select("page_id", "host", "path", "rule", "verdict")


@query
def op12_whitening(spark, sf_dir):
    """Whitened embeddings, eight components."""
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


@query
def op13_token_alignment(spark, sf_dir):
    """Alignment of a byte-level BPE and a piece tokenizer on documents."""
    import public_tokenizers

    return alignment.align(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                           public_tokenizers.path("piece_bpe_32k.model"))


ORACLE["op8_decontamination"] = oracle.decontamination(10)
ORACLE["op10_minhash"] = oracle.near_duplicates(3, 85)
ORACLE["op11_url_filter"] = oracle.url_filter(URL_RULES)
