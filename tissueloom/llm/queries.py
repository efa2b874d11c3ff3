"""Registered queries of the text operators, applied to whole tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import functions as F

from tissueloom.llm import alignment, bpe, language, lexical, lines, mtree, packing, pages, pii, quality, sketch, toxicity, urls
from tissueloom.llm.common import table
from tissueloom.llm.oracles import LINES_SQL, NEAR_SQL, QUALITY_SQL, RANK_SQL, TOP_SQL, URL_RULES, URLS_SQL

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def add(run):
        QUERIES[name] = run
        if oracle:
            ORACLES[name] = oracle
        return run

    return add


@query("op1_toxicity_chain")
def op1(spark, sf_dir):
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op2_pii_semi_markov")
def op2(spark, sf_dir):
    return pii.find(table(spark, sf_dir, "documents"))


@query("op3_language_id")
def op3(spark, sf_dir):
    return language.identify(table(spark, sf_dir, "documents"))


@query("op4_quality_rules", QUALITY_SQL)
def op4(spark, sf_dir):
    return quality.judge(table(spark, sf_dir, "documents"))


@query("op5_mtree_top_k", TOP_SQL)
def op5(spark, sf_dir):
    return mtree.top_k(table(spark, sf_dir, "embeddings"))


@query("op6_minhash_near_dedup", NEAR_SQL)
def op6(spark, sf_dir):
    return sketch.linked_components(table(spark, sf_dir, "documents"), percent=85)


@query("op7_line_dedup", LINES_SQL)
def op7(spark, sf_dir):
    done = lines.dedup_lines(table(spark, sf_dir, "documents"))
    return done.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


@query("op8_style_tree_text")
def op8(spark, sf_dir):
    return pages.main_text(table(spark, sf_dir, "pages"))


@query("op9_best_fit_packing")
def op9(spark, sf_dir):
    path = public_tokenizers.path("word_bpe_49k.json")
    return packing.pack_documents(table(spark, sf_dir, "documents"), path)


@query("op10_byte_bpe")
def op10(spark, sf_dir):
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.encode_documents(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)


@query("op11_url_filter", URLS_SQL)
def op11(spark, sf_dir):
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return urls.judge(table(spark, sf_dir, "pages"), rules)


@query("op12_token_alignment")
def op12(spark, sf_dir):
    sides = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    return alignment.align(table(spark, sf_dir, "documents"), *sides)


@query("op13_norm_bucket_search", RANK_SQL)
def op13(spark, sf_dir):
    return lexical.rank(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES["pipeline"] = corpus_pipeline.run
if corpus_pipeline.ORACLE_SQL:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
