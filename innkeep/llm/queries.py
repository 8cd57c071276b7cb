"""The registered queries of the operators; each covers its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from innkeep.llm import bpe, html, idfile, merkle, packing, pieces, quality, resample, simhash, sql, tokens, topk, toxicity, vectors
from innkeep.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def query(f: Query) -> Query:
    _QUERIES[f.__name__] = f
    return f


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)


BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


@query
def op1_token_counts(spark, sf_dir):
    return tokens.token_counts(table(spark, sf_dir, "documents"), PIECES)


@query
def op2_packing(spark, sf_dir):
    return packing.pack_documents(table(spark, sf_dir, "documents"), BYTE_BPE, end_id=2)


@query
def op3_quality(spark, sf_dir):
    return quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op4_token_ids(spark, sf_dir):
    return idfile.token_id_output(table(spark, sf_dir, "documents"), WORD_BPE, end_id=1)


@query
def op5_vectors(spark, sf_dir):
    return vectors.near_duplicates(table(spark, sf_dir, "embeddings"))


@query
def op6_bpe(spark, sf_dir):
    return bpe.encode_decode(table(spark, sf_dir, "documents"), BYTE_BPE)


@query
def op7_simhash(spark, sf_dir):
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op8_html(spark, sf_dir):
    return html.extract(table(spark, sf_dir, "pages"))


@query
def op9_toxicity(spark, sf_dir):
    return toxicity.score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op10_topk(spark, sf_dir):
    return topk.top_k(table(spark, sf_dir, "embeddings"), every=100)


@query
def op11_merkle(spark, sf_dir):
    return merkle.manifest(table(spark, sf_dir, "documents"))


@query
def op12_pieces(spark, sf_dir):
    return pieces.round_trip(table(spark, sf_dir, "documents"), PIECES)


@query
def op13_resample(spark, sf_dir):
    return resample.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


# SQL twins, where SQL can express the operator. The others hash with XXH64, encode,
# decode, learn or search; tests/llm holds brute-force versions.
ORACLE_SQL: dict[str, str] = {
    "op5_vectors": sql.NEAR_VECTORS, "op10_topk": sql.TOP_K, "op11_merkle": sql.MERKLE, "op13_resample": sql.RESAMPLE,
}
