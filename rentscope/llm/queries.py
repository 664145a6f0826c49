"""Queries of the training-data operators: name -> (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

import functools
import os
from pathlib import Path

from rentscope.llm import (bbit_minhash, chat_prefix, chunk_bpe, cross_tokens, decontaminate, licences, pfor, pii_boost,
                           quality, secret_links, token_transducer, tree_negatives, zip_warc)


def _public(name: str) -> str:
    """Place of a public tokenizer file; the operators take any path."""
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_pfor_token_files(spark, sf_dir):
    return pfor.query(spark, sf_dir, _public("byte_bpe_50k.json"))


def op2_secret_links(spark, sf_dir):
    return secret_links.query(spark, sf_dir)


def op3_chat_prefix_targets(spark, sf_dir):
    return chat_prefix.query(spark, sf_dir)


def op4_rare_seed_alignment(spark, sf_dir):
    return decontaminate.query(spark, sf_dir)


def op5_bbit_minhash(spark, sf_dir):
    return bbit_minhash.query(spark, sf_dir)


def op6_zip_warc(spark, sf_dir):
    return zip_warc.query(spark, sf_dir)


def op7_risk_controlled_quality(spark, sf_dir):
    return quality.query(spark, sf_dir)


def op8_chunk_reuse_bpe(spark, sf_dir):
    return chunk_bpe.query(spark, sf_dir, _public("byte_bpe_50k.json"))


def op9_transducer_token_counts(spark, sf_dir):
    return token_transducer.query(spark, sf_dir, _public("piece_bpe_32k.model"))


def op10_pii_boosting(spark, sf_dir):
    return pii_boost.query(spark, sf_dir)


def op11_identity_map_alignment(spark, sf_dir):
    return cross_tokens.query(spark, sf_dir, _public("byte_bpe_50k.json"), _public("piece_bpe_32k.model"))


def op12_licence_index(spark, sf_dir):
    return licences.query(spark, sf_dir)


def op13_tree_bound_negatives(spark, sf_dir):
    return tree_negatives.query(spark, sf_dir)


def _with_package(query):
    """Workers started in another folder find the package too."""
    @functools.wraps(query)
    def run(spark, sf_dir):
        workers = spark.sparkContext.environment
        root = str(Path(__file__).resolve().parents[2])
        if root not in workers.get("PYTHONPATH", "").split(os.pathsep):
            workers["PYTHONPATH"] = os.pathsep.join(filter(None, [root, workers.get("PYTHONPATH")]))
        return query(spark, sf_dir)
    return run


QUERIES = {f.__name__: _with_package(f) for f in (
    op1_pfor_token_files, op2_secret_links, op3_chat_prefix_targets, op4_rare_seed_alignment, op5_bbit_minhash,
    op6_zip_warc, op7_risk_controlled_quality, op8_chunk_reuse_bpe, op9_transducer_token_counts, op10_pii_boosting,
    op11_identity_map_alignment, op12_licence_index, op13_tree_bound_negatives)}
ORACLE: dict[str, str] = {
    "op3_chat_prefix_targets": chat_prefix.oracle(),
    "op5_bbit_minhash": bbit_minhash.oracle(),
    "op6_zip_warc": zip_warc.oracle(),
    "op7_risk_controlled_quality": quality.oracle(),
    "op12_licence_index": licences.oracle(),
    "op13_tree_bound_negatives": tree_negatives.oracle(),
}
