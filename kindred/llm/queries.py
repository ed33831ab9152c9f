"""The registered queries: each operator over its whole table with the parameters it is meant for."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from kindred.llm import classifier, contexts, jaccard, licenses, lloyd, packing, pieces, rules, substring, suffixes, topk, trie, urls
from kindred.llm.tables import table


def op1_best_fit_packing(spark, sf_dir):
    path = public_tokenizers.path("byte_bpe_50k.json")
    return packing.pack_documents(table(spark, sf_dir, "documents"), path, want_ids=False, added=True)


def op2_substring_dedup(spark, sf_dir):
    return substring.drop_repeats(table(spark, sf_dir, "documents"), kept_text=False)


def op3_url_filters(spark, sf_dir):
    return urls.judge(table(spark, sf_dir, "pages"))


def op4_jaccard_join(spark, sf_dir):
    found = jaccard.join(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "class_id", "n_links")


def op5_license_scan(spark, sf_dir):
    return licenses.scan(table(spark, sf_dir, "documents"), spans=False)


def op6_quality_rules(spark, sf_dir):
    return rules.apply_rules(table(spark, sf_dir, "documents"), kept_text=False)


def op7_topk_search(spark, sf_dir):
    return topk.search(table(spark, sf_dir, "embeddings"))


def op8_quality_classifier(spark, sf_dir):
    found = classifier.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.select("doc_id", "evidence", "site_share", "p_good", "kept")


def op9_sentencepiece(spark, sf_dir):
    return pieces.encode(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"), want_ids=False)


def op10_suffix_array_dedup(spark, sf_dir):
    return suffixes.drop_repeats(table(spark, sf_dir, "documents"), kept_bytes=False)


def op11_language_model(spark, sf_dir):
    return contexts.score(table(spark, sf_dir, "documents"))


def op12_vector_codes(spark, sf_dir):
    rows, codebooks = lloyd.compress(table(spark, sf_dir, "embeddings"))
    code, digest = F.lower(F.hex("code")).alias("code"), F.lit(lloyd.digest(codebooks)).alias("codebooks_sha256")
    return lloyd.label_errors(rows).select("vec_id", code, "error", "label_error", digest)


def op13_prefix_trie(spark, sf_dir):
    nodes, ends, _ = trie.prefix_trie(table(spark, sf_dir, "conversations"))
    digest = F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256")
    return nodes.join(trie.ends_digest(ends), trie.NODE, "left").drop("x", "y").withColumn("ends_sha256", digest)


QUERIES = {f.__name__: f for f in list(globals().values()) if getattr(f, "__name__", "").startswith("op")}
