"""One query for each operator, over its whole table, with its DuckDB SQL where there is one."""

from __future__ import annotations

from layerflow.llm import best_fit, exact_dedup, license_scan, merkle, partenum_join, pii, quality_rules, rlz_dedup, sp_codec, suffix_dedup, toxicity, url_filter, zfast_trie
from layerflow.llm.common import table

QUERIES: dict = {}
ORACLES: dict = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn
    return deco


@register("op1_toxicity")
def op1(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


@register("op2_exact_dedup", exact_dedup.SQL)
def op2(spark, sf_dir):
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents")).drop("text_hash")


@register("op3_ngram_jaccard")
def op3(spark, sf_dir):
    return partenum_join.similar_components(table(spark, sf_dir, "documents"), words=3, percent=90).drop("text_hash")


@register("op4_quality_rules", quality_rules.SQL)
def op4(spark, sf_dir):
    return quality_rules.quality_signals(table(spark, sf_dir, "documents"))


@register("op5_url_filter", url_filter.SQL)
def op5(spark, sf_dir):
    return url_filter.judge(table(spark, sf_dir, "pages")).drop("globs")


@register("op6_best_fit")
def op6(spark, sf_dir):
    return best_fit.best_fit(table(spark, sf_dir, "documents"))


@register("op7_pii_pseudonyms")
def op7(spark, sf_dir):
    return pii.pseudonymise(table(spark, sf_dir, "documents"), found="n_found").select("doc_id", "text", "n_found")


@register("op8_suffix_dedup")
def op8(spark, sf_dir):
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"), keep_bytes=False)


@register("op9_license_scan")
def op9(spark, sf_dir):
    return license_scan.scan(table(spark, sf_dir, "documents"))


@register("op10_sentencepiece")
def op10(spark, sf_dir):
    import public_tokenizers

    return sp_codec.digests(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@register("op11_merkle_manifest", merkle.SQL)
def op11(spark, sf_dir):
    return merkle.manifest(table(spark, sf_dir, "documents"))


@register("op12_substring_dedup", rlz_dedup.SQL)
def op12(spark, sf_dir):
    return rlz_dedup.remove_passages(table(spark, sf_dir, "documents")).drop("n_factors")


@register("op13_prefix_trie", zfast_trie.SQL)
def op13(spark, sf_dir):
    return zfast_trie.prefix_trie(table(spark, sf_dir, "conversations"))
