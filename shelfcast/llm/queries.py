"""The operators as queries over the driver's tables, and their SQL where it can express them."""
from __future__ import annotations

from shelfcast.llm import (
    chat_format, decontam, exact_dedup, jaccard_join, mixing, ppm_langid, quality_crf, secret_scan, sharding,
    simplex_cluster, toxicity, url_filter, whitening,
)
from shelfcast.llm.common import table

QUERIES = {
    "op1_ngram_jaccard": lambda spark, sf: jaccard_join.join_documents(table(spark, sf, "documents")),
    "op2_quality_crf": lambda spark, sf: quality_crf.classify(table(spark, sf, "documents"), table(spark, sf, "labels")),
    "op3_chat_rotation": lambda spark, sf: chat_format.rotate(table(spark, sf, "conversations")),
    "op4_rendezvous_shards": lambda spark, sf: sharding.shard_documents(table(spark, sf, "documents")),
    "op5_source_mix": lambda spark, sf: mixing.mix_documents(table(spark, sf, "documents")),
    "op6_secret_ownership": lambda spark, sf: secret_scan.find_secrets(table(spark, sf, "documents")),
    "op7_url_filter": lambda spark, sf: url_filter.filter_urls(table(spark, sf, "pages")),
    "op8_ppm_language": lambda spark, sf: ppm_langid.identify(table(spark, sf, "documents")),
    "op9_bm25_decontam": lambda spark, sf: decontam.contaminated(table(spark, sf, "documents"), table(spark, sf, "benchmark")),
    "op10_content_sort_dedup": lambda spark, sf: exact_dedup.exact_dedup(table(spark, sf, "documents")),
    "op11_simplex_clusters": lambda spark, sf: simplex_cluster.cluster_vectors(table(spark, sf, "embeddings")),
    "op12_cholesky_whitening": lambda spark, sf: whitening.whiten_vectors(table(spark, sf, "embeddings")),
    "op13_viterbi_toxicity": lambda spark, sf: toxicity.score_documents(
        table(spark, sf, "documents"), table(spark, sf, "labels")),
}

ORACLES = {
    "op1_ngram_jaccard": jaccard_join.ORACLE,
    "op3_chat_rotation": chat_format.ORACLE,
    "op5_source_mix": mixing.ORACLE,
    "op10_content_sort_dedup": exact_dedup.ORACLE,
    "op11_simplex_clusters": simplex_cluster.ORACLE,
}
