"""Registered queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

from labelfold.llm.ann_collisions import nearest
from labelfold.llm.decontam import DECONTAM_SQL, decontaminate
from labelfold.llm.exact_dedup import EXACT_DEDUP_SQL, exact_dedup
from labelfold.llm.filter_audit import FILTER_AUDIT_SQL, audit_filters
from labelfold.llm.html_mincut import extract_text
from labelfold.llm.mixing import mix_sources
from labelfold.llm.ngram_join import NGRAM_JOIN_SQL, ngram_join
from labelfold.llm.pii import pii_digest
from labelfold.llm.pu_quality import score_quality
from labelfold.llm.ranked_search import RANKED_SEARCH_SQL, ranked_search
from labelfold.llm.token_counts import count_tokens
from labelfold.llm.url_filter import URL_FILTER_SQL, filter_urls
from labelfold.llm.warc import WARC_SQL, warc_round_trip
from labelfold.session import read_table as read

QUERIES = {
    "op1_pii": lambda spark, d: pii_digest(read(spark, d, "documents")),
    "op2_decontamination": lambda spark, d: decontaminate(read(spark, d, "documents"), read(spark, d, "benchmark")),
    "op3_token_counts": lambda spark, d: count_tokens(read(spark, d, "documents")),
    "op4_quality": lambda spark, d: score_quality(read(spark, d, "documents"), read(spark, d, "labels")),
    "op5_ngram_join": lambda spark, d: ngram_join(read(spark, d, "documents")),
    "op6_exact_dedup": lambda spark, d: exact_dedup(read(spark, d, "documents")),
    "op7_warc": lambda spark, d: warc_round_trip(read(spark, d, "pages")),
    "op8_mixing": lambda spark, d: mix_sources(read(spark, d, "documents")),
    "op9_url_filter": lambda spark, d: filter_urls(read(spark, d, "pages")),
    "op10_html_text": lambda spark, d: extract_text(read(spark, d, "pages")),
    "op11_nearest": lambda spark, d: nearest(read(spark, d, "embeddings")),
    "op12_ranked_search": lambda spark, d: ranked_search(read(spark, d, "documents"), read(spark, d, "benchmark")),
    "op13_filter_audit": lambda spark, d: audit_filters(read(spark, d, "documents"), read(spark, d, "labels")),
}

ORACLE = {
    "op2_decontamination": DECONTAM_SQL,
    "op5_ngram_join": NGRAM_JOIN_SQL,
    "op6_exact_dedup": EXACT_DEDUP_SQL,
    "op7_warc": WARC_SQL,
    "op9_url_filter": URL_FILTER_SQL,
    "op12_ranked_search": RANKED_SEARCH_SQL,
    "op13_filter_audit": FILTER_AUDIT_SQL,
}
