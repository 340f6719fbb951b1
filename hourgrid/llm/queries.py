"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

import corpus_pipeline
from hourgrid.llm import chat, decontaminate, interpolated, mixing, neardup, oracle, prefixtrie, quality, resample, substring, suffix, templates, tokenfile, warc
from hourgrid.llm.frames import query

QUERIES = [
    warc.op1_warc_archive,
    templates.op2_line_templates,
    mixing.op3_mix_sources,
    substring.op4_remove_repeated_windows,
    chat.op5_chat_format,
    neardup.op6_near_duplicates,
    decontaminate.op7_decontaminate,
    interpolated.op8_interpolated_scores,
    suffix.op9_remove_repeated_bytes,
    quality.op10_quality_rules,
    tokenfile.op11_token_ids,
    prefixtrie.op12_prefix_trie,
    resample.op13_importance_resample,
]


def queries() -> dict:
    return {f.__name__: query(f) for f in QUERIES} | {"pipeline": query(corpus_pipeline.run)}


def oracle_sql() -> dict[str, str]:
    return dict(oracle.SQL)
