"""The queries of the training-data operators, and the SQL of those that SQL can express."""

from __future__ import annotations

from . import decontaminate, exactdedup, licenses, mixing, ngramjoin, secrets, tokencount, tokenids, toxicity, warc

_ALL = {
    "op2_exact_dedup": exactdedup,
    "op3_source_mix": mixing,
    "op7_token_ids": tokenids,
    "op1_token_counts": tokencount,
    "op6_decontaminate": decontaminate,
    "op9_license_scan": licenses,
    "op5_warc": warc,
    "op10_ngram_join": ngramjoin,
    "op8_toxicity": toxicity,
    "op4_secret_scan": secrets,
}


def queries() -> dict:
    import corpus_pipeline

    return {name: module.query for name, module in _ALL.items()} | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    import corpus_pipeline

    found = {name: module.ORACLE for name, module in _ALL.items() if getattr(module, "ORACLE", None)}
    return found | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})
