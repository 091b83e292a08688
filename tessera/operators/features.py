"""Features of candidate pairs: set measures in the JVM, edit-based ratios by one Arrow function."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions import similarity as S
from tessera.operators.aliases import trusted_city

#: The columns that a model learns from, in order.
FEATURES = [
    "name_core_exact", "name_core_ratio", "name_core_partial", "name_core_token_set", "name_core_token_sort",
    "name_sorted_ratio", "name_compact_exact", "name_compact_ratio", "name_best_ratio",
    "address_exact", "address_ratio", "address_partial", "address_component_jaccard", "addr_number_overlap",
    "state_match", "city_match", "legal_form_match", "country_match", "name_len_diff", "address_len_diff", "combined_ratio",
]
#: Those that need no string distance, and the overlap of name tokens, which the fixed score uses.
SET_FEATURES = [
    "name_core_exact", "name_compact_exact", "address_exact", "address_component_jaccard", "addr_number_overlap", "state_match",
    "city_match", "legal_form_match", "country_match", "name_len_diff", "address_len_diff", "name_jaccard",
]
#: What features need of a record.
COLUMNS = [
    "name_core", "name_sorted", "name_compact", "name_translit", "name_tokens", "addr_norm", "addr_numbers", "addr_components",
    "state_canon", "city_canon", "city_count", "legal_form", "country_norm", "script",
]


def beside(pairs: DataFrame, records: DataFrame, columns: list[str], targets: DataFrame | None = None) -> DataFrame:
    """The pairs with both records' columns, a_ before those of the S1 record, b_ before those of the target. targets: where these are not
    among records."""
    side = lambda df, p, key: df.select(F.col("entity_id").alias(key), *[F.col(c).alias(p + c) for c in columns])
    return pairs.join(side(records, "a_", "s1_id"), "s1_id").join(side(records if targets is None else targets, "b_", "target_id"), "target_id")


def _sets() -> dict:
    a, b = (lambda c: F.col("a_" + c)), (lambda c: F.col("b_" + c))
    city = lambda p: trusted_city(F.col(p + "city_canon"), F.col(p + "addr_components"), F.col(p + "city_count"))
    apart = lambda c: F.abs(F.length(a(c)) - F.length(b(c)))
    return {
        "name_core_exact": S.same(a("name_core"), b("name_core")), "name_compact_exact": S.same(a("name_compact"), b("name_compact")), "address_exact": S.same(a("addr_norm"), b("addr_norm")),
        "address_component_jaccard": S.jaccard(a("addr_components"), b("addr_components")), "addr_number_overlap": S.overlap(a("addr_numbers"), b("addr_numbers")),
        "state_match": S.same(a("state_canon"), b("state_canon")), "city_match": S.same(city("a_"), city("b_")), "legal_form_match": S.same(a("legal_form"), b("legal_form")),
        "country_match": (a("country_norm") == b("country_norm")).cast("int"), "name_len_diff": apart("name_core"), "address_len_diff": apart("addr_norm"),
        "name_jaccard": S.jaccard(a("name_tokens"), b("name_tokens")),
    }


def set_features(pairs: DataFrame, records: DataFrame) -> DataFrame:
    """The pairs with SET_FEATURES."""
    sets = _sets()
    return beside(pairs, records, COLUMNS).select(*pairs.columns, *[sets[c].alias(c) for c in SET_FEATURES])


def features(pairs: DataFrame, records: DataFrame, targets: DataFrame | None = None) -> DataFrame:
    """The pairs with FEATURES and name_jaccard, both sides fetched once; targets as in ``beside``.

    name_best_ratio: where a side isn't latin, the better of the ratios of the names as written and of those in Latin letters."""
    both = beside(pairs, records, COLUMNS, targets)
    joined = lambda p: F.trim(F.concat_ws(" ", p + "name_core", p + "addr_norm"))
    other = (F.col("a_script") != "latin") | (F.col("b_script") != "latin")
    latin = [F.when(other, F.col(p + "name_translit")) for p in ("a_", "b_")]
    texts = [F.col(p + c) for c in ("name_core", "name_sorted", "name_compact", "addr_norm") for p in ("a_", "b_")]
    both = both.withColumn("_r", S.ratios(*texts, joined("a_"), joined("b_"), *latin))
    r = lambda c: F.col(f"_r.{c}")
    edits = {c: r(c) for c in S.RATIOS if c != "latin_ratio"}
    edits["name_best_ratio"] = F.greatest(r("name_core_ratio"), F.coalesce(r("latin_ratio"), F.lit(0.0)))
    every = _sets() | edits
    return both.select(*pairs.columns, *[every[c].alias(c) for c in [*FEATURES, "name_jaccard"]])
