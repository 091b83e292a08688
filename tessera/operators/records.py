"""Normalized records: names, addresses and countries in the forms that blocking and matching compare."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions import text as X
from tessera.operators import aliases as A

_LIST = T.ArrayType(T.StringType())
#: The columns of a normalized record as a file holds them, with their types; the first four are the record's own.
SCHEMA = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("entity_id", "business_name", "business_address", "country", "script", "name_norm", "name_core", "name_sorted", "name_compact", "name_translit", "legal_form")]
    + [T.StructField("is_domain", T.BooleanType()), T.StructField("addr_norm", T.StringType()), T.StructField("addr_components", _LIST), T.StructField("addr_numbers", _LIST)]
    + [T.StructField("state_canon", T.StringType()), T.StructField("city_canon", T.StringType())]
)


def normalized(df: DataFrame, aliases: DataFrame | None = None, full: bool = True) -> DataFrame:
    """The records (entity_id, business_name, business_address, country, and any others) with the columns of SCHEMA, name_tokens,
    country_norm and city_count.

    aliases (kind, country, variant, canonical, cnt) name states and cities; without them the last and the last but one
    component of the address stand for themselves. city_count is the count of the alias that gave the city, null where none
    did. full: NFKD of every script and Latin readings of Indic names, by Arrow functions; else Latin letters are folded in
    the JVM and name_translit is name_core, which is the same for Latin text without ligatures and full-width forms. Null
    names and addresses count as empty."""
    name, address, c = F.coalesce("business_name", F.lit("")), F.coalesce("business_address", F.lit("")), F.col("country")
    df = df.withColumns({"_name": X.folded(name, full), "_address": X.folded_address(address, full)})
    df = df.withColumns({"name_norm": X.cleaned(F.col("_name")), "is_domain": X.is_domain(name), "script": X.script(name)})
    core, form = X.legal_form(X.tokens(F.col("name_norm")), c)
    core = F.when(F.col("is_domain"), F.filter(core, lambda x: ~x.isin(X.DOMAIN_TOKENS))).otherwise(core)
    df = df.withColumns({"name_tokens": core, "legal_form": form, "addr_components": X.address_components(F.col("_address"), c)})
    df = df.withColumns({
        "name_core": F.array_join("name_tokens", " "), "name_sorted": F.array_join(F.array_sort("name_tokens"), " "), "name_compact": F.array_join("name_tokens", ""),
        "addr_norm": F.array_join(X.expand_address(X.tokens(X.cleaned(F.col("_address"))), c), " "),
        "addr_numbers": X.address_numbers(address), "country_norm": X.country_norm(c),
        "_state": F.coalesce(F.try_element_at("addr_components", F.lit(-1)), F.lit("")), "_city": F.coalesce(F.try_element_at("addr_components", F.lit(-2)), F.lit("")),
    })
    df = df.withColumn("name_translit", X.transliterated(F.col("name_core"), F.col("script")) if full else F.col("name_core"))
    if aliases is None:
        df = df.withColumns({"state_canon": F.col("_state"), "city_canon": F.col("_city"), "city_count": F.lit(None).cast("bigint")})
    else:
        df = A.canonical(df, aliases, "state", "_state", "state_canon").drop("state_canon_count")
        df = A.canonical(df, aliases, "city", "_city", "city_canon").withColumnRenamed("city_canon_count", "city_count")
    return df.drop("_name", "_address", "_state", "_city")


def write(records: DataFrame, path: str) -> None:
    """Normalized records as Parquet, always with SCHEMA: no rows are still rows of these types."""
    records.select(*[F.col(f.name).cast(f.dataType) for f in SCHEMA]).write.parquet(path)


def read(spark, path: str) -> DataFrame:
    """Records that ``write`` has written, with the columns that follow from the others."""
    df = spark.read.schema(SCHEMA).parquet(path)
    return df.withColumns({"name_tokens": X.tokens(F.col("name_core")), "country_norm": X.country_norm(F.col("country"))})
