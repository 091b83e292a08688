"""What a dataset holds: inventory, structure of the truth, shapes, lengths, words, quality flags."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions import text as X
from tessera.operators.blocking import lowest

#: Fields that stand for nothing, in lower case.
NULLISH = ["null", "<null>", "n/a", "na", "none", "nan", "-", "--", "nil", "#n/a"]
ENTITY = r"^S[123]-[0-9]+$"
#: Accented Latin letters; letters of other scripts; null-like address components; domains in names.
ACCENTED = r"[\x{C0}-\x{24F}\x{1E00}-\x{1EFF}]"
NON_LATIN = r"[^\x{0}-\x{24F}\x{1E00}-\x{1EFF}\x{2000}-\x{206F}\x{20A0}-\x{20CF}\x{2100}-\x{214F}]"
NULL_COMPONENT = r"(?i)(?:^|,)\s*(?:null|<null>|n/a|none|nan)\s*(?=,|$)"
NAME_DOMAIN = r"(?i)\.(?:com|in|net|org|co|fr|io|biz)\b"
QUANTILES = (0.05, 0.25, 0.5, 0.75, 0.95)
COLUMNS = ["entity_id", "business_name", "business_address", "country"]


def share(c: Column) -> Column:
    """The share of rows where it holds, to six places."""
    return F.round(F.avg(c.cast("int")), 6)


def inventory(records: DataFrame) -> DataFrame:
    """A row a source: rows, distinct, repeated, misshapen and foreign ids, rows with a quote; for each column empty and null-like
    fields; countries with their rows, in order."""
    bare = lambda c: F.trim(F.col(c))
    fields = [x for c in COLUMNS for x in (F.count_if(bare(c) == "").alias(f"empty_{c}"), F.count_if(F.lower(bare(c)).isin(NULLISH)).alias(f"null_{c}"))]
    good = F.col("entity_id").rlike(ENTITY)
    n = records.groupBy("source").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(~good).alias("n_bad_id"), F.count_if(good & ~F.col("entity_id").startswith(F.concat("source", F.lit("-")))).alias("n_foreign_id"),
        F.count_if(F.concat_ws("\t", *COLUMNS).contains('"')).alias("n_quoted"), *fields,
    )
    ids = records.groupBy("source", "entity_id").agg(F.count(F.lit(1)).alias("n")).groupBy("source").agg(F.count(F.lit(1)).alias("n_ids"), F.count_if(F.col("n") > 1).alias("n_repeated"))
    countries = records.groupBy("source", "country").agg(F.count(F.lit(1)).alias("n")).groupBy("source")
    countries = countries.agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("country", "n"))), lambda x: F.concat(x["country"], F.lit(":"), x["n"].cast("string"))), ", ").alias("countries"))
    return n.join(ids, "source").join(countries, "source")


def label_structure(s1: DataFrame, truth: DataFrame) -> DataFrame:
    """(country, n, singletons and their share, mean matches, with S2, with S3, shares with only S2, only S3 and both, most, n_ten_up), null
    country for all."""
    by = match_counts(s1, truth)
    mean = lambda c: F.round(F.avg(c), 6)
    n2, n3, n = F.col("n2"), F.col("n3"), F.col("n2") + F.col("n3")
    return by.rollup("country").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(n == 0).alias("singletons"), share(n == 0).alias("singleton_share"), mean(n).alias("mean_matches"), mean(n2).alias("mean_s2"), mean(n3).alias("mean_s3"),
        share((n2 > 0) & (n3 == 0)).alias("only_s2"), share((n3 > 0) & (n2 == 0)).alias("only_s3"), share((n2 > 0) & (n3 > 0)).alias("both"), F.max(n).alias("most"), F.count_if(n >= 10).alias("n_ten_up"),
    )


def match_counts(s1: DataFrame, truth: DataFrame) -> DataFrame:
    """(entity_id, country, n2, n3) of every S1 record: its matches in S2 and in S3."""
    n = truth.groupBy(F.col("s1_id").alias("entity_id")).agg(F.count_if(F.col("target_source") == "S2").alias("n2"), F.count_if(F.col("target_source") == "S3").alias("n3"))
    return s1.select("entity_id", "country").join(n, "entity_id", "left").na.fill(0, ["n2", "n3"])


def match_histogram(s1: DataFrame, truth: DataFrame) -> DataFrame:
    """(country, counted, matches, n): S1 records by their matches, five or more as 5; counted S2+S3, S2 or S3; null country for all."""
    by = match_counts(s1, truth)
    kinds = F.array(*[F.struct(F.lit(k).alias("counted"), F.least(c, F.lit(5)).cast("bigint").alias("matches")) for k, c in (("S2+S3", F.col("n2") + F.col("n3")), ("S2", F.col("n2")), ("S3", F.col("n3")))])
    rows = by.withColumn("k", F.explode(kinds)).select("country", "k.*")
    rows = rows.withColumn("country", F.explode(F.array("country", F.lit(None).cast("string"))))
    return rows.groupBy("country", "counted", "matches").agg(F.count(F.lit(1)).alias("n"))


def multiplicity(rows: DataFrame, *key: str) -> DataFrame:
    """(n_keys, n_multiple, most): distinct keys, those that come more than once, and how often the most frequent does."""
    n = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
    return n.agg(F.count(F.lit(1)).alias("n_keys"), F.count_if(F.col("n") > 1).alias("n_multiple"), F.max("n").alias("most"))


def unmatched(records: DataFrame, truth: DataFrame) -> DataFrame:
    """(source, country, n, n_unmatched, share) of the target records."""
    t = truth.select(F.col("target_id").alias("entity_id"), F.lit(1).alias("hit")).distinct()
    rows = records.filter("source <> 'S1'").join(t, "entity_id", "left")
    alone = F.col("hit").isNull()
    return rows.groupBy("source", "country").agg(F.count(F.lit(1)).alias("n"), F.count_if(alone).alias("n_unmatched"), share(alone).alias("share"))


def integrity(records: DataFrame, truth: DataFrame) -> DataFrame:
    """(check, n): ids of the truth that no source has, S1 records that the truth leaves out, and numbers that two sources share."""
    ids = records.select("entity_id", "source")
    s1, other = ids.filter("source = 'S1'"), ids.filter("source <> 'S1'")
    number = lambda s: ids.filter(F.col("source") == s).select(X.entity_number(F.col("entity_id")).alias("number")).distinct()
    checks = [
        ("truth S1 ids not in S1", truth.select(F.col("s1_id").alias("entity_id")).distinct().join(s1, "entity_id", "left_anti")),
        ("S1 ids not in truth", s1.join(truth.select(F.col("s1_id").alias("entity_id")), "entity_id", "left_anti")),
        ("truth target ids not in S2 or S3", truth.select(F.col("target_id").alias("entity_id")).distinct().join(other, "entity_id", "left_anti")),
        ("S2 numbers that S3 has", number("S2").join(number("S3"), "number", "left_semi")),
    ]
    out = None
    for name, df in checks:
        row = df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("check"), "n")
        out = row if out is None else out.unionByName(row)
    return out


def country_crosstab(records: DataFrame, truth: DataFrame) -> DataFrame:
    """(c1, c2, n): true pairs by the countries of their two sides."""
    side = lambda key, name: records.select(F.col("entity_id").alias(key), F.col("country").alias(name))
    both = truth.select("s1_id", "target_id").join(side("s1_id", "c1"), "s1_id").join(side("target_id", "c2"), "target_id")
    return both.groupBy("c1", "c2").agg(F.count(F.lit(1)).alias("n"))


def source_shape(records: DataFrame) -> DataFrame:
    """(country, n1, n2, n3, share of each source's rows, ratios to S1), country 'all' for all."""
    count = lambda s: F.count_if(F.col("source") == s)
    by = records.groupBy("country").agg(count("S1").alias("n1"), count("S2").alias("n2"), count("S3").alias("n3"))
    every = by.agg(*[F.sum(c).alias(c) for c in ("n1", "n2", "n3")]).select(F.lit("all").alias("country"), "n1", "n2", "n3")
    total = every.select(*[F.col(c).alias("t" + c[1]) for c in ("n1", "n2", "n3")])
    rows = by.unionByName(every).join(F.broadcast(total))  # one row
    part = lambda a, b: F.round(F.try_divide(F.col(a), F.col(b)), 6)
    return rows.select(
        "country", "n1", "n2", "n3", *[part(f"n{i}", f"t{i}").alias(f"share{i}") for i in (1, 2, 3)],
        part("n2", "n1").alias("ratio2"), part("n3", "n1").alias("ratio3"), F.round(F.try_divide(F.col("n2") + F.col("n3"), F.col("n1")), 6).alias("ratio23"),
    )


def length_percentiles(rows: DataFrame, column: str, *by: str) -> DataFrame:
    """(by..., n, mean_len, p5 to p95, max_len) of a column's lengths in characters; exact."""
    n = F.length(F.coalesce(column, F.lit("")))
    p = F.percentile(n, F.array(*[F.lit(x) for x in QUANTILES]))
    by_group = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.round(F.avg(n), 6).alias("mean_len"), p.alias("p"), F.max(n).cast("bigint").alias("max_len"))
    return by_group.select(*by, "n", "mean_len", *[F.round(F.col("p")[i], 6).alias(f"p{int(q * 100)}") for i, q in enumerate(QUANTILES)], "max_len")


def top_tokens(rows: DataFrame, tokens: str, by: str, k: int) -> DataFrame:
    """(by, token, n, share, rank): the k most frequent tokens and their shares of all tokens; totals come from the counts, and tasks cut
    their own lists first."""
    n = rows.select(by, F.explode(tokens).alias("token")).groupBy(by, "token").agg(F.count(F.lit(1)).alias("n"))
    total = n.groupBy(by).agg(F.sum("n").alias("total"))
    order = [F.desc("n"), F.col("token")]
    top = lowest(n, k, [by], order).join(total, by).withColumn("share", F.round(F.col("n") / F.col("total"), 6))
    return top.withColumn("rank", F.row_number().over(Window.partitionBy(by).orderBy(*order))).select(by, "token", "n", "share", "rank")


def quality_flags(records: DataFrame) -> DataFrame:
    """Records with flags of name (non_ascii, accented, non_latin, domain, all_upper) and address (the first three, null_part, postcode)."""
    name, address = F.coalesce("business_name", F.lit("")), F.coalesce("business_address", F.lit(""))
    flags = {}
    for p, c in (("name", name), ("addr", address)):
        flags |= {f"{p}_non_ascii": c.rlike(r"[^\x00-\x7F]"), f"{p}_accented": c.rlike(ACCENTED), f"{p}_non_latin": c.rlike(NON_LATIN)}
    flags |= {"addr_null_part": address.rlike(NULL_COMPONENT), "addr_postcode": X.postcode(address, F.col("country")).isNotNull(), "name_domain": name.rlike(NAME_DOMAIN)}
    flags |= {"name_all_upper": (F.upper(name) == name) & (F.lower(name) != name)}
    return records.withColumns(flags)


FLAGS = ["name_non_ascii", "name_accented", "name_non_latin", "addr_non_ascii", "addr_accented", "addr_non_latin", "addr_null_part", "addr_postcode", "name_domain", "name_all_upper"]


def flag_rates(records: DataFrame) -> DataFrame:
    """(source, country, n, a share a flag)."""
    return quality_flags(records).groupBy("source", "country").agg(F.count(F.lit(1)).alias("n"), *[share(F.col(c)).alias(c) for c in FLAGS])


def hardest_pairs(pairs: DataFrame, records: DataFrame, k: int = 5, seed: str = "42") -> DataFrame:
    """(country, s1_id, target_id, name_jaccard): of each country the k pairs with the least alike names, ties by hash."""
    from tessera.functions import similarity as S
    from tessera.operators.features import beside

    both = beside(pairs.select("s1_id", "target_id"), records.withColumn("_words", X.tokens(F.col("name_norm"))), ["_words", "country"])
    j = F.round(S.jaccard(F.col("a__words"), F.col("b__words"), 1.0), 9).alias("name_jaccard")
    rows = both.select(F.col("b_country").alias("country"), "s1_id", "target_id", j)
    return lowest(rows, k, ["country"], ["name_jaccard", F.md5(F.concat("s1_id", "target_id", F.lit(seed)).cast("binary")), "s1_id", "target_id"])


def duplicates(rows: DataFrame, key: str) -> DataFrame:
    """(key, n) of keys that come more than once."""
    return rows.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
