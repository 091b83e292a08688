"""Mixing sources to target weights, in DataFrame operations only.

Sources, by code point with null last, weigh 5, 2, 1, repeating, and share the words of all documents; a target stops
at three times its source's words and the excess goes to the others by weight until none is above. In closed form:
sources in the order of their cap divided by their weight are capped as long as the level of the
others (what is left of the total, divided by their weights) stands above that ratio.

Each document gets a random key, the MD5 of its id, a seed and its text's MD5, so only rows with equal id and text share a key;
these are counted before any shuffle and stand as one entry. Within a source the keys are cut into ranges of about
RANGE documents, each range is sorted, and the words before an entry are the sum of the earlier blocks of BLOCK ranges, of
the earlier ranges of its block and of the earlier entries of its range: no task holds a source, however large. A source takes
every document as often as its whole words fit into the target, and once more those documents whose middle lies before the
rest of the budget: so the words taken differ from the target by half a document at most, whole documents are taken, and none
more than three times. The last entry to be taken once more is the source's cut; whether a row is taken once more shows
in the row and the cut alone, so no text is joined or shuffled. The targets are computed in one task, a row a source: sources
must be few enough to be listed (a million take some 100 MB).

Null texts have no words. Documents without words are taken only with whole epochs. Rows with equal id and text
are separate rows; where only some of them fit, any are taken. A null id is keyed as an empty one. An empty table gives no rows.
Other columns are ignored by ``mix`` and kept by ``mixed``, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common as C

WEIGHTS, CAP, RANGE, BLOCK, SEED = (5.0, 2.0, 1.0), 3.0, 4_000, 1_000, "mix-1"


def words(column: str) -> Column:
    """Number of words of a text; the white space before each, and at the start one is put, is what the pattern splits at."""
    return (F.size(F.split(F.concat(F.lit(" "), F.coalesce(column, F.lit(""))), "[\\x20\\x09-\\x0D]+(?=[^\\x20\\x09-\\x0D])")) - 1).cast("long")


def key() -> Column:
    """The random key of a row, from its id and text."""
    return F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(SEED), F.md5(F.coalesce("text", F.lit("")).cast("binary"))).cast("binary"))


def sizes(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size, k): words and the random key."""
    return docs.select("doc_id", "source", words("text").alias("size"), key().alias("k"))


def targets(rows: DataFrame) -> DataFrame:
    """(source, n, source_size, target), a row a source."""
    by = rows.groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(w) for w in WEIGHTS]), (place % len(WEIGHTS) + 1).cast("int"))
    every = Window.partitionBy(F.lit(0))
    by = by.withColumn("weight", weight).withColumn("cap", CAP * F.col("source_size"))
    by = by.withColumn("ratio", F.col("cap") / F.col("weight")).withColumn("total", F.sum("source_size").over(every)).withColumn("all_weight", F.sum("weight").over(every))
    up = Window.partitionBy(F.lit(0)).orderBy("ratio", F.col("source").asc_nulls_last())
    by = by.withColumn("before_cap", F.coalesce(F.sum("cap").over(up.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
    by = by.withColumn("before_weight", F.coalesce(F.sum("weight").over(up.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
    level = (F.col("total") - F.col("before_cap")) / (F.col("all_weight") - F.col("before_weight"))
    by = by.withColumn("level", level).withColumn("free", F.col("level") <= F.col("ratio"))
    final = F.min(F.when(F.col("free"), F.struct("ratio", "level"))).over(every)["level"]
    return by.select("source", "n", "source_size", F.when(F.col("free"), F.least("cap", F.col("weight") * final)).otherwise(F.col("cap")).alias("target"))


def entries(rows: DataFrame, goals: DataFrame) -> DataFrame:
    """(source, k, size, m, before, epochs, rest): an entry for each key; m its rows, before the words of the source's earlier entries."""
    first = F.conv(F.substring("k", 1, 8), 16, 10).cast("long")
    ranges = goals.select("source", F.greatest(F.lit(1), F.ceil(F.col("n") / RANGE)).alias("ranges"))
    joined = rows.alias("r").join(ranges.alias("g"), _same("r.source", "g.source")).select("r.source", "r.k", "r.size", F.floor(first * F.col("g.ranges") / F.lit(float(1 << 32))).cast("long").alias("range"))
    held = joined.groupBy("source", "range", "k", "size").agg(F.count(F.lit(1)).alias("m")).withColumn("in_entry", F.col("m") * F.col("size"))
    totals = C.handed(held.groupBy("source", "range").agg(F.sum("in_entry").alias("in_range")).withColumn("block", F.floor(F.col("range") / BLOCK)), "ranges")
    blocks = totals.groupBy("source", "block").agg(F.sum("in_range").alias("in_block"))
    blocks = blocks.select("source", "block", (F.sum("in_block").over(Window.partitionBy("source").orderBy("block")) - F.col("in_block")).alias("before_block"))
    inside = F.sum("in_range").over(Window.partitionBy("source", "block").orderBy("range")) - F.col("in_range")
    offsets = totals.withColumn("inside", inside).alias("r").join(blocks.alias("b"), _same("r.source", "b.source") & (F.col("r.block") == F.col("b.block")))
    offsets = offsets.select("r.source", "r.range", (F.col("inside") + F.col("before_block")).alias("offset"))
    within = Window.partitionBy("source", "range").orderBy("k").rowsBetween(Window.unboundedPreceding, -1)
    at = held.withColumn("inside", F.coalesce(F.sum("in_entry").over(within), F.lit(0))).alias("r")
    at = at.join(offsets.alias("o"), _same("r.source", "o.source") & (F.col("r.range") == F.col("o.range")))
    at = at.select("r.source", "r.k", "r.size", "r.m", (F.col("inside") + F.col("offset")).alias("before"))
    goal = goals.select("source", "epochs", "rest")
    return at.alias("e").join(goal.alias("g"), _same("e.source", "g.source")).select("e.*", "g.epochs", "g.rest")


def plan(rows: DataFrame) -> DataFrame:
    """(source, source_size, target, epochs, cut, of, extra), a row a source: rows with a key below cut are taken epochs times and once
    more; of those with that key, which are of in all, so are extra; the others, and those without words, epochs times."""
    goals = targets(rows)
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    goals = goals.withColumn("epochs", epochs).withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size"))
    goals = C.handed(goals, "targets")
    # of an entry's m rows, those whose middle lies before the rest of the budget
    more = F.least(F.col("m"), F.floor((F.col("rest") - F.col("before") - F.col("size") / 2) / F.col("size")).cast("long") + 1)
    taken = entries(rows, goals).filter("size > 0").withColumn("extra", more).filter("extra > 0")
    cut = taken.groupBy("source").agg(F.max(F.struct("k", "m", "extra")).alias("last"))
    both = goals.alias("g").join(cut.alias("c"), _same("g.source", "c.source"), "left")
    return C.handed(both.select("g.source", "g.source_size", "g.target", "g.epochs", F.col("c.last.k").alias("cut"), F.col("c.last.m").alias("of"), F.col("c.last.extra").alias("extra")), "plan")


def _times(rows: DataFrame, sources: DataFrame, k: str, source: str, size: str) -> DataFrame:
    """The rows as a struct ``row`` and the plan's columns, with ``times``. k, source and size name fields of ``row``."""
    both = rows.join(sources, F.col(source).eqNullSafe(F.col("source")))
    some = (F.col(k) == F.col("cut")) & (F.col("extra") < F.col("of"))
    once_more = F.coalesce((F.col(size) > 0) & (F.col(k) <= F.col("cut")), F.lit(False))
    whole = both.filter(~F.coalesce(some, F.lit(False))).withColumn("times", F.col("epochs") + once_more.cast("long"))
    if sources.filter("extra < of").limit(1).count() == 0:
        return whole
    # equal rows of which only some fit: numbered by the task that reads them, then within it
    tied = C.handed(both.filter(some).withColumn("part", F.spark_partition_id()), "tied")
    counts = tied.groupBy("source", "part").agg(F.count(F.lit(1)).alias("c"))
    before = counts.select(F.col("source").alias("of_source"), F.col("part").alias("of_part"), (F.sum("c").over(Window.partitionBy("source").orderBy("part")) - F.col("c")).alias("before"))
    number = F.col("before") + F.row_number().over(Window.partitionBy("source", "part").orderBy("cut"))
    tied = tied.join(before, F.col("source").eqNullSafe(F.col("of_source")) & (F.col("part") == F.col("of_part")))
    tied = tied.withColumn("times", F.col("epochs") + (number <= F.col("extra")).cast("long")).select(*whole.columns)
    return whole.unionByName(tied)


def mix(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size, source_size, target, taken, times) of every document: times it is taken, and the words that makes."""
    rows = C.handed(sizes(docs), "sizes")
    row = F.struct("doc_id", "source", "size", "k").alias("row")
    at = _times(rows.select(row), plan(rows), "row.k", "row.source", "row.size")
    return at.select("row.doc_id", "row.source", "row.size", "source_size", "target", (F.col("row.size") * F.col("times")).alias("taken"), "times")


def mixed(docs: DataFrame) -> DataFrame:
    """The documents, with all their columns, each as often as the mix takes it."""
    about = F.struct(words("text").alias("size"), key().alias("k"))
    row = F.struct(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("doc"), F.col("source").alias("source"), about.alias("about")).alias("row")
    at = _times(docs.select(row), plan(C.handed(sizes(docs), "sizes")), "row.about.k", "row.source", "row.about.size")
    copies = F.explode(F.sequence(F.lit(1), F.col("times").cast("int")))
    return at.filter("times > 0").select("row.doc", copies.alias("copy")).select("doc.*")


def _same(a: str, b: str) -> Column:
    return F.col(a).eqNullSafe(F.col(b))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(C.documents(spark, sf_dir, "doc_id", "text", "source")).drop("source", "times")


ORACLE = """
WITH t AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size,
  md5(coalesce(CAST(doc_id AS VARCHAR), '') || 'mix-1' || md5(coalesce(text, ''))) AS k FROM documents),
s AS (SELECT source, CAST(sum(size) AS DOUBLE) AS source_size,
  [5.0, 2.0, 1.0][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::DOUBLE AS w FROM t GROUP BY source),
c AS (SELECT *, 3 * source_size AS cap, 3 * source_size / w AS ratio, sum(source_size) OVER () AS total, sum(w) OVER () AS all_w FROM s),
l AS (SELECT *, (total - coalesce(sum(cap) OVER b, 0)) / (all_w - coalesce(sum(w) OVER b, 0)) AS level FROM c
  WINDOW b AS (ORDER BY ratio, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
g AS (SELECT source, source_size, CASE WHEN level <= ratio THEN least(cap, w * (SELECT arg_min(level, ratio) FROM l WHERE level <= ratio)) ELSE cap END AS target FROM l),
p AS (SELECT t.doc_id, t.size, g.source_size, g.target,
  coalesce(sum(t.size) OVER (PARTITION BY t.source ORDER BY t.k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM t JOIN g ON t.source IS NOT DISTINCT FROM g.source),
e AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS epochs FROM p)
SELECT doc_id, size, CAST(source_size AS BIGINT) AS source_size, target,
  CAST(size * (epochs + CASE WHEN size > 0 AND before + size / 2 <= target - epochs * source_size THEN 1 ELSE 0 END) AS BIGINT) AS taken FROM e
"""
