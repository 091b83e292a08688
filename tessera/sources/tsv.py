"""Tab-separated tables without quoting, every field text; their lines; and results as TSV and JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

COLUMNS = ["entity_id", "business_name", "business_address", "country"]
TRUTH_COLUMNS = ["source1_entity_id", "matched_entity_ids"]


def header(spark: SparkSession, path: str) -> list[str]:
    """The names in a file's first line; none of an empty file."""
    first = spark.read.option("lineSep", "\n").text(path).first()
    return first[0].rstrip("\r").split("\t") if first and first[0] else []


def read(spark: SparkSession, path: str, required: list[str] = COLUMNS, malformed: str = "PERMISSIVE") -> DataFrame:
    """The required columns by name, in any order of the header; empty fields are empty text.

    malformed: PERMISSIVE pads short rows and cuts long ones; DROPMALFORMED drops rows of another width, for which every field of a row
    is parsed, however few columns are asked for."""
    names = header(spark, path)
    if missing := [c for c in required if c not in names]:
        raise ValueError(f"{path}: columns missing: {missing}")
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    options = {"sep": "\t", "header": True, "quote": "", "lineSep": "\n", "mode": malformed, "columnPruning": malformed != "DROPMALFORMED", "maxCharsPerColumn": -1}
    df = spark.read.schema(schema).options(**options).csv(path)
    return df.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in required])


def lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, lineno, value): every line, numbered from 1 in each file. Blocks are counted, so that tasks number theirs by themselves."""
    raw = spark.read.option("lineSep", "\n").text(path)
    raw = raw.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_id"))
    blocks = raw.groupBy("file", "_block").agg(F.count(F.lit(1)).alias("_n"), F.min("_id").alias("_first"))
    before = F.sum("_n").over(Window.partitionBy("file").orderBy("_block")) - F.col("_n")  # a row a block
    blocks = blocks.withColumn("_before", before).drop("_n")
    return raw.join(blocks, ["file", "_block"]).select("file", (F.col("_before") + F.col("_id") - F.col("_first") + 1).alias("lineno"), "value")


def rows(spark: SparkSession, path: str, fields: int | None = len(COLUMNS)) -> DataFrame:
    """(lineno, fields): the fields of each line after the header; only lines of so many fields, or all for None."""
    split = F.split(F.regexp_replace("value", "\r$", ""), "\t", -1)
    found = lines(spark, path).filter("lineno > 1").select("lineno", split.alias("fields"))
    return found if fields is None else found.filter(F.size("fields") == fields)


def scan(spark: SparkSession, path: str) -> DataFrame:
    """One row for all files: bytes, lines, line feeds, carriage returns, files without a final line feed, rows of another width
    than the header's, and the first five of these by number."""
    width = len(header(spark, path))
    sized = spark.read.option("lineSep", "\n").text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size"), "value")
    length = F.octet_length("value")
    files = sized.groupBy("file").agg(F.max("size").alias("size"), F.count(F.lit(1)).alias("lines"), F.sum(length + 1).alias("with_feeds"), F.sum(length - F.octet_length(F.replace("value", F.lit("\r"), F.lit("")))).alias("returns"))
    files = files.withColumn("open", (F.col("with_feeds") > F.col("size")).cast("int"))
    total = files.agg(F.sum("size").alias("bytes"), F.sum("lines").alias("lines"), F.sum(F.col("lines") - F.col("open")).alias("feeds"), F.sum("returns").alias("returns"), F.sum("open").alias("no_final_feed"))
    bad = lines(spark, path).filter((F.col("lineno") > 1) & (F.size(F.split("value", "\t", -1)) != width))
    examples = bad.orderBy("file", "lineno").limit(5).agg(F.sort_array(F.collect_list(F.struct("lineno", F.substring("value", 1, 160).alias("start")))).alias("examples"))
    count = bad.agg(F.count(F.lit(1)).alias("malformed"))
    return total.join(F.broadcast(count)).join(F.broadcast(examples))  # a row each


def listing(spark: SparkSession, path: str) -> DataFrame:
    """(name, bytes) of the files in a folder; no file is read."""
    found = spark.read.format("binaryFile").load(path)
    return found.select(F.element_at(F.split("path", "/"), -1).alias("name"), F.col("length").alias("bytes"))


def mentions(spark: SparkSession, path: str, patterns: dict[str, str]) -> DataFrame:
    """(check, found): whether a text file holds each pattern."""
    text = spark.read.text(path, wholetext=True)
    checks = F.explode(F.array(*[F.struct(F.lit(name).alias("check"), F.col("value").rlike(p).alias("found")) for name, p in patterns.items()]))
    return text.select(checks.alias("c")).groupBy("c.check").agg(F.max("c.found").alias("found"))


def positioned(spark: SparkSession, path: str, required: list[str] = COLUMNS) -> DataFrame:
    """The required columns of well-formed rows, and pos, the row's number in the file from 1."""
    names = header(spark, path)
    if missing := [c for c in required if c not in names]:
        raise ValueError(f"{path}: columns missing: {missing}")
    found = rows(spark, path, len(names))
    return found.select(*[F.col("fields")[names.index(c)].alias(c) for c in required], (F.col("lineno") - 1).alias("pos"))


def truth_pairs(truth: DataFrame) -> DataFrame:
    """(s1_id, target_id, target_source) of source1_entity_id and comma-joined matched_entity_ids."""
    ids = F.filter(F.transform(F.split("matched_entity_ids", ","), lambda v: F.trim(v)), lambda x: x != "")
    pairs = truth.select(F.col("source1_entity_id").alias("s1_id"), F.explode(ids).alias("target_id"))
    return pairs.withColumn("target_source", F.substring("target_id", 1, 2))


def matched_ids(truth: DataFrame, s1: DataFrame) -> DataFrame:
    """(entity_id): the distinct targets of some S1 records."""
    mine = truth.join(s1.select(F.col("entity_id").alias("source1_entity_id")), "source1_entity_id", "left_semi")
    return truth_pairs(mine).select(F.col("target_id").alias("entity_id")).distinct()


def write(df: DataFrame, path: str, one_file: bool = False) -> None:
    """A folder of TSV files with headers, empty text as nothing between tabs. one_file: by one task, in the order of the rows."""
    (df.coalesce(1) if one_file else df).write.options(sep="\t", header=True, emptyValue="", quote="", lineSep="\n", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)


def write_json(df: DataFrame, path: str) -> None:
    """A folder of JSON lines."""
    df.write.json(path)
