"""Rules for result files: header, rows, lists of ids; all findings with a few examples, and a verdict."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators.aliases import _exists

MATCHING = ["source1_entity_id", "matched_entity_ids"]
CANDIDATES = ["source1_entity_id", "candidate_entity_ids"]
EXAMPLES = 5


def list_problems(rows: DataFrame, key: str, ids: str) -> DataFrame:
    """(key, n_ids, has_duplicate, n_s1, n_bad_prefix) of comma-joined lists; empty items dropped."""
    x = F.filter(F.transform(F.split(ids, ","), lambda v: F.trim(v)), lambda v: v != "")
    size = lambda c: F.size(c).cast("bigint")
    return rows.select(key, x.alias("x")).select(
        key, size("x").alias("n_ids"), (F.size("x") != F.size(F.array_distinct("x"))).alias("has_duplicate"),
        size(F.filter("x", lambda v: v.startswith("S1-"))).alias("n_s1"), size(F.filter("x", lambda v: ~v.rlike("^S[123]-"))).alias("n_bad_prefix"),
    )


def exploded(rows: DataFrame, key: str, ids: str) -> DataFrame:
    """(key, id), a row an item of the lists; empty items dropped."""
    return rows.select(key, F.explode(F.split(ids, ",")).alias("id")).filter("id <> ''")


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """(entity_id), the distinct first fields of a TSV; header and blank lines left out."""
    lines = spark.read.option("lineSep", "\n").text(path)
    header = lines.first()
    rows = lines.filter(F.trim("value") != "").select(F.trim(F.split("value", "\t")[0]).alias("entity_id")).distinct()
    return rows if header is None else rows.filter(F.col("entity_id") != header["value"].split("\t")[0].strip())


def header_problem(spark: SparkSession, path: str, expected: list[str]) -> str | None:
    """What is wrong with a file before its first row; None if nothing is."""
    if not _exists(spark, path):
        return "file not found"
    first = spark.read.option("lineSep", "\n").text(path).first()
    if first is None:
        return "empty file"
    if "\t" not in first["value"] and "," in first["value"]:
        return "header has commas and no tab"
    columns = [c.strip().lower() for c in first["value"].split("\t")]
    return None if columns == expected else f"unexpected header {columns}"


def rows_of(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(s1_id, ids) of the rows after the header, ids as they stand between commas; and (line), lines with text and no tab."""
    lines = spark.read.option("lineSep", "\n").text(path)
    header = lines.first()["value"]
    # only one line equals the header unless it is repeated; the first is the file's start
    numbered = lines.withColumns({"_at": F.col("_metadata.file_block_start"), "_id": F.monotonically_increasing_id()})
    first = numbered.filter((F.col("_at") == 0) & (F.col("value") == header)).agg(F.min("_id").alias("_first"))
    body = numbered.join(F.broadcast(first), F.col("_id") == F.col("_first"), "left_anti").select("value")
    has = F.instr("value", "\t") > 0
    rest = F.substring_index("value", "\t", 1)
    after = F.expr("substring(value, instr(value, '\t') + 1)")
    lists = F.when(F.trim(after) == "", F.array().cast("array<string>")).otherwise(F.split(F.regexp_replace(after, "\r$", ""), ","))
    return body.filter(has).select(rest.alias("s1_id"), lists.alias("ids")), body.filter(~has & (F.trim("value") != "")).select(F.col("value").alias("line"))


RULES = ["no_tab", "duplicate_row", "repeated_id", "s1_id", "bad_prefix", "unknown_id", "missing_s1", "extra_s1"]


def findings(rows: DataFrame, tabless: DataFrame, required: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """(rule, n, examples): offenders of each rule that some row breaks, the first EXAMPLES in order. known: ids that lists may hold."""
    one = lambda rule, df, c: df.select(F.lit(rule).alias("rule"), F.col(c).alias("item"))
    ids = rows.select("s1_id", F.explode("ids").alias("id"))
    target = F.col("id").startswith("S2-") | F.col("id").startswith("S3-")
    need = required.select(F.col("entity_id").alias("s1_id")).distinct()
    found = [
        one("no_tab", tabless, "line"), one("duplicate_row", rows.groupBy("s1_id").count().filter("count > 1"), "s1_id"),
        one("repeated_id", rows.filter(F.size("ids") != F.size(F.array_distinct("ids"))), "s1_id"), one("s1_id", ids.filter(F.col("id").startswith("S1-")), "id"),
        one("bad_prefix", ids.filter(~target & ~F.col("id").startswith("S1-")), "id"),
        one("missing_s1", need.join(rows, "s1_id", "left_anti"), "s1_id"), one("extra_s1", rows.join(need, "s1_id", "left_anti"), "s1_id"),
    ]
    if known is not None:
        found.append(one("unknown_id", ids.filter(target).join(known.select(F.col("entity_id").alias("id")), "id", "left_anti"), "id"))
    every = found[0]
    for df in found[1:]:
        every = every.unionByName(df)
    items = every.distinct()
    # the examples are the smallest items of each rule: cut by tasks first
    from tessera.operators.blocking import lowest

    few = lowest(items, EXAMPLES, ["rule"], ["item"]).groupBy("rule").agg(F.array_join(F.array_sort(F.collect_list("item")), ", ").alias("examples"))
    return items.groupBy("rule").agg(F.count(F.lit(1)).alias("n")).join(few, "rule")


def outside(matching: DataFrame, candidates: DataFrame) -> DataFrame:
    """(s1_id): records with a match that is none of their candidates."""
    pairs = lambda df: df.select("s1_id", F.explode("ids").alias("id"))
    return pairs(matching).join(pairs(candidates), ["s1_id", "id"], "left_anti").select("s1_id").distinct()


@dataclass
class Report:
    errors: list[str] = field(default_factory=list)
    warnings: list[str] = field(default_factory=list)
    notes: list[str] = field(default_factory=list)

    @property
    def code(self) -> int:
        return int(bool(self.errors))

    def __str__(self) -> str:
        head = [f"  {x}" for x in self.notes] + [f"WARNING: {x}" for x in self.warnings]
        last = [f"FAIL: {len(self.errors)} issue(s)", *[f"  {i}. {x}" for i, x in enumerate(self.errors, 1)]] if self.errors else ["PASS"]
        return "\n".join(head + last)


def validate(spark: SparkSession, matching: str, required: str, candidates: str | None = None, known: list[str] | None = None) -> Report:
    """Check result files against the S1 file, and, if target files are named, the ids against these. Every rule is a distributed
    query; only counts and examples reach the driver."""
    report, lists = Report(), {}
    if not _exists(spark, required):
        report.errors.append(f"{required}: S1 file not found")
        return report
    need = read_ids(spark, required)
    ids = None
    if known is None:
        report.warnings.append("ids in lists are not checked against target files")
    elif gone := [p for p in known if not _exists(spark, p)]:
        report.warnings.append(f"{gone[0]} not found: ids in lists are not checked")
    else:
        ids = read_ids(spark, known[0])
        for p in known[1:]:
            ids = ids.union(read_ids(spark, p)).distinct()
    for path, expected in ((matching, MATCHING), (candidates, CANDIDATES)):
        if path is None or (path == candidates and not _exists(spark, path)):
            if path is not None:
                report.warnings.append(f"{path} not found: candidates are not checked")
            continue
        if wrong := header_problem(spark, path, expected):
            report.errors.append(f"{path}: {wrong}")
            continue
        rows, tabless = rows_of(spark, path)
        n = rows.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.size("ids") == 0).alias("empty")).first()
        report.notes.append(f"{path}: {n['n']} rows ({n['empty']} empty)")
        order = {r: i for i, r in enumerate(RULES)}
        for f in sorted(findings(rows, tabless, need, ids).collect(), key=lambda f: order[f["rule"]]):
            report.errors.append(f"{path}: {f['rule']}: {f['n']}, e.g. {f['examples']}")
        lists[path] = rows
    if matching in lists and candidates in lists:
        offenders = outside(lists[matching], lists[candidates])
        if n := offenders.count():
            some = [r["s1_id"] for r in offenders.orderBy("s1_id").limit(EXAMPLES).collect()]
            report.warnings.append(f"{n} S1 records have matches that are no candidates, e.g. {', '.join(some)}")
    return report
