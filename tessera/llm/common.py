"""What the operators of this subpackage share: the shared folder, table hand-over, byte-level word splitting.

Only ``spark.checkpoint.dir`` is taken as visible to the driver and to every executor. A table or file
that one job writes for a later one goes there, so a lost executor costs a task and never an intermediate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.sources.store import cleanup, handed, qualified, shared_dir  # noqa: F401

#: Arrow batches handed to Python hold at most this many rows and bytes; one text may still be larger.
BATCH_ROWS, BATCH_BYTES = 1024, 16 << 20

#: Lower-cases A-Z; the other bytes, UTF-8 included, stay.
LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
#: Lower-cases A-Z and turns every ASCII character outside [0-9a-z] into a space: what is left between
#: spaces is a word of ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+``, because every byte of a non-ASCII character is 0x80 or more.
WORDS = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256)
)
#: The six characters of ``[\x20\x09-\x0D]``; ``bytes.split()`` splits on exactly these.
SPACES = b" \t\n\x0b\x0c\r"


def prepare(spark: SparkSession) -> None:
    """Bound the Arrow batches of this session, where they are larger. The settings stay: a lazy result needs them when it runs."""
    for key, most in (("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS), ("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)):
        now = spark.conf.get(key)
        if not (now.isdigit() and 0 < int(now) <= most):
            spark.conf.set(key, str(most))


def partitions(spark: SparkSession, amount: float = 0, each: float = 1) -> int:
    """Tasks for so much input at so much a task, the session's shuffle partitions at least."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-int(amount) // int(each)))


def open_fs(uri: str):
    """(file system, path) of a URI, for reads and writes by executors; file, hdfs, s3 and gs paths work alike."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def write_bytes(uri: str, data: bytes) -> None:
    fs, path = open_fs(uri)
    fs.create_dir(path.rpartition("/")[0], recursive=True)
    with fs.open_output_stream(path) as out:
        out.write(data)


def read_bytes(uri: str, offset: int = 0, length: int | None = None) -> bytes:
    fs, path = open_fs(uri)
    with fs.open_input_file(path) as f:
        return f.read_at(f.size() - offset if length is None else length, offset)


def release() -> None:
    """Give the memory that a finished task has freed back to the system; the worker lives on for other tasks."""
    import ctypes

    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass  # not a C library that has it


def byte_rows(column) -> list:
    """The values of an Arrow string column as UTF-8 bytes (None stays)."""
    import pyarrow as pa

    return column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()).to_pylist()


def documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return table(spark, sf_dir, "documents", *columns)


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


def small(df: DataFrame, max_rows: int, what: str) -> list:
    """Collect a table whose size has a proven bound; more rows than that are an error, never a silent cut."""
    rows = df.limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        raise ValueError(f"{what}: more than {max_rows} rows")
    return rows


def crc_fold(column: str = "doc_id"):
    return F.crc32(F.col(column).cast("string").cast("binary")) % 5
