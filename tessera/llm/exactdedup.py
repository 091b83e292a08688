"""Exact duplicates by a minimal perfect hash over the digests already seen.

``fingerprints`` gives each text the SHA-256 of its UTF-8 bytes without white space. ``build`` packs the
distinct digests of the history into shards, each with a minimal perfect hash whose slots hold the full digest and
the locator of the row that wins (most code points, then smallest id) with the number of its copies. Hash and slots are
stored side by side, and every later step loads them as they are. ``absorb`` looks the distinct digests of a new batch up: a
member must equal the digest in its slot byte for byte, and may take the slot over; digests that are no members are
grouped apart, in the shard's tail. ``resolve`` finds each row's digest by the same lookup and names the row that stays.

A shard holds about KEYS digests whatever the input's size. Rows of one shard are spread by their id over as many tasks
as their number asks for, against ROWS and against the mean shard (the shard is copied to each), and copies are counted
before any shuffle, so a text that a third of all rows share burdens no task.

Null counts as empty text; empty texts are copies of each other. Rows with the same id and text are separate rows
of one group. A null id loses ties; where all ids of a group are null, keep_id is null and all its rows are kept. An empty
table gives no rows. Other columns are ignored. Of a very long text only the digest and size leave its batch.
"""

from __future__ import annotations

import hashlib
import struct

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as C

#: Digests of a shard; rows of a task, at most and before a shard is split at all.
KEYS, ROWS, LEAST = 50_000, 100_000, 1000
#: Bits a key for each level of the hash; levels before the rest is kept as a sorted list.
GAMMA, LEVELS = 2.0, 24


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, digest, size): size in code points of the whole text."""

    def run(batches):
        import pyarrow as pa
        import pyarrow.compute as pc

        for batch in batches:
            texts = batch.column(1)
            digests = [hashlib.sha256((x or b"").translate(None, C.SPACES)).digest() for x in C.byte_rows(texts)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(digests, pa.binary()), pc.fill_null(pc.utf8_length(texts).cast(pa.int64()), 0)], names=["doc_id", "digest", "size"])

    C.prepare(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, digest binary, size long")


def _mix(words: np.ndarray, level: int) -> np.ndarray:
    x = words[:, 0] + np.uint64((0x9E3779B97F4A7C15 * (level + 1)) & (2**64 - 1))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9) ^ words[:, 1]
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class PerfectHash:
    """Minimal perfect hash of 32-byte digests: at each level the keys that hit a bit alone get it; the others go on.

    Kept are each level's bits, in 64-bit words, with the number of bits set before each word; a slot is a bit's rank."""

    def __init__(self, digests: np.ndarray):
        words = digests.view("<u8").reshape(-1, 4)
        left, self.levels, start = np.arange(len(words)), [], 0
        for level in range(LEVELS):
            if not len(left):
                break
            m = max(64, int(GAMMA * len(left)))
            at = (_mix(words[left], level) % np.uint64(m)).astype(np.int64)
            alone = np.bincount(at, minlength=m) == 1
            packed = np.packbits(alone, bitorder="little")
            bits = np.frombuffer(packed.tobytes() + b"\0" * (-len(packed) % 8), "<u8")
            ones = np.cumsum(np.bitwise_count(bits), dtype=np.int64)
            self.levels.append((m, bits, start + ones - np.bitwise_count(bits)))
            start += int(ones[-1])
            left = left[~alone[at]]
        self.start, self.rest = start, np.sort(_keys(digests[left]))

    def __call__(self, digests: np.ndarray) -> np.ndarray:
        """The slot of each digest; any slot, or -1, for one that is not a key."""
        words = digests.view("<u8").reshape(-1, 4)
        slots, left = np.full(len(words), -1, np.int64), np.arange(len(words))
        for level, (m, bits, ranks) in enumerate(self.levels):
            at = (_mix(words[left], level) % np.uint64(m)).astype(np.int64)
            word, bit = bits[at >> 6], np.uint64(1) << (at & 63).astype(np.uint64)
            hit = (word & bit) != 0
            slots[left[hit]] = ranks[at[hit] >> 6] + np.bitwise_count(word[hit] & (bit[hit] - np.uint64(1)))
            left = left[~hit]
        if len(self.rest) and len(left):
            keys = _keys(digests[left])
            at = np.minimum(np.searchsorted(self.rest, keys), len(self.rest) - 1)
            same = self.rest[at] == keys
            slots[left[same]] = self.start + at[same]
        return slots

    def dump(self) -> bytes:
        head = struct.pack("<qqq", self.start, len(self.levels), len(self.rest))
        return head + b"".join(struct.pack("<qq", m, len(bits)) + bits.tobytes() + ranks.astype("<i8").tobytes() for m, bits, ranks in self.levels) + self.rest.tobytes()

    @classmethod
    def load(cls, blob: bytes) -> PerfectHash:
        """The hash that was dumped; its arrays are views of the bytes."""
        self, at = cls.__new__(cls), 24
        self.start, levels, rest = struct.unpack_from("<qqq", blob)
        self.levels = []
        for _ in range(levels):
            m, n = struct.unpack_from("<qq", blob, at)
            self.levels.append((m, np.frombuffer(blob, "<u8", n, at + 16), np.frombuffer(blob, "<i8", n, at + 16 + 8 * n)))
            at += 16 + 16 * n
        self.rest = np.frombuffer(blob, "S33", rest, at)
        return self


def _keys(digests: np.ndarray) -> np.ndarray:
    """As fixed-width strings that sort and compare; a last byte of one keeps trailing zero bytes."""
    return np.concatenate([digests, np.ones((len(digests), 1), np.uint8)], 1).view("S33").ravel()


def _digests(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, 32)


def _better(size, ident, size2, ident2) -> np.ndarray:
    """Where the second row wins: more code points, then the smaller id (null, as the largest, last)."""
    return (size2 > size) | ((size2 == size) & (ident2 < ident))


def shard_of(digest, shards: int):
    return (F.conv(F.substring(F.hex(digest), 1, 8), 16, 10).cast("long") % shards).cast("int")


def _winner(rows: DataFrame, *keys: str) -> DataFrame:
    """One row a digest: the size and id of the row that wins, and how many there are; summed before the shuffle."""
    top = F.coalesce(F.col("doc_id"), F.lit((1 << 63) - 1))
    best = F.min(F.struct((-F.col("size")).alias("s"), top.alias("i")))
    return rows.groupBy("digest", *keys).agg(best.alias("best"), F.count(F.lit(1)).alias("n")).select("digest", *keys, (-F.col("best.s")).alias("size"), F.col("best.i").alias("id"), "n")


def build(history: DataFrame, shards: int) -> DataFrame:
    """(shard, hash, slots): the history's digests, a row for each shard: the perfect hash, and a serialized table in slot order."""

    def run(table):
        import pyarrow as pa

        digests = _digests(table.column("digest"))
        found = PerfectHash(digests)
        slots = found(digests)
        order = np.argsort(slots)
        if not (slots[order] == np.arange(len(slots))).all():
            raise ValueError("a shard's hash is not minimal and perfect: does a digest stand in it twice?")
        kept = _pack(table.take(order).select(["digest", "size", "id", "n"]))
        return pa.table({"shard": table.column("shard")[:1], "hash": pa.array([found.dump()], pa.binary()), "slots": pa.array([kept], pa.binary())})

    keyed = _winner(history).withColumn("shard", shard_of(F.col("digest"), shards))
    return keyed.select("shard", "digest", "size", "id", "n").groupBy("shard").applyInArrow(run, "shard int, hash binary, slots binary")


def _pack(table) -> bytes:
    import pyarrow as pa

    sink = pa.BufferOutputStream()
    table = table.combine_chunks()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_table(table)
    return sink.getvalue().to_pybytes()


def _unpack(blob: bytes):
    import pyarrow as pa

    return pa.ipc.open_stream(blob).read_all()


class _Shard:
    """A shard's members by its stored perfect hash; none where the shard is new."""

    def __init__(self, row):
        self.blob = row.column("hash")[0].as_py() if row.num_rows else PerfectHash(np.empty((0, 32), np.uint8)).dump()
        self.hash = PerfectHash.load(self.blob)
        members = _unpack(row.column("slots")[0].as_py()) if row.num_rows else None
        none = [np.empty((0, 32), np.uint8), *[np.empty(0, np.int64)] * 3]
        self.member = none if members is None else [_digests(members.column("digest")), *(np.array(members.column(c).to_numpy()) for c in ("size", "id", "n"))]

    def find(self, digests: np.ndarray) -> np.ndarray:
        """The member slot of each digest whose bytes stand in the slot, else -1."""
        slots = self.hash(digests)
        known = slots >= 0
        known[known] = (self.member[0][slots[known]] == digests[known]).all(1)
        return np.where(known, slots, -1)


def absorb(state: DataFrame, batch: DataFrame, shards: int) -> DataFrame:
    """(shard, hash, slots, tail): the history with the batch looked up; members' locators updated, the others grouped in the tail."""

    def run(left, right):
        import pyarrow as pa

        shard = _Shard(left)
        new = right.select(["digest", "size", "id", "n"]).combine_chunks()
        tail = new
        if new.num_rows:
            slots = shard.find(_digests(new.column("digest")))
            size, ident, n = (new.column(c).to_numpy() for c in ("size", "id", "n"))
            known, (_, s, i, c) = slots >= 0, shard.member
            to = slots[known]  # the batch holds a digest once, so a slot comes once
            wins = _better(s[to], i[to], size[known], ident[known])
            s[to[wins]], i[to[wins]] = size[known][wins], ident[known][wins]
            c[to] += n[known]
            tail = new.filter(pa.array(~known))
            tail = tail.take(np.argsort(_keys(_digests(tail.column("digest"))))) if tail.num_rows else tail
        d, s, i, c = shard.member
        kept = pa.table({"digest": pa.array([x.tobytes() for x in d], pa.binary()), "size": s, "id": i, "n": c})
        name = (left if left.num_rows else right).column("shard")[:1]
        return pa.table({"shard": name, "hash": pa.array([shard.blob], pa.binary()), "slots": pa.array([_pack(kept)], pa.binary()), "tail": pa.array([_pack(tail)], pa.binary())})

    keyed = _winner(batch).withColumn("shard", shard_of(F.col("digest"), shards)).select("shard", "digest", "size", "id", "n")
    return state.groupBy("shard").cogroup(keyed.groupBy("shard")).applyInArrow(run, "shard int, hash binary, slots binary, tail binary")


def resolve(rows: DataFrame, state: DataFrame, shards: int) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) of each row."""
    keyed = rows.withColumn("shard", shard_of(F.col("digest"), shards))
    each = min(ROWS, max(LEAST, 2 * rows.count() // shards))
    split = keyed.groupBy("shard").agg(F.ceil(F.count(F.lit(1)) / each).cast("int").alias("parts")).filter("parts > 1")
    split = C.handed(split, "split")  # its size decides how it is joined
    parts = F.coalesce("parts", F.lit(1))
    dealt = keyed.join(split, "shard", "left").withColumn("part", (F.abs(F.xxhash64("doc_id", "size")) % parts).cast("int")).drop("parts")
    copies = state.join(split, "shard", "left").withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1))).drop("parts")

    def run(left, right):
        import pyarrow as pa

        schema = pa.schema([("doc_id", pa.int64()), ("keep_id", pa.int64()), ("group_size", pa.int64()), ("kept", pa.bool_()), ("text_sha256", pa.string())])
        if not left.num_rows:
            return schema.empty_table()
        shard, tail = _Shard(right), _unpack(right.column("tail")[0].as_py())
        digests = _digests(left.column("digest"))
        slots = shard.find(digests)
        keep, n = np.zeros(len(slots), np.int64), np.zeros(len(slots), np.int64)
        known = slots >= 0
        keep[known], n[known] = shard.member[2][slots[known]], shard.member[3][slots[known]]
        if (~known).any():
            names, keys = _keys(_digests(tail.column("digest"))), _keys(digests[~known])
            at = np.minimum(np.searchsorted(names, keys), max(0, len(names) - 1))
            if not len(names) or not (names[at] == keys).all():
                raise ValueError("a digest stands neither in its shard nor in the shard's tail")
            keep[~known], n[~known] = tail.column("id").to_numpy()[at], tail.column("n").to_numpy()[at]
        top = (1 << 63) - 1
        mine = left.column("doc_id").fill_null(top).to_numpy()
        return pa.table([left.column("doc_id"), pa.array(keep, mask=keep == top), pa.array(n), pa.array(mine == keep), pa.array([x.hex() for x in left.column("digest").to_pylist()])], schema=schema)

    return dealt.groupBy("shard", "part").cogroup(copies.groupBy("shard", "part")).applyInArrow(run, "doc_id long, keep_id long, group_size long, kept boolean, text_sha256 string")


def dedup(history: DataFrame, batch: DataFrame) -> DataFrame:
    """Both tables' rows (doc_id, text) with the row of their group that stays; the history is hashed, the batch looked up."""
    spark = history.sparkSession
    both = fingerprints(history.select("doc_id", "text")).withColumn("old", F.lit(True)).unionByName(fingerprints(batch.select("doc_id", "text")).withColumn("old", F.lit(False)))
    rows = C.handed(both, "fingerprints")
    shards = C.partitions(spark, rows.count(), KEYS)
    state = C.handed(absorb(build(rows.filter("old"), shards), rows.filter("not old"), shards), "state")
    return resolve(rows.drop("old"), state, shards)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of the even half of the sources' id hashes are the history; the others are the batch that arrives."""
    docs = C.documents(spark, sf_dir, "doc_id", "text")
    old = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 2 == 0
    return dedup(docs.filter(old), docs.filter(~old))


ORACLE = """
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
n AS (SELECT doc_id, length(text) AS size, sha256(regexp_replace(text, '[\\x20\\x09-\\x0D]', '', 'g')) AS text_sha256 FROM t),
w AS (SELECT *, first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY size DESC, doc_id) AS keep_id,
  count(*) OVER (PARTITION BY text_sha256) AS group_size FROM n)
SELECT doc_id, keep_id, CAST(group_size AS BIGINT) AS group_size, doc_id = keep_id AS kept, text_sha256 FROM w
"""
