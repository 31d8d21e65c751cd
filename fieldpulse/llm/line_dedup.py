"""Incremental, reversible line dedup: sharded cuckoo filters backed by exact reference counts.

The state of a ``LineIndex`` lies in a shared folder. A posting says that a document holds a line key; the reference count of a
key is the number of its postings, and its holder the largest document among them. Each shard of keys has a cuckoo filter with all
live keys. When documents come in, a key that its filter does not know is certainly new and goes straight to the count
table; only the others are looked up there. When documents go, counts fall, and keys that nobody holds any more
leave the filters, which a Bloom filter could not do. Every decision is taken from the exact counts.

Keys are spread over shards by hash and counted with map-side combine, so one very common line costs one row per task.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldpulse.llm.tables import scratch, ship, stored

BLANKS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SLOTS = 4
LOAD = 0.9
SHARD_KEYS = 250_000


def lines(text: Column) -> Column:
    """The text cut at line feeds; null and empty are one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(BLANKS)), UPPER, LOWER)


class CuckooFilter:
    """Set of 64-bit keys with insertion and deletion; a key it does not know is certainly absent.

    Buckets of four 16-bit fingerprints; a key's second bucket is the first one xor a hash of the fingerprint. All
    methods take arrays of distinct keys.
    """

    def __init__(self, table: np.ndarray):
        self.table = table.reshape(-1, SLOTS)
        self.mask = np.int64(len(self.table) - 1)

    @classmethod
    def of(cls, keys: np.ndarray, room: int = 0) -> CuckooFilter:
        need = max(1, int(np.ceil(max(len(keys), room) / (SLOTS * LOAD))))
        size = 1 << (need - 1).bit_length()
        while True:
            made = cls(np.zeros(size * SLOTS, np.uint16))
            if made.insert(keys):
                return made
            size *= 2

    def _places(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        bits = keys.astype(np.int64).view(np.uint64)
        prints = (bits & np.uint64(0xFFFF)).astype(np.uint16)
        prints[prints == 0] = 1
        return prints, (bits >> np.uint64(20)).astype(np.int64) & self.mask

    def _other(self, bucket: np.ndarray, prints: np.ndarray) -> np.ndarray:
        return (bucket ^ (prints.astype(np.int64) * np.int64(0x5BD1E995))) & self.mask

    def _place(self, prints: np.ndarray, bucket: np.ndarray) -> np.ndarray:
        """Puts fingerprints where their bucket has room; returns which are left over."""
        order = np.argsort(bucket, kind="stable")
        sorted_ = bucket[order]
        turn = np.arange(len(order)) - np.searchsorted(sorted_, sorted_)
        free = self.table[sorted_] == 0
        fits = turn < free.sum(axis=1)
        slot = (free.cumsum(axis=1) == (turn + 1)[:, None]).argmax(axis=1)
        self.table[sorted_[fits], slot[fits]] = prints[order[fits]]
        return np.sort(order[~fits])

    def insert(self, keys: np.ndarray, kicks: int = 200) -> bool:
        """False if the filter is too full; it is then to be built anew."""
        prints, bucket = self._places(keys)
        left = self._place(prints, bucket)
        prints, bucket = prints[left], self._other(bucket[left], prints[left])
        for kick in range(kicks):
            left = self._place(prints, bucket)
            if not len(left):
                return True
            prints, bucket = prints[left], bucket[left]
            # One fingerprint per full bucket takes the place of another, which moves on; the rest tries again.
            moved, first = np.unique(bucket, return_index=True)
            slot = (kick + prints[first]) % SLOTS
            evicted = self.table[moved, slot].copy()
            self.table[moved, slot] = prints[first]
            prints[first], bucket[first] = evicted, self._other(moved, evicted)
        return False

    def contains(self, keys: np.ndarray) -> np.ndarray:
        prints, bucket = self._places(keys)
        return ((self.table[bucket] == prints[:, None]) | (self.table[self._other(bucket, prints)] == prints[:, None])).any(axis=1)

    def delete(self, keys: np.ndarray) -> None:
        """Removes keys that are in the filter, one fingerprint each."""
        prints, bucket = self._places(keys)
        for value, one, two in zip(prints, bucket, self._other(bucket, prints)):
            for place in (one, two):
                found = np.flatnonzero(self.table[place] == value)
                if len(found):
                    self.table[place, found[0]] = 0
                    break


@dataclass(frozen=True)
class LineRule:
    """Keys of at least ``least_length`` code points in at least ``least_docs`` documents are dropped but in the last document."""
    least_length: int = 40
    least_docs: int = 5


COUNTS = "shard int, key string, docs long, holder long"
FILTERS = "shard int, keys long, cuckoo binary"


class LineIndex:
    """Line keys of a growing and shrinking set of documents, under ``path`` or a new scratch folder.

    ``shards`` should leave some 250,000 keys a shard; without it, the first insertion sets it from its number of keys. An insertion that takes
    the shards beyond twice that deals all keys to more shards and builds their filters anew.

    Each change writes a new version of the touched state; the version before stays until it is no longer needed, so a job that
    dies can be run again from it.
    """

    def __init__(self, spark: SparkSession, rule: LineRule = LineRule(), shards: int | None = None, path: str | None = None):
        ship(spark)
        self.spark, self.rule, self.shards = spark, rule, shards
        self.path, self.version = path or scratch(spark, "lines"), 0
        self.postings = spark.createDataFrame([], "key string, doc_id long")
        self.counts = spark.createDataFrame([], COUNTS)
        self.filters = spark.createDataFrame([], FILTERS)

    def _keys(self, docs: DataFrame) -> DataFrame:
        """(key, doc_id), each once: the long lines of documents with an id."""
        each = docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), F.explode(lines(F.col("text"))).alias("line"))
        keyed = each.where(F.length("line") >= self.rule.least_length).select("doc_id", line_key(F.col("line")).alias("key"))
        keyed = keyed.where(F.length("key") >= self.rule.least_length)
        return keyed.select(F.md5("key").alias("key"), "doc_id").distinct()

    def _shard(self, key: Column) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(self.shards)).cast("int")

    def _save(self, frame: DataFrame, name: str) -> DataFrame:
        path = f"{self.path}/v{self.version}/{name}"
        frame.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(frame.schema).parquet(path)

    def _filtered(self, keys: DataFrame) -> DataFrame:
        """Adds ``known`` to ``keys(shard, key, ...)``: false where the shard's filter rules the key out."""
        schema = f"{', '.join(f'{f.name} {f.dataType.simpleString()}' for f in keys.schema.fields)}, known boolean"

        def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
            if not len(right):
                return left.assign(known=False)
            held = CuckooFilter(np.frombuffer(right["cuckoo"].iloc[0], np.uint16).copy())
            return left.assign(known=held.contains(_hashes(left["key"])))
        return keys.groupBy("shard").cogroup(self.filters.groupBy("shard")).applyInPandas(run, schema)

    def insert(self, docs: DataFrame) -> LineIndex:
        """Adds documents that the index does not hold; rows that repeat a document count once."""
        self.version += 1
        found = self._save(self._keys(docs), "postings")
        if self.shards is None:
            self.shards = max(16, -(-found.agg(F.approx_count_distinct("key")).first()[0] // SHARD_KEYS))
        # Documents that come again must not be counted twice.
        if not self.postings.isEmpty():
            found = self._save(found.join(self.postings, ["key", "doc_id"], "left_anti"), "fresh")
        fresh = found.groupBy("key").agg(F.count(F.lit(1)).alias("docs"), F.max("doc_id").alias("holder"))
        fresh = fresh.select(self._shard(F.col("key")).alias("shard"), "key", "docs", "holder")
        if self.version == 1:
            counts = self._save(fresh, "counts")
        else:
            asked = stored(self._filtered(fresh), "asked")
            known, new = asked.where("known").drop("known"), asked.where("not known").drop("known")
            merged = self.counts.join(known.select("key", F.col("docs").alias("more"), F.col("holder").alias("later")), "key", "left").select(
                "shard", "key", (F.col("docs") + F.coalesce("more", F.lit(0))).alias("docs"), F.greatest("holder", "later").alias("holder"))
            # The filter may take a new key for a known one; the exact table decides.
            false = known.join(self.counts.select("key"), "key", "left_anti").select("shard", "key", "docs", "holder")
            counts = self._save(merged.unionByName(new).unionByName(false), "counts")
            fresh = new.unionByName(false)
        held = counts.count()
        if held > 2 * SHARD_KEYS * self.shards:
            self.shards = -(-held // SHARD_KEYS)
            counts = self._save(counts.withColumn("shard", self._shard(F.col("key"))), "dealt")
            self.filters = self._save(_built(counts), "filters")
        else:
            self.filters = self._save(self._changed(fresh.select("shard", "key"), counts, grown=True), "filters")
        self.counts, self.postings = counts, self.postings.unionByName(found)
        return self

    def delete(self, docs: DataFrame) -> LineIndex:
        """Takes documents (by doc_id) out again; ids that the index does not hold are ignored."""
        self.version += 1
        ids = docs.select(F.col("doc_id").cast("long").alias("doc_id")).where("doc_id is not null").distinct()
        gone = stored(self.postings.join(ids, "doc_id", "left_semi").select("key", "doc_id"), "gone")
        postings = self._save(self.postings.join(ids, "doc_id", "left_anti").select("key", "doc_id"), "postings")
        touched = gone.groupBy("key").agg(F.count(F.lit(1)).alias("fewer"))
        # A key may lose its holder, so touched keys get theirs from the postings that stay.
        holders = postings.join(touched, "key", "left_semi").groupBy("key").agg(F.max("doc_id").alias("later"))
        counts = (self.counts.join(touched, "key", "left").join(holders, "key", "left")
                  .select("shard", "key", (F.col("docs") - F.coalesce("fewer", F.lit(0))).alias("docs"),
                          F.when(F.col("fewer").isNull(), F.col("holder")).otherwise(F.col("later")).alias("holder")))
        dead = stored(counts.where("docs = 0").select("shard", "key"), "dead")
        counts = self._save(counts.where("docs > 0"), "counts")
        self.filters = self._save(self._changed(dead, counts, grown=False), "filters")
        self.counts, self.postings = counts, postings
        return self

    def _changed(self, keys: DataFrame, counts: DataFrame, grown: bool) -> DataFrame:
        """The filters after the given keys came in or went. A shard whose filter is too small is built from the counts."""
        def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
            changed = _hashes(left["key"])
            shard = int((left if len(left) else right)["shard"].iloc[0])
            held = CuckooFilter(np.frombuffer(right["cuckoo"].iloc[0], np.uint16).copy()) if len(right) else None
            size = int(right["keys"].iloc[0]) if len(right) else 0
            size += len(changed) if grown else -len(changed)
            if grown and held is None:
                held = CuckooFilter.of(changed)
            elif grown and (size > held.table.size * LOAD or not held.insert(changed)):
                return pd.DataFrame({"shard": [shard], "keys": [size], "cuckoo": [None]})
            elif not grown:
                held.delete(changed)
            return pd.DataFrame({"shard": [shard], "keys": [size], "cuckoo": [held.table.tobytes()]})

        made = stored(keys.groupBy("shard").cogroup(self.filters.groupBy("shard")).applyInPandas(run, FILTERS), "filters")
        full = made.where("cuckoo is null").select("shard")
        if full.isEmpty():
            return made
        return made.where("cuckoo is not null").unionByName(_built(counts.join(full, "shard", "left_semi")))

    def known(self, docs: DataFrame) -> DataFrame:
        """(key, docs, holder) of the line keys of ``docs`` that the index holds: filters first, then the exact counts."""
        keys = self._keys(docs).select(self._shard(F.col("key")).alias("shard"), "key").distinct()
        return self._filtered(keys).where("known").select("key").join(self.counts.select("key", "docs", "holder"), "key")

    def drops(self) -> DataFrame:
        """(key, doc_id) of every document that loses the lines of a key."""
        common = self.counts.where(F.col("docs") >= self.rule.least_docs).select("key", "holder")
        return self.postings.join(common, "key").where("doc_id != holder").select("key", "doc_id")


def _built(counts: DataFrame) -> DataFrame:
    """Filters of whole shards, from the counts."""
    def build(group: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"shard": [int(group["shard"].iloc[0])], "keys": [len(group)],
                             "cuckoo": [CuckooFilter.of(_hashes(group["key"])).table.tobytes()]})
    return counts.select("shard", "key").groupBy("shard").applyInPandas(build, FILTERS)


def _hashes(keys: pd.Series) -> np.ndarray:
    """64 bits of hex digests."""
    return np.array([int(key[:16], 16) for key in keys], np.uint64).view(np.int64)


def without_common_lines(docs: DataFrame, index: LineIndex) -> DataFrame:
    """``docs`` with n_lines, n_dropped and kept (the text of the lines that stay), from the decisions of ``index``.

    A document without an id loses no line and counts for no key; rows that repeat a document all lose the same lines. Columns with
    a name of the result are replaced; others may have any name.
    """
    made = ("n_lines", "n_dropped", "kept")
    columns = [name for name in docs.columns if name not in made]
    lost = index.drops().groupBy("doc_id").agg(F.collect_set("key").alias("lost"))
    packed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.struct(*columns).alias("_row"))
    rows = packed.join(lost, "doc_id", "left")
    cut = lines(F.col("_row.text"))
    stays = F.filter(cut, lambda line: ~F.array_contains("lost", F.md5(line_key(line))))
    rows = rows.withColumn("n_lines", F.size(cut).cast("long")).withColumn("stay", F.when(F.col("lost").isNull(), cut).otherwise(stays))
    return rows.select(*(F.col("_row")[name].alias(name) for name in columns), "n_lines", (F.col("n_lines") - F.size("stay")).alias("n_dropped"),
                       F.array_join("stay", "\n").alias("kept"))
