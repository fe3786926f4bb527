"""Incremental line de-duplication that can be undone: cuckoo filters before exact reference tables.

An index holds which documents use which line. Line keys are dealt out to shards by the first bits of
their digest, and every shard has a cuckoo filter with one fingerprint for each key in use. A batch of
documents asks the filters first: what they do not know is new and needs no look at earlier data. Only
what they know is met with the exact tables, which settle false alarms, counts and the smallest id.
Deleting documents takes their references away, keys without any leave the filters again, and keys
whose first document went get the next one.

A digest is the first 16 bytes of SHA-256 of a key, so equal digests stand for equal keys.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from billstream.llm.common import in_arrow, scratch_path, slices, stored, texts_of

#: Code points a key needs to count, and documents that have to hold it.
LEAST_POINTS = 10
WHITE = b" \t\n\x0b\x0c\r"
#: Keys of a shard on average before shards are split; its filter has twice as many slots.
SHARD_KEYS = 1 << 14
BUCKETS, SLOTS = 1 << 13, 4
#: Rounds of eviction after which fingerprints are kept beside the filter.
KICKS = 200
#: Batches in which the registered query hands over the table.
BATCHES = 2


def line_key(line: bytes) -> bytes | None:
    """Digest of a line's key, None where the key is too short to count."""
    key = line.strip(WHITE).lower()  # bytes: A to Z alone
    if len(key) < LEAST_POINTS or (len(key) < 4 * LEAST_POINTS and len(key.decode()) < LEAST_POINTS):
        return None
    return sha256(key).digest()[:16]


class CuckooFilter:
    """A set of 16-bit fingerprints in buckets of four; each has two buckets, one known from the other."""

    def __init__(self, slots: bytes | None = None, beside: bytes | None = None, buckets: int = BUCKETS):
        self.table = np.zeros((buckets, SLOTS), np.uint16)
        if slots:
            self.table = np.frombuffer(slots, np.uint16).reshape(-1, SLOTS).copy()
        #: Fingerprints that found no slot, with their bucket.
        self.beside = np.frombuffer(beside or b"", np.int64).reshape(-1, 2).copy()

    def places(self, digests: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Fingerprint and first bucket; the shard is told by other bytes."""
        raw = np.frombuffer(b"".join(digests), np.uint8).reshape(-1, 16)
        mark = np.maximum(raw[:, 8:10].copy().view("<u2").ravel(), 1)
        return mark, raw[:, 10:14].copy().view("<u4").ravel().astype(np.int64) & (len(self.table) - 1)

    def other(self, mark: np.ndarray, bucket: np.ndarray) -> np.ndarray:
        return bucket ^ (mark.astype(np.int64) * 0x5BD1E995 >> 5) & (len(self.table) - 1)

    def contains(self, mark: np.ndarray, bucket: np.ndarray) -> np.ndarray:
        twin = self.other(mark, bucket)
        found = ((self.table[bucket] == mark[:, None]) | (self.table[twin] == mark[:, None])).any(1)
        for m, b in self.beside.tolist():
            found |= (mark == m) & ((bucket == b) | (twin == b))
        return found

    def insert(self, mark: np.ndarray, bucket: np.ndarray) -> None:
        mark, bucket, moved = mark.copy(), bucket.copy(), np.zeros(len(mark), bool)
        for kick in range(KICKS):
            if not len(mark):
                return
            order = np.argsort(bucket, kind="stable")
            mark, bucket, moved = mark[order], bucket[order], moved[order]
            rank = np.arange(len(bucket)) - np.searchsorted(bucket, bucket, side="left")
            free = self.table[bucket] == 0
            fits = rank < free.sum(1)
            slot = np.argsort(~free, axis=1, kind="stable")[np.arange(len(rank)), np.minimum(rank, SLOTS - 1)]
            self.table[bucket[fits], slot[fits]] = mark[fits]
            mark, bucket, moved = mark[~fits], bucket[~fits], moved[~fits]
            # Who was turned away tries the twin bucket; who was turned away there too, one a bucket, evicts.
            first = np.concatenate([[True], bucket[1:] != bucket[:-1]])[: len(bucket)]
            evicts = moved & first
            at = bucket[evicts]
            victim = self.table[at, kick % SLOTS]
            self.table[at, kick % SLOTS] = mark[evicts]
            mark[evicts] = victim
            bucket, moved = self.other(mark, bucket), ~moved | evicts
        self.beside = np.concatenate([self.beside, np.stack([mark.astype(np.int64), bucket], axis=1)])

    def remove(self, mark: np.ndarray, bucket: np.ndarray) -> None:
        """Take one copy of each fingerprint out; they must have been inserted."""
        while len(mark):
            # Equal fingerprints of one pair of buckets go one by one.
            pair = np.minimum(bucket, self.other(mark, bucket)) << 16 | mark
            _, now = np.unique(pair, return_index=True)
            m, b = mark[now], bucket[now]
            here = (self.table[b] == m[:, None]).any(1)
            b = np.where(here, b, self.other(m, b))
            same = self.table[b] == m[:, None]
            found = same.any(1)
            self.table[b[found], same[found].argmax(1)] = 0
            for one, place in zip(m[~found].tolist(), b[~found].tolist()):
                match = np.nonzero((self.beside[:, 0] == one) & np.isin(self.beside[:, 1], [place, int(self.other(np.array([one], np.uint16), np.array([place]))[0])]))[0]
                self.beside = np.delete(self.beside, match[:1], axis=0)
            left = np.ones(len(mark), bool)
            left[now] = False
            mark, bucket = mark[left], bucket[left]


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in slices(batches):
        ids, digests = [], []
        for doc_id, text in zip(part["doc_id"].to_pylist(), part["text"].to_pylist()):
            found = {line_key(line) for line in text.encode().split(b"\n")} - {None}
            digests += found
            ids += [doc_id] * len(found)
        yield pa.RecordBatch.from_arrays([pa.array(digests, pa.binary()), pa.array(ids, pa.int64())], ["digest", "doc_id"])


ASKED = "shard int, digest binary, refs long, first_id long, known boolean, slots binary, beside binary"


def _through_filters(change: str) -> Callable:
    """Rows sorted by shard, its filter first: the keys with ``known``, then the filter afterwards.

    ``ask`` marks the keys that the filter knows and inserts the others, ``add`` inserts all keys,
    ``remove`` takes them out. One filter is held at a time.
    """
    schema = pa.schema(
        [("shard", pa.int32()), ("digest", pa.binary()), ("refs", pa.int64()), ("first_id", pa.int64()), ("known", pa.bool_()), ("slots", pa.binary()), ("beside", pa.binary())]
    )

    def through(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, held = None, None

        def done() -> pa.RecordBatch:
            row = {"shard": shard, "slots": held.table.tobytes(), "beside": held.beside.tobytes()}
            return pa.RecordBatch.from_pylist([row], schema=schema)

        for batch in batches:
            shards = np.array(batch["shard"])
            cuts = [0, *(np.nonzero(shards[1:] != shards[:-1])[0] + 1).tolist(), len(shards)]
            for start, end in zip(cuts, cuts[1:]):
                if start == end:
                    continue
                rows = batch.slice(start, end - start)
                if shards[start] != shard:
                    if held is not None:
                        yield done()
                    shard, held = int(shards[start]), CuckooFilter()
                if rows["digest"][0].as_py() is None:
                    held = CuckooFilter(rows["slots"][0].as_py(), rows["beside"][0].as_py())
                    rows = rows.slice(1)
                if not rows.num_rows:
                    continue
                mark, bucket = held.places(rows["digest"].to_pylist())
                if change == "remove":
                    held.remove(mark, bucket)
                elif change == "add":
                    held.insert(mark, bucket)
                else:
                    known = held.contains(mark, bucket)
                    held.insert(mark[~known], bucket[~known])
                    nothing = pa.nulls(rows.num_rows, pa.binary())
                    yield pa.RecordBatch.from_arrays([*(rows[c] for c in ("shard", "digest", "refs", "first_id")), pa.array(known), nothing, nothing], schema=schema)
        if held is not None:
            yield done()

    return through


TABLES = {
    #: Every use of a key by a document: +1 when it came, -1 when it went.
    "refs": "digest binary, doc_id long, change int, batch int",
    #: Documents that came and went.
    "docs": "doc_id long, change int, batch int",
    #: Number of references and smallest document after a batch, of keys that had several.
    "shared": "digest binary, refs long, first_id long, batch int",
    "filters": "shard int, slots binary, beside binary, batch int",
    #: One row for each batch, written last: a batch without it never was.
    "log": "kind string, depth int, keys long, batch int",
}


class LineIndex:
    """Which documents hold which line, in a folder that all executors share.

    Every batch adds files and changes none; a job that dies half way leaves a batch that nobody
    reads and the next one overwrites. One writer at a time.
    """

    def __init__(self, spark: SparkSession, folder: str, shard_keys: int = SHARD_KEYS):
        self.spark, self.folder, self.shard_keys = spark, folder, shard_keys
        self.log: list = []

    @classmethod
    def opened(cls, spark: SparkSession, folder: str, shard_keys: int = SHARD_KEYS) -> LineIndex:
        """The index that earlier sessions left in a folder."""
        index = cls(spark, folder, shard_keys)
        index.log = spark.read.schema(TABLES["log"]).parquet(f"{folder}/log").orderBy("batch").collect()
        return index

    def insert(self, docs: DataFrame) -> None:
        """Add documents. Ids that the index holds already are left out: delete them first.

        Rows of one id are one document; rows with a null id are not held.
        """
        rows = texts_of(docs).where("doc_id is not null")
        if self.log:
            # Ids alone are compared; the usual batch brings none that is held, and its texts stay where they are.
            held = stored(rows.select("doc_id").join(self._live("docs", "doc_id"), "doc_id", "left_semi").distinct(), "line-held")
            rows = rows.join(held, "doc_id", "left_anti")
        batch = len(self.log)
        self._write("docs", batch, rows.select("doc_id").distinct().withColumn("change", F.lit(1)))
        refs = self._write("refs", batch, in_arrow(rows, _keys, "digest binary, doc_id long").distinct().withColumn("change", F.lit(1)))
        # One row for each key, combined before the shuffle, whatever number of documents holds it.
        keys = stored(refs.groupBy("digest").agg(F.count("*").alias("refs"), F.min("doc_id").alias("first_id")), "line-keys")
        count = keys.count()
        depth, filters = self._filters(count)
        asked = stored(self._pass(keys, filters, depth, "ask"), "line-asked")
        known = asked.where("known")
        old = self._looked_up(known.select("digest"), with_first=True)
        met = stored(
            known.join(old, "digest", "left").select("digest", "refs", "first_id", "old_refs", "old_first"), "line-met"
        )
        # What the filter knew by mistake has to be inserted after all.
        missed = met.where("old_refs is null").select("digest", "refs", "first_id")
        self._write("filters", batch, self._pass(missed, asked.where("slots is not null"), depth, "add").select("shard", "slots", "beside"))
        total = F.col("refs") + F.coalesce("old_refs", F.lit(0))
        first = F.least("first_id", "old_first")
        new = asked.where("not known").select("digest", "refs", "first_id")
        shared = new.union(met.select("digest", total.alias("refs"), first.alias("first_id")))
        self._write("shared", batch, shared.where("refs > 1"))
        repeated = met.where("old_refs is not null").count()
        self._commit("insert", depth, self._size() + count - repeated)

    def delete(self, ids: DataFrame) -> None:
        """Take documents (column ``doc_id``) out; ids that the index does not hold change nothing."""
        batch = len(self.log)
        if not batch:
            return
        gone = stored(ids.select(F.col("doc_id").cast("long").alias("doc_id")).join(self._live("docs", "doc_id"), "doc_id", "left_semi").distinct(), "line-gone")
        self._write("docs", batch, gone.withColumn("change", F.lit(-1)))
        lost = self._net(self._read("refs").join(gone, "doc_id", "left_semi")).withColumn("change", F.lit(-1))
        lost = self._write("refs", batch, lost)
        keys = stored(lost.groupBy("digest").agg(F.count("*").alias("lost"), F.min("doc_id").alias("least")), "line-keys")
        left = stored(
            keys.join(self._looked_up(keys.select("digest"), with_first=True), "digest")
            .select("digest", (F.col("old_refs") - F.col("lost")).alias("refs"), "old_refs", "old_first", "least"),
            "line-left",
        )
        # Only where the smallest document went is the next one looked for among the references.
        headless = left.where("refs > 0 and old_first = least").select("digest")
        again = self._net(self._read("refs", batch + 1).join(headless, "digest", "left_semi")).groupBy("digest").agg(F.min("doc_id").alias("next_id"))
        shared = left.join(again, "digest", "left").where("old_refs > 1")
        self._write("shared", batch, shared.select("digest", "refs", F.coalesce("next_id", "old_first").alias("first_id")))
        unused = left.where("refs = 0").select("digest", "refs", F.col("least").alias("first_id"))
        depth = self.log[-1].depth
        self._write("filters", batch, self._pass(unused, self._latest_filters(), depth, "remove").select("shard", "slots", "beside"))
        self._commit("delete", depth, self._size() - unused.count())

    def shared(self) -> DataFrame:
        """``digest``, ``refs``, ``first_id`` of the keys that several documents hold."""
        latest = F.max_by(F.struct("refs", "first_id"), "batch").alias("now")
        return self._read("shared").groupBy("digest").agg(latest).select("digest", "now.refs", "now.first_id").where("refs > 1")

    def dropped(self) -> DataFrame:
        """``doc_id`` and the digests of the lines that an earlier document holds."""
        # Written first: adaptive execution splits a hot digest only between bare tables.
        shared = stored(self.shared().select("digest", "first_id"), "line-shared")
        refs = self._net(self._read("refs")) if any(b.kind == "delete" for b in self.log) else self._read("refs").select("digest", "doc_id")
        return refs.join(shared, "digest").where("doc_id > first_id").groupBy("doc_id").agg(F.collect_list("digest").alias("dropped"))

    def _write(self, name: str, batch: int, rows: DataFrame) -> DataFrame:
        rows.write.mode("overwrite").parquet(f"{self.folder}/{name}/batch={batch}")
        return self.spark.read.schema(rows.schema).parquet(f"{self.folder}/{name}/batch={batch}")

    def _read(self, name: str, batches: int | None = None) -> DataFrame:
        """The rows of all batches that were written whole (or of the first so many)."""
        paths = [f"{self.folder}/{name}/batch={i}" for i in range(len(self.log) if batches is None else batches)]
        return self.spark.read.schema(TABLES[name]).option("basePath", f"{self.folder}/{name}").parquet(*paths)

    def _commit(self, kind: str, depth: int, keys: int) -> None:
        batch = len(self.log)
        row = self.spark.range(1).select(F.lit(kind).alias("kind"), F.lit(depth).alias("depth"), F.lit(keys).cast("long").alias("keys"))
        self._write("log", batch, row.coalesce(1))
        self.log.append(self._read("log", batch + 1).where(F.col("batch") == batch).first())

    def _size(self) -> int:
        return self.log[-1]["keys"] if self.log else 0

    def _net(self, refs: DataFrame) -> DataFrame:
        return refs.groupBy("digest", "doc_id").agg(F.sum("change").alias("uses")).where("uses > 0").select("digest", "doc_id")

    def _live(self, name: str, key: str) -> DataFrame:
        return self._read(name).groupBy(key).agg(F.sum("change").alias("uses")).where("uses > 0").select(key)

    def _looked_up(self, digests: DataFrame, with_first: bool) -> DataFrame:
        """``digest``, ``old_refs``, ``old_first`` of those keys that earlier batches left in use."""
        if not self.log:
            return self.spark.createDataFrame([], "digest binary, old_refs long, old_first long")
        many = self.shared().join(digests, "digest", "left_semi").select("digest", F.col("refs").alias("old_refs"), F.col("first_id").alias("old_first"))
        many = stored(many, "line-many")
        rest = digests.join(many, "digest", "left_anti")
        one = self._net(self._read("refs").join(rest, "digest", "left_semi")).groupBy("digest").agg(F.count("*").alias("old_refs"), F.min("doc_id").alias("old_first"))
        return many.union(one)

    def _latest_filters(self) -> DataFrame:
        filters = self._read("filters")
        latest = filters.groupBy("shard").agg(F.max("batch").alias("batch"))
        return filters.join(latest, ["shard", "batch"]).select("shard", "slots", "beside")

    def _filters(self, more: int) -> tuple[int, DataFrame]:
        """Bits that tell the shard, and the filters; rebuilt from the references where shards get full."""
        wanted = max(0, (max(1, self._size() + more) - 1) // self.shard_keys).bit_length()
        empty = self.spark.createDataFrame([], "shard int, slots binary, beside binary")
        if not self.log:
            return wanted, empty
        if wanted <= self.log[-1].depth:
            return self.log[-1].depth, self._latest_filters()
        live = self._net(self._read("refs")).groupBy("digest").agg(F.count("*").alias("refs"), F.min("doc_id").alias("first_id"))
        return wanted, stored(self._pass(live, empty, wanted, "add").select("shard", "slots", "beside"), "line-filters")

    def _pass(self, keys: DataFrame, filters: DataFrame, depth: int, change: str) -> DataFrame:
        head = F.conv(F.hex(F.substring("digest", 1, 4)), 16, 10).cast("long")
        nothing = F.lit(None).cast("binary")
        rows = keys.select(
            F.shiftright(head, 32 - depth).cast("int").alias("shard"), F.lit(1).alias("kind"), "digest", "refs", "first_id",
            nothing.alias("slots"), nothing.alias("beside"),
        )
        none = F.lit(None).cast("long")
        held = filters.select("shard", F.lit(0).alias("kind"), nothing.alias("digest"), none.alias("refs"), none.alias("first_id"), "slots", "beside")
        tasks = int(self.spark.conf.get("spark.sql.shuffle.partitions", "200"))
        both = rows.union(held).repartition(tasks, "shard").sortWithinPartitions("shard", "kind").drop("kind")
        return in_arrow(both, _through_filters(change), ASKED)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in slices(batches):
        out = []
        for text, dropped in zip(part["text"].to_pylist(), part["dropped"].to_pylist()):
            lines = text.encode().split(b"\n")
            n = len(lines)
            if dropped:
                gone = set(dropped)
                lines = [line for line in lines if line_key(line) not in gone]
            kept = b"\n".join(lines)
            out.append((n, n - len(lines), sha256(kept).hexdigest(), kept.decode()))
        columns = list(zip(*out))
        yield pa.RecordBatch.from_arrays(
            [part["doc_id"], *(pa.array(c, pa.int64()) for c in columns[:2]), pa.array(columns[2]), pa.array(columns[3])],
            ["doc_id", "n_lines", "n_dropped", "kept_sha256", "kept_text"],
        )


def drop_known_lines(docs: DataFrame, index: LineIndex) -> DataFrame:
    """One row per row of ``documents``: line counts, the digest of what is left, and it as text.

    A line's key is the line without ASCII white space at both ends, A to Z in lower case. Keys of
    at least ten code points that several documents of the index hold lose their lines everywhere
    but in the document with the smallest id; there all of them stay. Null and empty texts are one
    empty line. Rows of one id are one document; rows with a null id, and documents that the index
    does not hold, lose nothing. An empty table gives no row; other columns are ignored.
    """
    texts, dropped = texts_of(docs), index.dropped()
    with_id = texts.where("doc_id is not null").join(dropped, "doc_id", "left").select("doc_id", "text", "dropped")
    # Apart: null ids would meet in one task of the join.
    without = texts.where("doc_id is null").select("doc_id", "text", F.lit(None).cast("array<binary>").alias("dropped"))
    return in_arrow(with_id.union(without), _cut, "doc_id long, n_lines long, n_dropped long, kept_sha256 string, kept_text string")


def op11_line_dedup(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    index = LineIndex(spark, scratch_path(spark, "line-index"))
    for batch in range(BATCHES):
        index.insert(docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(BATCHES)) == batch))
    return drop_known_lines(docs, index).drop("kept_text")


OP11_SQL = """
    WITH lines AS (
      SELECT doc_id, row, generate_subscripts(parts, 1) AS i, unnest(parts) AS line
      FROM (SELECT doc_id, row_number() OVER () AS row, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents)),
    keyed AS (
      SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
    shared AS (
      SELECT key, min(doc_id) AS first_id FROM keyed WHERE length(key) >= 10
      GROUP BY key HAVING count(DISTINCT doc_id) > 1),
    marked AS (
      SELECT k.*, coalesce(k.doc_id > s.first_id, false) AS gone FROM keyed k LEFT JOIN shared s ON k.key = s.key)
    SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
           sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
    FROM marked GROUP BY doc_id, row"""
