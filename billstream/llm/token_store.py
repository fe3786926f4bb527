"""Token ids as shards of raw bytes, with a minimal perfect hash index from document to offset.

``write_token_store`` encodes texts and writes one Parquet row per shard: ``payload`` holds the ids
of the shard's documents one after another (little-endian, two bytes where the vocabulary allows),
in ascending ``doc_id``. Beside it stand the index of the shard's document ids (bit levels of a
minimal perfect hash, a fingerprint and a row number for each slot) and the row offsets. Spark's
writers commit the files, so a lost executor only repeats its tasks.
"""

from __future__ import annotations

import gc
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from billstream.llm.common import in_arrow, scratch_path, slices, texts_of

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: Bytes of ids after which a shard is closed.
SHARD_BYTES = 4 << 20
#: Distinct words whose ids a Python worker keeps; then it starts anew.
KEPT_WORDS = 400_000
#: The same for the lower-case letters of words, whose ids cost most.
KEPT_CORES = 1_200_000
#: Slots of a hash level for each key that is left.
SLACK = 2
LEVELS = 64
STORE = (
    "shard long, first_id long, last_id long, n_docs long, n_ids long, width int, payload binary, doc_ids array<long>, "
    "offsets array<long>, levels array<int>, bits binary, slots binary, left_over array<long>"
)


# ---- minimal perfect hash -------------------------------------------------------------------


def mixed(keys: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit finalizer over keys (as unsigned) and a seed."""
    x = keys.astype(np.int64, copy=False).view(np.uint64) + np.uint64((seed + 1) * 0x9E3779B97F4A7C15 % 2**64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def fingerprint(keys: np.ndarray) -> np.ndarray:
    return mixed(keys, LEVELS + 1).astype(np.uint32)


def build_hash(keys: np.ndarray) -> tuple[list[int], np.ndarray, np.ndarray]:
    """Sizes of the levels, their bits (one array), and keys that no level could place.

    A key alone on its place of a level sets that bit; keys that share a place go to the next level.
    """
    sizes, bits, left = [], [], keys
    while len(left) and len(sizes) < LEVELS:
        size = SLACK * len(left) + 1
        place = (mixed(left, len(sizes)) % np.uint64(size)).astype(np.int64)
        alone = np.bincount(place, minlength=size) == 1
        sizes.append(size)
        bits.append(alone)
        left = left[~alone[place]]
    return sizes, np.concatenate(bits) if bits else np.zeros(0, bool), left


def slot_of(keys: np.ndarray, sizes: list[int], bits: np.ndarray, left: np.ndarray) -> np.ndarray:
    """The slot of each key, 0 to n-1; for a key that was not indexed any slot or -1."""
    ranks = np.cumsum(bits) - bits
    slot, open_ = np.full(len(keys), -1, np.int64), np.arange(len(keys))
    base = 0
    for level, size in enumerate(sizes):
        place = base + (mixed(keys[open_], level) % np.uint64(size)).astype(np.int64)
        hit = bits[place]
        slot[open_[hit]] = ranks[place[hit]]
        open_ = open_[~hit]
        base += size
    if len(left) and len(open_):
        at = np.minimum(np.searchsorted(left, keys[open_]), len(left) - 1)
        hit = left[at] == keys[open_]
        slot[open_[hit]] = int(bits.sum()) + at[hit]
    return slot


def build_index(keys: np.ndarray) -> dict:
    """Index of sorted keys that may repeat: slots hold fingerprint, first row and number of rows."""
    unique, first, count = np.unique(keys, return_index=True, return_counts=True)
    sizes, bits, left = build_hash(unique)
    left = np.sort(left)
    slots = np.zeros(len(unique), [("mark", "<u4"), ("row", "<u4"), ("rows", "<u4")])
    at = slot_of(unique, sizes, bits, left)
    slots["mark"][at], slots["row"][at], slots["rows"][at] = fingerprint(unique), first, count
    return {"levels": sizes, "bits": np.packbits(bits).tobytes(), "slots": slots.tobytes(), "left_over": left.tolist()}


def look_up(index: dict, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First row and number of rows for each key; 0 rows where the fingerprint differs."""
    slots = np.frombuffer(index["slots"], [("mark", "<u4"), ("row", "<u4"), ("rows", "<u4")])
    if not len(slots):
        return np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
    bits = np.unpackbits(np.frombuffer(index["bits"], np.uint8), count=sum(index["levels"])).astype(bool)
    at = slot_of(keys, index["levels"], bits, np.array(index["left_over"], np.int64))
    found = slots[np.maximum(at, 0)]
    known = (at >= 0) & (found["mark"] == fingerprint(keys))
    return np.where(known, found["row"], 0).astype(np.int64), np.where(known, found["rows"], 0).astype(np.int64)


# ---- encoding -------------------------------------------------------------------------------

#: str.split() also cuts at these, which the tokenizer takes as ordinary characters.
SEPARATORS = "\x1c\x1d\x1e\x1f"
SPACES = re.compile(r"[ \t\n\r\f\v]+")


class WordEncoder:
    """Ids of whole texts, word by word, with the ids of the words seen kept.

    The tokenizer turns white space into single spaces and never joins characters across one, so the
    ids of a text are those of its words. Words not yet known are encoded together, with a mark
    between them whose one id separates their ids again.
    """

    MARK = "\x01"

    def __init__(self, tokenizer_path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_path)
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        self.kept: dict[str, bytes] = {}
        self.cores: dict[str, bytes] = {}
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.mark = self.tokenizer.encode(self.MARK, add_special_tokens=False).ids

    def _ids(self, texts: list[str]) -> list[list[int]]:
        return [x.ids for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn_letters(self, words: list[str]) -> None:
        """Words that are one piece each: the ids of one end with the first that ends a piece."""
        w = self.width
        for i in range(0, len(words), 200):
            part = words[i : i + 200]
            ids = np.array(self._ids([" ".join(part)])[0], f"<u{w}")
            raw, edges = ids.tobytes(), [0, *((np.nonzero(self.ends[ids])[0] + 1) * w).tolist()]
            if len(edges) != len(part) + 1:
                raise ValueError("a word of letters is not one piece of this tokenizer")
            self.cores.update((word, raw[a:b]) for word, a, b in zip(part, edges, edges[1:]))

    def _learn(self, words: list[str]) -> None:
        kind = f"<u{self.width}"
        plain = [w for w in words if self.MARK not in w and len(w) < 1000]
        odd = [w for w in words if self.MARK in w or len(w) >= 1000] if len(self.mark) == 1 else words
        if len(self.mark) != 1:
            plain = []
        for i in range(0, len(plain), 2000):
            part = plain[i : i + 2000]
            ids = np.array(self._ids([f" {self.MARK} ".join(part)])[0], kind)
            cuts = np.nonzero(ids == self.mark[0])[0]
            if len(cuts) != len(part) - 1:
                odd = odd + part
                continue
            raw, edges = ids.tobytes(), [0, *(cuts + 1).tolist(), len(ids) + 1]
            w = self.width
            self.cores.update((word, raw[a * w : (b - 1) * w]) for word, a, b in zip(part, edges, edges[1:]))
        for i in range(0, len(odd), 1000):
            part = odd[i : i + 1000]
            self.cores.update((word, np.array(ids, kind).tobytes()) for word, ids in zip(part, self._ids(part)))

    def _remember(self, words: set[str]) -> None:
        """Keep the ids of new words; one of letters and a comma or stop is put together from its parts."""
        if len(self.cores) > KEPT_CORES:
            self.cores = {}
        parts, plain = [], {".", ","}
        for word in words:
            core, tail = (word[:-1], word[-1]) if word[-1:] in (".", ",") else (word, "")
            if core.isalpha() and (core.isascii() or core.isprintable() and max(core) < "\u0100"):
                core = core.lower()
                plain.add(core)
                parts.append((word, core, tail))
            else:
                parts.append((word, word, ""))
        cores = self.cores
        self._learn_letters([c for c in plain if c not in cores])
        self._learn([c for _, c, _ in parts if c and c not in cores])
        cores[""] = b""
        self.kept.update([(word, cores[core] + cores[tail]) for word, core, tail in parts])

    def encode(self, texts: list[str]) -> list[bytes]:
        split = [SPACES.split(t) if any(c in t for c in SEPARATORS) else t.split() for t in texts]
        if len(self.kept) > KEPT_WORDS:
            self.kept = {}
        # Millions of small objects without cycles: the collector would only walk them.
        gc.disable()
        try:
            return self._encode(split)
        finally:
            gc.enable()

    def _encode(self, split: list[list[str]]) -> list[bytes]:
        seen: set[str] = set()
        for words in split:
            seen.update(words)
        self._remember(seen.difference(self.kept))
        get = self.kept.__getitem__
        return [b"".join(map(get, words)) for words in split]


_ENCODERS: dict[str, WordEncoder] = {}


def word_encoder(path: str) -> WordEncoder:
    """The encoder of this Python worker, kept from task to task."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


# ---- the store ------------------------------------------------------------------------------


def _shard_row(shard: int, ids: list, parts: list[bytes], width: int) -> pa.RecordBatch:
    lengths = np.array([len(p) // width for p in parts], np.int64)
    known = np.array([i for i in ids if i is not None], np.int64)
    # Null ids sort first; the index holds the others and counts rows behind them.
    index = build_index(known)
    row = {
        "shard": shard,
        "first_id": int(known[0]) if len(known) else None,
        "last_id": int(known[-1]) if len(known) else None,
        "n_docs": len(ids),
        "n_ids": int(lengths.sum()),
        "width": width,
        "payload": b"".join(parts),
        "doc_ids": ids,
        "offsets": [0, *np.cumsum(lengths).tolist()],
        **index,
    }
    kinds = {"binary": pa.binary(), "long": pa.int64(), "int": pa.int32()}
    fields = []
    for part in STORE.split(", "):
        name, kind = part.split(" ")
        fields.append((name, pa.list_(kinds[kind[6:-1]]) if kind.startswith("array") else kinds[kind]))
    return pa.RecordBatch.from_pylist([row], schema=pa.schema(fields))


def _shards(tokenizer_path: str, end_id: int, shard_bytes: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_encoder(tokenizer_path)
        end = np.array([end_id], f"<u{encoder.width}").tobytes()
        shard, ids, parts, held = TaskContext.get().partitionId() << 33, [], [], 0
        for part in slices(batches):
            for doc_id, raw in zip(part["doc_id"].to_pylist(), encoder.encode(part["text"].to_pylist())):
                ids.append(doc_id)
                parts.append(raw + end)
                held += len(raw)
                if held >= shard_bytes:
                    yield _shard_row(shard, ids, parts, encoder.width)
                    shard, ids, parts, held = shard + 1, [], [], 0
        if ids:
            yield _shard_row(shard, ids, parts, encoder.width)

    return write


def write_token_store(docs: DataFrame, path: str, tokenizer_path: str, end_id: int, shard_bytes: int = SHARD_BYTES) -> None:
    """Encode ``text`` (null: empty) of ``documents`` and write the store to ``path``.

    Documents lie in ascending ``doc_id`` (null first; rows of one id by text), each with ``end_id``
    at its end. Repeated rows are kept; columns besides ``doc_id`` and ``text`` are ignored. An empty
    table gives a store without shards. One shard is held at a time, and one longer text is whole.
    """
    ordered = texts_of(docs).repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    in_arrow(ordered, _shards(tokenizer_path, end_id, shard_bytes), STORE).write.parquet(path)


def _read_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from zlib import crc32

    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1).to_pylist()[0]
            ids, offsets = row["doc_ids"], np.array(row["offsets"], np.int64)
            payload = np.frombuffer(row["payload"], f"<u{row['width']}")
            nulls = sum(x is None for x in ids)
            known = np.array(ids[nulls:], np.int64)
            first, rows = look_up(row, known)
            # Rows of one id follow each other: the k-th of them is k rows behind the first.
            at = nulls + first + np.arange(len(known)) - np.searchsorted(known, known)
            if (rows == 0).any():
                raise ValueError(f"the index of shard {row['shard']} lacks a document")
            at = np.concatenate([np.arange(nulls), at])
            sums = [crc32(payload[a:b].astype("<u4").tobytes()) for a, b in zip(offsets[at], offsets[at + 1])]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([row["shard"]] * len(ids), pa.int64()),
                    pa.array(ids, pa.int64()),
                    pa.array(offsets[at]),
                    pa.array(offsets[at + 1] - offsets[at]),
                    pa.array(sums, pa.int64()),
                ],
                ["shard", "doc_id", "local", "n_tokens", "ids_crc32"],
            )


def shard_bases(store: DataFrame) -> DataFrame:
    """``shard`` and the ids before it: sums within each writing task, then over the tasks."""
    totals = store.select("shard", "n_ids", F.shiftright("shard", 33).alias("task"))
    within = Window.partitionBy("task").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    over = Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    tasks = totals.groupBy("task").agg(F.sum("n_ids").alias("all")).select(
        "task", F.coalesce(F.sum("all").over(over), F.lit(0)).alias("earlier")
    )
    return totals.withColumn("inside", F.coalesce(F.sum("n_ids").over(within), F.lit(0))).join(tasks, "task").select(
        "shard", (F.col("inside") + F.col("earlier")).alias("base")
    )


def read_token_digests(spark: SparkSession, path: str) -> DataFrame:
    """Read every document back through the index: start, number and checksum of its ids."""
    store = spark.read.parquet(path)
    rows = in_arrow(
        store.select("shard", "width", "payload", "doc_ids", "offsets", "levels", "bits", "slots", "left_over"),
        _read_shards,
        "shard long, doc_id long, local long, n_tokens long, ids_crc32 long",
    )
    return rows.join(shard_bases(store), "shard").select(
        "doc_id", (F.col("base") + F.col("local")).alias("start"), "n_tokens", "ids_crc32"
    )


def _fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1).to_pylist()[0]
            keys, offsets = np.array(row["keys"], np.int64), row["offsets"]
            payload = np.frombuffer(row["payload"], f"<u{row['width']}")
            nulls = sum(x is None for x in row["doc_ids"])
            got_keys, got_ids = [], []
            for key, first, rows in zip(keys, *look_up(row, keys)):
                for at in range(nulls + first, nulls + first + rows):
                    if row["doc_ids"][at] == key:
                        got_keys.append(key)
                        got_ids.append(payload[offsets[at] : offsets[at + 1]].astype(np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(got_keys, pa.int64()), pa.array(got_ids, pa.list_(pa.int64()))], ["doc_id", "ids"]
            )


def fetch_tokens(spark: SparkSession, path: str, keys: DataFrame) -> DataFrame:
    """The ids of the wanted ``doc_id``: one row for each stored row; unknown and null keys give none.

    Keys meet shards by coarse bins of the key range, about two bins for each shard, so neither side
    is copied whole; within a shard each key takes one probe.
    """
    store = spark.read.parquet(path)
    spans = store.agg(F.min("first_id").alias("low"), F.max("last_id").alias("high"), F.count("*").alias("n")).first()
    if not spans["n"] or spans["low"] is None:
        return spark.createDataFrame([], "doc_id long, ids array<long>")
    width = (spans["high"] - spans["low"]) // spans["n"] + 1
    bin_of = lambda c: F.floor((F.col(c) - spans["low"]) / width)
    ranges = store.select("shard", "first_id", "last_id").select(
        "*", F.explode(F.sequence(bin_of("first_id"), bin_of("last_id"))).alias("bin")
    )
    wanted = (
        keys.select(F.col("doc_id").cast("long").alias("key")).where("key is not null").distinct()
        .withColumn("bin", bin_of("key"))
        .join(ranges, "bin").where("key between first_id and last_id")
        .groupBy("shard").agg(F.collect_set("key").alias("keys"))
    )
    return in_arrow(
        store.join(wanted, "shard").select(
            "width", "payload", "doc_ids", "offsets", "levels", "bits", "slots", "left_over", "keys"
        ),
        _fetch,
        "doc_id long, ids array<long>",
    )


END_ID = 2


def op1_token_store(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = scratch_path(spark, "token-store")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    write_token_store(docs, path, public_tokenizers.path("word_bpe_49k.json"), END_ID)
    return read_token_digests(spark, path)
