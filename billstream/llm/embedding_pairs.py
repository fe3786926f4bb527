"""Near-duplicate embeddings by cross-polytope hashing after fast Hadamard rotations.

A hash is the nearest signed axis after three rounds of random signs and a Hadamard transform; a
table joins a few hashes. Each vector lies in its own bucket and in the likeliest neighbouring ones
of every table, and two vectors meet where one of them is at home. What meets is verified by cosine.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from billstream.llm.common import components, in_arrow, stored

LEAST_COSINE = 0.95
#: Tables, hashes of a table, and buckets a vector lies in per table. At a cosine of exactly 0.95 in
#: 64 dimensions a table lets a pair meet with chance 0.78, so ten miss it once in four million.
TABLES, HASHES, PROBES = 10, 2, 4
#: Members of a bucket that one task compares at once; larger buckets are dealt out in such parts.
PART = 2000
ROUNDS = 3


@lru_cache(maxsize=8)
def _signs(size: int, tables: int, hashes: int) -> np.ndarray:
    return np.random.default_rng(size * 1009 + 17).choice([-1.0, 1.0], (tables, hashes, ROUNDS, size))


def hadamard(x: np.ndarray) -> np.ndarray:
    """The normalised Hadamard transform of each row; the length is a power of two."""
    n, size = x.shape
    span = 1
    while span < size:
        pairs = x.reshape(n, -1, 2, span)
        x = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(n, size)
        span *= 2
    return x / np.sqrt(size)


def bucket_codes(units: np.ndarray, tables: int = TABLES, hashes: int = HASHES, probes: int = PROBES) -> np.ndarray:
    """For each row and table the codes of its buckets: the own one, then the likeliest others."""
    n, width = units.shape
    size = 1 << max(1, (width - 1).bit_length())
    x = np.zeros((n, size))
    x[:, :width] = units
    signs = _signs(size, tables, hashes)
    ways = [(0,) * hashes]
    for k in range(hashes):
        ways += [tuple(r if i == k else 0 for i in range(hashes)) for r in (1, 2) if r < size]
    ways += [tuple(int(i in two) for i in range(hashes)) for two in combinations(range(hashes), 2)]
    ways_array = np.array(ways)
    out = np.empty((n, tables, probes), np.int64)
    for t in range(tables):
        code, loss = np.zeros((n, len(ways)), np.int64), np.zeros((n, len(ways)))
        for k in range(hashes):
            y = x
            for turn in signs[t, k]:
                y = hadamard(y * turn)
            top = np.argsort(-np.abs(y), axis=1, kind="stable")[:, :3]
            value = np.take_along_axis(y, top, 1)
            axis = 2 * top + (value < 0)
            code = code * (2 * size) + axis[:, ways_array[:, k]]
            loss += (np.abs(value[:, :1]) - np.abs(value))[:, ways_array[:, k]]
        order = np.argsort(loss, axis=1, kind="stable")[:, :probes]
        chosen = np.take_along_axis(code, order, 1)
        out[:, t] = chosen[:, np.minimum(np.arange(probes), chosen.shape[1] - 1)]
    return out


def _matrix(column: pa.Array) -> np.ndarray:
    """Vectors of one length as rows."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def _unit(x: np.ndarray) -> np.ndarray:
    # Scaled first, so that squares neither overflow nor vanish.
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def _deal(tables: int, hashes: int, probes: int):
    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 2048):
                batch = whole.slice(at, 2048)
                lengths = np.array(batch["size"])
                for size in np.unique(lengths):
                    part = batch.filter(pa.array(lengths == size))
                    codes = bucket_codes(_unit(_matrix(part["embedding"])), tables, hashes, probes)
                    n = len(codes)
                    rows = np.repeat(np.arange(n), tables * probes)
                    table = np.tile(np.repeat(np.arange(tables), probes), n)
                    yield pa.RecordBatch.from_arrays(
                        [
                            part["rep_id"].take(pa.array(rows)),
                            part["size"].take(pa.array(rows)),
                            pa.array(table, pa.int32()),
                            pa.array(codes.reshape(-1)),
                            pa.array(np.tile(np.arange(probes) == 0, n * tables)),
                        ],
                        ["rep_id", "size", "bank", "code", "home"],
                    )

    return deal


def _local_roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest index each of n members reaches over links a, b."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        after = root.copy()
        np.minimum.at(after, a, low)
        np.minimum.at(after, b, low)
        after = after[after]
        if (after == root).all():
            return root
        root = after


def _verify(least: float, tables: int, hashes: int, probes: int):
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None

        def checked(rows: pa.Table) -> pa.RecordBatch:
            rows = rows.combine_chunks()
            keys = [np.array(rows[c]) for c in ("size", "bank", "code", "i", "j")]
            new = np.zeros(len(rows), bool)
            new[0] = True
            for k in keys:
                new[1:] |= k[1:] != k[:-1]
            starts = [*np.nonzero(new)[0].tolist(), len(rows)]
            ids, weight, home, part = (np.array(rows[c]) for c in ("rep_id", "n", "home", "part"))
            vectors = rows["embedding"].chunk(0) if rows["embedding"].num_chunks else pa.array([], pa.list_(pa.float32()))
            found_id, found_n, found_root = [], [], []
            for start, end in zip(starts, starts[1:]):
                if end - start < 2:
                    continue
                x = _unit(_matrix(vectors.slice(start, end - start)))
                own, p, h = ids[start:end], part[start:end], home[start:end]
                near = np.triu(x @ x.T >= least, 1)
                near &= h[:, None] | h[None, :]
                if keys[3][start] != keys[4][start]:  # two parts of a bucket: pairs across alone
                    near &= p[:, None] != p[None, :]
                a, b = np.nonzero(near)
                if not len(a):
                    continue
                root = own[_local_roots(len(own), a, b)]
                add = np.zeros(len(own), np.int64)
                for at in range(0, len(a), 1 << 14):
                    one, two = a[at : at + (1 << 14)], b[at : at + (1 << 14)]
                    used, back = np.unique(np.concatenate([one, two]), return_inverse=True)
                    first = _meetings(x[used], back[: len(one)], back[len(one) :])
                    counted = (first[0] == keys[1][start]) & (first[1] == keys[2][start])
                    np.add.at(add, one[counted], weight[start:end][two[counted]])
                    np.add.at(add, two[counted], weight[start:end][one[counted]])
                linked = near.any(0) | near.any(1)
                found_id.append(own[linked])
                found_n.append(add[linked])
                found_root.append(root[linked])
            many = [np.concatenate(f) if f else np.zeros(0, np.int64) for f in (found_id, found_n, found_root)]
            return pa.RecordBatch.from_arrays([pa.array(m) for m in many], ["rep_id", "links", "root"])

        def _meetings(x: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            codes = bucket_codes(x, tables, hashes, probes)
            none = np.iinfo(np.int64).max
            p, q = codes[a], codes[b]
            met = np.minimum(
                np.where(p == q[:, :, :1], q[:, :, :1], none).min(2), np.where(q == p[:, :, :1], p[:, :, :1], none).min(2)
            )
            table = (met != none).argmax(1)
            return table, met[np.arange(len(a)), table]

        for batch in batches:
            rows = pa.Table.from_batches([batch])
            held = rows if held is None else pa.concat_tables([held, rows])
            # The last bucket may go on in the next batch.
            size, bank, code, i, j = (np.array(held[c]) for c in ("size", "bank", "code", "i", "j"))
            last = (size == size[-1]) & (bank == bank[-1]) & (code == code[-1]) & (i == i[-1]) & (j == j[-1])
            cut = int(len(last) - last.sum())
            if cut:
                yield checked(held.slice(0, cut))
                held = held.slice(cut)
        if held is not None and len(held):
            yield checked(held)

    return verify


def _is_usable() -> Column:
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(F.col("vec_id").isNotNull() & finite & F.exists("embedding", lambda x: x != 0), F.lit(False))


def embedding_groups(
    vectors: DataFrame, least: float = LEAST_COSINE, tables: int = TABLES, hashes: int = HASHES, probes: int = PROBES
) -> DataFrame:
    """One row per row of ``vec_id``, ``embedding``: ``n_links``, ``component_id``, ``kept``.

    Vectors that are null, empty, zero or hold null or non-finite parts link with nothing, nor do
    vectors of different lengths or rows with a null id. Equal vectors are hashed once and counted with their number, so
    copies make no pairs. A bucket of many different vectors is compared part by part in many tasks.
    Rows that repeat an id count as vectors of their own; an empty table gives no row; other columns
    are ignored.
    """
    kind = "array<float>" if dict(vectors.dtypes)["embedding"] == "array<float>" else "array<double>"
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast(kind).alias("embedding"))
    good = rows.where(_is_usable())
    uniq = stored(
        good.groupBy("embedding").agg(F.min("vec_id").alias("rep_id"), F.count("*").alias("n"))
        .withColumn("size", F.size("embedding")),
        "embedding-distinct",
    )
    in_bucket = ["size", "bank", "code"]
    placed = stored(
        in_arrow(uniq.select("rep_id", "size", "embedding"), _deal(tables, hashes, probes), "rep_id long, size int, bank int, code long, home boolean"),
        "embedding-buckets",
    )
    counts = placed.groupBy(*in_bucket).agg(F.count("*").alias("members"), F.max("home").alias("any_home")).where("members > 1 and any_home")
    parts = F.ceil(F.col("members") / PART).cast("int")
    cells = (
        placed.join(counts, in_bucket)
        .withColumn("part", F.pmod(F.xxhash64("rep_id"), parts).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), parts - 1)))
        .select("rep_id", *in_bucket, "home", "part", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"))
    )
    cell = [*in_bucket, "i", "j"]
    met = cells.join(uniq.select("rep_id", "n", "embedding"), "rep_id")
    spark = vectors.sparkSession
    dealt = met.repartition(int(spark.conf.get("spark.sql.shuffle.partitions", "200")), *cell).sortWithinPartitions(*cell)
    found = stored(in_arrow(dealt, _verify(least, tables, hashes, probes), "rep_id long, links long, root long"), "embedding-links")
    groups = components(found.select(F.col("rep_id").alias("a"), F.col("root").alias("b")).distinct(), "embedding-components")
    links = found.groupBy("rep_id").agg(F.sum("links").alias("links"))
    labels = (
        uniq.join(links, "rep_id", "left").join(groups.withColumnRenamed("node", "rep_id"), "rep_id", "left")
        .select(
            "embedding",
            (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"),
            F.coalesce("component", "rep_id").alias("component_id"),
        )
    )
    linked = good.join(labels, "embedding", "left").select("vec_id", "n_links", "component_id")
    alone = rows.where(~_is_usable()).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    return linked.union(alone).select("vec_id", "n_links", "component_id", F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept"))


def op6_embedding_pairs(spark, sf_dir: str) -> DataFrame:
    return embedding_groups(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
