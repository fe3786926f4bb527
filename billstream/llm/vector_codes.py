"""Vectors as short codes: sixteen small codebooks, searched by slices and bit masks.

Every codebook has at most 64 entries, so a set of entries is one uint64. In each dimension the
entries' coordinates are sorted and carry the mask of all entries up to them; the entries within a
range are then the exclusive or of two prefix masks. A query takes as its first radius the distance
to the best of the entries next to it in one dimension, selects that range in every dimension and
intersects the masks: the nearest entry and all its ties are among the bits that are left, and only
those are measured.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from billstream.llm.common import in_arrow, stored

PARTS, ENTRIES, ROUNDS = 16, 64, 2
SCALE = 256
#: Largest integer component; squared distances of parts of up to 256 components then fit 64 bits.
LARGEST = 1 << 26
#: Vectors that a task searches at once.
AT_ONCE = 4096


@dataclass(frozen=True)
class Slices:
    """The entries of one codebook with, for each dimension, sorted coordinates and prefix masks."""

    entries: np.ndarray
    coordinates: list[np.ndarray]
    order: list[np.ndarray]
    prefixes: list[np.ndarray]

    @classmethod
    def of(cls, entries: np.ndarray) -> Slices:
        order = [np.argsort(entries[:, d], kind="stable") for d in range(entries.shape[1])]
        bits = np.uint64(1) << np.arange(len(entries), dtype=np.uint64)
        none = np.zeros(1, np.uint64)
        prefixes = [np.concatenate([none, np.bitwise_or.accumulate(bits[o])]) for o in order]
        return cls(entries, [entries[o, d] for d, o in enumerate(order)], order, prefixes)

    def first_radius(self, x: np.ndarray) -> np.ndarray:
        """A distance within which an entry lies: that to the best of the entries next in one dimension."""
        best = np.full(len(x), np.iinfo(np.int64).max)
        for d, (sorted_, order) in enumerate(zip(self.coordinates, self.order)):
            place = np.searchsorted(sorted_, x[:, d])
            for near in (place - 1, place):
                some = order[np.clip(near, 0, len(order) - 1)]
                best = np.minimum(best, ((x - self.entries[some]) ** 2).sum(1))
        # Rounded up with room for the root's error: too wide a range costs time, never a candidate.
        return np.sqrt(best.astype(np.float64)).astype(np.int64) + 2

    def candidates(self, x: np.ndarray, radius: np.ndarray) -> np.ndarray:
        """For each row the mask of all entries that lie within the radius in every dimension."""
        found = np.full(len(x), np.iinfo(np.uint64).max, np.uint64)
        for d, (sorted_, masks) in enumerate(zip(self.coordinates, self.prefixes)):
            low = np.searchsorted(sorted_, x[:, d] - radius, side="left")
            high = np.searchsorted(sorted_, x[:, d] + radius, side="right")
            found &= masks[high] ^ masks[low]
        return found

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the nearest entry (ties: the lowest) and its squared distance, for each row."""
        left = self.candidates(x, self.first_radius(x))
        rows = np.arange(len(x))
        index, least = np.zeros(len(x), np.int64), np.full(len(x), np.iinfo(np.int64).max)
        while len(rows):
            lowest = left & (~left + np.uint64(1))
            at = np.log2(lowest.astype(np.float64)).astype(np.int64)  # exact: powers of two
            distance = ((x[rows] - self.entries[at]) ** 2).sum(1)
            better = distance < least[rows]
            index[rows[better]], least[rows[better]] = at[better], distance[better]
            left ^= lowest
            more = left != 0
            rows, left = rows[more], left[more]
        return index, least


@dataclass(frozen=True)
class Codebooks:
    """``entries[part, entry, position]``, integers; at most 64 entries for each part."""

    entries: np.ndarray

    @property
    def width(self) -> int:
        return self.entries.shape[2]

    def slices(self) -> list[Slices]:
        return [Slices.of(part) for part in self.entries]

    def digest(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.reshape(-1).tolist())).encode()).hexdigest()


def integer_parts(column: pa.Array, width: int, parts: int = PARTS) -> np.ndarray:
    """``floor(256 x)`` of lists of numbers as rows, parts, positions; shorter lists end in zeros."""
    flat = np.floor(SCALE * column.flatten().to_numpy(zero_copy_only=False).astype(np.float64))
    if len(flat) and np.abs(flat).max() > LARGEST:
        raise ValueError(f"a vector holds a component above {LARGEST // SCALE} in size")
    sizes = np.diff(column.offsets.to_numpy())
    out = np.zeros((len(column), parts * width), np.int64)
    out[np.arange(parts * width) < sizes[:, None]] = flat
    return out.reshape(len(column), parts, width)


def _each(batches: Iterator[pa.RecordBatch], width: int, parts: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for whole in batches:
        for at in range(0, whole.num_rows, AT_ONCE):
            batch = whole.slice(at, AT_ONCE)
            yield batch, integer_parts(batch["embedding"], width, parts)


def _sums_of(books: Codebooks) -> Callable:
    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, entries, width = books.entries.shape
        slices = books.slices()
        # The first place of each row of sums counts the assigned parts.
        total = np.zeros((parts, entries, width + 1), np.int64)
        for _, x in _each(batches, width, parts):
            for p, some in enumerate(slices):
                index, _ = some.nearest(x[:, p])
                np.add.at(total[p], index, np.concatenate([np.ones((len(index), 1), np.int64), x[:, p]], axis=1))
        part, entry = np.nonzero(total[:, :, 0])
        yield pa.RecordBatch.from_arrays(
            [pa.array(part.astype(np.int32)), pa.array(entry.astype(np.int32)), pa.array(list(total[part, entry]), pa.list_(pa.int64()))],
            ["part", "entry", "sums"],
        )

    return sums


def _codes_of(books: Codebooks, keep: list[str]) -> Callable:
    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, _, width = books.entries.shape
        slices = books.slices()
        for batch, x in _each(batches, width, parts):
            index, error = np.zeros((len(x), parts), np.uint8), np.zeros(len(x), np.int64)
            for p, some in enumerate(slices):
                index[:, p], distance = some.nearest(x[:, p])
                error += distance
            yield pa.RecordBatch.from_arrays(
                [*(batch[c] for c in keep), pa.array([row.tobytes().hex() for row in index], pa.string()), pa.array(error)],
                [*keep, "code", "error"],
            )

    return code


def _is_kept() -> Column:
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite, F.lit(False))


def kept_vectors(vectors: DataFrame, *more: str) -> DataFrame:
    """``vec_id``, ``embedding`` and further columns of the rows whose vector has only finite components."""
    kind = "array<float>" if dict(vectors.dtypes)["embedding"] == "array<float>" else "array<double>"
    return vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast(kind).alias("embedding"), *more).where(_is_kept())


def train_codebooks(kept: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> Codebooks | None:
    """Codebooks of the vectors of ``kept_vectors``; None where there is no vector.

    They start as the parts of the vectors with the smallest ids (ties by the vectors themselves,
    null ids last). In every round each task sums its parts by entry, so ``parts * entries`` rows
    leave a task, and as many sums, independent of the number of vectors, come to the driver.
    """
    if not 0 < entries <= 64:
        raise ValueError("a codebook has 1 to 64 entries, the bits of a mask")
    longest = kept.agg(F.max(F.size("embedding"))).first()[0]
    if longest is None:
        return None
    width = max(1, -(-longest // parts))
    first = kept.orderBy(F.asc_nulls_last("vec_id"), "embedding").limit(entries).select("embedding").collect()
    start = integer_parts(pa.array([list(r.embedding) for r in first], pa.list_(pa.float64())), width, parts)
    books = Codebooks(start.transpose(1, 0, 2))
    for _ in range(rounds):
        sums = in_arrow(kept.select("embedding"), _sums_of(books), "part int, entry int, sums array<long>")
        summed = (
            sums.select("part", "entry", F.posexplode("sums").alias("at", "x"))
            .groupBy("part", "entry").pivot("at", list(range(width + 1))).agg(F.sum(F.col("x").cast("decimal(38,0)")))
        )
        after = books.entries.copy()
        for part, entry, count, *totals in summed.collect():
            after[part, entry] = [int(t) // int(count) for t in totals]
        books = Codebooks(after)
    return books


def encode_vectors(kept: DataFrame, books: Codebooks, *more: str) -> DataFrame:
    """``vec_id``, further columns, ``code`` (two hex digits for each part) and ``error``."""
    keep = ["vec_id", *more]
    fields = [kept.schema[c] for c in keep] + [T.StructField("code", T.StringType()), T.StructField("error", T.LongType())]
    return in_arrow(kept.select("embedding", *keep), _codes_of(books, keep), T.StructType(fields))


def decode_vectors(codes: DataFrame, books: Codebooks) -> DataFrame:
    """``vec_id`` and the vector that its ``code`` stands for, in the middle of each integer step."""
    parts, _, width = books.entries.shape

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            index = np.array([list(bytes.fromhex(c)) for c in batch["code"].to_pylist()], np.int64).reshape(-1, parts)
            x = (books.entries[np.arange(parts), index].reshape(-1, parts * width) + 0.5) / SCALE
            yield pa.RecordBatch.from_arrays([batch["vec_id"], pa.array(list(x), pa.list_(pa.float64()))], ["vec_id", "embedding"])

    return in_arrow(codes.select("vec_id", "code"), decode, "vec_id long, embedding array<double>")


def compress(vectors: DataFrame) -> DataFrame:
    """Codes, errors and errors by ``label`` of ``vec_id``, ``embedding``, ``label``.

    Vectors that are null or hold null or non-finite components are dropped. Lengths that 16 does not
    divide, and vectors shorter than the longest, are filled up with zeros at the end. With fewer than
    64 vectors the codebooks are as much smaller. Repeated rows stay, rows with a null id too, and a
    null label is a label of its own. A component above 262,144 in size stops the job, as its squared
    distances pass 64 bits. An empty table gives no row; other columns are ignored.
    """
    kept = kept_vectors(vectors, "label")
    columns = ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    books = train_codebooks(kept)
    if books is None:
        none = kept.select("vec_id", F.lit("").alias("code"), *(F.lit(0).cast("long").alias(c) for c in columns[2:4]), F.lit("").alias(columns[4]))
        return none.where("false")
    coded = stored(encode_vectors(kept, books, "label"), "vector-codes")
    # Written, so that adaptive execution may split a label that many rows have.
    by_label = stored(coded.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error")), "vector-labels")
    joined = coded.join(by_label, F.col("label").eqNullSafe(F.col("of")))
    return joined.withColumn("codebooks_sha256", F.lit(books.digest())).select(*columns)


def op13_vector_codes(spark, sf_dir: str) -> DataFrame:
    return compress(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def _sql() -> str:
    def assigned(book: str) -> str:
        distance = "list_dot_product(c, c) - 2 * list_dot_product(c, b.entry) + list_dot_product(b.entry, b.entry)"
        return (
            f"SELECT vec_id, label, row, p, c, min({{'d': {distance}, 'e': b.e}}) AS best "
            f"FROM parts JOIN {book} b USING (p) GROUP BY vec_id, label, row, p, c"
        )

    def updated(book: str, marks: str) -> str:
        return f"""
            SELECT p, e, coalesce(list(to_double ORDER BY i) FILTER (i IS NOT NULL), any_value(old)) AS entry FROM (
              SELECT b.p, b.e, any_value(b.entry) AS old, i, floor(sum(x) / count(*)) AS to_double
              FROM {book} b LEFT JOIN (SELECT p, best.e AS e, unnest(c) AS x, generate_subscripts(c, 1) AS i FROM {marks}) a USING (p, e)
              GROUP BY b.p, b.e, i) GROUP BY p, e"""

    return f"""
        WITH kept AS MATERIALIZED (
          SELECT vec_id, label, row_number() OVER () AS row, [floor(256 * x::DOUBLE) FOR x IN embedding] AS v FROM embeddings
          WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        wide AS (SELECT max(len(v)) // {PARTS} AS w FROM kept),
        parts AS MATERIALIZED (
          SELECT vec_id, label, row, p, v[p * w + 1 : (p + 1) * w] AS c FROM kept, wide, (SELECT unnest(range({PARTS})) AS p)),
        book0 AS MATERIALIZED (
          SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e, c AS entry FROM parts
          QUALIFY e < {ENTRIES}),
        marks0 AS MATERIALIZED ({assigned("book0")}),
        book1 AS MATERIALIZED ({updated("book0", "marks0")}),
        marks1 AS MATERIALIZED ({assigned("book1")}),
        book2 AS MATERIALIZED ({updated("book1", "marks1")}),
        marks2 AS MATERIALIZED ({assigned("book2")}),
        coded AS (
          SELECT vec_id, label, string_agg(printf('%02x', best.e), '' ORDER BY p) AS code, sum(best.d)::BIGINT AS error
          FROM marks2 GROUP BY vec_id, label, row),
        digest AS (
          SELECT sha256(string_agg(x::BIGINT::VARCHAR, ',' ORDER BY p, e, i)) AS codebooks_sha256
          FROM (SELECT p, e, unnest(entry) AS x, generate_subscripts(entry, 1) AS i FROM book2))
        SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
        FROM coded, digest"""


OP13_SQL = _sql()
