"""Which windows of a text occur elsewhere: what the two exact-repeat operators share.

Every window of W symbols has one anchor: its leftmost gram with the smallest hash. Equal windows
have equal anchors at equal places, so windows of different anchors never need to be compared.
Neighbouring windows with one anchor are a run; a run's content is its context. Anchors that occur
once leave the game at once; equal contexts are counted, not compared; only different contexts of one
anchor are looked at symbol by symbol, by the method of each operator.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from billstream.llm.common import in_arrow, slices, stored

#: Bytes of text that a Python step takes at once, and symbols of one text at a time.
SLICE = 2_000_000
PIECE_BITS = 22
BASE = 0x9E3779B97F4A7C15
#: Contexts of one anchor above which its windows are dealt out one by one.
HOT = 4096
CONTEXT = ["h", "n", "off", "c"]
WHITE = b" \t\n\x0b\x0c\r"


@lru_cache(maxsize=2)
def _powers(bits: int) -> tuple[np.ndarray, np.ndarray]:
    size = 1 << bits
    up = np.full(size, BASE, np.uint64)
    down = np.full(size, pow(BASE, -1, 1 << 64), np.uint64)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def prefix_sums(values: np.ndarray) -> np.ndarray:
    up, _ = _powers(max(PIECE_BITS, (len(values) + 1).bit_length()))
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[: len(values)], out=out[1:])
    return out


def range_hashes(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A hash of the symbols start to end, the same wherever they stand."""
    _, down = _powers(max(PIECE_BITS, len(sums).bit_length()))
    return mix((sums[end] - sums[start]) * down[start])


@lru_cache(maxsize=1)
def byte_values() -> np.ndarray:
    return mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(BASE))


def byte_symbols(raw: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Values of all bytes, and the number of each text."""
    return byte_values()[np.frombuffer(b"".join(raw), np.uint8)], np.array([len(r) for r in raw], np.int64)


def word_symbols(raw: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words (runs of other than ASCII white space), and the number of each text."""
    whole = np.frombuffer(b" ".join(raw) + b" ", np.uint8)
    table = np.ones(256, bool)
    table[list(WHITE)] = False
    edge = np.diff(np.concatenate([[0], table[whole].astype(np.int8)]))
    starts, ends = np.nonzero(edge == 1)[0], np.nonzero(edge == -1)[0]
    sums = prefix_sums(byte_values()[whole])
    values = range_hashes(sums, starts, ends) + (ends - starts).astype(np.uint64)
    bounds = np.cumsum([0, *(len(r) + 1 for r in raw)])
    return mix(values), np.diff(np.searchsorted(starts, bounds))


@dataclass(frozen=True)
class Unit:
    """What a symbol is, and the lengths of windows and anchors in symbols."""

    symbols: Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]]
    window: int
    gram: int


def _sliding_least(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of ``width`` values."""
    n = len(x)
    rows = -(-n // width)
    padded = np.full(rows * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = x
    grid = padded.reshape(rows, width)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: n - width + 1], ahead[width - 1 : n])


def runs(values: np.ndarray, counts: np.ndarray, unit: Unit) -> dict[str, np.ndarray]:
    """Runs of windows with one anchor: text, first window (in it), number, anchor's place, hashes."""
    w, k = unit.window, unit.gram
    ends = np.cumsum(counts)
    none = {c: np.zeros(0, np.int64) for c in ("text", "lo", "n", "off", "h", "c")}
    if not len(values) or len(values) < w:
        return none
    sums = prefix_sums(values)
    at = np.arange(len(values) - k + 1)
    grams = range_hashes(sums, at, at + k)
    mask = np.uint64((1 << PIECE_BITS) - 1)
    least = _sliding_least((grams & ~mask) | at.astype(np.uint64), w - k + 1)
    anchor = (least & mask).astype(np.int64)
    text = np.searchsorted(ends, np.arange(len(anchor)), side="right")
    start = np.nonzero(np.arange(len(anchor)) + w <= ends[np.minimum(text, len(ends) - 1)])[0]
    if not len(start):
        return none
    a, t = anchor[start], text[start]
    new = np.concatenate([[True], (a[1:] != a[:-1]) | (t[1:] != t[:-1])])
    first = np.nonzero(new)[0]
    n = np.diff(np.append(first, len(start)))
    low, who = start[first], t[first]
    return {
        "text": who,
        "lo": low - (ends[who] - counts[who]),
        "n": n,
        "off": a[first] - low,
        "h": grams[a[first]].view(np.int64),
        "c": range_hashes(sums, low, low + n - 1 + w).view(np.int64),
    }


def _runs_of(unit: Unit):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, most=SLICE):
            values, counts = unit.symbols([t.encode() for t in part["text"].to_pylist()])
            most = 1 << PIECE_BITS
            if len(values) < most:
                pieces = [(values, counts, 0)]
            else:  # one very long text: pieces that overlap by all but one symbol of a window
                pieces = [(values[i : i + most], np.array([len(values[i : i + most])]), i) for i in range(0, len(values), most - unit.window + 1)]
            for some, sizes, shift in pieces:
                found = runs(some, sizes, unit)
                who = pa.array(found["text"])
                yield pa.RecordBatch.from_arrays(
                    [
                        part["doc_id"].take(who),
                        part["k"].take(who),
                        pa.array(found["h"]),
                        pa.array(found["c"]),
                        pa.array(found["lo"] + shift),
                        pa.array(found["n"].astype(np.int32)),
                        pa.array(found["off"].astype(np.int32)),
                    ],
                    ["doc_id", "k", "h", "c", "lo", "n", "off"],
                )

    return find


def keyed(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``text`` (null: empty) and a key ``k`` that tells rows of one id apart."""
    text = F.coalesce("text", F.lit(""))
    doc_id = F.col("doc_id").cast("long")
    return docs.select(doc_id.alias("doc_id"), text.alias("text"), F.xxhash64(doc_id, text).alias("k"))


def same_row(left: DataFrame, right: DataFrame):
    return (left["k"] == right["k"]) & left["doc_id"].eqNullSafe(right["doc_id"])


def _contexts_of(unit: Unit, as_body: Callable[[bytes], bytes]):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, most=SLICE):
            out = []
            for doc_id, text, wanted in zip(*(part[c].to_pylist() for c in ("doc_id", "text", "wanted"))):
                body = as_body(text.encode())
                size = _BODY_BYTES[as_body]
                for x in wanted:
                    end = x["lo"] + x["n"] - 1 + unit.window
                    out.append({**{c: x[c] for c in (*CONTEXT, "seen", "hot")}, "first_id": doc_id, "body": body[x["lo"] * size : end * size]})
            yield pa.RecordBatch.from_pylist(out, schema=_BODIES)

    return cut


def as_bytes(raw: bytes) -> bytes:
    return raw


def as_word_hashes(raw: bytes) -> bytes:
    return word_symbols([raw])[0].tobytes()


_BODY_BYTES = {as_bytes: 1, as_word_hashes: 8}
BODY = "h long, n int, off int, c long, seen long, first_id long, hot boolean, body binary"
_BODIES = pa.schema(
    [
        ("h", pa.int64()), ("n", pa.int32()), ("off", pa.int32()), ("c", pa.int64()),
        ("seen", pa.int64()), ("first_id", pa.int64()), ("hot", pa.bool_()), ("body", pa.binary()),
    ]
)
HITS = "h long, n int, off int, c long, hits array<struct<s:int,e:int>>"


def flag_ranges(flags: np.ndarray) -> list[dict[str, int]]:
    edge = np.diff(np.concatenate([[0], flags.astype(np.int8), [0]]))
    return [{"s": int(s), "e": int(e)} for s, e in zip(np.nonzero(edge == 1)[0], np.nonzero(edge == -1)[0])]


def grouped(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[list[dict]]:
    """Rows sorted by ``h``, in lists of whole groups with about ``most`` bytes of bodies."""
    held, size = [], 0
    for batch in batches:
        for row in batch.to_pylist():
            if size >= most and row["h"] != held[-1]["h"]:
                yield held
                held, size = [], 0
            held.append(row)
            size += len(row["body"])
    if held:
        yield held


def hit_batch(rows: list[dict], flags: list[np.ndarray]) -> pa.RecordBatch:
    kind = pa.list_(pa.struct([("s", pa.int32()), ("e", pa.int32())]))
    rows_with = [(r, flag_ranges(f)) for r, f in zip(rows, flags) if f.any()]
    return pa.RecordBatch.from_arrays(
        [
            pa.array([r["h"] for r, _ in rows_with], pa.int64()),
            pa.array([r["n"] for r, _ in rows_with], pa.int32()),
            pa.array([r["off"] for r, _ in rows_with], pa.int32()),
            pa.array([r["c"] for r, _ in rows_with], pa.int64()),
            pa.array([h for _, h in rows_with], kind),
        ],
        ["h", "n", "off", "c", "hits"],
    )


def _window_digests(unit: Unit, kind: str):
    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                values = np.frombuffer(row["body"], kind)
                values = byte_values()[values] if kind == "u1" else values
                at = np.arange(row["n"])
                one = range_hashes(prefix_sums(values), at, at + unit.window)
                two = range_hashes(prefix_sums(mix(values ^ np.uint64(BASE))), at, at + unit.window)
                columns = {c: pa.array([row[c]] * row["n"], _BODIES.field(c).type) for c in CONTEXT}
                columns["first_id"] = pa.array([row["first_id"]] * row["n"], pa.int64())
                yield pa.RecordBatch.from_pydict(
                    columns | {"at": pa.array(at.astype(np.int32)), "w1": pa.array(one.view(np.int64)), "w2": pa.array(two.view(np.int64))}
                )

    return digest


def repeated_spans(docs: DataFrame, unit: Unit, as_body: Callable[[bytes], bytes], compare, earlier_only: bool) -> DataFrame:
    """``doc_id``, ``k`` and the ``spans`` (symbols, end exclusive) that repeated windows cover.

    A window counts as repeated if it also starts anywhere else or, with ``earlier_only``, in a
    document with a smaller id. ``docs`` comes from ``keyed``; ``compare`` settles the contexts of
    one anchor: from Arrow batches sorted by ``h`` to rows of ``HITS``.
    """
    rows = stored(in_arrow(docs, _runs_of(unit), "doc_id long, k long, h long, c long, lo long, n int, off int"), "repeat-runs")
    again = rows.groupBy("h").agg(F.count("*").alias("many")).where("many > 1").select("h")
    live = stored(rows.join(again, "h"), "repeat-live")
    # The place of the smallest id stands for a context; a null id is no smaller than any.
    place = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "k", "lo"))
    contexts = live.groupBy(*CONTEXT).agg(F.count("*").alias("seen"), place.alias("place"))
    contexts = stored(contexts.select(*CONTEXT, "seen", F.col("place.doc_id").alias("first_id"), "place.k", "place.lo"), "repeat-contexts")
    several = contexts.groupBy("h").agg(F.count("*").alias("many")).where("many > 1")
    wanted = (
        contexts.join(several, "h")
        .groupBy(F.col("first_id").alias("doc_id"), "k")
        .agg(F.collect_list(F.struct(*CONTEXT, "lo", "seen", (F.col("many") > HOT).alias("hot"))).alias("wanted"))
    )
    picked = docs.join(wanted, same_row(docs, wanted)).select(docs["doc_id"], docs["text"], "wanted")
    open_ = stored(in_arrow(picked, _contexts_of(unit, as_body), BODY), "repeat-bodies")
    cold = open_.where("not hot").repartition("h").sortWithinPartitions("h", "first_id")
    hits = in_arrow(cold, compare, HITS)
    # Anchors with very many contexts: one row for each window, counted with a combine before the shuffle.
    kind = "u1" if _BODY_BYTES[as_body] == 1 else "u8"
    windows = in_arrow(open_.where("hot"), _window_digests(unit, kind), "h long, n int, off int, c long, first_id long, at int, w1 long, w2 long")
    equal = windows.groupBy("w1", "w2").agg(F.count("*").alias("many"), F.min("first_id").alias("least"))
    repeated = F.col("least") < F.col("first_id") if earlier_only else F.col("many") > 1
    hot_hits = (
        windows.join(equal, ["w1", "w2"]).where(repeated)
        .groupBy(*CONTEXT).agg(F.collect_list(F.struct(F.col("at").alias("s"), (F.col("at") + 1).alias("e"))).alias("hits"))
    )
    settled = stored(hits.union(hot_hits), "repeat-hits")
    known = contexts.select(*CONTEXT, "seen", "first_id").join(settled, CONTEXT, "left")
    whole = F.col("doc_id") > F.col("first_id") if earlier_only else F.col("seen") > 1
    if earlier_only:
        live = live.where("doc_id is not null")
    all_of_it = F.array(F.struct(F.lit(0).alias("s"), F.col("n").alias("e")))
    found = live.join(known.where(F.col("seen").isNotNull() & ((F.col("seen") > 1) | F.col("hits").isNotNull())), CONTEXT)
    found = found.withColumn("hits", F.when(whole, all_of_it).otherwise(F.col("hits")))
    spans = F.transform("hits", lambda x: F.struct((F.col("lo") + x.s).alias("start"), (F.col("lo") + x.e - 1 + unit.window).alias("end")))
    return (
        found.where(F.col("hits").isNotNull())
        .select("doc_id", "k", spans.alias("spans"))
        .groupBy("doc_id", "k")
        .agg(F.flatten(F.collect_list("spans")).alias("spans"))
    )


def covered(n: int, spans: list[dict] | None) -> np.ndarray:
    """Which of n symbols the spans cover."""
    change = np.zeros(n + 1, np.int64)
    if spans:
        np.add.at(change, [s["start"] for s in spans], 1)
        np.add.at(change, [s["end"] for s in spans], -1)
    return np.cumsum(change)[:n] > 0
