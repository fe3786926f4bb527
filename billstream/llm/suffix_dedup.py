"""Byte passages that occur again, found in suffix order by a difference cover.

Texts meet by the anchors of ``repeats``; each task orders the suffixes of the contexts it is dealt:
the triples at two of three places are sorted and named, the names are ordered by the same step, the
remaining suffixes are merged in, and neighbours in that order are compared.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from billstream.llm.common import in_arrow, slices
from billstream.llm.repeats import (
    SLICE, Unit, as_bytes, byte_symbols, covered, grouped, hit_batch, keyed, repeated_spans, same_row,
)

WINDOW, ANCHOR = 200, 32
#: Bytes of contexts whose suffixes are ordered at once; an anchor's contexts stay together.
AT_ONCE = 1 << 19


def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """One number for each pair, in the order of the pairs."""
    low = int(b.max(initial=0)).bit_length()
    if int(a.max(initial=0)).bit_length() + low > 62:
        a = np.unique(a, return_inverse=True)[1]
    return (a.astype(np.int64) << low) | b


def suffix_order(s: np.ndarray) -> np.ndarray:
    """Start positions of all suffixes of positive symbols in ascending order."""
    n = len(s)
    if n < 4:
        return np.array(sorted(range(n), key=lambda i: s[i:].tolist()), np.int64)
    t = np.concatenate([s.astype(np.int64), np.zeros(3, np.int64)])
    one, two = np.arange(1, n + (n % 3 == 1), 3), np.arange(2, n, 3)
    sample = np.concatenate([one, two])
    triple = _pair(_pair(t[sample], t[sample + 1]), t[sample + 2])
    names, name = np.unique(triple, return_inverse=True)
    order = np.argsort(name, kind="stable") if len(names) == len(sample) else suffix_order(name + 1)
    rank = np.zeros(n + 3, np.int64)
    rank[sample[order]] = np.arange(1, len(sample) + 1)
    sampled = sample[order]
    sampled = sampled[sampled < n]
    rest = np.arange(0, n, 3)
    rest = rest[np.argsort(_pair(t[rest], rank[rest + 1]), kind="stable")]
    # How many sampled suffixes precede each of the rest: both kinds are compared by symbols up to
    # the next place at which both are sampled, then by rank.
    kind = sampled % 3
    before = np.zeros(len(rest), np.int64)
    for offset, some in ((1, sampled[kind == 1]), (2, sampled[kind == 2])):
        both = np.concatenate([some, rest])
        key = t[both]
        if offset == 2:
            key = _pair(key, t[both + 1])
        key = _pair(key, rank[both + offset])
        before += np.searchsorted(key[: len(some)], key[len(some) :])
    place = np.arange(len(rest)) + before
    out, free = np.empty(n, np.int64), np.ones(n, bool)
    out[place], free[place] = rest, False
    out[free] = sampled
    return out


def equal_neighbours(text: np.ndarray, order: np.ndarray, length: int) -> np.ndarray:
    """For each suffix of the order but the first: does it share ``length`` symbols with the one before?"""
    a, b = order[:-1], order[1:]
    open_ = np.arange(len(a))
    for at in range(0, length, 8):
        reach = np.arange(at, min(at + 8, length))
        same = (text[a[open_][:, None] + reach] == text[b[open_][:, None] + reach]).all(1)
        open_ = open_[same]
    out = np.zeros(len(a), bool)
    out[open_] = True
    return out


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows in grouped(batches, AT_ONCE):
        # Contexts end in symbols of their own, so no common prefix reaches beyond one.
        lengths = np.array([len(r["body"]) for r in rows])
        ends = np.cumsum(lengths + 1) - 1
        text = np.empty(ends[-1] + 1, np.int64)
        inside = np.ones(len(text), bool)
        inside[ends] = False
        text[inside] = np.frombuffer(b"".join(r["body"] for r in rows), np.uint8).astype(np.int64) + 1
        text[ends] = 257 + np.arange(len(rows))
        begins = ends - lengths
        window = np.zeros(len(text) + 1, np.int64)
        window[begins] += 1
        np.add.at(window, begins + np.array([r["n"] for r in rows]), -1)
        window = np.cumsum(window)[:-1] > 0
        order = suffix_order(text)
        order = order[window[order]]
        same = equal_neighbours(text, order, WINDOW)
        flag = np.zeros(len(text), bool)
        flag[order[1:][same]] = True
        flag[order[:-1][same]] = True
        yield hit_batch(rows, [flag[b : b + r["n"]] for b, r in zip(begins, rows)])


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in slices(batches, most=SLICE):
        out = []
        for text, spans in zip(part["text"].to_pylist(), part["spans"].to_pylist()):
            raw = text.encode()
            if not spans:
                out.append((len(raw), 0, 0, sha256(raw).hexdigest(), text))
                continue
            gone = covered(len(raw), spans)
            n_spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
            kept = np.frombuffer(raw, np.uint8)[~gone].tobytes()
            out.append((len(raw), int(gone.sum()), n_spans, sha256(kept).hexdigest(), kept.decode("utf-8", "ignore")))
        columns = list(zip(*out))
        yield pa.RecordBatch.from_arrays(
            [part["doc_id"], *(pa.array(c, pa.int64()) for c in columns[:3]), pa.array(columns[3]), pa.array(columns[4])],
            ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_text"],
        )


def remove_repeated_bytes(docs: DataFrame) -> DataFrame:
    """One row per row of ``documents``: counts, the digest of what is left, and it as text.

    A byte goes if a string of ``WINDOW`` bytes that covers it also starts anywhere else, in the same
    text or another; matches never cross texts. Null text is empty. Repeated rows are other places.
    Rows with a null id take part as any other. ``kept_text`` leaves out characters that a removal
    has cut in two. An empty table gives no row; other columns are ignored.
    """
    texts = keyed(docs)
    spans = repeated_spans(texts, Unit(byte_symbols, WINDOW, ANCHOR), as_bytes, _compare, earlier_only=False)
    joined = texts.join(spans, same_row(texts, spans), "left").select(texts["doc_id"], texts["text"], "spans")
    return in_arrow(
        joined, _digest, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept_text string"
    )


def op9_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    return remove_repeated_bytes(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("kept_text")
