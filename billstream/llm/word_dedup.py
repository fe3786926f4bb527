"""Word passages that an earlier document holds, found by fixed-block anchors.

Texts meet by the anchors of ``repeats``. Within what a task is dealt, blocks of 25 words that do not
overlap are the reference index; every rolling run of 25 words probes it, and hits are extended to
whole windows and on to maximal repeats. A window of 50 words always holds a whole reference block.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from billstream.llm.common import in_arrow, slices
from billstream.llm.repeats import (
    BASE, SLICE, Unit, as_word_hashes, covered, grouped, hit_batch, keyed, mix, prefix_sums, range_hashes,
    repeated_spans, same_row, word_symbols,
)

WINDOW, ANCHOR = 50, 10
BLOCK = WINDOW // 2
AT_ONCE = 1 << 22
NEVER = np.iinfo(np.int64).max


def _least_of(keys: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys and the smallest id of each."""
    order = np.lexsort((ids, keys))
    keys, ids = keys[order], ids[order]
    first = np.concatenate([[True], keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, bool)
    return keys[first], ids[first]


def _found_in(index: tuple[np.ndarray, np.ndarray], keys: np.ndarray) -> np.ndarray:
    """The smallest id of each key, or ``NEVER``."""
    known, ids = index
    if not len(known):
        return np.full(len(keys), NEVER)
    at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
    return np.where(known[at] == keys, ids[at], NEVER)


def earlier_windows(values: np.ndarray, lengths: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """At each word of joined contexts: does a window begin there that a smaller id holds too?"""
    ends = np.cumsum(lengths)
    begins = ends - lengths
    who = np.repeat(np.arange(len(lengths)), lengths)
    at = np.arange(len(values))
    own = ids[who]
    sums = prefix_sums(values)
    # Reference: blocks that do not overlap, each with the smallest id that holds it.
    rolling = at[at + BLOCK <= ends[who]]
    probe = range_hashes(sums, rolling, rolling + BLOCK)
    is_block = (rolling - begins[who[rolling]]) % BLOCK == 0
    blocks = _least_of(probe[is_block], own[rolling[is_block]])
    # Probes: every rolling run; a hit is one that an earlier document's block equals.
    hit = np.zeros(len(values) + 1, np.int64)
    hit[rolling + 1] = _found_in(blocks, probe) < own[rolling]
    hits = np.cumsum(hit)
    # Extension: windows around a hit, judged as a whole.
    whole = at[at + WINDOW <= ends[who]]
    one = range_hashes(sums, whole, whole + WINDOW)
    two = range_hashes(prefix_sums(mix(values ^ np.uint64(BASE))), whole, whole + WINDOW)
    digest = mix(one) ^ (two * np.uint64(0x94D049BB133111EB))
    near = hits[whole + WINDOW - BLOCK + 1] > hits[whole]
    least = _found_in(_least_of(digest, own[whole]), digest[near])
    out = np.zeros(len(values), bool)
    out[whole[near]] = least < own[whole[near]]
    return out


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows in grouped(batches, AT_ONCE):
        lengths = np.array([len(r["body"]) // 8 for r in rows])
        values = np.frombuffer(b"".join(r["body"] for r in rows), np.uint64)
        ids = np.array([NEVER if r["first_id"] is None else r["first_id"] for r in rows], np.int64)
        flag = earlier_windows(values, lengths, ids)
        begins = np.cumsum(lengths) - lengths
        yield hit_batch(rows, [flag[b : b + r["n"]] for b, r in zip(begins, rows)])


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in slices(batches, most=SLICE):
        out = []
        for text, spans in zip(part["text"].to_pylist(), part["spans"].to_pylist()):
            words = text.encode().split()
            n = len(words)
            if spans:
                words = list(compress(words, ~covered(n, spans)))
            kept = b" ".join(words)
            out.append((n, n - len(words), sha256(kept).hexdigest(), kept.decode()))
        columns = list(zip(*out))
        yield pa.RecordBatch.from_arrays(
            [part["doc_id"], *(pa.array(c, pa.int64()) for c in columns[:2]), pa.array(columns[2]), pa.array(columns[3])],
            ["doc_id", "n_words", "n_removed", "kept_sha256", "kept_text"],
        )


def remove_repeated_words(docs: DataFrame) -> DataFrame:
    """One row per row of ``documents``: counts, the digest of what is left, and it as text.

    Words are runs of other than ASCII white space, unchanged. A word goes if a window of ``WINDOW``
    words that covers it also starts in a document with a smaller id. Null text has no word. Rows of
    one id do not count as earlier for each other; rows with a null id lose nothing and remove
    nothing. An empty table gives no row; other columns are ignored.
    """
    texts = keyed(docs)
    spans = repeated_spans(texts, Unit(word_symbols, WINDOW, ANCHOR), as_word_hashes, _compare, earlier_only=True)
    joined = texts.join(spans, same_row(texts, spans), "left").select(texts["doc_id"], texts["text"], "spans")
    return in_arrow(joined, _digest, "doc_id long, n_words long, n_removed long, kept_sha256 string, kept_text string")


def op5_word_dedup(spark, sf_dir: str) -> DataFrame:
    return remove_repeated_words(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("kept_text")
