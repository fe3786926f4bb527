"""Small helpers that run inside Arrow batches on executors.

The module is pickled by value, so executors need no copy of the package.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.dataset as ds
from pyarrow import fs
from pyspark import cloudpickle

# Weights of the score parts, without and with a keyword hit.
BASE_WEIGHT = (0.5, 0.35)
EXAMPLE_WEIGHT = (0.35, 0.25)
KEYWORD_WEIGHT = 0.4
NEGATIVE_WEIGHT = 0.25


def cosine_matrix(batch: np.ndarray, matrix: np.ndarray) -> np.ndarray:
    norms = np.outer(np.linalg.norm(batch, axis=1), np.linalg.norm(matrix, axis=1))
    return (batch @ matrix.T) / np.maximum(norms, 1e-9)


def composite(
    base: np.ndarray, example: np.ndarray, negative: np.ndarray, hit: np.ndarray, threshold: np.ndarray
) -> np.ndarray:
    """Weighted mean of the parts that exist (missing: nan), lifted by a keyword hit, lowered by a
    negative example, clamped to [0, 1]."""
    w_base = np.where(np.isnan(base), 0.0, np.where(hit, BASE_WEIGHT[1], BASE_WEIGHT[0]))
    w_example = np.where(np.isnan(example), 0.0, np.where(hit, EXAMPLE_WEIGHT[1], EXAMPLE_WEIGHT[0]))
    w_keyword = np.where(hit, KEYWORD_WEIGHT, 0.0)
    weight = w_base + w_example + w_keyword
    total = np.nan_to_num(base) * w_base + np.nan_to_num(example) * w_example + w_keyword
    mean = np.divide(total, weight, out=np.zeros_like(total), where=weight > 0)
    lifted = np.where(hit, np.maximum(mean, threshold), mean)
    lowered = np.where(np.isnan(negative), lifted, np.maximum(lifted - np.nan_to_num(negative) * NEGATIVE_WEIGHT, 0.0))
    return np.clip(lowered, 0.0, 1.0)


# -- tag vectors -----------------------------------------------------------------------

#: Bytes of tag vectors a task keeps; a larger table is read anew for each slice of entries.
KEPT_BYTES = 64 << 20
#: Vectors of the table that are multiplied at once, and cells (entries times tags) of a slice.
VECTORS_AT_ONCE, CELLS = 4096, 1 << 20
TAG, EXAMPLE, NEGATIVE = 0, 1, 2


class TagVectorFile:
    """The vectors of all tags (``owner``, ``kind``, ``vector``) as tasks read them from the shared folder."""

    def __init__(self, path: str, size: int):
        self.path, self.size, self.kept = path, size, None

    def _read(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        uri = re.sub("^s3[an]:", "s3:", self.path)
        system, path = fs.FileSystem.from_uri(uri) if "://" in uri else (fs.LocalFileSystem(), re.sub("^file:", "", uri))
        table = ds.dataset(path, filesystem=system, format="parquet")
        for batch in table.to_batches(columns=["owner", "kind", "vector"], batch_size=VECTORS_AT_ONCE):
            if batch.num_rows:
                vectors = batch["vector"].flatten().to_numpy(zero_copy_only=False).astype("float64").reshape(-1, self.size)
                yield np.array(batch["owner"]), np.array(batch["kind"]), vectors

    def __iter__(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        if self.kept is not None:
            yield from self.kept
            return
        held, size = [], 0
        for part in self._read():
            size += part[2].nbytes
            if size <= KEPT_BYTES:
                held.append(part)
            yield part
        if size <= KEPT_BYTES:
            self.kept = held


def usable_vectors(column: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Which vectors are whole (of the right length, no gap), and those as rows."""
    listed = column.to_pylist()
    usable = np.array([v is not None and len(v) == size and all(x is not None and x == x for x in v) for v in listed], bool)
    return usable, np.array([listed[i] for i in np.nonzero(usable)[0]], "float64").reshape(-1, size)


def similarities(batch: np.ndarray, table: TagVectorFile, tags: int) -> np.ndarray:
    """For each entry and tag: similarity to the tag, the best to its examples and to its negatives
    (never below zero); nan where there is none."""
    out = np.full((3, len(batch), tags), np.nan)
    for owner, kind, vectors in table:
        found = cosine_matrix(batch, vectors)
        own = kind == TAG
        out[TAG][:, owner[own]] = found[:, own]
        for part in (EXAMPLE, NEGATIVE):
            for tag in np.unique(owner[kind == part]):
                best = np.maximum(found[:, (kind == part) & (owner == tag)].max(axis=1), 0.0)
                out[part][:, tag] = np.fmax(out[part][:, tag], best)
    return out


def _marks(lists: pa.Array, tags: int) -> np.ndarray:
    """Lists of tag numbers as a matrix of flags."""
    out = np.zeros((len(lists), tags), bool)
    sizes = np.diff(lists.offsets.to_numpy())
    out[np.repeat(np.arange(len(lists)), sizes), lists.flatten().to_numpy(zero_copy_only=False)] = True
    return out


def sparse_scores(table: TagVectorFile, thresholds: np.ndarray, vector: str, keep: Sequence[str], keep_all: bool):
    """Arrow batches of entries to one row per entry and tag that reaches its threshold."""
    tags = len(thresholds)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = max(1, CELLS // max(1, tags))
        for whole in batches:
            for at in range(0, whole.num_rows, rows):
                batch = whole.slice(at, rows)
                usable, vectors = usable_vectors(batch[vector], table.size)
                parts = np.full((3, batch.num_rows, tags), np.nan)
                if len(vectors):
                    parts[:, usable] = similarities(vectors, table, tags)
                hit, blocked = _marks(batch["_include"], tags), _marks(batch["_exclude"], tags)
                final = np.where(blocked, 0.0, composite(*parts, hit, thresholds))
                parts[:, blocked] = np.nan
                entry, tag = np.nonzero(np.ones_like(blocked) if keep_all else final >= thresholds)
                base, example, negative = (pa.array(p[entry, tag], from_pandas=True) for p in parts)
                yield pa.RecordBatch.from_arrays(
                    [*(batch[c].take(pa.array(entry)) for c in keep), pa.array(tag.astype("int32")), pa.array(final[entry, tag]), base, example, negative],
                    [*keep, "_owner", "final_score", "base_embedding", "example_similarity", "_negative"],
                )

    return score


cloudpickle.register_pickle_by_value(sys.modules[__name__])
