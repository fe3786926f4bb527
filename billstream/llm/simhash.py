"""SimHash near-duplicates by a self-join of a binary trie of fingerprints."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from billstream.llm.common import components, in_arrow, slices, stored, texts_of

SEED = 42
SHINGLE = 3
MOST_BITS = 2
#: Distinct fingerprints under one node at the depth where the trie is dealt out to tasks.
LEAF = 4096
#: A node of more than so many times LEAF is dealt out deeper, by so many bits at a time.
HEAVY, DEEPER = 4, 8
#: Node pairs that a step of the traversal expands at once.
PAIRS = 1 << 19
#: Bits by which the traversal goes down at a time.
STEP = 2


def shingle_hashes(text: str) -> list[int]:
    # bytes.lower() and bytes.split() know ASCII alone, as the definition of words does.
    words = text.encode().lower().split()
    if not words:
        return []
    parts = [words[i:] for i in range(SHINGLE)] if len(words) >= SHINGLE else [words]
    joined = map(b" ".join, zip(*parts)) if len(words) >= SHINGLE else [b" ".join(words)]
    return list(map(xxhash.xxh64_intdigest, joined, repeat(SEED)))


def majority_bits(hashes: np.ndarray) -> int:
    """The bits set in over half of the hashes."""
    ones = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 1 << 18):
        part = hashes[i : i + (1 << 18)]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64)[0])


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in slices(batches):
        found = [majority_bits(np.array(shingle_hashes(t), np.uint64)) for t in part["text"].to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [part["doc_id"], pa.array(np.array(found, np.uint64).view(np.int64))], ["doc_id", "fp"]
        )


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the 64 bits of its fingerprint as a long; no words: zero."""
    return in_arrow(texts_of(docs), _fingerprints, "doc_id long, fp long")


def _permuted(values: np.ndarray, order: list[int]) -> np.ndarray:
    """Bits moved so that ``order[0]`` becomes the highest; distances stay as they are."""
    out = np.zeros_like(values)
    for place, bit in enumerate(order):
        out |= ((values >> np.uint64(bit)) & np.uint64(1)) << np.uint64(63 - place)
    return out


def _spread(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For counts c: the index of each repeat, and 0..c-1 within it."""
    owner = np.repeat(np.arange(len(counts)), counts)
    return owner, np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)


def near_pairs(left: np.ndarray, right: np.ndarray | None, depth: int, budget: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of sorted distinct values that differ in ``budget`` bits at most below ``depth``.

    Two tries are walked together: a pair of nodes is expanded into pairs of its children, the
    differing bits add up, and a pair over the budget is dropped. ``right`` None: a self-join, each
    pair once. A long list of node pairs is taken in runs, so memory stays bounded.
    """
    own = right is None
    tries = [left] if own else [left, right]
    levels = list(range(depth, 64, STEP)) + [64]
    nodes = [[np.unique(t >> np.uint64(64 - d)) if d else np.zeros(1, np.uint64) for d in levels] for t in tries]
    if own:
        nodes *= 2
    start = np.zeros(1, np.int64)  # all values share their first bits: one node
    todo = [(0, start, start, start)]
    while todo:
        at, a, b, spent = todo.pop()
        if len(a) > PAIRS:
            half = len(a) // 2
            todo += [(at, a[half:], b[half:], spent[half:]), (at, a[:half], b[:half], spent[:half])]
            continue
        if at == len(levels) - 1:
            keep = a < b if own else slice(None)
            if len(a[keep]):
                yield a[keep], b[keep]
            continue
        step = np.uint64(levels[at + 1] - levels[at])
        kids = []
        for trie, who in zip(nodes, (a, b)):
            parents = trie[at + 1] >> step if step < 64 else np.zeros(len(trie[at + 1]), np.uint64)
            low = np.searchsorted(parents, trie[at][who], "left")
            kids.append((low, np.searchsorted(parents, trie[at][who], "right") - low))
        (low_a, n_a), (low_b, n_b) = kids
        owner, k = _spread(n_a * n_b)
        x, y = low_a[owner] + k // n_b[owner], low_b[owner] + k % n_b[owner]
        apart = spent[owner] + np.bitwise_count(
            (nodes[0][at + 1][x] ^ nodes[1][at + 1][y]) & np.uint64((1 << int(step)) - 1)
        )
        keep = apart <= budget
        if own:
            keep &= x <= y
        todo.append((at + 1, x[keep], y[keep], apart[keep]))


def _block_links(depth: int, most: int):
    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                sides = []
                for name in ("left", "right"):
                    values = np.array([x["p"] for x in row[name] or []], np.int64).view(np.uint64)
                    ids = np.array([x["first_id"] for x in row[name] or []], np.int64)
                    order = np.argsort(values)
                    sides.append((values[order], ids[order]))
                (left, left_ids), (right, right_ids) = sides
                own = row["block"] == row["other"]
                found = near_pairs(left, None if own else right, depth, most - (0 if own else row["apart"]))
                for a, b in found:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(left_ids[a]), pa.array((left_ids if own else right_ids)[b])], ["a", "b"]
                    )

    return links


def _block(depth: int) -> Column:
    return F.shiftrightunsigned("p", 64 - depth) if depth else F.lit(0).cast("long")


def _masks(most: int, bits: int) -> Column:
    """One row for each way in which ``most`` of the lowest ``bits`` bits at most can differ."""
    masks = [sum(1 << i for i in c) for k in range(most + 1) for c in combinations(range(bits), k)]
    return F.explode(F.array(*[F.lit(m).cast("long") for m in masks]))


def _other(sizes: DataFrame) -> DataFrame:
    return sizes.select(F.col("block").alias("other"), F.col("n").alias("n_other"))


def _walked(permuted: DataFrame, pairs: DataFrame, depth: int, most: int, whole: bool) -> DataFrame:
    """The links of node pairs of one depth; ``whole``: they hold every node."""
    members = permuted.withColumn("block", _block(depth))
    if not whole:
        members = members.join(pairs.select("block").union(pairs.select("other")).distinct(), "block", "left_semi")
    blocks = stored(members.groupBy("block").agg(F.collect_list(F.struct("p", "first_id")).alias("members")), "simhash-blocks")
    left = blocks.withColumnRenamed("members", "left")
    right = blocks.select(F.col("block").alias("other"), F.col("members").alias("right"))
    # Few rows with much work each: dealt out by pair, whatever their bytes are.
    dealt = pairs.select("block", "other", "apart").join(left, "block").join(right, "other")
    return in_arrow(
        dealt.repartition(_tasks(permuted.sparkSession), "block", "other"), _block_links(depth, most), "a long, b long"
    )


def near_links(uniq: DataFrame, most: int = MOST_BITS) -> DataFrame:
    """Links ``a``, ``b`` (by ``first_id``) of distinct fingerprints ``fp`` within ``most`` bits.

    The bits are put in the order of their balance, so that the top of the trie spreads well. Its
    nodes at one depth are paired within the budget. A pair with a node of over ``HEAVY * LEAF``
    fingerprints is replaced by the pairs of their children, until all are lighter; at 64 bits a node
    is one fingerprint. The pairs are dealt to tasks, and each task walks its two subtrees together.
    """
    counts = uniq.agg(
        F.count("*").alias("n"), *[F.sum(F.shiftrightunsigned("fp", i).bitwiseAND(1)).alias(str(i)) for i in range(64)]
    ).first()
    n = counts["n"]
    order = sorted(range(64), key=lambda i: (abs(2 * (counts[str(i)] or 0) - n), i))
    depth = 0
    while n >> depth > LEAF and depth < 32:
        depth += 1

    def permute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = _permuted(np.asarray(batch["fp"]).view(np.uint64), order)
            yield pa.RecordBatch.from_arrays([pa.array(p.view(np.int64)), batch["first_id"]], ["p", "first_id"])

    permuted = stored(in_arrow(uniq.select("fp", "first_id"), permute, "p long, first_id long"), "simhash-permuted")
    heavy = HEAVY * LEAF

    def sized(depth: int) -> DataFrame:
        return permuted.groupBy(_block(depth).alias("block")).agg(F.count("*").alias("n"))

    sizes = stored(sized(depth), "simhash-sizes")
    pairs = sizes.select("block", _masks(most, depth).alias("mask"), "n").select(
        "block", F.col("block").bitwiseXOR(F.col("mask")).alias("other"), F.bit_count("mask").alias("apart"), "n"
    )
    pairs = pairs.where("other >= block").join(_other(sizes), "other")
    found = []
    while True:
        light = (F.col("n") <= heavy) & (F.col("n_other") <= heavy)
        done = depth == 64 or sizes.where(F.col("n") > heavy).isEmpty()
        found.append(_walked(permuted, pairs.where(light), depth, most, whole=done and not found))
        if done:
            break
        rest = stored(pairs.where(~light).select("block", "other", "apart"), "simhash-heavy")
        step = min(DEEPER, 64 - depth)
        depth += step
        sizes = stored(sized(depth), "simhash-sizes")
        kids = sizes.select(F.shiftrightunsigned("block", step).alias("block"), F.col("block").alias("kid"), "n")
        near = (
            rest.join(kids, "block")
            .select("block", "other", "kid", "n", "apart", _masks(most, step).alias("mask"))
            .where(F.col("apart") + F.bit_count("mask") <= most)
            .select(
                F.col("kid").alias("block"),
                F.shiftleft("other", step).bitwiseOR(F.col("kid").bitwiseAND((1 << step) - 1).bitwiseXOR(F.col("mask"))).alias("other"),
                (F.col("apart") + F.bit_count("mask")).alias("apart"),
                "n",
                (F.col("block") == F.col("other")).alias("own"),
            )
            # Below one node each pair of children comes from both sides.
            .where("not own or other >= block")
            .drop("own")
        )
        pairs = stored(near.join(_other(sizes), "other"), "simhash-pairs")
    links = found[0]
    for more in found[1:]:
        links = links.unionByName(more)
    return links


def _tasks(spark) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def _labelled(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``fp``, ``root`` (one fingerprint for each component), ``component_id``.

    Fingerprints are the nodes, not ids: one id may stand at several texts.
    """
    marked = stored(fingerprints(docs), "simhash-fingerprints")
    uniq = stored(
        marked.groupBy("fp").agg(F.min("doc_id").alias("first_id")).where("first_id is not null"), "simhash-distinct"
    )
    found = components(near_links(uniq.select("fp", F.col("fp").alias("first_id"))), "simhash-links")
    linked = stored(found.select(F.col("node").alias("fp"), F.col("component").alias("root")).join(uniq, "fp"), "simhash-linked")
    least = linked.groupBy("root").agg(F.min("first_id").alias("component_id"))
    labels = uniq.join(linked.drop("first_id").join(least, "root"), "fp", "left").select(
        "fp", F.coalesce("root", "fp").alias("root"), F.coalesce("component_id", "first_id").alias("component_id")
    )
    return marked.join(labels, "fp", "left").select("doc_id", "fp", "root", "component_id")


def simhash_groups(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id``, ``fp`` (long), ``component_id`` (smallest linked id).

    Null text counts as empty; texts without words have fingerprint zero and are linked like any
    other. Equal fingerprints are one node of the trie, so copies make no pairs. Repeated rows stay;
    different texts of one id are not linked by it. Rows with a null id take the component of their
    fingerprint (null if no row of it has an id).
    """
    return _labelled(docs).select("doc_id", "fp", "component_id")


def _fingerprints_beside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in slices(batches):
        (found,) = _fingerprints(iter([part]))
        yield pa.RecordBatch.from_arrays([part["doc_id"], found["fp"], part["row"]], ["doc_id", "fp", "row"])


def first_of_groups(docs: DataFrame) -> DataFrame:
    """The documents that stay: of each group one row of the smallest id (rows without id stay).

    Rows are decided one by one where an id is repeated: of the rows of that id in a group the one
    with the smallest fingerprint stays, then the first by its values.
    """
    labelled = stored(_labelled(docs).where("doc_id is not null"), "simhash-labelled")
    marks = stored(
        labelled.groupBy("doc_id")
        .agg((F.count("*") > 1).alias("repeated"), F.bool_or(F.col("doc_id") != F.col("component_id")).alias("later"))
        .where("repeated or later"),
        "simhash-marks",
    )
    once = docs.join(marks, "doc_id", "left_anti")
    repeated = marks.where("repeated").select("doc_id")
    if repeated.isEmpty():
        return once
    # Few rows: only those of repeated ids get their fingerprints again, beside all of their columns.
    rows = texts_of(docs, F.struct(*docs.columns).alias("row")).join(repeated, "doc_id", "left_semi")
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("fp", T.LongType()), rows.schema["row"]])
    first = labelled.where("doc_id = component_id").join(repeated, "doc_id", "left_semi").select("doc_id", "fp", "root").distinct()
    ranked = Window.partitionBy("root").orderBy("fp", F.to_json("row"))
    chosen = in_arrow(rows, _fingerprints_beside, schema).join(first, ["doc_id", "fp"])
    return once.unionByName(chosen.withColumn("rank", F.row_number().over(ranked)).where("rank = 1").select("row.*"))


def op8_simhash(spark, sf_dir: str) -> DataFrame:
    found = simhash_groups(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
