import hashlib
import random

import numpy as np
import pytest
from conftest_llm import by_id, table
from pyspark.sql import functions as F

from billstream.llm import line_dedup as ld
from billstream.llm.common import scratch_path

WHITE = " \t\n\x0b\x0c\r"


def key_of(line):
    key = "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(WHITE))
    return key if len(key) >= 10 else None


def holders(rows):
    found = {}
    for doc_id, text in rows:
        if doc_id is not None:
            for line in (text or "").split("\n"):
                if key_of(line):
                    found.setdefault(key_of(line), set()).add(doc_id)
    return found


def brute(rows, held=None):
    """What is left of each row; ``held`` are the rows the index holds."""
    used = holders(rows if held is None else held)
    out = []
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if not (doc_id is not None and key_of(x) in used and doc_id in used[key_of(x)] and doc_id > min(used[key_of(x)]))]
        left = "\n".join(kept)
        out.append((doc_id, len(lines), len(lines) - len(kept), hashlib.sha256(left.encode()).hexdigest(), left))
    return by_id(out)


def some_rows(n, seed, lines=40):
    rng = random.Random(seed)
    pool = [f"Line number {i} of the pool" for i in range(lines)] + ["short", "", "  Ärger über Öl  ", "ärger über öl", "0123456789", "012345678"]
    return [(i, "\n".join(rng.choice([" ", "", "\t"]) + rng.choice(pool) for _ in range(rng.randint(0, 6)))) for i in range(n)]


def built(spark, *batches, shard_keys=ld.SHARD_KEYS):
    index = ld.LineIndex(spark, scratch_path(spark, "test-lines"), shard_keys)
    for rows in batches:
        index.insert(table(spark, rows))
    return index


def state(index):
    return {bytes(r.digest): (r.refs, r.first_id) for r in index.shared().collect()}


def wanted(rows):
    return {ld.line_key(k.encode()): (len(d), min(d)) for k, d in holders(rows).items() if len(d) > 1}


@pytest.mark.parametrize("load", [0.3, 0.9, 1.2])
def test_filter_forgets_nothing_and_unlearns(load):
    rng = np.random.default_rng(3)
    digests = [rng.bytes(16) for _ in range(int(load * 256 * 4))]
    held = ld.CuckooFilter(buckets=256)
    held.insert(*held.places(digests))
    assert (held.table != 0).sum() + len(held.beside) == len(digests)
    assert held.contains(*held.places(digests)).all()
    others = [rng.bytes(16) for _ in range(20_000)]
    assert held.contains(*held.places(others)).mean() < 0.01
    again = ld.CuckooFilter(held.table.tobytes(), held.beside.tobytes())
    again.remove(*again.places(digests[::2]))
    assert again.contains(*again.places(digests[1::2])).all()
    again.remove(*again.places(digests[1::2]))
    assert not again.table.any() and not len(again.beside)


def test_equal_fingerprints_are_counted():
    held = ld.CuckooFilter(buckets=4)
    digests = [b"\x00" * 8 + b"\x07\x00\x01\x00\x00\x00" + bytes([i, 0]) for i in range(12)]
    held.insert(*held.places(digests))
    held.remove(*held.places(digests[:11]))
    assert held.contains(*held.places(digests[11:])).all()
    held.remove(*held.places(digests[11:]))
    assert not held.contains(*held.places(digests)).any()


def test_edge_rows(spark, edge_rows, edge_docs, no_docs):
    extra = [(20, "UPPER line of text"), (21, "  upper LINE of text\t"), (22, "\n\n"), (23, "ÉÉÉÉÉÉÉÉÉÉ"), (24, "ééééééééééé\nÉÉÉÉÉÉÉÉÉÉ"), (25, " upper line of text")]
    rows = edge_rows + extra
    for batches in ([rows], [rows[::2], rows[1::2]]):
        index = built(spark, *batches)
        if len(batches) == 1:  # rows of one id that come in two batches are not one document
            assert by_id(ld.drop_known_lines(table(spark, rows), index).collect()) == brute(rows)
    empty = built(spark, [])
    assert ld.drop_known_lines(no_docs, empty).collect() == []
    assert by_id(ld.drop_known_lines(edge_docs, empty).collect()) == brute(edge_rows, held=[])


def test_batches_deletion_and_return(spark):
    rows = some_rows(60, 1)
    index = built(spark, rows[40:], rows[:20], rows[20:40])
    assert state(index) == wanted(rows)
    # The smallest documents go: later ones take their place, or the key is no longer shared.
    rng = random.Random(5)
    gone = {0, 1, 2, *rng.sample(range(60), 25)}
    index.delete(spark.createDataFrame([(i,) for i in [*gone, 777]], "doc_id long"))
    left = [r for r in rows if r[0] not in gone]
    assert state(index) == wanted(left)
    assert by_id(ld.drop_known_lines(table(spark, left), index).collect()) == brute(left)
    index.delete(spark.createDataFrame([(i,) for i in gone], "doc_id long"))  # gone already: nothing happens
    assert state(index) == wanted(left)
    new = [(i, some_rows(60, 9)[i][1]) for i in sorted(gone)]  # other texts under the old ids
    index.insert(table(spark, new + left[:3]))  # ids in the index are left out
    assert state(index) == wanted(left + new)
    index.delete(spark.createDataFrame([(i,) for i in range(60)], "doc_id long"))
    assert state(index) == {} and index._size() == 0
    assert all(not any(r.slots) and not r.beside for r in index._latest_filters().collect())
    index.insert(table(spark, rows))
    assert state(index) == wanted(rows)


def test_shards_are_split_as_the_index_grows(spark):
    rows = [(i, "\n".join(f"line {i * 3 + k} of many, {i}" for k in range(5))) for i in range(60)]
    rows += [(100 + i, text) for i, text in rows[:10]]
    index = built(spark, rows[:5], rows[5:], shard_keys=16)
    assert index.log[0].depth < index.log[1].depth and index.log[1]["keys"] == 300
    assert state(index) == wanted(rows)
    again = ld.LineIndex.opened(spark, index.folder, 16)
    again.delete(table(spark, rows[:5]))
    assert state(again) == wanted(rows[5:])


def test_a_batch_that_died_never_was(spark):
    rows = some_rows(20, 2)
    index = built(spark, rows[:10])
    one = table(spark, [(99, "Line number 1 of the pool")])
    index._write("refs", 1, one.select(F.lit(b"x" * 16).alias("digest"), "doc_id", F.lit(1).alias("change")))
    again = ld.LineIndex.opened(spark, index.folder)
    assert state(again) == wanted(rows[:10])
    again.insert(table(spark, rows[10:]))
    assert state(again) == wanted(rows)


def test_false_alarms_are_settled(spark):
    """A filter that takes new keys for known ones costs a look-up, no result."""
    rows = some_rows(40, 3)
    index = built(spark, rows[:20])
    coming = spark.createDataFrame([(ld.line_key(k.encode()), 1, 1) for k in holders(rows[20:])], "digest binary, refs long, first_id long")
    claimed = index._pass(coming, index._latest_filters(), index.log[0].depth, "add").select("shard", "slots", "beside")
    index._write("filters", 0, ld.stored(claimed, "test-claimed"))
    index.insert(table(spark, rows[20:]))
    assert state(index) == wanted(rows) and index._size() == len(holders(rows))


def test_hot_line_is_combined_before_the_shuffle(spark):
    rows = [(i, "a line that all hold\nand one more of them") for i in range(3000)]
    index = built(spark, rows)
    assert {v for v in state(index).values()} == {(3000, 0)}
    got = ld.drop_known_lines(table(spark, rows), index).agg(F.sum("n_dropped")).first()[0]
    assert got == 2 * 2999
