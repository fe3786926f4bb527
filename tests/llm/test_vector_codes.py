import hashlib
import math

import numpy as np
import pytest
from conftest_llm import by_id, table

from billstream.llm import vector_codes as vc

COLUMNS = "vec_id long, embedding array<float>, label int"


def brute(rows, parts=16, entries=64, rounds=2):
    """Plain loops over Python integers."""
    good = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    if not good:
        return []
    width = max(1, -(-max(len(r[1]) for r in good) // parts))

    def cut(v):
        whole = [math.floor(256 * float(np.float32(x))) for x in v] + [0] * (parts * width - len(v))
        return [whole[p * width : (p + 1) * width] for p in range(parts)]

    cuts = [cut(r[1]) for r in good]
    first = sorted(range(len(good)), key=lambda i: (good[i][0] is None, good[i][0] or 0, good[i][1]))[:entries]
    books = [[cuts[i][p] for i in first] for p in range(parts)]

    def nearest(p, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), k) for k, e in enumerate(books[p]))

    for _ in range(rounds):
        after = [list(b) for b in books]
        for p in range(parts):
            members = {}
            for c in cuts:
                members.setdefault(nearest(p, c[p])[1], []).append(c[p])
            for e, xs in members.items():
                after[p][e] = [sum(col) // len(xs) for col in zip(*xs)]
        books = after
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    coded = [[nearest(p, c[p]) for p in range(parts)] for c in cuts]
    errors = [sum(d for d, _ in c) for c in coded]
    return [
        (r[0], "".join(f"{e:02x}" for _, e in c), err, sum(x for x, o in zip(errors, good) if o[2] == r[2]), digest)
        for r, c, err in zip(good, coded, errors)
    ]


def some_vectors(n, size, seed=0):
    rng = np.random.default_rng(seed)
    return [(i, [float(x) for x in rng.normal(0, 0.2, size).astype(np.float32)], int(i % 3)) for i in range(n)]


def coded(spark, rows):
    return by_id(vc.compress(table(spark, rows, COLUMNS)).collect())


@pytest.mark.parametrize("entries", [1, 2, 63, 64])
@pytest.mark.parametrize("spread", [2, 300, 1 << 26])
def test_masks_find_the_nearest_entry(entries, spread):
    rng = np.random.default_rng(entries + spread)
    book, x = rng.integers(-spread, spread, (entries, 4)), rng.integers(-spread, spread, (500, 4))
    book[entries // 2] = book[0]  # equal entries: the lower index
    found = vc.Slices.of(book)
    distance = ((x[:, None] - book[None]) ** 2).sum(2)
    index, least = found.nearest(x)
    assert (index == distance.argmin(1)).all() and (least == distance.min(1)).all()
    masks = found.candidates(x, found.first_radius(x))
    ties = distance == distance.min(1, keepdims=True)
    assert all((int(m) >> k) & 1 for m, row in zip(masks, ties) for k in np.nonzero(row)[0].tolist())
    if spread == 300 and entries == 64:  # the masks leave few entries to measure
        assert np.mean([int(m).bit_count() for m in masks]) < entries / 4


def test_against_loops(spark):
    rows = some_vectors(150, 32)
    assert coded(spark, rows) == by_id(brute(rows))


def test_edge_rows(spark):
    rows = some_vectors(90, 20, seed=1)  # 16 does not divide 20
    rows += [(5, None, 1), (6, [], 2), (7, [1.0], None), (8, [None] * 20, None), (9, [float("nan")] + [0.0] * 19, 1)]
    rows += [(10, [float("inf")] * 20, 1), (None, [0.5] * 20, None), (3, rows[3][1], 9), (3, rows[3][1], 9), (-4, [-0.001] * 20, 1)]
    got = coded(spark, rows)
    assert got == by_id(brute(rows)) and len(got) == len(rows) - 4


def test_fewer_vectors_than_entries_and_none(spark):
    rows = some_vectors(5, 16)
    got = coded(spark, rows)
    assert got == by_id(brute(rows)) and all(r[2] == 0 for r in got)
    for none in ([], [(1, None, 0), (2, [float("nan")], 0)]):
        frame = vc.compress(table(spark, none, COLUMNS))
        assert frame.collect() == [] and frame.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]


def test_doubles_and_too_large(spark):
    rows = some_vectors(70, 16, seed=2)
    wide = vc.compress(table(spark, rows, COLUMNS.replace("float", "double")))
    assert by_id(wide.collect()) == by_id(brute(rows))
    with pytest.raises(Exception, match="above 262144"):
        vc.compress(table(spark, [(1, [1e30] * 16, 0)], COLUMNS)).collect()


def test_decode(spark):
    rows = some_vectors(64, 32, seed=3)
    kept = vc.kept_vectors(table(spark, rows, COLUMNS))
    books = vc.train_codebooks(kept, rounds=0)
    decoded = {r.vec_id: r.embedding for r in vc.decode_vectors(vc.encode_vectors(kept, books), books).collect()}
    # With as many entries as vectors each is its own entry; half a step is all that is lost.
    assert all(np.abs(np.array(v) - decoded[i]).max() <= 0.5 / 256 for i, v, _ in rows)


def test_few_rows_leave_a_task(spark):
    kept = vc.kept_vectors(table(spark, some_vectors(400, 16), COLUMNS))
    books = vc.train_codebooks(kept, rounds=0)
    tasks = kept.rdd.getNumPartitions()
    sums = vc.in_arrow(kept.select("embedding"), vc._sums_of(books), "part int, entry int, sums array<long>")
    assert sums.count() <= tasks * 16 * 64
