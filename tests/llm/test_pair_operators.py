"""Operators that compare texts or vectors: SimHash, embeddings, repeats, decontamination, pipeline."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
import xxhash
from conftest_llm import by_id, prose, table

from billstream.llm import common, decontaminate, embedding_pairs, repeats, simhash, suffix_dedup, word_dedup


def reach(n, links):
    label = list(range(n))
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(label[a], label[b])
            if label[a] != low or label[b] != low:
                label[a] = label[b] = low
                changed = True
    return label


@pytest.mark.parametrize("kind", ["random", "chain", "star", "none"])
def test_components(spark, kind):
    rng = random.Random(4)
    links = {
        "random": [(rng.randrange(60), rng.randrange(60)) for _ in range(45)],
        "chain": [(i, i + 1) for i in range(40)],
        "star": [(0, i) for i in range(1, 50)] + [(3, 3)],
        "none": [],
    }[kind]
    got = {r.node: r.component for r in common.components(spark.createDataFrame(links, "a long, b long")).collect()}
    label = reach(60, links)
    assert got == {x: label[x] for pair in links if pair[0] != pair[1] for x in pair}


# ---- SimHash --------------------------------------------------------------------------------


def brute_fingerprint(text):
    words = (text or "").encode().lower().split()
    joined = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(j, 42) for j in joined]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash_equals_brute_force(spark, edge_rows, no_docs):
    base = prose(20, 400).split(" ")
    rows = list(edge_rows)
    for i in range(40):
        words = list(base)
        for k in range(i % 4):
            words[(37 * i + 91 * k) % 400] = "changed"
        rows.append((100 + i, " ".join(words)))
    got = simhash.simhash_groups(table(spark, rows)).collect()
    prints = [brute_fingerprint(t) for _, t in rows]
    links = [(a, b) for a in range(len(rows)) for b in range(a) if (prints[a] ^ prints[b]).bit_count() <= 2]
    label = reach(len(rows), links)
    least = {}
    for (doc_id, _), c in zip(rows, label):
        if doc_id is not None:
            least[c] = min(least.get(c, doc_id), doc_id)
    want = [(i, p, least.get(c)) for (i, _), p, c in zip(rows, prints, label)]
    assert by_id((r.doc_id, r.fp % 2**64, r.component_id) for r in got) == by_id(want)
    assert simhash.simhash_groups(no_docs).count() == 0
    kept = simhash.first_of_groups(table(spark, rows))
    assert {r.doc_id for r in kept.collect()} == set(least.values()) | {None}


def test_repeated_ids_are_decided_by_row(spark):
    a, b, c, d = (prose(50 + i, 80) for i in range(4))
    # 1 and 2 share a text; the other text of 2 is the only one of its group; 3 and 4 share d.
    rows = [(1, a), (1, a), (2, a), (2, b), (3, c), (3, d), (4, d), (None, a), (5, None), (5, None)]
    docs = table(spark, rows)
    kept = simhash.first_of_groups(docs)
    assert kept.columns == docs.columns
    want = [(1, a), (2, b), (3, c), (3, d), (None, a), (5, None)]
    assert by_id(kept.select("doc_id", "text").collect()) == by_id(want)
    got = {(r.doc_id, r.fp % 2**64): r.component_id for r in simhash.simhash_groups(docs).collect()}
    assert got[2, brute_fingerprint(b)] == 2 and got[2, brute_fingerprint(a)] == 1
    # Two texts of 7 are near one text each; the id does not join the two groups.
    e, f = prose(60, 400).split(" "), prose(61, 400).split(" ")
    near = [(7, " ".join(e)), (7, " ".join(f)), (8, " ".join(e)), (9, " ".join(f))]
    assert by_id(simhash.first_of_groups(table(spark, near)).select("doc_id", "text").collect()) == by_id(near[:2])


def test_trie_walk_equals_all_pairs():
    rng = np.random.default_rng(0)
    base = rng.integers(0, 2**63, 80, dtype=np.uint64)
    values = np.unique(np.concatenate([base, *(base ^ (np.uint64(1) << rng.integers(0, 64, 80, dtype=np.uint64)) for _ in range(5)), np.array([0, 1, 3, 2**64 - 1], np.uint64)]))
    apart = np.bitwise_count(values[:, None] ^ values[None, :])
    want = {(int(a), int(b)) for a, b in zip(*np.nonzero(apart <= 2)) if a < b}
    got = [(int(a), int(b)) for x, y in simhash.near_pairs(values, None, 0, 2) for a, b in zip(x, y)]
    assert len(got) == len(set(got)) and set(got) == want


def test_dealt_blocks_equal_one_block(spark, monkeypatch):
    rng = np.random.default_rng(1)
    values = rng.integers(0, 2**63, 60, dtype=np.int64)
    values = np.unique(np.concatenate([values, values ^ (1 << 5), values ^ (1 << 62)]))
    uniq = spark.createDataFrame([(int(v), i) for i, v in enumerate(values)], "fp long, first_id long")
    found = []
    for leaf in (4096, 8):
        monkeypatch.setattr(simhash, "LEAF", leaf)
        rows = simhash.near_links(uniq).collect()
        found.append(sorted(tuple(sorted((r.a, r.b))) for r in rows))
    assert found[0] == found[1] and len(found[0]) >= 120


def test_heavy_nodes_are_dealt_out_deeper(spark, monkeypatch):
    # Two templates, each the other's complement: most bits are in balance, but they say the same.
    rng = np.random.default_rng(2)
    spots = np.array([3, 9, 14, 20, 25, 31, 37, 42, 60], np.uint64)
    own = np.unique((rng.random((150, 9)) < 0.35).astype(np.uint64) @ (np.uint64(1) << spots))
    values = np.unique(np.concatenate([np.uint64(0x0123456789ABCDEF) ^ own, ~np.uint64(0x0123456789ABCDEF) ^ own])).view(np.int64)
    values = np.append(values, np.int64(0))
    uniq = spark.createDataFrame([(int(v), i) for i, v in enumerate(values)], "fp long, first_id long")
    monkeypatch.setattr(simhash, "LEAF", 4)
    monkeypatch.setattr(simhash, "DEEPER", 24)
    walked, walk = [], simhash._block_links

    def seen(depth, most):
        def links(batches):
            for batch in batches:
                assert all(len(r["left"]) <= 16 and len(r["right"]) <= 16 for r in batch.to_pylist())
                yield from walk(depth, most)(iter([batch]))

        walked.append(depth)
        return links

    monkeypatch.setattr(simhash, "_block_links", seen)
    got = [tuple(sorted((r.a, r.b))) for r in simhash.near_links(uniq).collect()]
    apart = np.bitwise_count(values.view(np.uint64)[:, None] ^ values.view(np.uint64)[None, :])
    want = {(int(a), int(b)) for a, b in zip(*np.nonzero(apart <= 2)) if a < b}
    assert len(got) == len(set(got)) and set(got) == want and len(want) > 300 and len(walked) > 1


# ---- embeddings -----------------------------------------------------------------------------


def vectors(seed, n, size=24):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(n, size))
    near = base[: n // 2] + rng.normal(size=(n // 2, size)) * 0.06 * np.linalg.norm(base[: n // 2], axis=1, keepdims=True) / np.sqrt(size) * 3
    return [[float(np.float32(x)) for x in v] for v in np.concatenate([base, near, near[:5], 3 * base[:4]])]


@pytest.mark.parametrize("part", [2000, 4])
def test_embeddings_equal_brute_force(spark, monkeypatch, part):
    monkeypatch.setattr(embedding_pairs, "PART", part)
    good = vectors(3, 60) + [[1.0, 0.0], [1.0, 0.001], [0.0, 1.0]] + [[5.0] * 24] * 9
    bad = [None, [], [0.0] * 24, [float("nan")] * 24, [1.0, None], [float("inf"), 1.0]]
    rows = [(2 * i + 1, v) for i, v in enumerate(good + bad)]
    got = {r.vec_id: r for r in embedding_pairs.embedding_groups(table(spark, rows, "vec_id long, embedding array<float>")).collect()}
    links = []
    for a in range(len(good)):
        for b in range(a):
            x, y = np.array(good[a]), np.array(good[b])
            if len(x) == len(y) and x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= 0.95:
                links.append((a, b))
    degree, label = Counter(x for pair in links for x in pair), reach(len(rows), links)
    assert len(links) > 60 and len(got) == len(rows)
    for i, (vec_id, _) in enumerate(rows):
        r = got[vec_id]
        assert (r.n_links, r.component_id, r.kept) == (degree[i], 2 * label[i] + 1, label[i] == i)


def test_embedding_edges(spark):
    schema = "vec_id long, embedding array<float>"
    assert embedding_pairs.embedding_groups(table(spark, [], schema)).count() == 0
    got = embedding_pairs.embedding_groups(table(spark, [(1, [1.0, 2.0]), (1, [1.0, 2.0]), (None, [3.0, 1.0]), (None, None)], schema)).collect()
    assert by_id((r.vec_id, r.n_links, r.component_id) for r in got) == by_id([(1, 1, 1), (1, 1, 1), (None, 0, None), (None, 0, None)])


def test_hash_recall():
    rng = np.random.default_rng(8)
    a = rng.normal(size=(2000, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    o = rng.normal(size=a.shape)
    o -= (o * a).sum(1, keepdims=True) * a
    b = 0.95 * a + np.sqrt(1 - 0.95**2) * o / np.linalg.norm(o, axis=1, keepdims=True)
    x, y = embedding_pairs.bucket_codes(a), embedding_pairs.bucket_codes(b)
    met = ((x == y[:, :, :1]).any(2) | (y == x[:, :, :1]).any(2)).any(1)
    assert met.mean() >= 0.999


# ---- repeats --------------------------------------------------------------------------------


def brute_words(rows, size):
    first = {}
    for i, t in rows:
        w = (t or "").encode().split()
        for k in range(len(w) - size + 1):
            key = tuple(w[k : k + size])
            if i is not None:
                first[key] = min(first.get(key, i), i)
    out = []
    for i, t in rows:
        w = (t or "").encode().split()
        gone = np.zeros(len(w), bool)
        for k in range(len(w) - size + 1):
            if i is not None and first[tuple(w[k : k + size])] < i:
                gone[k : k + size] = True
        kept = b" ".join(x for x, g in zip(w, gone) if not g)
        out.append((i, len(w), int(gone.sum()), hashlib.sha256(kept).hexdigest()))
    return out


def brute_bytes(rows, size):
    count = Counter()
    for _, t in rows:
        b = (t or "").encode()
        count.update(b[k : k + size] for k in range(len(b) - size + 1))
    out = []
    for i, t in rows:
        b = (t or "").encode()
        gone = np.zeros(len(b), bool)
        for k in range(len(b) - size + 1):
            if count[b[k : k + size]] > 1:
                gone[k : k + size] = True
        n = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((i, len(b), int(gone.sum()), n, hashlib.sha256(np.frombuffer(b, np.uint8)[~gone].tobytes()).hexdigest()))
    return out


def near_copies():
    """A group of near copies with edits everywhere, and one passage within many different texts."""
    words, rows = prose(30, 160).split(" "), []
    for i in range(60):
        mine = list(words)
        mine[(7 * i) % 160] = f"edit{i % 9}"
        rows.append((200 + i, " ".join(mine)))
    passage = prose(31, 55)
    return rows + [(300 + i, f"{prose(400 + i, 30)} {passage} {prose(500 + i, 30)}") for i in range(40)]


@pytest.mark.parametrize("hot", [4096, 3])
def test_word_repeats_equal_brute_force(spark, edge_rows, monkeypatch, hot):
    monkeypatch.setattr(repeats, "HOT", hot)
    rows = edge_rows + near_copies()
    got = word_dedup.remove_repeated_words(table(spark, rows)).collect()
    assert by_id(tuple(r)[:4] for r in got) == by_id(brute_words(rows, 50))


@pytest.mark.parametrize("hot", [4096, 3])
def test_byte_repeats_equal_brute_force(spark, edge_rows, monkeypatch, hot):
    monkeypatch.setattr(repeats, "HOT", hot)
    rows = edge_rows + near_copies()
    got = suffix_dedup.remove_repeated_bytes(table(spark, rows)).collect()
    assert by_id(tuple(r)[:5] for r in got) == by_id(brute_bytes(rows, 200))


def test_repeats_of_nothing(spark, no_docs):
    assert suffix_dedup.remove_repeated_bytes(no_docs).count() == 0
    assert word_dedup.remove_repeated_words(no_docs).count() == 0


def test_suffix_order():
    rng = np.random.default_rng(0)
    for _ in range(300):
        s = rng.integers(1, rng.integers(2, 6), rng.integers(0, 60))
        assert suffix_dedup.suffix_order(s).tolist() == sorted(range(len(s)), key=lambda i: s[i:].tolist())
    s = rng.integers(1, 3, 500)
    order = suffix_dedup.suffix_order(np.concatenate([s, [9], s, [10]]))
    assert sorted(order.tolist()) == list(range(1002))


def test_very_long_text_is_cut_with_overlap(monkeypatch):
    text = prose(60, 2000).encode()
    values, counts = repeats.byte_symbols([text])
    unit = repeats.Unit(repeats.byte_symbols, 200, 32)
    whole = repeats.runs(values, counts, unit)
    windows = np.concatenate([np.arange(a, a + n) for a, n in zip(whole["lo"], whole["n"])])
    assert windows.tolist() == list(range(len(text) - 199))
    inside = (whole["off"] >= whole["n"] - 1) & (whole["off"] <= 200 - 32)
    assert inside.all()


# ---- decontamination ------------------------------------------------------------------------


def test_decontamination_equals_brute_force(spark, edge_rows, no_docs):
    import re

    def shingles(text):
        w = re.findall(r"[^\W_]+", (text or "").lower())
        return {tuple(w[i : i + 5]) for i in range(len(w) - 4)}

    items = [(i, prose(700 + i, n)) for i, n in enumerate((5, 6, 9, 14, 30, 60, 200))] + [(7, None), (8, ""), (9, "a b c"), (10, prose(704, 30)), (None, prose(99, 12))]
    rows = list(edge_rows) + [(500 + i, f"{prose(800 + i, 300)} {t} {prose(900 + i, 50)}") for i, t in items if t and i is not None]
    for i, t in items[2:7]:
        words = t.split(" ")
        for cut in (1, 2, 4, 9):
            rows.append((600 + 10 * i + cut, f"{prose(cut, 90)} {' '.join(words[cut:]).upper()}"))
    got = decontaminate.contaminated_pairs(table(spark, rows), table(spark, items, "item_id long, text string")).collect()
    want, by_doc, by_item = [], {}, {}
    for i, t in rows:
        by_doc.setdefault(i, set()).update(shingles(t))
    for i, t in items:
        by_item.setdefault(i, set()).update(shingles(t))
    for d, s in by_doc.items():
        for i, m in by_item.items():
            if m and len(s & m) >= 0.8 * len(m):
                want.append((d, i, len(s & m), len(m)))
    assert len(want) > 12 and by_id(tuple(r)[:4] for r in got) == by_id(want)
    kept = decontaminate.decontaminated(table(spark, rows), table(spark, items, "item_id long, text string"))
    assert {r.doc_id for r in kept.collect()} == set(by_doc) - {w[0] for w in want}
    none = table(spark, [], "item_id long, text string")
    assert decontaminate.contaminated_pairs(table(spark, rows), none).count() == 0
    assert decontaminate.contaminated_pairs(no_docs, table(spark, items, "item_id long, text string")).count() == 0
    assert decontaminate.decontaminated(table(spark, rows), none).count() == len(rows)


def test_decontamination_is_native(spark, edge_docs):
    items = table(spark, [(1, prose(1, 30))], "item_id long, text string")
    plan = decontaminate.contaminated_pairs(edge_docs, items)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas", "Cartesian", "NestedLoop"))


# ---- pipeline -------------------------------------------------------------------------------


def test_pipeline_stages(spark):
    import corpus_pipeline

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    columns, before = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES:
        docs = common.stored(stage(spark, docs, "/root/testdata/sf0.001"), name)
        assert docs.columns == columns or name == "byte_bpe"
        assert docs.count() <= before
        before = docs.count()
    assert before == corpus_pipeline.run(spark, "/root/testdata/sf0.001").count() > 100
