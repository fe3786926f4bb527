import random
import re
from collections import Counter

import numpy as np
import pytest
from conftest_llm import table
from hypothesis import given, settings
from hypothesis import strategies as st

from billstream.llm import collocations as co

COLUMNS = "doc_id long, text string, lang string"


def brute(rows, least, longest=5, top=2000):
    found, total = {}, Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(words)
            for k in range(1, longest + 1):
                for i in range(len(words) - k + 1):
                    found.setdefault(lang, Counter())[tuple(words[i : i + k])] += 1
    out = []
    for lang, f in found.items():
        n, ranked = total[lang], []
        many = {p: a for p, a in f.items() if a >= least}
        for p, a in many.items():
            if len(p) < 2:
                continue
            held = any(len(q) > len(p) and 100 * b >= 100 * a and any(q[i : i + len(p)] == p for i in range(len(q))) for q, b in many.items())
            if not held:
                score, _, l, r = min((1000 * a * n // (f[p[:c]] * f[p[c:]]), c, f[p[:c]], f[p[c:]]) for c in range(1, len(p)))
                ranked.append((-score, -a, " ".join(p).encode(), l, r))
        ranked.sort()
        out += [(lang, i + 1, p.decode(), -a, l, r, n, -s) for i, (s, a, p, l, r) in enumerate(ranked[:top])]
    return sorted(out)


def found(spark, rows, least, **more):
    frame = co.collocations(table(spark, rows, COLUMNS), least, **more)
    assert frame.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(tuple(r) for r in frame.collect())


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 63), st.lists(st.tuples(st.integers(0, 2**63 - 1), st.sampled_from([1, 2, 3, 256, 257, 258, 2**40])), max_size=60))
def test_filter_loses_nothing(bits, rows):
    own = dict((k % (1 << bits), c) for k, c in rows)
    keys = np.array(sorted(own), np.uint64)
    counts = np.array([own[int(k)] for k in keys], np.int64)
    again = co.unpack_filter(co.pack_filter(keys, counts, bits), bits)
    assert (again[0] == keys).all() and (again[1] == counts).all()
    assert (co.restored(co.permuted(keys, bits), bits) == keys).all() and (co.permuted(keys, bits) < 1 << bits).all()


def test_permutation_is_one_to_one():
    for bits in (1, 2, 3, 8, 13):
        x = np.arange(1 << bits, dtype=np.uint64)
        assert (np.sort(co.permuted(x, bits)) == x).all()


def test_filter_is_compact():
    rng = np.random.default_rng(1)
    keys = np.unique(co.permuted(rng.integers(0, 1 << 34, 300_000).astype(np.uint64), 34))
    assert len(co.pack_filter(keys, np.ones(len(keys), np.int64), 34)) < 2.6 * len(keys)


def test_merge():
    rng = np.random.default_rng(2)
    parts = [np.unique(rng.integers(0, 50, 30).astype(np.uint64), return_counts=True) for _ in range(7)]
    keys, counts = co.merge_counts([*parts, (np.zeros(0, np.uint64), np.zeros(0, np.int64))])
    want = Counter()
    for k, c in parts:
        want.update(dict(zip(k.tolist(), c.tolist())))
    assert dict(zip(keys.tolist(), counts.tolist())) == want and (np.diff(keys.astype(np.int64)) > 0).all()


def test_long_texts_are_cut_at_breaks(monkeypatch):
    monkeypatch.setattr(co, "PORTION", 50)
    raw = b"one two three. four five, six seven " * 40
    parts = list(co._in_portions(raw))
    tokens = [t for p in parts for t in co.tokens_of(p)]
    assert len(parts) > 5 and tokens == co.tokens_of(raw)


def some_rows(n, seed):
    rng = random.Random(seed)
    words = ["the", "The", "of", "red", "Ébène", "ébène", "x y", "a\x1cb", "nul\x00", "ok"]
    phrases = ["of the red house", "of the red", "a a a a a a", "New York City", "new york"]
    rows = []
    for i in range(n):
        parts = [rng.choice(words + phrases) + rng.choice([" ", "  ", "\t", ", ", ".", "\n", "\r\n", " - "]) for _ in range(rng.randint(0, 60))]
        rows.append((i, "".join(parts), rng.choice(["en", "en", "de", None, "und"])))
    return rows


@pytest.mark.parametrize("least,shard", [(2, 1 << 22), (5, 16), (12, 1)])
def test_against_loops(spark, least, shard):
    rows = some_rows(80, least)
    assert found(spark, rows, least, shard=shard) == brute(rows, least)


def test_top_and_longest(spark):
    rows = some_rows(60, 9)
    assert found(spark, rows, 3, top=7) == brute(rows, 3, top=7)
    assert found(spark, rows, 3, longest=3) == brute(rows, 3, longest=3)


def test_edge_rows(spark, edge_rows):
    rows = [(i, t, None if n % 3 else "en") for n, (i, t) in enumerate(edge_rows)]
    assert found(spark, rows, 3) == brute(rows, 3)
    assert found(spark, [], 1) == [] and found(spark, [(1, None, None), (2, "", "en"), (3, " .,\n", "en")], 1) == []
    assert found(spark, [(1, "only words. each, alone", "en")], 1) == brute([(1, "only words. each, alone", "en")], 1)


def test_products_pass_64_bits(spark):
    rows = spark.createDataFrame([(3_000_000_000, 4_000_000_000, 5_000_000_000, 6_000_000_000)], "a long, n long, l long, r long")
    exact = rows.selectExpr("(cast(1000 as decimal(5,0)) * (cast(a as decimal(19,0)) * cast(n as decimal(19,0)))) div (cast(l as decimal(19,0)) * cast(r as decimal(19,0))) AS x")
    assert exact.first().x == 1000 * 3 * 4 * 10**18 // (30 * 10**18)


def test_planes():
    for numbers in ([], [-1], [0, -1, 254, 255], [-1, 2**16, 7], [2**40, -1]):
        x = np.array(numbers, np.int64)
        assert co.from_planes(co.planes(x)).tolist() == numbers
    assert len(co.planes(np.arange(1000))) < 2001 and len(co.planes(np.full(100_000, 3))) < 200
    for words in ([], [b"a"], [b"a", "é".encode(), b"\x00"]):
        assert co.unpack_words(co.pack_words(words)) == words
