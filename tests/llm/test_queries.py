"""The registered queries over whole tables, against SQL or brute force."""

import hashlib
import os
import sys
import zlib

import numpy as np
import pytest
import tiktoken
import public_tokenizers
from conftest_llm import by_id
from test_pair_operators import brute_bytes, brute_fingerprint, brute_words, reach
from test_text_operators import base_spans, brute_tokens

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from compare import connect, rows_of  # noqa: E402

import corpus_pipeline  # noqa: E402
from billstream.llm import byte_bpe, decontaminate, language_crf, pii  # noqa: E402
from billstream.llm.queries import QUERIES, SQL  # noqa: E402

FOLDER = "/root/testdata/sf0.001"


def digest(text):
    return hashlib.sha256(text.encode() if isinstance(text, str) else text).hexdigest()


@pytest.fixture(scope="module")
def documents():
    return connect(FOLDER).execute("SELECT doc_id, text FROM documents ORDER BY doc_id").fetchall()


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.read_ranks(byte_bpe.ranks_path()), special_tokens={}
    )


def run(spark, name, *columns):
    got = QUERIES[name](spark, FOLDER)
    return by_id(got.select(*columns).collect() if columns else got.collect())


def test_names_and_numbers():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(SQL) <= set(QUERIES) and [n for n, _ in corpus_pipeline.STAGES][0] == "language_id"


@pytest.mark.parametrize("name", sorted(SQL))
def test_sql(spark, name):
    got = QUERIES[name](spark, FOLDER)
    cursor = connect(FOLDER).execute(SQL[name])
    assert rows_of(got.columns, [tuple(r) for r in got.collect()]) == rows_of([d[0] for d in cursor.description], cursor.fetchall())


def test_op1(spark, documents):
    assert run(spark, "op1_token_store", "doc_id", "start", "n_tokens", "ids_crc32") == by_id(brute_tokens(documents))


def test_op2(spark, documents):
    want = []
    for doc_id, text in documents:
        base = base_spans(text or "")
        count = [sum(s[0] == k for s in base) for k in pii.BASE_KINDS]
        want.append((doc_id, *count, digest(",".join("{}:{}:{}".format(*s) for s in base))))
    got = run(spark, "op2_pii", "doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256")
    assert got == by_id(want) and sum(sum(r[1:5]) for r in want) > 0


def test_op3(spark, documents, library):
    want = []
    for doc_id, text in documents:
        ids = np.array(library.encode_ordinary(text or ""), "<u4")
        want.append((doc_id, len(ids), digest(ids.tobytes()), digest(text or "")))
    assert run(spark, "op3_byte_bpe", "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == by_id(want)


def test_op5(spark, documents):
    assert run(spark, "op5_word_dedup") == by_id(brute_words(documents, 50))


def test_op6(spark):
    rows = connect(FOLDER).execute("SELECT vec_id, embedding FROM embeddings ORDER BY vec_id").fetchall()
    x = np.array([r[1] for r in rows])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = x @ x.T >= 0.95
    np.fill_diagonal(near, False)
    label = reach(len(rows), list(zip(*np.nonzero(near))))
    want = [(v, int(near[i].sum()), rows[label[i]][0], label[i] == i) for i, (v, _) in enumerate(rows)]
    assert run(spark, "op6_embedding_pairs") == by_id(want)


def test_op7(spark, documents):
    lang = dict(connect(FOLDER).execute("SELECT doc_id, lang FROM documents").fetchall())
    got = QUERIES["op7_language_crf"](spark, FOLDER).collect()
    assert len(got) == len(documents)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    held = [r for r in got if r.held_out]
    assert len(held) > 20 and sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.98 * len(held)


def groups(documents):
    prints = [brute_fingerprint(t) for _, t in documents]
    links = [(a, b) for a in range(len(prints)) for b in range(a) if (prints[a] ^ prints[b]).bit_count() <= 2]
    return prints, reach(len(prints), links)


def test_op8(spark, documents):
    prints, label = groups(documents)
    want = [(d, f"{p:016x}", documents[c][0]) for (d, _), p, c in zip(documents, prints, label)]
    assert run(spark, "op8_simhash") == by_id(want)


def test_op9(spark, documents):
    assert run(spark, "op9_suffix_dedup") == by_id(brute_bytes(documents, 200))


def test_pipeline(spark, documents, library):
    field = language_crf.fit(spark.read.parquet(f"{FOLDER}/documents.parquet"))
    said = language_crf.label_texts(field, [t or "" for _, t in documents])
    kept = [d for d, (lang, score, _, _) in zip(documents, said) if lang != "und" and score >= language_crf.LEAST_SCORE]
    kept = [d for i, (d, c) in enumerate(zip(kept, groups(kept)[1])) if c == i]
    bad = {r[0] for r in connect(FOLDER).execute(f"SELECT doc_id FROM ({decontaminate.OP10_SQL}) x").fetchall()}
    want = []
    for doc_id, text in kept:
        if doc_id not in bad:
            for kind, start, end, _ in sorted(pii.spans_of(text), key=lambda s: -s[1]):
                text = f"{text[:start]}[{kind.upper()}]{text[end:]}"
            ids = library.encode_ordinary(text)
            want.append((doc_id, ids, digest(text)))
    got = corpus_pipeline.run(spark, FOLDER).select("doc_id", "ids", "decoded_sha256").collect()
    assert by_id((r.doc_id, list(r.ids), r.decoded_sha256) for r in got) == by_id(want) and len(want) < len(documents)
