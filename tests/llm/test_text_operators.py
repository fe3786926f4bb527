"""Operators that work on each text by itself: PII, byte-level BPE, language, token store."""

import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from conftest_llm import by_id, prose, table
from tokenizers import Tokenizer

from billstream.llm import byte_bpe, language_crf, pii, token_store

# ---- PII ------------------------------------------------------------------------------------

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def base_spans(text):
    out = []
    for kind, pattern in BASE.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            good = {
                "email": lambda: True,
                "ip": lambda: all(int(p) < 256 for p in m[0].split(".")),
                "card": lambda: 16 <= len(digits) <= 19 and pii.luhn(digits),
                "phone": lambda: 8 <= len(digits) <= 15,
            }[kind]()
            if good:
                out.append((kind, *m.span()))
    return out


def test_base_spans_equal_plain_patterns():
    rng = random.Random(3)
    bits = ["@", "a", "b.c", ".", "-", " ", "+", "1", "23", "4111 1111 1111 1111", "192.168.1.", "+44 20 7946 0958", "(", "x@y.z", "%", "é", "\n"]
    for _ in range(5000):
        text = "".join(rng.choice(bits) for _ in range(rng.randint(1, 14)))
        assert [s[:3] for s in pii.spans_of(text) if s[0] in BASE] == base_spans(text)


@pytest.mark.parametrize("text", ["a" * 300_000 + "@", "1." * 100_000, "+" * 100_000, "1 " * 200_000, "0" * 100_000 + ".1.2.3"])
def test_long_runs_stay_linear(text):
    assert len(pii.spans_of(text)) <= len(text)


def test_checksums_and_context():
    assert [s[0] for s in pii.spans_of("iban GB82 WEST 1234 5698 7654 32 here")] == ["iban"]
    assert pii.spans_of("iban GB82 WEST 1234 5698 7654 33 here") == []
    assert [s[0] for s in pii.spans_of("social security 123-45-6789")] == ["ssn"]
    assert pii.spans_of("part 123-45-6789") == []
    near, far = (pii.spans_of(t)[0][3] for t in ("call +49 30 1234567", "x +49 30 1234567"))
    assert near > far


@pytest.mark.parametrize(
    "text, want",
    [
        ("IBAN DE89370400440532013000 BIC COBADEFFXXX", ["DE89370400440532013000"]),
        ("DE89 3704 0044 0532 0130 00 Please pay", ["DE89 3704 0044 0532 0130 00"]),
        ("DE89370400440532013000 12 May", ["DE89370400440532013000"]),
        ("DE89370400440532013000 A", ["DE89370400440532013000"]),
        ("DE89370400440532013000 GB82 WEST 1234 5698 7654 32", ["DE89370400440532013000", "GB82 WEST 1234 5698 7654 32"]),
        ("GB82WEST12345698765432 NO93 8601 1117 947 DE89370400440532013000", ["GB82WEST12345698765432", "NO93 8601 1117 947", "DE89370400440532013000"]),
        ("REF AB12 DE89 3704 0044 0532 0130 00 1", ["DE89 3704 0044 0532 0130 00"]),
        ("LC14BOSL123456789012345678901234 2026", ["LC14BOSL123456789012345678901234"]),
        ("XDE89370400440532013000 DE89370400440532013000x DE89370400440532013001 12", []),
    ],
)
def test_iban_before_words_numbers_and_ibans(text, want):
    assert [text[a:b] for kind, a, b, _ in pii.spans_of(text) if kind == "iban"] == want


def test_iban_of_an_unlisted_country_and_in_redaction(spark):
    body = "ZZ00ABCD12345678"
    number = int("".join(str(int(c, 36)) for c in body[4:] + body[:4]))
    iban = f"ZZ{98 - number % 97:02}ABCD12345678"
    assert [s[1:3] for s in pii.spans_of(f"{iban} Then")] == [(0, 16)]
    docs = table(spark, [(1, "pay DE89370400440532013000 GB82 WEST 1234 5698 7654 32 Today")])
    assert pii.redact_pii(docs).first()["text"] == "pay [IBAN] [IBAN] Today"


@pytest.mark.parametrize("text", ["AA11 " * 60_000, "AA11" + " 1" * 150_000, "AA11" * 75_000])
def test_long_iban_runs_stay_linear(text):
    assert len(pii.spans_of(text)) <= len(text)


def test_pii_rows_and_redaction(spark, edge_docs, no_docs, edge_rows):
    assert pii.find_pii(edge_docs).count() == len(edge_rows)
    assert pii.find_pii(no_docs).count() == pii.redact_pii(no_docs).count() == 0
    docs = table(spark, [(1, "mail a.b@c.de, ip 10.0.0.1"), (2, None), (2, None), (None, "+4930 123456-7@x.yz")])
    got = pii.redact_pii(docs)
    assert got.columns == docs.columns
    assert by_id(got.select("doc_id", "text", "n_chars").collect()) == by_id(
        [(1, "mail [EMAIL], ip [IP]", 21), (2, None, 0), (2, None, 0), (None, "[PHONE]", 7)]
    )


# ---- byte-level BPE -------------------------------------------------------------------------


@pytest.fixture(scope="module")
def reference():
    ranks = byte_bpe.read_ranks(byte_bpe.ranks_path())
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_pieces_and_merges_equal_the_library(reference):
    rng, encoder = random.Random(1), byte_bpe.ByteEncoder(byte_bpe.ranks_path())
    signs = " \n\t'''srvltedmaXé漢5½_!.\u00a0\u3000\x1c\x85\u0301\U0001f600"
    for _ in range(60):
        texts = ["".join(rng.choice(signs) for _ in range(rng.choice([0, 1, 2, 5, 30, 900]))) for _ in range(20)]
        for text, (ids, offsets) in zip(texts, encoder.encode(texts)):
            assert ids.tolist() == reference.encode_ordinary(text)
            assert encoder.decode(ids) == text.encode()
            assert all(0 <= o < len(text) for o in offsets)


def test_scan_composes_functions():
    kinds = np.random.default_rng(0).integers(0, len(byte_bpe.CLASSES), 5000).astype(np.uint8)
    target, state, want = byte_bpe.automaton()["target"], 0, []
    for kind in kinds:
        want.append(state)
        state = target[state, kind]
    for width in (1, 7, 512):
        assert byte_bpe.states_before(kinds, width).tolist() == want


def test_bpe_rows(spark, edge_docs, no_docs, edge_rows, reference):
    got = byte_bpe.encode_documents(edge_docs, byte_bpe.ranks_path())
    rows = got.collect()
    want = []
    for doc_id, text in edge_rows:
        ids = np.array(reference.encode_ordinary(text or ""), "<u4")
        want.append((doc_id, len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    assert by_id((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in rows) == by_id(want)
    back = byte_bpe.decode_documents(got, byte_bpe.ranks_path()).collect()
    assert by_id((r.doc_id, r.text) for r in back) == by_id((i, t or "") for i, t in edge_rows)
    assert byte_bpe.encode_documents(no_docs, byte_bpe.ranks_path()).count() == 0


# ---- token store ----------------------------------------------------------------------------

WORDS = "word_bpe_49k.json"


def brute_tokens(rows):
    tokenizer = Tokenizer.from_file(public_tokenizers.path(WORDS))
    start, out = 0, []
    for doc_id, text in sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1])):
        ids = np.array(tokenizer.encode(text, add_special_tokens=False).ids + [2], "<u4")
        out.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_word_encoder_equals_the_library():
    rng, tokenizer = random.Random(2), Tokenizer.from_file(public_tokenizers.path(WORDS))
    encoder = token_store.WordEncoder(public_tokenizers.path(WORDS))
    signs = " \n\t'sS.,rÉé\u0301漢5½_!\u00a0\u2003\x1c\x01\x85ßIİ<|endoftext|>"
    for _ in range(40):
        texts = ["".join(rng.choice(signs) for _ in range(rng.choice([0, 1, 3, 40]))) for _ in range(20)] + ["a <|endoftext|>b's Tests, Été."]
        for text, raw in zip(texts, encoder.encode(texts)):
            assert np.frombuffer(raw, f"<u{encoder.width}").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("shard_bytes", [1, 2000, 1 << 22])
def test_store_reads_back(spark, edge_docs, edge_rows, tmp_path, shard_bytes):
    path = str(tmp_path / "store")
    token_store.write_token_store(edge_docs, path, public_tokenizers.path(WORDS), 2, shard_bytes)
    got = token_store.read_token_digests(spark, path).collect()
    assert by_id(got) == by_id(brute_tokens(edge_rows))
    wanted = spark.createDataFrame([(6,), (8,), (-3,), (99,), (None,), (6,)], "doc_id long")
    found = token_store.fetch_tokens(spark, path, wanted).collect()
    assert sorted(r.doc_id for r in found) == [-3, 6, 6, 8]
    sizes = {(i, n) for i, _, n, _ in brute_tokens(edge_rows)}
    assert all((r.doc_id, len(r.ids)) in sizes for r in found)


def test_empty_store(spark, no_docs, tmp_path):
    path = str(tmp_path / "store")
    token_store.write_token_store(no_docs, path, public_tokenizers.path(WORDS), 2)
    assert token_store.read_token_digests(spark, path).count() == 0
    assert token_store.fetch_tokens(spark, path, spark.range(3).withColumnRenamed("id", "doc_id")).count() == 0


def test_perfect_hash():
    keys = np.unique(np.random.default_rng(5).integers(-(2**62), 2**62, 20_000))
    sizes, bits, left = token_store.build_hash(keys)
    assert sorted(token_store.slot_of(keys, sizes, bits, np.sort(left)).tolist()) == list(range(len(keys)))
    index = token_store.build_index(keys)
    first, rows = token_store.look_up(index, keys)
    assert (first == np.arange(len(keys))).all() and (rows == 1).all()
    strangers = np.arange(2**62 + 1, 2**62 + 20_001)
    assert (token_store.look_up(index, strangers)[1] > 0).mean() < 0.001


# ---- language -------------------------------------------------------------------------------


def syllables(lang, seed, words):
    rng = random.Random(f"{lang}{seed}")
    parts = {"aa": ["ka", "lo", "mi", "tu"], "bb": ["sch", "ung", "ein", "ber"], "cc": ["eau", "oux", "lle", "ai"]}[lang]
    return " ".join("".join(rng.choice(parts) for _ in range(rng.randint(1, 4))) for _ in range(words))


@pytest.fixture(scope="module")
def labelled():
    return [(i, syllables(lang := ("aa", "bb", "cc")[i % 3], i, 20 + i % 50), lang) for i in range(240)]


def test_held_out_accuracy(spark, labelled):
    docs = table(spark, labelled, "doc_id long, text string, lang string")
    field = language_crf.fit(docs)
    got = {r.doc_id: r for r in language_crf.identify(docs, field).collect()}
    held = [r for r in labelled if zlib.crc32(str(r[0]).encode()) % 4 == 2]
    assert len(held) > 30 and sum(got[i].lang_pred == lang for i, _, lang in held) >= 0.98 * len(held)
    assert all(0 <= r.score <= 1 for r in got.values())
    mixed = f"{syllables('aa', 900, 40)} {syllables('bb', 901, 15)}"
    pred, _, shares, switches = language_crf.label_texts(field, [mixed])[0]
    assert pred == "aa" and 0.15 < shares["bb"] < 0.4 and 1 <= switches <= 6


def test_prediction_needs_text_alone_and_edges(spark, labelled, edge_docs, no_docs, edge_rows):
    field = language_crf.fit(table(spark, labelled, "doc_id long, text string, lang string"))
    got = language_crf.identify(edge_docs, field).collect()
    assert len(got) == len(edge_rows)
    assert {r.lang_pred for r in got if r.doc_id in (1, 2, 3)} == {"und"}
    assert language_crf.identify(no_docs, field).count() == 0
    nothing = language_crf.fit(no_docs)
    assert {r.lang_pred for r in language_crf.identify(edge_docs, nothing).collect()} == {"und"}
    shuffled = [(t, f"{t} {t}") for t in (syllables("cc", 3, 500), "word", "")]
    for one, two in shuffled:
        a, b = language_crf.label_texts(field, [one, two, "x"])[:2]
        assert a == language_crf.label_texts(field, [one])[0] and a[0] == b[0]


def test_forward_backward_equals_enumeration():
    rng = np.random.default_rng(0)
    scores, move, start = rng.normal(size=(4, 1, 2)), rng.normal(size=(2, 2)), rng.normal(size=2)
    begins = np.array([[True], [False], [True], [False]])
    got = language_crf.forward_backward(scores, begins, move, start)
    weight = np.zeros((4, 2))
    for path in np.ndindex(2, 2, 2, 2):
        s = sum(scores[t, 0, path[t]] for t in range(4)) + start[path[0]] + move[path[0], path[1]] + start[path[2]] + move[path[2], path[3]]
        for t in range(4):
            weight[t, path[t]] += np.exp(s)
    assert np.allclose(got[:, 0], weight / weight.sum(1, keepdims=True))


def test_known_language_keeps_columns(spark, labelled):
    docs = table(spark, [*labelled, (900, None, None), (901, "123 !", "aa")], "doc_id long, text string, lang string")
    kept = language_crf.known_language(docs)
    assert kept.columns == docs.columns and kept.count() == len(labelled)
    assert prose(1, 1)


def test_classes_are_those_of_the_pattern(reference):
    encoder = byte_bpe.ByteEncoder(byte_bpe.ranks_path())
    signs = [chr(c) for c in [*range(128, 0x3000), *range(0x3000, 0x110000, 997), 0x18CFF, 0x105C0, 0x10D41, 0x323E7] if not 0xD800 <= c < 0xE000]
    text = "\n\n".join(f"a{c}b {c}1{c}!{c}{c}'s{c}" for c in signs)
    assert encoder.encode([text])[0][0].tolist() == reference.encode_ordinary(text)
