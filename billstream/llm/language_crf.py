"""Language identification with a linear-chain conditional random field over words.

Words carry hashed features (character n-grams, affixes, lexicon entries); weights and transitions
between languages are learned from sequences in which pieces of several languages follow each
other. Forward-backward gives each word its label probabilities; a document's language is the one
with the largest mean.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from billstream.llm.common import in_arrow, slices

UNKNOWN = "und"
#: Bound of the training sample: labelled documents per language, pieces of each, words of a piece.
SAMPLE_DOCS, SAMPLE_PIECES, PIECE_WORDS = 300, 6, 24
BUCKETS = 1 << 17
EPOCHS, BATCH, PIECES_IN_A_ROW = 4, 48, 3
LANES = 256
WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


# ---- features -------------------------------------------------------------------------------


def hashed_features(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all features of distinct words, and where each word's features begin.

    Two- and three-character grams of the word between marks (with the marks: affixes of one and two
    characters), affixes of three characters, and the word as a whole.
    """
    marked = "".join([f"\x02{w}\x03" for w in words])
    codes = np.frombuffer(marked.encode("utf-32-le"), np.uint32).astype(np.uint64)
    ends = np.cumsum([len(w) + 2 for w in words])
    starts = ends - np.array([len(w) + 2 for w in words])
    n = len(codes)
    owner = np.repeat(np.arange(len(words)), ends - starts)
    padded = np.concatenate([codes, np.zeros(4, np.uint64)])
    odd = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]

    def gram(size: int, at: np.ndarray) -> np.ndarray:
        h = np.full(len(at), size * 0x51ED2701, np.uint64)
        for k in range(size):
            h = (h ^ padded[at + k]) * odd[k]
            h ^= h >> np.uint64(29)
        return h

    at, found, who = np.arange(n), [], []
    for size in (2, 3):
        inside = at + size <= ends[owner]
        found.append(gram(size, at[inside]))
        who.append(owner[inside])
    long = np.nonzero(ends - starts >= 4)[0]
    for where in (starts[long], ends[long] - 4):
        found.append(gram(4, where))
        who.append(long)
    found.append(word_hashes(codes, starts))
    who.append(np.arange(len(words)))
    who_all, all_found = np.concatenate(who), np.concatenate(found)
    order = np.argsort(who_all, kind="stable")
    first = np.searchsorted(who_all[order], np.arange(len(words)))
    return (all_found[order] >> np.uint64(40)).astype(np.int64) % BUCKETS, first


def word_hashes(codes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    place = np.arange(len(codes), dtype=np.uint64) - np.repeat(
        starts, np.diff(np.append(starts, len(codes)))
    ).astype(np.uint64)
    x = (codes + np.uint64(0x9E3779B97F4A7C15)) * (2 * place + np.uint64(0xBF58476D1CE4E5B9 | 1))
    x ^= x >> np.uint64(31)
    h = np.add.reduceat(x * np.uint64(0x94D049BB133111EB), starts)
    return h ^ (h >> np.uint64(32))


def hash_words(words: list[str]) -> np.ndarray:
    codes = np.frombuffer("".join([f"\x02{w}\x03" for w in words]).encode("utf-32-le"), np.uint32).astype(np.uint64)
    sizes = np.array([len(w) + 2 for w in words])
    return word_hashes(codes, np.cumsum(sizes) - sizes)


# ---- the field ------------------------------------------------------------------------------


@dataclass
class Field:
    langs: list[str]
    weights: np.ndarray  # bucket, language
    lexicon: np.ndarray  # sorted hashes of words typical of one language
    lexicon_lang: np.ndarray
    lexicon_weight: np.ndarray  # language of the entry, language
    transitions: np.ndarray
    start: np.ndarray

    def emissions(self, words: list[str]) -> np.ndarray:
        """Scores of distinct words, one column for each language."""
        features, first = hashed_features(words)
        out = np.add.reduceat(self.weights[features], first, axis=0)
        entry = self.entries(words)
        known = entry >= 0
        out[known] += self.lexicon_weight[self.lexicon_lang[entry[known]]]
        return out

    def entries(self, words: list[str]) -> np.ndarray:
        if not len(self.lexicon):
            return np.full(len(words), -1)
        h = hash_words(words)
        at = np.minimum(np.searchsorted(self.lexicon, h), len(self.lexicon) - 1)
        return np.where(self.lexicon[at] == h, at, -1)


def _scaled(x: np.ndarray) -> np.ndarray:
    return x / x.sum(-1, keepdims=True)


def forward_backward(scores: np.ndarray, begins: np.ndarray, transitions: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Label probabilities for lanes of sequences: ``scores`` is time, lane, language.

    ``begins`` marks the first word of each sequence of a lane; nothing passes across it.
    """
    steps = len(scores)
    e = np.exp(scores - scores.max(-1, keepdims=True))
    move, first = np.exp(transitions - transitions.max()), np.exp(start - start.max())
    forward, backward = np.empty_like(e), np.ones_like(e)
    flow = begins[..., None]
    for t in range(steps):
        came = np.where(flow[t], first, forward[t - 1] @ move) if t else np.broadcast_to(first, e[0].shape)
        forward[t] = _scaled(came * e[t])
    for t in range(steps - 2, -1, -1):
        backward[t] = np.where(flow[t + 1], 1.0, _scaled((e[t + 1] * backward[t + 1]) @ move.T))
    return _scaled(forward * backward)


def train(rows: list[tuple[str, list[list[str]]]], seed: int = 7) -> Field:
    """Fit a field to rows of a language and pieces of words, by AdaGrad on the log-likelihood."""
    rng = np.random.default_rng(seed)
    langs = sorted({lang for lang, _ in rows})
    n_langs = len(langs)
    pieces = [(langs.index(lang), p) for lang, many in rows for p in many if p]
    vocabulary = sorted({w for _, p in pieces for w in p})
    field = Field(
        langs, np.zeros((BUCKETS, n_langs), np.float32), np.zeros(0, np.uint64), np.zeros(0, np.int64),
        np.zeros((n_langs, n_langs), np.float32), np.zeros((n_langs, n_langs), np.float32), np.zeros(n_langs, np.float32),
    )
    if not vocabulary:
        return field
    number = {w: i for i, w in enumerate(vocabulary)}
    counts = np.zeros((len(vocabulary), n_langs))
    for lang, p in pieces:
        np.add.at(counts[:, lang], [number[w] for w in p], 1)
    typical = np.nonzero((counts.sum(1) >= 3) & (counts.max(1) >= 0.9 * counts.sum(1)))[0]
    if len(typical):
        hashes = hash_words([vocabulary[i] for i in typical])
        order = np.argsort(hashes)
        field.lexicon, field.lexicon_lang = hashes[order], counts[typical].argmax(1)[order]
    features, first = hashed_features(vocabulary)
    size = np.diff(np.append(first, len(features)))
    entry = field.entries(vocabulary)
    kind = np.where(entry >= 0, field.lexicon_lang[np.maximum(entry, 0)] if len(field.lexicon) else 0, -1)
    squares = [np.full(a.shape, 1e-6, np.float32) for a in (field.weights, field.lexicon_weight, field.transitions, field.start)]

    def step(array: np.ndarray, square: np.ndarray, gradient: np.ndarray, rate: float, rows=slice(None)) -> None:
        square[rows] += gradient**2
        array[rows] += rate * gradient / np.sqrt(square[rows])

    for _ in range(EPOCHS):
        shuffled = rng.permutation(len(pieces))
        joined = [shuffled[i : i + PIECES_IN_A_ROW] for i in range(0, len(shuffled), PIECES_IN_A_ROW)]
        for at in range(0, len(joined), BATCH):
            lanes = joined[at : at + BATCH]
            ids = [[number[w] for k in lane for w in pieces[k][1]] for lane in lanes]
            gold = [[pieces[k][0] for k in lane for _ in pieces[k][1]] for lane in lanes]
            steps, many = max(map(len, ids)), len(ids)
            word, label = np.full((steps, many), -1), np.zeros((steps, many), np.int64)
            for j, (a, b) in enumerate(zip(ids, gold)):
                word[: len(a), j], label[: len(b), j] = a, b
            real = word >= 0
            used, inverse = np.unique(word[real], return_inverse=True)
            spread = np.repeat(np.arange(len(used)), size[used])
            where = first[used][spread] + np.arange(len(spread)) - np.repeat(np.cumsum(size[used]) - size[used], size[used])
            bucket = features[where]
            score = np.zeros((len(used), n_langs), np.float32)
            np.add.at(score, spread, field.weights[bucket])
            lex = kind[used]
            score[lex >= 0] += field.lexicon_weight[lex[lex >= 0]]
            scores = np.zeros((steps, many, n_langs), np.float32)
            scores[real] = score[inverse]
            begins = np.zeros((steps, many), bool)
            begins[0] = True
            begins |= ~real
            chance = forward_backward(scores, begins, field.transitions, field.start)
            error = np.where(real[..., None], np.eye(n_langs)[label] - chance, 0).astype(np.float32)
            # Pairs of neighbours: observed less expected under the product of their chances with the move.
            both = real[1:] & real[:-1]
            move = np.exp(field.transitions - field.transitions.max())
            joint = chance[:-1][both][:, :, None] * move * (chance[1:][both] / np.maximum(chance[:-1][both] @ move, 1e-9))[:, None, :]
            joint /= joint.sum((1, 2), keepdims=True)
            seen = np.zeros((n_langs, n_langs))
            np.add.at(seen, (label[:-1][both], label[1:][both]), 1)
            by_word = np.zeros((len(used), n_langs), np.float32)
            np.add.at(by_word, inverse, error[real])
            rows_used, back = np.unique(bucket, return_inverse=True)
            gradient = np.zeros((len(rows_used), n_langs), np.float32)
            np.add.at(gradient, back, by_word[spread])
            step(field.weights, squares[0], gradient, 0.1, rows_used)
            by_lexicon = np.zeros((n_langs, n_langs), np.float32)
            np.add.at(by_lexicon, lex[lex >= 0], by_word[lex >= 0])
            step(field.lexicon_weight, squares[1], by_lexicon, 0.05)
            step(field.transitions, squares[2], (seen - joint.sum(0)).astype(np.float32), 0.05)
            step(field.start, squares[3], error[0].sum(0), 0.02)
    return field


# ---- use ------------------------------------------------------------------------------------


def label_texts(field: Field, texts: list[str]) -> list[tuple[str, float, dict[str, float], int]]:
    """Language, its mean probability, the share of each language, and label changes, for whole texts."""
    nothing = (UNKNOWN, 0.0, {}, 0)
    if not field.langs:
        return [nothing] * len(texts)
    number: dict[str, int] = {}
    ids = [np.array([number.setdefault(w, len(number)) for w in words_of(t)], np.int64) for t in texts]
    out = [nothing] * len(texts)
    filled = sorted((i for i in range(len(texts)) if len(ids[i])), key=lambda i: -len(ids[i]))
    if not filled:
        return out
    # Whole texts are laid into lanes of about equal length, one behind the other.
    total, longest = sum(len(x) for x in ids), len(ids[filled[0]])
    lanes = [(0, k) for k in range(max(1, min(LANES, total // longest + 1)))]
    place = {}
    for i in filled:
        length, k = heapq.heappop(lanes)
        place[i] = (length, k)
        heapq.heappush(lanes, (length + len(ids[i]), k))
    steps = max(length for length, _ in lanes)
    word, begins = np.zeros((steps, len(lanes)), np.int64), np.ones((steps, len(lanes)), bool)
    for i, (t, k) in place.items():
        word[t : t + len(ids[i]), k] = ids[i]
        begins[t + 1 : t + len(ids[i]), k] = False
    scores = field.emissions(list(number))[word]
    chance = forward_backward(scores, begins, field.transitions, field.start)
    for i, (t, k) in place.items():
        mine = chance[t : t + len(ids[i]), k]
        mean = mine.mean(0, dtype=np.float64)
        best = int(mean.argmax())
        labels = mine.argmax(1)
        shares = {lang: round(float(s), 6) for lang, s in zip(field.langs, mean)}
        out[i] = (field.langs[best], min(1.0, float(mean[best])), shares, int((labels[1:] != labels[:-1]).sum()))
    return out


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from training: crc32 of its id as text leaves 2 by 4."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in slices(batches):
        found = []
        for text in part["text"].to_pylist():
            words = words_of(text)
            gap = max(PIECE_WORDS, len(words) // SAMPLE_PIECES)
            found.append([" ".join(words[i : i + PIECE_WORDS]) for i in range(0, len(words), gap)][:SAMPLE_PIECES])
        yield pa.RecordBatch.from_arrays([part["doc_id"], part["lang"], pa.array(found, pa.list_(pa.string()))], ["doc_id", "lang", "pieces"])


def fit(docs: DataFrame) -> Field:
    """Learn from ``text`` and ``lang`` of rows that are not held out.

    The sample is bounded by ``SAMPLE_DOCS`` documents of each language, those with the smallest hash
    of their id, and pieces from all over each. Rows without text or language are left out.
    """
    usable = docs.select("doc_id", "text", "lang").where(
        F.col("text").isNotNull() & F.col("lang").isNotNull() & ~held_out(F.col("doc_id"))
    )
    # Ranked by id alone; the texts of the chosen few are fetched afterwards.
    by_lang = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    chosen = usable.select("doc_id", "lang").withColumn("rank", F.row_number().over(by_lang)).where(F.col("rank") <= SAMPLE_DOCS)
    ids = [r[0] for r in chosen.select("doc_id").distinct().collect() if r[0] is not None]
    sample = usable.where(F.col("doc_id").isin(ids)) if ids else usable.limit(0)
    rows = in_arrow(sample, _pieces, "doc_id long, lang string, pieces array<string>").collect()
    rows = sorted({(r["lang"], r["doc_id"], tuple(r["pieces"])) for r in rows})
    return train([(lang, [p.split(" ") for p in pieces]) for lang, _, pieces in rows])


def _label(field: Field):
    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            found = label_texts(field, part["text"].to_pylist())
            yield pa.RecordBatch.from_arrays(
                [
                    part["doc_id"],
                    pa.array([x[0] for x in found]),
                    pa.array([x[1] for x in found], pa.float64()),
                    pa.array([list(x[2].items()) for x in found], pa.map_(pa.string(), pa.float64())),
                    pa.array([x[3] for x in found], pa.int64()),
                ],
                ["doc_id", "lang_pred", "score", "shares", "n_switches"],
            )

    return label


def identify(docs: DataFrame, field: Field) -> DataFrame:
    """``doc_id``, ``lang_pred``, ``score``, ``shares`` and ``n_switches`` of every row, whole texts.

    Null texts and texts without a letter are ``und`` with score 0, as is everything if nothing was
    learned. Equal means go to the first language by name. Repeated rows and null ids stay; an empty
    table gives none. Nothing but ``text`` is an input of the prediction.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return in_arrow(
        texts, _label(field), "doc_id long, lang_pred string, score double, shares map<string,double>, n_switches long"
    )


#: Documents below this mean probability are rejected as not of one known language.
LEAST_SCORE = 0.3


def _keep(field: Field, least: float):
    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            found = label_texts(field, [t or "" for t in part["text"].to_pylist()])
            yield part.filter(pa.array([lang != UNKNOWN and score >= least for lang, score, _, _ in found], pa.bool_()))

    return keep


def known_language(docs: DataFrame, least: float = LEAST_SCORE) -> DataFrame:
    """The rows of ``documents`` whose text is of a learned language, all columns as they were."""
    return in_arrow(docs, _keep(fit(docs), least), docs.schema)


def op7_language_crf(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = identify(docs, fit(docs))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "n_switches")
