"""Phrases that stick together, counted exactly in counting quotient filters.

Words that are frequent enough get ids. An n-gram is packed into one integer (the id of its frequent
prefix and its last word), and an invertible permutation spreads the packed integers evenly. Their
first bits are the quotient, all other bits the remainder: a filter keeps which quotients occur, where
their runs end, the full remainders and the counters above one, so it loses nothing and takes little
more than the remainders. Every portion of text counts into filters of its own, one for each shard
of quotients; sorted filters of a shard are merged, and what reaches the least count goes back to
the portions that hold it. Longer n-grams are only counted where both shorter ones are frequent,
which leaves out none that could be.
"""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from billstream.llm.common import in_arrow, slices, stored

LEAST, LONGEST, SCALE, TOP = 100, 5, 1000, 2000
#: Bytes of text of a portion, and n-grams of a shard on average.
PORTION, SHARD = 8_000_000, 1 << 22
#: Parts in which the candidates of a language are ranked first.
RANK_PARTS = 32
BREAK = b"\xff"  # stands in no UTF-8 text
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ.,;:!?\n\x0b\x0c\r", b"abcdefghijklmnopqrstuvwxyz" + 10 * BREAK)


# ---- counting quotient filters ----------------------------------------------------------------


def _inverse(odd: int, bits: int) -> int:
    return pow(odd, -1, 1 << bits)


FIRST, SECOND = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93


def permuted(x: np.ndarray, bits: int) -> np.ndarray:
    """A permutation of the integers below ``2 ** bits``: odd products and folded upper halves."""
    mask, half = np.uint64((1 << bits) - 1), np.uint64((bits + 1) // 2)
    x = x.astype(np.uint64) * np.uint64(FIRST) & mask
    x ^= x >> half
    x = x * np.uint64(SECOND) & mask
    return x ^ (x >> half)


def restored(x: np.ndarray, bits: int) -> np.ndarray:
    """What ``permuted`` was given."""
    mask, half = np.uint64((1 << bits) - 1), np.uint64((bits + 1) // 2)
    x = x ^ (x >> half)
    x = x * np.uint64(_inverse(SECOND, bits)) & mask
    x ^= x >> half
    return x * np.uint64(_inverse(FIRST, bits)) & mask


def pack_filter(keys: np.ndarray, counts: np.ndarray, bits: int) -> bytes:
    """Sorted distinct keys below ``2 ** bits`` and their counts as a counting quotient filter.

    The remainder takes whole bytes: as many as leave about one quotient for each key.
    """
    n = len(keys)
    wide = max(0, -(-(bits - max(0, n.bit_length() - 1)) // 8))
    rest = min(bits, 8 * wide)
    quotient = (keys >> np.uint64(rest)).astype(np.int64) if rest < 64 else np.zeros(n, np.int64)
    occupied = np.zeros(1 << (bits - rest), bool)
    occupied[quotient] = True
    ends = np.ones(n, bool)
    ends[:-1] = quotient[1:] != quotient[:-1]
    remainder = keys.astype("<u8").view(np.uint8).reshape(n, 8)[:, :wide].copy()
    if rest % 8 and wide:
        remainder[:, -1] &= (1 << rest % 8) - 1
    several = counts > 1
    small = np.minimum(counts[several] - 2, 255)
    large = counts[several][small == 255]
    head = np.array([n, len(small), len(large), rest], "<u8")
    return b"".join(
        [head.tobytes(), large.astype("<u8").tobytes(), np.packbits(occupied).tobytes(), np.packbits(ends).tobytes(),
         np.packbits(several).tobytes(), small.astype(np.uint8).tobytes(), remainder.tobytes()]
    )


def unpack_filter(raw: bytes, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted keys and counts of a filter."""
    n, n_small, n_large, rest = np.frombuffer(raw, "<u8", 4).astype(np.int64).tolist()
    at, wide = 32, -(-rest // 8)

    def take(size: int) -> np.ndarray:
        nonlocal at
        at += size
        return np.frombuffer(raw, np.uint8, size, at - size)

    def flags(size: int) -> np.ndarray:
        return np.unpackbits(take(-(-size // 8)), count=size).astype(bool)

    large = take(8 * n_large).view("<u8") if n_large else np.zeros(0, np.uint64)
    occupied, ends, several = flags(1 << (bits - rest)), flags(n), flags(n)
    small = take(n_small)
    remainder = np.zeros((n, 8), np.uint8)
    remainder[:, :wide] = take(n * wide).reshape(n, wide)
    keys = remainder.view("<u8").ravel().astype(np.uint64)
    if rest < 64 and n:
        run = np.cumsum(ends) - ends
        keys |= np.nonzero(occupied)[0].astype(np.uint64)[run] << np.uint64(rest)
    counts = np.ones(n, np.int64)
    more = small.astype(np.int64) + 2
    more[small == 255] = large.astype(np.int64)
    counts[several] = more
    return keys, counts


def merge_counts(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """One sorted list of keys and summed counts from several; neighbours are merged two by two."""
    while len(parts) > 1:
        pairs = [parts[i : i + 2] for i in range(0, len(parts), 2)]
        parts = [p[0] if len(p) == 1 else _merged(*p) for p in pairs]
    return parts[0]


def _merged(one: tuple[np.ndarray, np.ndarray], two: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    keys = np.concatenate([one[0], two[0]])
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], np.concatenate([one[1], two[1]])[order]
    first = np.nonzero(np.concatenate([[True], keys[1:] != keys[:-1]])[: len(keys)])[0]
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts


# ---- portions of text -------------------------------------------------------------------------


def tokens_of(raw: bytes) -> list[bytes]:
    """Words with A to Z in lower case, and ``BREAK`` where a piece or a text ends."""
    return raw.translate(LOWER).replace(BREAK, b" \xff ").split()


def _in_portions(raw: bytes) -> Iterator[bytes]:
    """Cuts at breaks, so that a very long text makes several portions and no phrase is cut."""
    raw = raw.translate(LOWER)
    start = 0
    while len(raw) - start > 2 * PORTION:
        end = raw.find(BREAK, start + PORTION)
        if end < 0:
            break
        yield raw[start:end]
        start = end
    yield raw[start:]


def packed(raw: bytes) -> bytes:
    """Entropy-coded, which Spark's own shuffle compression is not."""
    return len(raw).to_bytes(8, "little") + (pa.compress(raw, codec="zstd", asbytes=True) if raw else b"")


def unpacked(raw: bytes) -> bytes:
    size = int.from_bytes(raw[:8], "little")
    return pa.decompress(raw[8:], decompressed_size=size, codec="zstd", asbytes=True) if size else b""


def planes(numbers: np.ndarray) -> bytes:
    """Integers from -1 on, byte place by byte place and with no more places than the largest needs."""
    up = (numbers + 1).astype("<u8")
    wide = max(1, -(-int(up.max(initial=0)).bit_length() // 8))
    return bytes([wide]) + packed(up.view(np.uint8).reshape(-1, 8)[:, :wide].T.tobytes())


def from_planes(raw: bytes) -> np.ndarray:
    wide = raw[0]
    places = np.frombuffer(unpacked(raw[1:]), np.uint8).reshape(wide, -1)
    up = np.zeros((places.shape[1], 8), np.uint8)
    up[:, :wide] = places.T
    return up.view("<i8").ravel() - 1


def pack_words(words: list[bytes]) -> bytes:
    return packed(BREAK.join(words))


def unpack_words(raw: bytes) -> list[bytes]:
    words = unpacked(raw)
    return words.split(BREAK) if words else []


def _portions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    number = TaskContext.get().partitionId() << 33
    held: dict[str, list[bytes]] = {}
    sizes: dict[str, int] = {}

    def made(lang: str) -> Iterator[pa.RecordBatch]:
        nonlocal number
        raws = BREAK.join(held.pop(lang))
        del sizes[lang]
        for raw in _in_portions(raws):
            coded = pa.array([BREAK, *tokens_of(raw), BREAK], pa.binary()).dictionary_encode()
            codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)  # 0: break, it comes first
            codes = codes[np.concatenate([[True], (codes[1:] != 0) | (codes[:-1] != 0)])]
            counts = np.bincount(codes, minlength=len(coded.dictionary))
            # The usual words first: their codes have empty upper bytes.
            order = np.concatenate([[0], 1 + np.argsort(-counts[1:], kind="stable")])
            rank = np.empty(len(order), np.int64)
            rank[order] = np.arange(len(order))
            words = coded.dictionary.take(pa.array(order[1:])).to_pylist()
            counts = counts[order[1:]]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([number]), pa.array([lang]), pa.array([int(counts.sum())], pa.int64()), pa.array([planes(rank[codes])], pa.binary()),
                    pa.array([pack_words(words)], pa.binary()), pa.array([planes(counts)], pa.binary()),
                ],
                ["portion", "lang", "n", "codes", "words", "counts"],
            )
            number += 1

    for part in slices(batches, most=PORTION):
        for lang, text in zip(part["lang"].to_pylist(), part["text"].to_pylist()):
            raw = text.encode()
            held.setdefault(lang, []).append(raw)
            sizes[lang] = sizes.get(lang, 0) + len(raw) + 1
            if sizes[lang] >= PORTION:
                yield from made(lang)
        while sum(sizes.values()) > 2 * PORTION:
            yield from made(max(sizes, key=sizes.__getitem__))
    for lang in list(held):
        yield from made(lang)


# ---- words ------------------------------------------------------------------------------------


def _word_pieces(shard_bits: int):
    """The words of a portion, dealt out to shards by their checksum."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                words, counts = unpack_words(batch["words"][i].as_py()), from_planes(batch["counts"][i].as_py())
                dealt: dict[int, list[tuple[bytes, int]]] = {}
                for place, word in enumerate(words):
                    dealt.setdefault(crc32(word) & ((1 << shard_bits) - 1), []).append((word, place))
                for s, both in dealt.items():
                    # In order, neighbours are alike and take little room.
                    both.sort()
                    places = np.array([place for _, place in both])
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch["lang"].slice(i, 1), pa.array([s], pa.int32()), batch["portion"].slice(i, 1), pa.array([planes(places)], pa.binary()),
                            pa.array([pack_words([word for word, _ in both])], pa.binary()), pa.array([planes(counts[places])], pa.binary()),
                        ],
                        ["lang", "shard", "portion", "places", "words", "counts"],
                    )

    return deal


WORDS = "lang string, shard int, portion long, places binary, ids binary, words binary, counts binary"


def _merged_words(shard_bits: int, least: int):
    """Pieces sorted by language and shard: the frequent words with their ids, and those of each portion."""
    schema = pa.schema(
        [("lang", pa.string()), ("shard", pa.int32()), ("portion", pa.int64()), ("places", pa.binary()), ("ids", pa.binary()), ("words", pa.binary()), ("counts", pa.binary())]
    )

    def settled(lang: str, shard: int, held: list[tuple]) -> Iterator[pa.RecordBatch]:
        words = pa.chunked_array([pa.array(unpack_words(h[2]), pa.binary()) for h in held])
        counts = np.concatenate([from_planes(h[3]) for h in held])
        total = pa.table({"word": words, "count": counts}).group_by("word").aggregate([("count", "sum")])
        total = total.filter(pc.greater_equal(total["count_sum"], least)).sort_by("word").combine_chunks()
        if not len(total):
            return
        frequent, ids = total["word"], np.arange(len(total)) << shard_bits | shard
        rows = [{"lang": lang, "shard": shard, "ids": planes(ids), "words": pack_words(frequent.to_pylist()), "counts": planes(np.array(total["count_sum"]))}]
        for own, (portion, places, _, _) in zip(words.chunks, held):
            at = pc.index_in(own, value_set=frequent.chunk(0))
            known = np.array(at.is_valid())
            if known.any():
                rank = at.drop_null().to_numpy()
                rows.append({"lang": lang, "shard": shard, "portion": portion, "places": planes(from_planes(places)[known]), "ids": planes(ids[rank])})
        yield pa.RecordBatch.from_pylist(rows, schema=schema)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = None, []
        for batch in batches:
            for i in range(batch.num_rows):
                key = (batch["lang"][i].as_py(), batch["shard"][i].as_py())
                if key != at:
                    if held:
                        yield from settled(*at, held)
                    at, held = key, []
                held.append(tuple(batch[c][i].as_py() for c in ("portion", "places", "words", "counts")))
        if held:
            yield from settled(*at, held)

    return merge


def _word_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            words = pa.array(unpack_words(batch["words"][i].as_py()), pa.binary())
            columns = [from_planes(batch[c][i].as_py()) for c in ("ids", "counts")]
            yield pa.RecordBatch.from_arrays([pa.array(batch["lang"].slice(i, 1).to_pylist() * len(words), pa.string()), pa.array(columns[0]), words.cast(pa.string()), pa.array(columns[1])], ["lang", "id", "phrase", "f"])


def _squeezed(tokens: np.ndarray, keep: np.ndarray) -> np.ndarray:
    """Tokens that are kept, with one -1 wherever others stood between."""
    tokens = np.where(keep, tokens, -1)
    return tokens[np.concatenate([[True], (tokens[1:] != -1) | (tokens[:-1] != -1)])[: len(tokens)]]


def _with_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Codes of a portion into ids of frequent words; -1 stands for all others and for breaks."""
    for batch in batches:
        for i in range(batch.num_rows):
            codes, found = from_planes(batch["codes"][i].as_py()), batch["found"][i].values
            ids = np.full(int(codes.max(initial=0)) + 1, -1, np.int64)
            for places, own in zip(found.field("places").to_pylist(), found.field("ids").to_pylist()):
                ids[from_planes(places) + 1] = from_planes(own)
            tokens = ids[codes]
            tokens = _squeezed(tokens, tokens >= 0)
            yield pa.RecordBatch.from_arrays(
                [batch["portion"].slice(i, 1), batch["lang"].slice(i, 1), pa.array([planes(tokens)], pa.binary()), pa.nulls(1, pa.binary())],
                ["portion", "lang", "tokens", "grams"],
            )


# ---- one length of n-grams --------------------------------------------------------------------


def _packed(tokens: np.ndarray, grams: np.ndarray, k: int, word_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of n-grams of k words whose two shorter ones are frequent, and the packed n-grams."""
    start = np.nonzero((grams[:-1] >= 0) & (grams[1:] >= 0))[0]
    start = start[start + k <= len(tokens)]
    return start, (grams[start] << word_bits | tokens[start + k - 1]).astype(np.uint64)


def _numbers(batch: pa.RecordBatch, i: int) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of a portion and, at each of them, the id of the n-gram that starts there; first the tokens."""
    tokens, grams = (batch[c][i].as_py() for c in ("tokens", "grams"))
    tokens = from_planes(tokens)
    return tokens, tokens if grams is None else from_planes(grams)


def _counted(k: int, word_bits: int, bits: int, shard_bits: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                _, keys = _packed(*_numbers(batch, i), k, word_bits)
                keys, counts = np.unique(permuted(keys, bits), return_counts=True)
                shards, first = np.unique((keys >> np.uint64(bits - shard_bits)).astype(np.int32), return_index=True)
                low = keys & np.uint64((1 << (bits - shard_bits)) - 1)
                ends = [*first[1:].tolist(), len(keys)]
                filters = [pack_filter(low[a:b], counts[a:b], bits - shard_bits) for a, b in zip(first.tolist(), ends)]
                n = len(filters)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(batch["lang"].slice(i, 1).to_pylist() * n, pa.string()), pa.array(shards), pa.array(batch["portion"].slice(i, 1).to_pylist() * n, pa.int64()), pa.array(filters, pa.binary())],
                    ["lang", "shard", "portion", "filter"],
                )

    return count


FOUND = "lang string, shard int, portion long, keys binary, ranks binary, counts binary"


def _merged_shards(bits: int, shard_bits: int, least: int):
    """Filters sorted by language and shard: the frequent n-grams of each, and those of each portion.

    Row by row where filters of one shard go together; only packed filters are held.
    """
    schema = pa.schema(
        [("lang", pa.string()), ("shard", pa.int32()), ("portion", pa.int64()), ("keys", pa.binary()), ("ranks", pa.binary()), ("counts", pa.binary())]
    )

    def settled(lang: str, shard: int, held: list[tuple[int, bytes]]) -> pa.RecordBatch:
        own = bits - shard_bits
        keys, counts = merge_counts([unpack_filter(raw, own) for _, raw in held])
        frequent, counts = keys[counts >= least], counts[counts >= least]
        whole = restored(frequent | np.uint64(shard) << np.uint64(own), bits).tobytes()
        rows = [{"lang": lang, "shard": shard, "keys": packed(whole), "ranks": planes(np.arange(len(frequent))), "counts": planes(counts)}]
        for portion, raw in held if len(frequent) else []:
            rank = np.nonzero(np.isin(frequent, unpack_filter(raw, own)[0], assume_unique=True))[0]
            if len(rank):
                some = restored(frequent[rank] | np.uint64(shard) << np.uint64(own), bits)
                rows.append({"lang": lang, "shard": shard, "portion": portion, "keys": packed(some.tobytes()), "ranks": planes(rank)})
        return pa.RecordBatch.from_pylist(rows, schema=schema)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = None, []
        for batch in batches:
            for lang, shard, portion, raw in zip(*(batch[c].to_pylist() for c in ("lang", "shard", "portion", "filter"))):
                if at != (lang, shard):
                    if held:
                        yield settled(*at, held)
                    at, held = (lang, shard), []
                held.append((portion, raw))
        if held:
            yield settled(*at, held)

    return merge


def _lengthened(k: int, word_bits: int, shard_bits: int):
    """The portions with the ids of their frequent n-grams of k words; tokens in none of them go."""

    def lengthen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                found = batch["found"][i].values
                keys = np.concatenate([np.frombuffer(unpacked(x), np.uint64) for x in found.field("keys").to_pylist()])
                ranks = [from_planes(x) << shard_bits | s for x, s in zip(found.field("ranks").to_pylist(), found.field("shard").to_pylist())]
                order = np.argsort(keys)
                keys, ids = keys[order], np.concatenate(ranks)[order]
                tokens, grams = _numbers(batch, i)
                start, grams_here = _packed(tokens, grams, k, word_bits)
                place = np.minimum(np.searchsorted(keys, grams_here), len(keys) - 1)
                known = keys[place] == grams_here
                longer = np.full(len(tokens), -1, np.int64)
                longer[start[known]] = ids[place[known]]
                change = np.zeros(len(tokens) + 1, np.int64)
                np.add.at(change, start[known], 1)
                np.add.at(change, start[known] + k, -1)
                keep = np.cumsum(change)[:-1] > 0
                # The same squeezing for both, so that they stay side by side.
                tokens = np.where(keep, tokens, -1)
                stay = np.concatenate([[True], keep[1:] | keep[:-1]])
                yield pa.RecordBatch.from_arrays(
                    [batch["portion"].slice(i, 1), batch["lang"].slice(i, 1), pa.array([planes(tokens[stay])], pa.binary()), pa.array([planes(longer[stay])], pa.binary())],
                    ["portion", "lang", "tokens", "grams"],
                )

    return lengthen


def _spread(word_bits: int, shard_bits: int):
    """Frequent n-grams one by one: ``id``, those of prefix and last word, and the count."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, shard, keys, ranks, counts in zip(*(batch[c].to_pylist() for c in ("lang", "shard", "keys", "ranks", "counts"))):
                keys = np.frombuffer(unpacked(keys), np.int64)
                ids = from_planes(ranks) << shard_bits | shard
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(keys), pa.string()), pa.array(ids), pa.array(keys >> word_bits), pa.array(keys & ((1 << word_bits) - 1)), pa.array(from_planes(counts))],
                    ["lang", "id", "prefix", "word", "f"],
                )

    return spread


STATE = "portion long, lang string, tokens binary, grams binary"


def frequent_phrases(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, shard: int = SHARD) -> tuple[DataFrame, DataFrame]:
    """``lang``, ``k``, ``phrase``, ``f`` of all phrases of 1 to ``longest`` words found ``least`` times, and ``lang``, ``n``."""
    spark = docs.sparkSession
    rows = docs.select(F.coalesce("lang", F.lit("und")).cast("string").alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    portions = stored(
        in_arrow(rows, _portions, "portion long, lang string, n long, codes binary, words binary, counts binary"), "phrase-portions"
    )
    totals = stored(portions.groupBy("lang").agg(F.sum("n").alias("n")), "phrase-totals")
    held = totals.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    shard_bits = max(1, (int(held) // shard).bit_length())
    parts = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    pieces = in_arrow(
        portions.select("portion", "lang", "words", "counts"), _word_pieces(shard_bits),
        "lang string, shard int, portion long, places binary, words binary, counts binary",
    )
    dealt = pieces.repartition(parts, "lang", "shard").sortWithinPartitions("lang", "shard")
    found = stored(in_arrow(dealt, _merged_words(shard_bits, least), WORDS), "phrase-words")
    words = stored(in_arrow(found.where("portion is null").select("lang", "ids", "words", "counts"), _word_rows, "lang string, id long, phrase string, f long"), "phrase-ids")
    last = words.agg(F.max("id")).first()[0]
    levels = [words.select("lang", F.lit(1).alias("k"), "phrase", "f")]
    if last is None:
        return levels[0], totals
    word_bits = int(last).bit_length() or 1
    back = found.where("portion is not null").groupBy("portion").agg(F.collect_list(F.struct("places", "ids")).alias("found"))
    state = stored(in_arrow(portions.select("portion", "lang", "codes").join(back, "portion"), _with_ids, STATE), "phrase-tokens")
    prefix_bits, phrases = word_bits, words
    for k in range(2, longest + 1):
        bits = prefix_bits + word_bits
        if bits > 63:
            raise ValueError("packed n-grams need more than 63 bits: raise the least count")
        own_shards = min(shard_bits, bits - 1)
        filters = in_arrow(state, _counted(k, word_bits, bits, own_shards), "lang string, shard int, portion long, filter binary")
        dealt = filters.repartition(parts, "lang", "shard").sortWithinPartitions("lang", "shard")
        found = stored(in_arrow(dealt, _merged_shards(bits, own_shards, least), FOUND), f"phrase-found-{k}")
        grams = stored(in_arrow(found.where("portion is null"), _spread(word_bits, own_shards), "lang string, id long, prefix long, word long, f long"), f"phrase-grams-{k}")
        last = grams.agg(F.max("id")).first()[0]
        if last is None:
            break
        ends = words.select("lang", F.col("id").alias("word"), F.col("phrase").alias("end"))
        begins = phrases.select("lang", F.col("id").alias("prefix"), F.col("phrase").alias("begin"))
        phrases = stored(
            grams.join(begins, ["lang", "prefix"]).join(ends, ["lang", "word"])
            .select("lang", "id", F.concat_ws(" ", "begin", "end").alias("phrase"), "f"),
            f"phrase-texts-{k}",
        )
        levels.append(phrases.select("lang", F.lit(k).alias("k"), "phrase", "f"))
        prefix_bits = int(last).bit_length() or 1
        if k < longest:
            by_portion = found.where("portion is not null").groupBy("portion").agg(F.collect_list(F.struct("shard", "keys", "ranks")).alias("found"))
            state = stored(in_arrow(state.join(by_portion, "portion"), _lengthened(k, word_bits, own_shards), STATE), f"phrase-tokens-{k}")
    phrases = levels[0]
    for level in levels[1:]:
        phrases = phrases.union(level)
    return phrases, totals


def collocations(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, top: int = TOP, shard: int = SHARD) -> DataFrame:
    """The best phrases of each language, with the counts their scores come from.

    Null text holds no word; a null language counts as ``und``. Repeated rows count as often as they
    stand there, whatever their ids. Phrases do not run over ``.,;:!?``, line ends or texts. An empty
    table gives no row; other columns are ignored. Products pass 64 bits and are taken in decimals
    of 38 digits.
    """
    phrases, totals = frequent_phrases(docs, least, longest, shard)
    phrases = stored(phrases, "phrase-all")
    part = phrases.select("lang", F.col("phrase").alias("part"), F.col("f").alias("part_f"))
    candidates = phrases.where("k > 1")
    cuts = candidates.withColumn("cut", F.explode(F.expr("sequence(1, k - 1)"))).select(
        "lang", "k", "phrase", F.col("f").alias("a"), "cut",
        F.expr("substring_index(phrase, ' ', cut)").alias("first"), F.expr("substring_index(phrase, ' ', cut - k)").alias("rest"),
    )
    cuts = (
        cuts.join(part.withColumnsRenamed({"part": "first", "part_f": "l"}), ["lang", "first"])
        .join(part.withColumnsRenamed({"part": "rest", "part_f": "r"}), ["lang", "rest"])
        .join(totals, "lang")
    )
    wide = lambda c: F.col(c).cast("decimal(19,0)")
    cuts = cuts.withColumn("above", F.lit(SCALE).cast("decimal(5,0)") * (wide("a") * wide("n"))).withColumn("below", wide("l") * wide("r"))
    cuts = cuts.withColumn("score", F.expr("above div below"))
    scored = cuts.groupBy("lang", "k", "phrase", "a", "n").agg(F.min(F.struct("score", "cut", "l", "r")).alias("least"))
    pieces = F.expr(
        "flatten(transform(sequence(2, k - 1), m -> transform(sequence(1, k - m + 1), i -> array_join(slice(words, i, m), ' '))))"
    )
    inside = (
        phrases.where("k > 2").withColumn("words", F.split("phrase", " "))
        .select("lang", F.explode(pieces).alias("phrase"), "f")
        .groupBy("lang", "phrase").agg(F.max("f").alias("longer"))
    )
    kept = scored.join(inside, ["lang", "phrase"], "left").where("longer is null or 100 * longer < 100 * a")
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    flat = kept.select("lang", "phrase", "a", F.col("least.l").alias("l"), F.col("least.r").alias("r"), "n", F.col("least.score").alias("score"))
    # First in parts: no task ranks all candidates of a language.
    dealt = flat.withColumn("deal", F.pmod(F.xxhash64("phrase"), F.lit(RANK_PARTS)))
    best = dealt.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "deal").orderBy(*order))).where(F.col("rank") <= top)
    ranked = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op12_collocations(spark, sf_dir: str) -> DataFrame:
    return collocations(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP12_SQL = f"""
    WITH pieces AS (
      SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS words
      FROM (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
              translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece
            FROM documents)),
    totals AS (SELECT lang, sum(len(words)) AS n FROM pieces GROUP BY lang),
    grams AS MATERIALIZED (
      SELECT lang, k, phrase, count(*) AS f FROM (
        SELECT lang, k, array_to_string(words[i : i + k - 1], ' ') AS phrase
        FROM (SELECT lang, words, k, unnest(range(1, len(words) - k + 2)) AS i
              FROM pieces, (SELECT unnest(range(1, {LONGEST + 1})) AS k)))
      GROUP BY lang, k, phrase HAVING count(*) >= {LEAST}),
    cuts AS (
      SELECT lang, k, phrase, f AS a, cut, array_to_string(string_split(phrase, ' ')[1 : cut], ' ') AS first,
             array_to_string(string_split(phrase, ' ')[cut + 1 : k], ' ') AS rest
      FROM (SELECT *, unnest(range(1, k)) AS cut FROM grams WHERE k > 1)),
    scored AS (
      SELECT c.lang, c.k, c.phrase, c.a, cut, x.f AS l, y.f AS r, n,
             ({SCALE}::HUGEINT * a * n) // (x.f::HUGEINT * y.f) AS score
      FROM cuts c JOIN grams x ON x.lang = c.lang AND x.phrase = c.first
      JOIN grams y ON y.lang = c.lang AND y.phrase = c.rest JOIN totals t ON t.lang = c.lang),
    lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
    inside AS (
      SELECT lang, phrase, max(f) AS longer FROM (
        SELECT lang, f, array_to_string(words[i : i + m - 1], ' ') AS phrase FROM (
          SELECT lang, f, k, m, words, unnest(range(1, k - m + 2)) AS i FROM (
            SELECT lang, f, k, string_split(phrase, ' ') AS words, unnest(range(2, k)) AS m FROM grams WHERE k > 2)))
      GROUP BY lang, phrase),
    ranked AS (
      SELECT l.*, row_number() OVER (PARTITION BY l.lang ORDER BY score DESC, a DESC, encode(l.phrase)) AS rank
      FROM lowest l LEFT JOIN inside i ON i.lang = l.lang AND i.phrase = l.phrase
      WHERE longer IS NULL OR 100 * longer < 100 * a)
    SELECT lang, rank, phrase, a, l, r, n::BIGINT AS n, score::BIGINT AS score FROM ranked WHERE rank <= {TOP}"""
