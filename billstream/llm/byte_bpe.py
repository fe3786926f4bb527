"""Byte-level BPE with vectorised pre-tokenisation.

A text becomes an array of codepoint classes. Each class is a function from state to state of a small
automaton; the functions compose into a finite set, whose table makes composition one lookup. Blocks
of the array are scanned side by side, the functions of whole blocks are scanned once more, and the
state before each character tells where pieces begin. No regular expression is run over texts.
"""

from __future__ import annotations

import base64
import heapq
import unicodedata
from collections.abc import Iterator
from functools import cache, lru_cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from billstream.llm.common import in_arrow, slices, texts_of

#: Pieces whose ids a Python worker keeps; then it starts anew.
KEPT_PIECES = 500_000
#: Characters that one scan takes.
SCAN_CHARS = 1 << 21

# ---- the automaton of the pieces ------------------------------------------------------------
# Fixed values, equal to the pattern of the public rank files: 's 't 're 've 'm 'll 'd | optional
# space and letters | optional space and numbers | optional space and others | white space up to
# the last one before a text | white space.

CLASSES = ("other", "letter", "s_t_m_d", "r", "v", "l", "e", "number", "space", "white", "quote", "end")
LETTERS = ("letter", "s_t_m_d", "r", "v", "l", "e")
#: Flags of a step: a piece begins at this character; a piece begins at the character before it.
HERE, BEFORE = 1, 2
#: start: nothing is open. in_*: within such a piece. space1, white1: one white space, a space or
#: another; space2, white2: the last of several. quote: an apostrophe that begins a piece, then
#: quote_r, quote_v, quote_l: the letter that may end a contraction comes next.
STATES = (
    "start", "in_letter", "in_number", "in_other", "space1", "space2", "white1", "white2",
    "quote", "quote_r", "quote_v", "quote_l",
)


def _opened(kind: str) -> str:
    """The state after a character that begins a piece."""
    if kind in LETTERS:
        return "in_letter"
    return {"number": "in_number", "other": "in_other", "space": "space1", "white": "white1", "quote": "quote", "end": "start"}[kind]


def _step(state: str, kind: str) -> tuple[str, int]:
    blank, wide = kind in ("space", "white"), "letter" if kind in LETTERS else kind
    if kind == "end":
        return "start", HERE | (BEFORE if state in ("quote_r", "quote_v", "quote_l") else 0)
    if state == "in_letter" and wide == "letter" or state == "in_number" and wide == "number":
        return state, 0
    if state == "in_other" and wide in ("other", "quote"):
        return state, 0
    if state in ("space1", "space2", "white1", "white2"):
        if blank:
            return kind + "2", 0
        if state in ("space1", "space2"):  # the space before a piece belongs to it
            return (_opened(kind) if kind != "quote" else "in_other"), BEFORE if state == "space2" else 0
        return _opened(kind), HERE | (BEFORE if state == "white2" else 0)
    if state == "quote":
        if kind == "s_t_m_d":
            return "start", 0
        if kind in ("r", "v", "l"):
            return f"quote_{kind}", 0
        if wide in ("other", "quote"):
            return "in_other", 0
    if state in ("quote_r", "quote_v", "quote_l"):
        if kind == ("l" if state == "quote_l" else "e"):
            return "start", 0
        if wide == "letter":
            return "in_letter", BEFORE
        return _opened(kind), HERE | BEFORE
    return _opened(kind), HERE


@cache
def automaton() -> dict[str, np.ndarray]:
    """Next states, flags, the closed set of composed functions, and its composition table."""
    steps = [[_step(s, k) for k in CLASSES] for s in STATES]
    target = np.array([[STATES.index(x[0]) for x in row] for row in steps], np.uint8)
    flags = np.array([[x[1] for x in row] for row in steps], np.uint8)
    identity = tuple(range(len(STATES)))
    found = {identity: 0}
    single = [tuple(target[:, k].tolist()) for k in range(len(CLASSES))]
    todo = [identity]
    while todo:
        f = todo.pop()
        for g in single:
            h = tuple(g[x] for x in f)
            if h not in found:
                found[h] = len(found)
                todo.append(h)
    functions = np.array(list(found), np.uint8)
    then = np.array([[found[tuple(g[x] for x in f)] for g in single] for f in found], np.uint16)
    whole = np.array([[found[tuple(g[x] for x in f)] for g in found] for f in found], np.uint16)
    return {"target": target, "flags": flags, "functions": functions, "then": then, "whole": whole}


# Letters and numbers that Unicode 16 added to 15.1. The pattern is defined by the
# former, Python 3.13 knows the latter, and the regex module knows later ones as well.
ADDED_IN_16 = (
    (0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D40, 0x10D85), (0x10EC2, 0x10EC4),
    (0x11380, 0x113E2), (0x116D0, 0x116E3), (0x11BC0, 0x11BF9), (0x13460, 0x143FA), (0x16100, 0x16139),
    (0x16D40, 0x16D79), (0x18CFF, 0x18CFF), (0x1CCF0, 0x1CCF9), (0x1E5D0, 0x1E5FF),
)


@cache
def class_table() -> np.ndarray:
    """The class of every codepoint."""
    import regex

    table = np.zeros(0x110000, np.uint8)
    everything = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
    for pattern, name in ((r"\p{L}+", "letter"), (r"\p{N}+", "number"), (r"\s+", "white")):
        for run in regex.finditer(pattern, everything):
            codes = np.frombuffer(run[0].encode("utf-32-le"), np.uint32)
            table[codes] = CLASSES.index(name)
    later = np.array([unicodedata.category(chr(c)) == "Cn" for c in range(0x110000)])
    for first, last in ADDED_IN_16:
        later[first : last + 1] = False
    table[later] = CLASSES.index("other")
    table[list(range(0x1C, 0x20))] = CLASSES.index("other")
    for chars, name in ((" ", "space"), ("'", "quote"), ("stmd", "s_t_m_d"), ("r", "r"), ("v", "v"), ("l", "l"), ("e", "e")):
        for c in chars:
            table[ord(c)] = CLASSES.index(name)
    return table


def states_before(kinds: np.ndarray, width: int = 512) -> np.ndarray:
    """The state before each character, from state ``start``."""
    a = automaton()
    n = len(kinds)
    rows = -(-n // width)
    grid = np.full((rows, width), CLASSES.index("end"), np.uint8)
    grid.ravel()[:n] = kinds
    grid = np.ascontiguousarray(grid.T)
    # The function of each block, then of all blocks before it (log steps), then states within.
    then, many = a["then"].ravel(), len(CLASSES)
    block = np.zeros(rows, np.intp)
    for column in grid:
        block = then[block * many + column].astype(np.intp)
    apart = 1
    while apart < rows:
        joined = block.copy()
        joined[apart:] = a["whole"][block[:-apart], block[apart:]]
        block, apart = joined, 2 * apart
    state = np.zeros(rows, np.intp)
    state[1:] = a["functions"][block[:-1], 0]
    target, out = a["target"].ravel(), np.empty((width, rows), np.uint8)
    for i, column in enumerate(grid):
        out[i] = state
        state = target[state * many + column].astype(np.intp)
    return np.ascontiguousarray(out.T).ravel()[:n]


def piece_starts(texts: list[str]) -> tuple[str, np.ndarray]:
    """The texts joined (each followed by a line feed as its end) and where pieces begin in that."""
    whole = "\n".join(texts) + "\n"
    kinds = class_table()[np.frombuffer(whole.encode("utf-32-le"), np.uint32)]
    kinds[np.cumsum([len(t) + 1 for t in texts]) - 1] = CLASSES.index("end")
    flags = automaton()["flags"].ravel()[states_before(kinds).astype(np.intp) * len(CLASSES) + kinds]
    starts = (flags & HERE).astype(bool)
    starts[:-1] |= (flags[1:] & BEFORE).astype(bool)
    return whole, np.nonzero(starts)[0]


# ---- merging --------------------------------------------------------------------------------


def merged(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Join the adjacent pair of lowest rank, leftmost first, until no pair has a rank."""
    if (whole := ranks.get(piece)) is not None:
        return [whole]
    n = len(piece)
    after, before, end = list(range(1, n + 1)), list(range(-1, n - 1)), list(range(1, n + 1))
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i : i + 2])) is not None]
    heapq.heapify(heap)
    alive = [True] * n
    while heap:
        _, i, stop = heapq.heappop(heap)
        # Outdated if the part is gone, or it or its neighbour has grown since.
        if not alive[i] or (j := after[i]) >= n or end[j] != stop:
            continue
        alive[j], end[i], after[i] = False, stop, after[j]
        if after[i] < n:
            before[after[i]] = i
            if (r := ranks.get(piece[i : end[after[i]]])) is not None:
                heapq.heappush(heap, (r, i, end[after[i]]))
        if (p := before[i]) >= 0 and (r := ranks.get(piece[p:stop])) is not None:
            heapq.heappush(heap, (r, p, stop))
    return [ranks[piece[i : end[i]]] for i in range(n) if alive[i]]


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class ByteEncoder:
    """Ids of pieces by rank, with those of the pieces seen kept, and the bytes of ids."""

    def __init__(self, path: str) -> None:
        self.ranks = read_ranks(path)
        self.kept: dict[str, bytes] = {}
        size = max(self.ranks.values()) + 1
        self.token_bytes = [b""] * size
        for token, rank in self.ranks.items():
            self.token_bytes[rank] = token

    def encode(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each text its ids and the character offsets at which its pieces begin."""
        whole, starts = piece_starts(texts)
        edges = [*starts.tolist(), len(whole)]
        pieces = [whole[a:b] for a, b in zip(edges, edges[1:])]
        kept = self.kept if len(self.kept) <= KEPT_PIECES else {}
        self.kept = kept
        found = list(map(kept.get, pieces))
        for i, known in enumerate(found):
            if known is None:
                piece = pieces[i]
                if (known := kept.get(piece)) is None:
                    known = kept[piece] = np.array(merged(piece.encode(), self.ranks), "<u4").tobytes()
                found[i] = known
        bounds = np.cumsum([0, *(len(t) + 1 for t in texts)])
        first = np.searchsorted(starts, bounds)
        out = []
        for i in range(len(texts)):
            # The last piece of a text is the line feed at its end.
            low, high = first[i], first[i + 1] - 1
            raw = b"".join(found[low:high])
            out.append((np.frombuffer(raw, "<u4"), starts[low:high] - bounds[i]))
        return out

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.token_bytes.__getitem__, ids.tolist()))


@lru_cache(maxsize=2)
def byte_encoder(path: str) -> ByteEncoder:
    """The encoder of this Python worker, kept from task to task."""
    return ByteEncoder(path)


def _encode(path: str, with_ids: bool):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = byte_encoder(path)
        for part in slices(batches, most=SCAN_CHARS):
            found = encoder.encode(part["text"].to_pylist())
            decoded = [encoder.decode(ids) for ids, _ in found]
            columns = {
                "doc_id": part["doc_id"],
                "n_tokens": pa.array([len(ids) for ids, _ in found], pa.int64()),
                "n_pieces": pa.array([len(offsets) for _, offsets in found], pa.int64()),
                "ids_sha256": pa.array([sha256(ids.tobytes()).hexdigest() for ids, _ in found]),
                "decoded_sha256": pa.array([sha256(d).hexdigest() for d in decoded]),
            }
            if with_ids:
                columns["ids"] = pa.array([ids.astype(np.int32) for ids, _ in found], pa.list_(pa.int32()))
                columns["offsets"] = pa.array([o.astype(np.int32) for _, o in found], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_pydict(columns)

    return encode


DIGESTS = "doc_id long, n_tokens long, n_pieces long, ids_sha256 string, decoded_sha256 string"


def encode_documents(docs: DataFrame, ranks_path: str, with_ids: bool = True) -> DataFrame:
    """One row per document: digests and, if asked for, ``ids`` and piece ``offsets`` (characters).

    Null text is empty and gives no id. Each row is encoded by itself: repeated rows and null ids
    stay, an empty table gives none, further columns are ignored. No text is cut.
    """
    schema = DIGESTS + (", ids array<int>, offsets array<int>" if with_ids else "")
    return in_arrow(texts_of(docs), _encode(ranks_path, with_ids), schema)


def _decode(path: str):
    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = byte_encoder(path)
        for batch in batches:
            found = [encoder.decode(np.array(ids or [], np.int64)).decode("utf-8", "replace") for ids in batch["ids"].to_pylist()]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(found, pa.string())], ["doc_id", "text"])

    return decode


def decode_documents(encoded: DataFrame, ranks_path: str) -> DataFrame:
    """``doc_id`` and ``text`` of rows with ``ids`` (null: empty)."""
    return in_arrow(encoded.select(F.col("doc_id").cast("long").alias("doc_id"), "ids"), _decode(ranks_path), "doc_id long, text string")


def ranks_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def op3_byte_bpe(spark, sf_dir: str) -> DataFrame:
    return encode_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"), ranks_path(), with_ids=False)
