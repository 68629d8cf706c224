"""Byte-level BPE encoding and decoding with vectorised pre-tokenisation.

Pre-tokens are located without regular expressions. Every code point becomes a
class (letter, number, other, the kinds of white space, the two kinds of
apostrophe that open a contraction); white space and apostrophes look ahead by
plain array comparisons. A class is a function from the state before a code
point to the state after it. These functions are closed under composition (a
small monoid, tabulated once), so the states of a whole batch come from an
associative scan: composed inside blocks, scanned over the blocks, applied
back. A pre-token starts where state and class say so. The first code point of
every document is a constant function, so documents of a batch never see each
other.

The slices (byte offsets are kept) feed a cache of merged pieces; a miss merges
its byte pairs by rank, lowest first. Decoding joins the bytes of the ids.

Edge cases: null and empty texts have no ids and decode to nothing; very long
pre-tokens are merged with a heap (``n log n``); repeated rows are encoded each
alone; other columns are not touched.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import held, text_of

CACHE_BYTES = 80 << 20        # of merged pieces a worker keeps, keys and values
CACHED_PIECE = 256            # bytes; longer pieces are merged each time
ENTRY_BYTES = 180             # of an entry besides its bytes
BATCH_CHARS = 500_000         # code points scanned at once (a longer text alone)
BLOCK = 64
LONG_PIECE = 96               # bytes from which pairs are merged with a heap

LETTER, NUMBER, OTHER, CLOSE2, CLOSE3, LEAD, LAST, RUN = range(8)
CLASSES = 8
# states: in letters, in numbers, in others, in a white-space run, one or two
# more code points of a contraction, nothing open, a space that attaches
S_LETTER, S_NUMBER, S_OTHER, S_RUN, S_ONE, S_TWO, S_NONE, S_ATTACH = range(8)
STATES = 8
# White_Space of Unicode
_SPACES = [9, 10, 11, 12, 13, 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]


def _step(state: int, kind: int) -> int:
    if state == S_ONE:
        return S_NONE
    if state == S_TWO:
        return S_ONE
    if kind in (CLOSE2, CLOSE3) and state in (S_OTHER, S_ATTACH):
        return S_OTHER
    return {LETTER: S_LETTER, NUMBER: S_NUMBER, OTHER: S_OTHER, CLOSE2: S_ONE, CLOSE3: S_TWO,
            LEAD: S_ATTACH, LAST: S_NONE, RUN: S_RUN}[kind]


def _starts(state: int, kind: int) -> bool:
    """Whether a code point of this class opens a pre-token after this state."""
    joins = {LETTER: (S_LETTER, S_ATTACH), NUMBER: (S_NUMBER, S_ATTACH), OTHER: (S_OTHER, S_ATTACH),
             CLOSE2: (S_OTHER, S_ATTACH), CLOSE3: (S_OTHER, S_ATTACH), RUN: (S_RUN,)}
    return state not in (S_ONE, S_TWO) and state not in joins.get(kind, ())


class Scanner:
    """Tables of the scan; ``starts`` finds the pre-tokens of a batch."""

    def __init__(self):
        kinds = np.full(0x110000, OTHER, np.uint8)
        for cp in range(0x110000):
            major = unicodedata.category(chr(cp))[0]
            if major == "L":
                kinds[cp] = LETTER
            elif major == "N":
                kinds[cp] = NUMBER
        kinds[_SPACES] = RUN
        self.kinds = kinds
        plain = [tuple(_step(s, k) for s in range(STATES)) for k in range(CLASSES)]
        first = [(f[S_NONE],) * STATES for f in plain]     # the first of a document
        elements = list(dict.fromkeys(plain + first))
        index = {f: i for i, f in enumerate(elements)}
        at = 0
        while at < len(elements):                           # closure under composition
            for g in plain + first:
                h = tuple(g[s] for s in elements[at])
                if h not in index:
                    index[h] = len(elements)
                    elements.append(h)
            at += 1
        n = len(elements)
        self.n = n
        identity = tuple(range(STATES))
        if identity not in index:
            index[identity] = n
            elements.append(identity)
            self.n = n = n + 1
        self.identity = index[identity]
        self.then = np.array([[index.get(tuple(g[s] for s in f), 0) for g in elements] for f in elements], np.uint16).ravel()
        self.element = np.array([index[f] for f in plain + first], np.uint16)
        self.after = np.array([f[S_NONE] for f in elements], np.uint8)
        self.opens = np.array([[_starts(s, k) for k in range(CLASSES)] for s in range(STATES)])

    def classes(self, cps: np.ndarray, last: np.ndarray) -> np.ndarray:
        """``last``: the places that end a document."""
        kinds = self.kinds[cps]
        ends = np.zeros(len(cps), bool)
        ends[last] = True
        white = kinds == RUN
        final = np.zeros(len(cps), bool)                   # white space before something else
        final[:-1] = white[:-1] & ~white[1:]
        final &= ~ends
        kinds[final] = LAST
        kinds[final & (cps == 32)] = LEAD
        quotes = np.flatnonzero(cps == 39)
        if len(quotes):
            padded = np.concatenate([cps, [0, 0]])
            stop = np.concatenate([ends, [True, True]])
            a, b = padded[quotes + 1], padded[quotes + 2]
            one = ~stop[quotes]
            two = one & ~stop[quotes + 1]
            pair = lambda x, y: (a == ord(x)) & (b == ord(y))
            kinds[quotes[one & np.isin(a, [ord(c) for c in "stmd"])]] = CLOSE2
            kinds[quotes[two & (pair("r", "e") | pair("v", "e") | pair("l", "l"))]] = CLOSE3
        return kinds

    def starts(self, cps: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Places where a pre-token starts; ``first`` and ``last`` are the
        places where (non-empty) documents start and end."""
        n = len(cps)
        kinds = self.classes(cps, last)
        heads = np.zeros(n, np.uint8)
        heads[first] = CLASSES
        rows = -(-n // BLOCK)
        own = np.full(rows * BLOCK, self.identity, np.uint16)
        own[:n] = self.element[kinds + heads]
        scan = np.ascontiguousarray(own.reshape(rows, BLOCK).T)
        for j in range(1, BLOCK):                           # inside the blocks
            scan[j] = self.then[scan[j - 1].astype(np.int32) * self.n + scan[j]]
        total, step = scan[-1].copy(), 1
        while step < rows:                                  # over the blocks
            total[step:] = self.then[total[:-step].astype(np.int32) * self.n + total[step:]]
            step *= 2
        before = np.concatenate([[self.identity], total[:-1]]).astype(np.int32)
        states = self.after[self.then[before * self.n + scan]].T.ravel()[:n]
        previous = np.concatenate([[S_NONE], states[:-1]]).astype(np.uint8)
        previous[first] = S_NONE
        return np.flatnonzero(self.opens[previous, kinds])


class Codec(dict):
    """Piece (bytes) -> its ids as little-endian 32-bit integers, cached."""

    def __init__(self, rank_file: str):
        with open(rank_file, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.vocabulary = {i: piece for piece, i in self.ranks.items()}
        self.scanner = Scanner()
        self.size = 0

    def __missing__(self, piece: bytes) -> bytes:
        ids = np.array(self.merge(piece), "<u4").tobytes()
        if len(piece) <= CACHED_PIECE:
            self.size += ENTRY_BYTES + len(piece) + len(ids)
            if self.size > CACHE_BYTES:
                self.clear()
                self.size = 0
            self[piece] = ids
        return ids

    def merge(self, piece: bytes) -> list[int]:
        ranks = self.ranks
        if (whole := ranks.get(piece)) is not None:
            return [whole]
        if len(piece) > LONG_PIECE:
            return self._merge_long(piece)
        parts = [piece[i:i + 1] for i in range(len(piece))]
        get = ranks.get
        pairs = [get(a + b, 1 << 60) for a, b in zip(parts, parts[1:])]
        while pairs:
            low = min(pairs)
            if low == 1 << 60:
                break
            i = pairs.index(low)
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
            del pairs[i]
            if i < len(pairs):
                pairs[i] = get(parts[i] + parts[i + 1], 1 << 60)
            if i:
                pairs[i - 1] = get(parts[i - 1] + parts[i], 1 << 60)
        return [ranks[p] for p in parts]

    def _merge_long(self, piece: bytes) -> list[int]:
        """The same with a heap of pairs over a linked list of parts."""
        ranks, n = self.ranks, len(piece)
        part = [piece[i:i + 1] for i in range(n)]
        right, left = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = []

        def offer(i):
            if i >= 0 and right[i] < n and (r := ranks.get(part[i] + part[right[i]])) is not None:
                heapq.heappush(heap, (r, i, len(part[i]), len(part[right[i]])))
        for i in range(n - 1):
            offer(i)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            if part[i] is None or right[i] >= n or len(part[i]) != a or len(part[right[i]]) != b:
                continue
            j = right[i]
            part[i], part[j] = part[i] + part[j], None
            right[i] = right[j]
            if right[j] < n:
                left[right[j]] = i
            offer(i)
            offer(left[i])
        return [ranks[p] for p in part if p is not None]

    def slices(self, texts: list[str]) -> Iterator[list[bytes]]:
        """The pre-tokens of each text, as UTF-8."""
        joined = "".join(texts)
        if not joined:
            yield from ([] for _ in texts)
            return
        cps = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4")
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        stops = np.cumsum(lengths)
        full = lengths > 0
        starts = self.scanner.starts(cps, (stops - lengths)[full], stops[full] - 1)
        width = 1 + (cps > 0x7F) + (cps > 0x7FF) + (cps > 0xFFFF)
        offset = np.concatenate([[0], np.cumsum(width)])
        data = joined.encode("utf-8", "surrogatepass")
        cuts = np.append(offset[starts], len(data)).tolist()
        where = np.searchsorted(starts, np.concatenate([[0], stops])).tolist()
        for a, b in zip(where, where[1:]):
            yield [data[x:y] for x, y in zip(cuts[a:b], cuts[a + 1:b + 1])]

    def encode(self, texts: list[str]) -> Iterator[tuple[bytes, list[bytes]]]:
        """Per text: its ids packed, and its pre-tokens."""
        group, size = [], 0
        for text in [*texts, None]:
            if group and (text is None or size + len(text) > BATCH_CHARS):
                for pieces in self.slices(group):
                    yield b"".join(map(self.__getitem__, pieces)), pieces
                group, size = [], 0
            if text is not None:
                group.append(text)
                size += len(text)

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.vocabulary.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def codec(rank_file: str) -> Codec:
    return held(("byte_bpe", rank_file), lambda: Codec(rank_file))


DIGEST = "n_tokens long, ids_sha256 string, decoded_sha256 string"


def _digest_udf(rank_file: str):
    @F.pandas_udf(DIGEST)
    def digest(texts: pd.Series) -> pd.DataFrame:
        c = codec(rank_file)
        rows = [(len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(c.decode(ids)).hexdigest())
                for ids, _ in c.encode(list(texts))]
        return pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])
    return digest


def encode_udf(rank_file: str):
    """Text -> ``ids``, and ``offsets``: per id, the byte at which it starts."""
    @F.pandas_udf("ids array<int>, offsets array<long>")
    def encode(texts: pd.Series) -> pd.DataFrame:
        c, ids, offsets = codec(rank_file), [], []
        for packed, _ in c.encode(list(texts)):
            own = np.frombuffer(packed, "<u4").astype(np.int32)
            ids.append(own)
            sizes = [len(c.vocabulary[i]) for i in own.tolist()]
            offsets.append(np.cumsum([0, *sizes[:-1]]) if sizes else np.zeros(0, np.int64))
        return pd.DataFrame({"ids": ids, "offsets": offsets})
    return encode


def decode_udf(rank_file: str):
    """Ids -> bytes (a slice of ids decodes to the bytes between its offsets)."""
    @F.pandas_udf(T.BinaryType())
    def decode(ids: pd.Series) -> pd.Series:
        c = codec(rank_file)
        return pd.Series([None if x is None else b"".join(c.vocabulary[i] for i in x) for x in ids], dtype=object)
    return decode


def encode_documents(docs: DataFrame, rank_file: str, text_column: str = "text") -> DataFrame:
    """``docs`` with ``token_ids`` and ``token_offsets`` (replacing columns of
    these names)."""
    kept = [F.col(f"`{c}`") for c in docs.columns if c not in ("token_ids", "token_offsets")]
    coded = docs.select(*kept, encode_udf(rank_file)(text_of(text_column)).alias("_coded"))
    return coded.select(*kept, F.col("_coded.ids").alias("token_ids"), F.col("_coded.offsets").alias("token_offsets"))


def digests(docs: DataFrame, rank_file: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of every row."""
    return docs.select(F.col(id_column).alias("doc_id"),
                       _digest_udf(rank_file)(text_of(text_column)).alias("d")).select("doc_id", "d.*")


def training_rows(docs: DataFrame, rank_file: str, id_column: str = "doc_id", text_column: str = "text",
                  source_column: str = "source") -> DataFrame:
    """``doc_id, source, n_tokens, token_ids, ids_sha256, decoded_sha256`` of
    every row."""
    @F.pandas_udf(f"token_ids array<int>, {DIGEST}")
    def encode(texts: pd.Series) -> pd.DataFrame:
        c = codec(rank_file)
        rows = [(np.frombuffer(ids, "<u4").astype(np.int32), len(ids) // 4, hashlib.sha256(ids).hexdigest(),
                 hashlib.sha256(c.decode(ids)).hexdigest()) for ids, _ in c.encode(list(texts))]
        return pd.DataFrame(rows, columns=["token_ids", "n_tokens", "ids_sha256", "decoded_sha256"])
    return docs.select(F.col(id_column).alias("doc_id"), F.col(source_column).alias("source"),
                       encode(text_of(text_column)).alias("d")).select("doc_id", "source", "d.*")
