"""SentencePiece encoding and decoding that keeps source offsets.

The normaliser reads the model's compiled character map (a double-array trie
over UTF-8 bytes and a pool of replacements). The longest key that starts at a
place is looked for at every character of a text at once: all places walk the
trie together, a byte a step. Where a longer key begins, the characters it
covers go with it, leftmost first; every other character stands for itself. For
each byte of the normalised text the source byte it came from is recorded, with
white space handled as the model says (an escape of three bytes, a space put in
front, runs shortened).

Two neighbouring characters that stand next to each other in no piece of the
model can never be merged, so a text is cut there (one table lookup for all its
characters at once) and each part is merged alone: pairs by score, leftmost
first; characters outside the vocabulary fall back to their bytes. Merged parts
are kept in a cache of two generations, bounded in bytes. Piece lengths laid
along the alignment project every piece to the span of source bytes it stands
for: the spans of a text follow one another, and of the bytes of a fallback the
last one carries the span.

``PieceModel`` raises for models whose pieces would not keep to this (other
kinds than BPE, own symbols, unused pieces).

Edge cases: null and empty texts are only the begin and end ids and decode to
nothing; leading, trailing and repeated spaces follow the model; control
symbols written in a text are ordinary text; U+2581 in a text is a space to the
model and comes back as one; very long texts and pre-tokens are whole (a heap
merges them in n log n); repeated rows are encoded each alone; other columns are
kept by ``encode_documents`` except for those it adds, which replace columns of
the same name.
"""

from __future__ import annotations

import hashlib
import heapq
import re
import struct
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_of

MARK = "▁"                          # escaped space, three bytes
CACHE_BYTES = 64 << 20              # of each of the two generations of merged parts a worker keeps
CACHED_CHARS = 64                   # longer parts are merged each time
ENTRY_BYTES = 200                   # of an entry besides its characters and ids
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
_NONE = 1 << 60


class CharMap:
    """A compiled character map: keys in a double-array trie, each with a
    replacement from a pool of strings that end with a zero byte."""

    def __init__(self, blob: bytes):
        size = struct.unpack_from("<I", blob)[0] if blob else 0
        self.units = np.frombuffer(blob, "<u4", size // 4, 4) if blob else np.zeros(0, np.uint32)
        self.pool = np.frombuffer(blob, np.uint8, offset=4 + size) if blob else np.zeros(0, np.uint8)
        zeros = np.flatnonzero(self.pool == 0)
        # where the string that holds a place of the pool ends
        self.ends = zeros
        if b"  " in self.pool.tobytes():
            raise ValueError("a replacement of this model holds a run of spaces")

    def longest(self, data: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per place of ``data``: length of the longest key that starts there
        (0: none) and where its replacement starts in the pool."""
        length, value = np.zeros(len(places), np.int64), np.zeros(len(places), np.int64)
        if not len(self.units) or not len(places):
            return length, value
        units, n = self.units, len(data)
        root = int(units[0])
        at = np.arange(len(places))
        node = np.full(len(places), (root >> 10) << ((root & 0x200) >> 6), np.int64)
        depth = 0
        while len(at):
            inside = places[at] + depth < n
            at, node = at[inside], node[inside]
            byte = data[places[at] + depth].astype(np.int64)
            node = node ^ byte
            unit = units[node].astype(np.int64)
            same = (unit & 0x800000FF) == byte
            at, node, unit = at[same], node[same], unit[same]
            node = node ^ ((unit >> 10) << ((unit & 0x200) >> 6))
            depth += 1
            leaf = (unit >> 8) & 1 == 1
            length[at[leaf]] = depth
            value[at[leaf]] = units[node[leaf]] & 0x7FFFFFFF
        return length, value

    def sizes(self, value: np.ndarray) -> np.ndarray:
        return self.ends[np.searchsorted(self.ends, value)] - value


class Normalizer:
    """Text -> normalised bytes, and for each of them and their end the source
    byte it came from."""

    def __init__(self, spec):
        self.map = CharMap(spec.precompiled_charsmap)
        self.prefix = spec.add_dummy_prefix
        self.shorten = spec.remove_extra_whitespaces
        self.escape = spec.escape_whitespaces
        self.space = np.frombuffer(MARK.encode() if self.escape else b" ", np.uint8)
        # what counts as a space at the end, where a written escape does too
        self.trailing = re.compile(rb"(?: |" + self.space.tobytes() + rb")*\Z")

    def __call__(self, source: bytes) -> tuple[bytes, np.ndarray]:
        data = np.frombuffer(source, np.uint8)
        starts = np.flatnonzero((data & 0xC0) != 0x80)
        taken = np.diff(np.append(starts, len(data)))
        length, value = self.map.longest(data, starts)
        if not length.any():                              # every character stands for itself
            return self._spaces(data, np.arange(len(data)), len(data))
        starts, taken, length, value = self._cover(starts, taken, length, value)
        mapped = length > 0
        size = taken.copy()
        size[mapped] = self.map.sizes(value[mapped])
        origin = np.where(mapped, len(data) + value, starts)
        pool = np.concatenate([data, self.map.pool])
        return self._spaces(pool[_runs(origin, size)], np.repeat(starts, size), len(data))

    @staticmethod
    def _cover(starts, taken, length, value):
        """Drop the characters inside a longer key, leftmost key first."""
        keep, free = np.ones(len(starts), bool), 0
        taken = np.where(length > 0, length, taken)
        own = np.diff(np.append(starts, starts[-1] + taken[-1]))
        for i in np.flatnonzero((length > 0) & (length > own)).tolist():
            if starts[i] < free:
                continue
            free = int(starts[i] + length[i])
            keep[i + 1:np.searchsorted(starts, free)] = False
        return starts[keep], taken[keep], length[keep], value[keep]

    def _spaces(self, out: np.ndarray, align: np.ndarray, end: int) -> tuple[bytes, np.ndarray]:
        blank = out == 32
        if self.shorten and len(out):
            before = np.concatenate([[True], blank[:-1]])
            keep = ~(blank & before)
            trailing = len(self.trailing.search(out.tobytes()).group())
            if trailing:
                keep[len(out) - trailing:] = False
                end = int(align[len(out) - trailing])
            out, align, blank = out[keep], align[keep], blank[keep]
            if not len(out):
                return b"", np.array([end])
        elif not end:
            return b"", np.array([0])
        if self.escape and blank.any():
            times = np.where(blank, 3, 1)
            align = np.repeat(align, times)
            first = (np.cumsum(times) - times)[blank]
            out = np.repeat(out, times)
            for k in range(3):
                out[first + k] = self.space[k]
        if self.prefix:
            head = align[0] if self.shorten else 0
            out = np.concatenate([self.space, out])
            align = np.concatenate([np.full(len(self.space), head), align])
        return out.tobytes(), np.append(align, end)


def _runs(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """first[0], first[0] + 1, ... (size[0] of them), first[1], ..."""
    total = int(size.sum())
    offset = np.cumsum(size) - size
    return np.repeat(first - offset, size) + np.arange(total)


class Neighbours:
    """Which characters stand next to each other in some piece."""

    def __init__(self, pieces):
        joined = {p[i:i + 2] for p in pieces for i in range(len(p) - 1)}
        characters = sorted({c for pair in joined for c in pair})
        self.number = np.zeros(0x110000, np.uint16)          # 0: in no pair
        self.number[[ord(c) for c in characters]] = np.arange(1, len(characters) + 1)
        self.width = len(characters) + 1
        known = self.number[[[ord(c) for c in pair] for pair in joined]].astype(np.int64) if joined else np.zeros((0, 2), int)
        self.joined = np.zeros(self.width * self.width, bool)
        self.joined[known[:, 0] * self.width + known[:, 1]] = True

    def cuts(self, text: str) -> list[int]:
        """Places of the text that no merge crosses, with both ends."""
        cps = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
        own = self.number[cps].astype(np.int32)
        apart = np.flatnonzero(~self.joined[own[:-1] * self.width + own[1:]]) + 1
        return [0, *apart.tolist(), len(text)]


class Merged(dict):
    """Part of a text -> its ids and their lengths in normalised bytes, pair by
    pair as packed 32-bit integers. When a generation is full, the one before
    it goes; parts still in use come along."""

    def __init__(self, merge):
        super().__init__()
        self.merge, self.older, self.size = merge, {}, 0

    def __missing__(self, part: str) -> bytes:
        made = self.older.get(part)
        if made is None:
            made = self.merge(part)
        if len(part) <= CACHED_CHARS:
            self.size += ENTRY_BYTES + 4 * len(part) + len(made)
            if self.size > CACHE_BYTES:
                self.older, self.size = dict(self), 0
                self.clear()
            self[part] = made
        return made


class PieceModel:
    """A BPE model with byte fallback, read from its file."""

    def __init__(self, model_file: str):
        from sentencepiece import sentencepiece_model_pb2 as proto

        spec = proto.ModelProto()
        with open(model_file, "rb") as f:
            spec.ParseFromString(f.read())
        kinds = {p.type for p in spec.pieces}
        trainer = spec.trainer_spec
        if (trainer.model_type != trainer.BPE or not trainer.byte_fallback or trainer.treat_whitespace_as_suffix
                or USER in kinds or UNUSED in kinds or spec.denormalizer_spec.precompiled_charsmap):
            raise ValueError("not a plain BPE model with byte fallback")
        self.normalize = Normalizer(spec.normalizer_spec)
        self.ids = {p.piece: i for i, p in enumerate(spec.pieces) if p.type == NORMAL}
        order = {s: r for r, s in enumerate(sorted({spec.pieces[i].score for i in self.ids.values()}, reverse=True))}
        # the higher its score, the sooner a pair is merged
        self.order = {p: order[spec.pieces[i].score] for p, i in self.ids.items()}
        self.neighbours = Neighbours(self.ids)
        self.merged = Merged(self._packed)
        self.begin, self.end = trainer.bos_id, trainer.eos_id
        self.strip = spec.normalizer_spec.add_dummy_prefix or spec.normalizer_spec.remove_extra_whitespaces
        self.strip_all = spec.normalizer_spec.remove_extra_whitespaces
        self.byte_of = {i: int(p.piece[3:5], 16) for i, p in enumerate(spec.pieces) if p.type == BYTE}
        self.byte_ids = {b: i for i, b in self.byte_of.items()}
        written = {NORMAL: lambda p: p.replace(MARK, " ").encode(), UNKNOWN: lambda p: trainer.unk_surface.encode(),
                   CONTROL: lambda p: b"", BYTE: lambda p: bytes([int(p[3:5], 16)])}
        self.surface = {i: written[p.type](p.piece) for i, p in enumerate(spec.pieces)}

    # ------------------------------------------------------------ encoding

    def merge(self, part: str) -> list[str]:
        """The pieces of a part of a text."""
        if len(part) > CACHED_CHARS:
            return self._merge_long(part)
        parts, get = list(part), self.order.get
        pairs = [get(a + b, _NONE) for a, b in zip(parts, parts[1:])]
        while pairs:
            low = min(pairs)
            if low == _NONE:
                break
            i = pairs.index(low)
            parts[i] += parts[i + 1]
            del parts[i + 1], pairs[i]
            if i < len(pairs):
                pairs[i] = get(parts[i] + parts[i + 1], _NONE)
            if i:
                pairs[i - 1] = get(parts[i - 1] + parts[i], _NONE)
        return parts

    def _merge_long(self, word: str) -> list[str]:
        """The same with a heap of pairs over a linked list of parts."""
        get, n = self.order.get, len(word)
        part: list[str | None] = list(word)
        right, left, heap = list(range(1, n + 1)), list(range(-1, n - 1)), []

        def offer(i: int) -> None:
            if i >= 0 and right[i] < n:
                both = part[i] + part[right[i]]
                if (r := get(both)) is not None:
                    heapq.heappush(heap, (r, i, both))
        for i in range(n - 1):
            offer(i)
        while heap:
            _, i, both = heapq.heappop(heap)
            if part[i] is None or right[i] >= n or part[i] + part[right[i]] != both:
                continue
            j = right[i]
            part[i], part[j], right[i] = both, None, right[j]
            if right[j] < n:
                left[right[j]] = i
            offer(i)
            offer(left[i])
        return [p for p in part if p is not None]

    def _packed(self, part: str) -> bytes:
        flat = []
        for p in self.merge(part):
            raw = p.encode("utf-8", "surrogatepass")
            if (i := self.ids.get(p)) is not None:
                flat += (i, len(raw))
            else:                                       # outside the vocabulary: the last byte carries the span
                for b in raw:
                    flat += (self.byte_ids[b], 0)
                flat[-1] = len(raw)
        return struct.pack(f"<{len(flat)}I", *flat)

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids (without begin and end) and the source bytes, from and to
        (exclusive), that each of them stands for."""
        normal, align = self.normalize(text.encode("utf-8", "surrogatepass"))
        if not normal:
            return np.zeros(0, "<u4"), np.zeros(0, np.int64), np.zeros(0, np.int64)
        string = normal.decode("utf-8", "surrogatepass")
        cuts = self.neighbours.cuts(string)
        parts = [string[a:b] for a, b in zip(cuts, cuts[1:])]
        made = np.frombuffer(b"".join(map(self.merged.__getitem__, parts)), "<u4").reshape(-1, 2)
        ends = np.cumsum(made[:, 1], dtype=np.int64)
        return made[:, 0], align[np.concatenate([[0], ends[:-1]])], align[ends]

    def framed(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``encode`` between the begin and the end id (empty spans at either
        end of the text)."""
        ids, starts, ends = self.encode(text)
        size = len(text.encode("utf-8", "surrogatepass"))
        return (np.concatenate([[self.begin], ids, [self.end]]).astype("<u4"),
                np.concatenate([[0], starts, [size]]), np.concatenate([[0], ends, [size]]))

    # ------------------------------------------------------------ decoding

    def decode(self, ids: list[int]) -> str:
        """The text of the ids: control ids are silent, runs of byte ids are
        read as UTF-8 (a byte that is none becomes U+FFFD), and the space put
        in front goes."""
        if self.strip and self.strip_all:
            return self._decode_by_piece(ids)
        written = list(map(self.surface.__getitem__, ids))
        raw = b"".join(written)
        if self.strip and raw[:1] == b" " and next(i for i, w in zip(ids, written) if w) not in self.byte_of:
            raw = raw[1:]
        try:
            return raw.decode("utf-8")
        except UnicodeDecodeError:           # some run of byte ids is no UTF-8 by itself
            return self._decode_by_piece(ids)

    def _decode_by_piece(self, ids: list[int]) -> str:
        out, run, surface, byte_of = [], bytearray(), self.surface, self.byte_of
        open_, seen = self.strip, False       # whether the space in front is still to come; whether it was met
        for i in ids:
            b = byte_of.get(i)
            if b is not None:
                run.append(b)
                continue
            if run:
                out.append(_characters(bytes(run)))
                run.clear()
            piece = surface[i]
            if open_:
                if seen or out:
                    open_ = False
                else:
                    seen = piece[:1] == b" "
                    piece = piece[1:] if seen else piece
                    if self.strip_all:
                        seen = False
            if piece:
                out.append(piece.decode("utf-8", "surrogatepass"))
        if run:
            out.append(_characters(bytes(run)))
        return "".join(out)


def _characters(raw: bytes) -> str:
    """UTF-8, each byte that begins no character replaced alone."""
    try:
        return raw.decode("utf-8")
    except UnicodeDecodeError:
        pass
    out, at = [], 0
    while at < len(raw):
        first = raw[at]
        size = 1 if first < 0x80 else 2 if first < 0xE0 else 3 if first < 0xF0 else 4
        try:
            out.append(raw[at:at + size].decode("utf-8"))
            at += size
        except UnicodeDecodeError:
            out.append("�")
            at += 1
    return "".join(out)


@lru_cache(maxsize=2)
def piece_model(model_file: str) -> PieceModel:
    return PieceModel(model_file)


def encode_udf(model_file: str):
    """Text -> ``ids`` (with begin and end), ``starts`` and ``ends`` (source
    bytes)."""
    @F.pandas_udf("ids array<int>, starts array<long>, ends array<long>")
    def encode(texts: pd.Series) -> pd.DataFrame:
        m = piece_model(model_file)
        rows = [m.framed(t) for t in texts]
        return pd.DataFrame({"ids": [r[0].astype(np.int32) for r in rows], "starts": [r[1] for r in rows],
                             "ends": [r[2] for r in rows]})
    return encode


def decode_udf(model_file: str):
    """Ids -> text."""
    @F.pandas_udf("string")
    def decode(ids: pd.Series) -> pd.Series:
        m = piece_model(model_file)
        return pd.Series([None if x is None else m.decode(x.tolist()) for x in ids], dtype=object)
    return decode


ADDED = ("piece_ids", "piece_starts", "piece_ends")


def encode_documents(docs: DataFrame, model_file: str, text_column: str = "text") -> DataFrame:
    """``docs`` with ``piece_ids``, ``piece_starts`` and ``piece_ends``."""
    kept = [F.col(f"`{c}`") for c in docs.columns if c not in ADDED]
    coded = docs.select(*kept, encode_udf(model_file)(text_of(text_column)).alias("_coded"))
    return coded.select(*kept, F.col("_coded.ids").alias("piece_ids"), F.col("_coded.starts").alias("piece_starts"),
                        F.col("_coded.ends").alias("piece_ends"))


def digests(docs: DataFrame, model_file: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256, spans_sha256`` of every
    row, ids with begin and end; ``spans_sha256`` is that of the spans' starts,
    then ends, as little-endian 64-bit integers."""
    @F.pandas_udf("n_tokens long, ids_sha256 string, decoded_sha256 string, spans_sha256 string")
    def digest(texts: pd.Series) -> pd.DataFrame:
        m, rows = piece_model(model_file), []
        for t in texts:
            ids, starts, ends = m.framed(t)
            text = m.decode(ids.tolist())
            rows.append((len(ids), hashlib.sha256(ids.tobytes()).hexdigest(),
                         hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest(),
                         hashlib.sha256(starts.astype("<i8").tobytes() + ends.astype("<i8").tobytes()).hexdigest()))
        return pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256", "spans_sha256"])
    return docs.select(F.col(id_column).alias("doc_id"),
                       digest(text_of(text_column)).alias("d")).select("doc_id", "d.*")
