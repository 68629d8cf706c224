"""Fill-in-middle transformation, cut by ranks on a wavelet matrix.

A text is a sequence of units: a run of ASCII letters, or one other code point.
Every code point gets a class: it stands alone, it goes on with a run of
letters, or it opens one. A wavelet matrix over the classes of a batch of texts
answers rank queries (how many code points of a class lie before a place), and
the ranks of the two classes that open a unit add up to the number of units
before a place. The places of the two cuts are found by bisection on that
number, for all texts of a batch at once. The batch is laid out text by text, so
a text's ranks are differences against the rank at its own start.

The rendered document is plain (the text), psm (prefix, suffix, middle) or spm
(suffix, prefix, middle), with a sentinel before each part; ``restore`` takes
the text back from the rendered document and its form alone. A text that already
holds a sentinel stays plain, and no sentinel can arise across a join, since no
proper beginning of one ends like it.

Edge cases: null and empty texts have no unit and stay plain; a null id is
hashed as an empty one; repeated rows with one id get the same cuts; very long
texts are cut whole, a batch of its own each (about one byte a code point and a
few bits more); other columns are kept by ``fill_in_middle`` except for those it
adds, which replace columns of the same name.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_of

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"
BATCH_CHARS = 1_000_000       # code points of one matrix (a longer text alone)
ALONE, GOES_ON, OPENS = range(3)
CLASS_BITS = 2


class RankBits:
    """A bit vector with constant-time rank: 64-bit words and the number of
    ones before each."""

    def __init__(self, bits: np.ndarray):
        packed = np.packbits(bits, bitorder="little")
        padded = np.zeros(len(bits) // 64 * 8 + 8, np.uint8)
        padded[:len(packed)] = packed
        self.words = padded.view("<u8")
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)[:-1]])

    def ones(self, i: np.ndarray) -> np.ndarray:
        """Ones before each place."""
        word, bit = i >> 6, (i & 63).astype(np.uint64)
        mask = (np.uint64(1) << bit) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & mask)


class WaveletMatrix:
    """Symbols of ``bits`` bits; a level per bit, highest first, each level's
    zeros moved before its ones."""

    def __init__(self, symbols: np.ndarray, bits: int):
        self.levels = []
        for b in range(bits - 1, -1, -1):
            ones = (symbols >> b) & 1 == 1
            self.levels.append((b, RankBits(ones), len(symbols) - int(ones.sum())))
            symbols = np.concatenate([symbols[~ones], symbols[ones]])

    def rank(self, symbol: int, i: np.ndarray) -> np.ndarray:
        """How often ``symbol`` occurs before each place."""
        start, end = np.zeros_like(i), i
        for b, level, zeros in self.levels:
            if (symbol >> b) & 1:
                start, end = zeros + level.ones(start), zeros + level.ones(end)
            else:
                start, end = start - level.ones(start), end - level.ones(end)
        return end - start


def character_classes(cps: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Class of every code point; ``first``: the places where texts start."""
    letter = ((cps >= 65) & (cps <= 90)) | ((cps >= 97) & (cps <= 122))
    joined = np.zeros(len(cps), bool)
    joined[1:] = letter[1:] & letter[:-1]
    joined[first] = False
    return np.where(letter, np.where(joined, GOES_ON, OPENS), ALONE).astype(np.uint8)


class Units:
    """Unit counts and unit places of a batch of texts."""

    def __init__(self, texts: list[str]):
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        self.stop = np.cumsum(lengths)
        self.start = self.stop - lengths
        cps = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4")
        self.matrix = WaveletMatrix(character_classes(cps, self.start[lengths > 0]), CLASS_BITS)
        self.base = self._opened(self.start)

    def _opened(self, place: np.ndarray) -> np.ndarray:
        """Units that open before each place of the batch."""
        return self.matrix.rank(ALONE, place) + self.matrix.rank(OPENS, place)

    def counts(self) -> np.ndarray:
        return self._opened(self.stop) - self.base

    def ends(self, k: np.ndarray) -> np.ndarray:
        """Per text, the code points of its first ``k`` units: the last place
        before which no more than ``k`` units open."""
        low, high = self.start, self.stop
        while (low < high).any():
            middle = (low + high + 1) >> 1
            fits = self._opened(middle) - self.base <= k
            low, high = np.where(fits, middle, low), np.where(fits, high, middle - 1)
        return low - self.start


def groups(texts: list[str], size: int = BATCH_CHARS):
    """Consecutive texts of about ``size`` code points together."""
    group, total = [], 0
    for text in texts:
        if group and total + len(text) > size:
            yield group
            group, total = [], 0
        group.append(text)
        total += len(text)
    if group:
        yield group


def unit_cuts(texts: list[str], a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Units of each text, and the ends of its first ``min`` and ``max`` of
    ``a % (n + 1)`` and ``b % (n + 1)`` units, in code points."""
    counts, first, second, at = [], [], [], 0
    for group in groups(texts):
        units = Units(group)
        n = units.counts()
        x, y = a[at:at + len(group)] % (n + 1), b[at:at + len(group)] % (n + 1)
        counts.append(n)
        first.append(units.ends(np.minimum(x, y)))
        second.append(units.ends(np.maximum(x, y)))
        at += len(group)
    if not counts:
        return (np.zeros(0, np.int64),) * 3
    return np.concatenate(counts), np.concatenate(first), np.concatenate(second)


def render(text: str, form: str, i: int, j: int) -> str:
    if form == PSM:
        return f"{PREFIX}{text[:i]}{SUFFIX}{text[j:]}{MIDDLE}{text[i:j]}"
    if form == SPM:
        return f"{SUFFIX}{text[j:]}{PREFIX}{text[:i]}{MIDDLE}{text[i:j]}"
    return text


def restore(output: str, form: str) -> str:
    """The text, from the rendered document and its form."""
    if form == PLAIN:
        return output
    inner = SUFFIX if form == PSM else PREFIX
    one = output.index(inner, len(PREFIX))
    two = output.index(MIDDLE, one + len(inner))
    parts = output[len(PREFIX):one], output[one + len(inner):two]
    prefix, suffix = parts if form == PSM else parts[::-1]
    return prefix + output[two + len(MIDDLE):] + suffix


def draws(id_column: str | Column, count: int = 4, seed: str = "1") -> list[Column]:
    """The first 8-digit groups of the SHA-256 of ``seed:id``, as numbers."""
    key = F.coalesce((F.col(id_column) if isinstance(id_column, str) else id_column).cast("string"), F.lit(""))
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), key), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(count)]


def _transform_udf():
    @F.pandas_udf("n long, form string, prefix_chars long, middle_chars long, output string")
    def transform(texts: pd.Series, a: pd.Series, b: pd.Series, plain: pd.Series, spm: pd.Series) -> pd.DataFrame:
        own = list(texts)
        n, i, j = unit_cuts(own, a.to_numpy(np.int64), b.to_numpy(np.int64))
        rows = []
        for text, units, x, y, is_plain, is_spm in zip(own, n.tolist(), i.tolist(), j.tolist(), plain, spm):
            if is_plain or not text or PREFIX in text or SUFFIX in text or MIDDLE in text:
                rows.append((units, PLAIN, None, None, text))
            else:
                form = SPM if is_spm else PSM
                rows.append((units, form, x, y - x, render(text, form, x, y)))
        out = pd.DataFrame(rows, columns=["n", "form", "prefix_chars", "middle_chars", "output"])
        return out.astype({"prefix_chars": "Int64", "middle_chars": "Int64"})
    return transform


def restored_udf():
    """``restore`` of rendered documents."""
    @F.pandas_udf("string")
    def restored(outputs: pd.Series, forms: pd.Series) -> pd.Series:
        return pd.Series([None if o is None else restore(o, f) for o, f in zip(outputs, forms)], dtype=object)
    return restored


ADDED = ("n", "form", "prefix_chars", "middle_chars", "output")


def fill_in_middle(docs: DataFrame, plain_percent: int = 10, spm_percent: int = 20, seed: str = "1",
                   id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``docs`` with ``n`` (units), ``form``, ``prefix_chars``,
    ``middle_chars`` (null when plain) and ``output`` (the rendered document).
    ``plain_percent`` of the documents stay plain, ``spm_percent`` of the
    others put the suffix first. No shuffle."""
    kept = [F.col(f"`{c}`") for c in docs.columns if c not in ADDED]
    h1, h2, h3, h4 = draws(F.col(f"`{id_column}`"), seed=seed)
    made = _transform_udf()(text_of(text_column), h1, h2, h3 % 100 >= 100 - plain_percent, h4 % 100 < spm_percent)
    return docs.select(*kept, made.alias("_made")).select(*kept, *[F.col(f"_made.{c}") for c in ADDED])


def digests(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars, output_sha256,
    restored_sha256`` of every row: what ``fill_in_middle`` renders and what
    ``restore`` takes back from it."""
    narrow = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    out = fill_in_middle(narrow).select("doc_id", *ADDED)
    return out.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored_udf()("output", "form"), 256).alias("restored_sha256"))
