"""Toxicity with noisy-channel deobfuscation.

Every word that holds a leetspeak sign next to a letter (before, inside or after
it) or a doubled letter, and every run of single letters and signs set apart by
spaces or marks, becomes a lattice: at each place the letters that the sign may
stand for, the run cut to one or two, the mark left out. Signs at either end may
also be plain punctuation or a number. The best path under a character trigram
model times the channel
is found by Viterbi; the restored text is then scored by a sparse logistic
regression on the presence of hashed character n-grams (trained by
follow-the-regularised-leader with an elastic net).

Labels are learned only from rows whose ``crc32`` of the id modulo 3 is not 1,
and from all of them. The trigrams of the language model are counted over every
one. The classifier is the mean of as many as the rows need, each fitted by a
task of its own on a shard of bounded size: the rows of the larger class are
dealt by a hash, about ``TRAIN_PER_CLASS`` a shard; those of the smaller one go
to as many shards as give each that number too, or all there are. So each row
trains, the classes meet in every shard, and all shards together hold at most
about twice the rows. Every row is scored whole in one pass without a shuffle;
labels, language, source and id are inputs of no score.

Edge cases: a null text counts as empty and scores what the intercept says; a
row of ``labels`` without a document, with a null label or a null id is
ignored, one repeated counts once if it agrees and not at all if it does not;
documents with one id and one text train as often as they occur, beyond
``REPEATS`` by heavier steps;
without both classes in the training rows every score is 0; other columns are
not touched. The language model has an entry for each different trigram of
letters.
"""

from __future__ import annotations

import hashlib
import pickle
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from itertools import groupby
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import held, stored, text_of
from .language_id import crc
from .linear import BinaryFtrl, letters, ngrams

SIZES = (3, 4, 5)
BITS = 18
TRAIN_PER_CLASS = 2_000       # rows of a class in one shard
SHARD_CHARS = 50_000_000      # at about which longer texts make more shards
REPEATS = 50                  # steps of an epoch for one text of one id
EPOCHS = 8
L1 = 15.0                     # heavy: signs that few documents carry must stand out to stay
THRESHOLD = 0.7
CACHE_ENTRIES = 100_000
CLOSE = 1e-9                  # scores nearer than this are compared as whole words, not by their ends
TAIL = 8                      # signs at the end of a word whose reading is cached, at most
COUNTED_CHARS = 500_000       # whose trigrams are sorted at once, about

# fixed values: the letters that a sign may stand for
LEET = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
        "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "€": "e", "*": "aeiou"}
_SIGNS = "".join(re.escape(c) for c in LEET)
_LETTER = r"[^\W\d_]"
_MARKS = " \t\u00a0._*-"
_SIGNED = rf"{_LETTER}[{_SIGNS}]|[{_SIGNS}]{_LETTER}"
SUSPECT = re.compile(rf"{_SIGNED}|({_LETTER})\1")
# without these only its runs of letters are read, so that "pull-off" stays two words
_WHOLE = re.compile(rf"{_SIGNED}|({_LETTER})\1\1")
_RUN = re.compile(rf"{_LETTER}+")
_WORD = re.compile(rf"{_LETTER}{{2,}}")
# '*' is a mark here; the lattice still reads it as a sign
_ITEM = rf"(?:{_LETTER}|[{_SIGNS.replace(re.escape('*'), '')}])"
SPACED = re.compile(rf"(?<!\S){_ITEM}(?:[{re.escape(_MARKS)}]++{_ITEM}){{3,}}(?![^\s.,;:!?])")
_ENDS = re.compile(rf"([{_SIGNS}]*+)(.*?)([{_SIGNS}]*)", re.S)
# signs that are common punctuation around a word
_PUNCTUATION = frozenset("!*|+")

_SAME, _SIGN, _KEPT_SIGN, _DROPPED = (float(np.log(p)) for p in (0.95, 0.5, 1e-4, 0.5))
_PUNCTUATED, _NOT_PUNCTUATED, _NUMBERED = (float(np.log(p)) for p in (0.9, 0.1, 1e-4))
_ONE_OF_TWO, _LONG_RUN = float(np.log(0.05)), float(np.log(0.5))
_REPEATED = re.compile(r"(.)\1+", re.S)


@lru_cache(maxsize=1024)
def _same(n: int) -> float:
    """Log odds of ``n`` letters that stand for themselves, added one by one."""
    return sum([_SAME] * n)


def trigrams(words: Counter) -> Counter:
    """Of counted words; ``^`` starts a word and ``$`` ends it."""
    three: Counter = Counter()
    for word, n in words.items():
        s = f"^^{word}$"
        for i in range(len(s) - 2):
            three[s[i:i + 3]] += n
    return three


class Language:
    """Character trigrams of words with back-off."""

    def __init__(self, three: Counter):
        self.three, self.two, self.one = three, Counter(), Counter()
        for k, n in three.items():
            self.two[k[1:]] += n
            self.one[k[2]] += n
        self.two_of, self.one_of = Counter(), Counter()
        for k, n in self.three.items():
            self.two_of[k[:2]] += n
        for k, n in self.two.items():
            self.one_of[k[0]] += n
        self.total = sum(self.one.values()) + 1
        self.held: dict = {}

    def log(self, a: str, b: str, c: str) -> float:
        """Of ``c`` after ``a``, ``b``; cached."""
        found = self.held.get(a + b + c)
        if found is None:
            if len(self.held) > CACHE_ENTRIES:
                self.held.clear()
            found = self.held[a + b + c] = self._log(a, b, c)
        return found

    def _log(self, a: str, b: str, c: str) -> float:
        p = (self.one[c] + 0.01) / (self.total + 1)
        p = (self.two[b + c] + 5 * p) / (self.one_of[b] + 5)
        p = (self.three[a + b + c] + 5 * p) / (self.two_of[a + b] + 5)
        return float(np.log(p))


_LETTERS, _SIGN_KIND, _BLANK, _MARK = 1, 2, 4, 8


@lru_cache(maxsize=1)
def _kinds() -> np.ndarray:
    """Per code point which of these it is, as the expressions above see it."""
    every = "".join(map(chr, range(0x110000)))
    kinds = np.zeros(len(every), np.uint8)
    for kind, found in ((_LETTERS, rf"{_LETTER}+"), (_SIGN_KIND, rf"[{_SIGNS}]+"), (_MARK, rf"[{re.escape(_MARKS)}]+")):
        for m in re.finditer(found, every):
            kinds[m.start():m.end()] |= kind
    kinds[[c for c, x in enumerate(every) if x.isspace()]] |= _BLANK
    return kinds


def _kinds_of(text: str) -> tuple[np.ndarray, np.ndarray]:
    cps = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    return cps, _kinds()[cps]


def _may_be_spaced(kinds: np.ndarray) -> bool:
    """Whether ``SPACED`` may be found: four characters in a row with marks
    between them."""
    gap = np.diff(np.flatnonzero(kinds < _MARK)) > 1
    return bool((gap[2:] & gap[1:-1] & gap[:-2]).any())


def _suspects(cps: np.ndarray, kinds: np.ndarray) -> list[int]:
    """Which words of a text, counted from 0, hold a match of ``SUSPECT``."""
    own = kinds & (_LETTERS | _SIGN_KIND)
    at = np.flatnonzero(((own[1:] | own[:-1]) == _LETTERS | _SIGN_KIND) | ((cps[1:] == cps[:-1]) & (own[1:] == _LETTERS)))
    if not len(at):
        return []
    solid = kinds & _BLANK == 0
    words = np.searchsorted(np.flatnonzero(solid[1:] & ~solid[:-1]) + 1, at, "right") - (not solid[0])
    return words[np.flatnonzero(np.diff(words, prepend=-1))].tolist()


class Restorer(dict):
    """Word -> its best reading, cached; words that do not look disguised are
    their own."""

    def __init__(self, language: Language):
        self.language = language
        self.runs: dict[str, str | None] = {}       # of _run
        self.tails: dict[str, str | None] = {}      # of _tail
        self.close: bool | None = None              # whether scores were too near to tell; None: not watched

    def __missing__(self, word: str) -> str:
        found = self._read(word)
        if len(self) > CACHE_ENTRIES:
            self.clear()
        self[word] = found
        return found

    @staticmethod
    def _suspect(word: str) -> bool:
        """``SUSPECT``, faster for words of letters alone."""
        return any(map(eq, word, word[1:])) if word.isalpha() else SUSPECT.search(word) is not None

    def _read(self, word: str) -> str:
        if word.isalpha():
            return self.viterbi(word)
        if _WHOLE.search(word):
            return self.reading(word)
        return _RUN.sub(self._read_run, word)

    def _read_run(self, m: re.Match) -> str:
        run = m.group()
        return self.viterbi(run) if run.isalpha() or self._suspect(run) else run

    @staticmethod
    def lattice(word: str) -> list[list[tuple[str, float]]]:
        """Per place the strings it may stand for, with log odds."""
        if Restorer._doubled(word):
            word = word[::2]
        places = []
        for c, same in groupby(word):
            run = len(list(same))
            if c.isalpha():
                if run >= 3:
                    places.append([(c, _LONG_RUN), (c + c, _LONG_RUN)])
                elif run == 2:
                    places.append([(c + c, _SAME), (c, _ONE_OF_TWO)])
                elif places and len(places[-1]) == 1:        # single letters are one place
                    before, odds = places[-1][0]
                    places[-1] = [(before + c, odds + _SAME)]
                else:
                    places.append([(c, _SAME)])
            else:
                for _ in range(run if run < 3 else 1):
                    options = [(x, _SIGN) for x in LEET.get(c, "")]
                    options.append((c, _KEPT_SIGN) if c.isdigit() else ("", _DROPPED if not options else _KEPT_SIGN))
                    places.append(options)
        return places

    def _step(self, best: dict, options: list) -> dict:
        """States (last two characters -> score, text as a linked list) after
        one more place."""
        log, known = self.language.log, self.language.held.get
        after: dict = {}
        for (a, b), (score, path) in best.items():
            for out, channel in options:
                s, x, y = score + channel, a, b
                for c in out:
                    odds = known(x + y + c)
                    s += log(x, y, c) if odds is None else odds
                    x, y = y, c
                held = after.get((x, y))
                if held is None:
                    after[x, y] = (s, (path, out))
                    continue
                if self.close is False and abs(s - held[0]) < CLOSE and self._text((path, out)) != self._text(held[1]):
                    self.close = True
                if s > held[0]:
                    after[x, y] = (s, (path, out))
        return after

    def _end(self, best: dict) -> tuple[float, tuple]:
        log, most, state, text = self.language.log, None, None, None
        for k, (s, path) in best.items():
            s += log(*k, "$")
            if self.close is False and most is not None and abs(s - most) < CLOSE:
                self.close = True
            if most is None or s > most or s == most and k > state:
                most, state, text = s, k, path
        return most, text

    @staticmethod
    def _text(path) -> str:
        out = []
        while path is not None:
            path, piece = path
            out.append(piece)
        return "".join(reversed(out))

    def viterbi(self, word: str) -> str:
        """The best path through the whole lattice."""
        if word.isalpha():
            found = self._read_letters(word[::2] if self._doubled(word) else word, "$")
            if found is not None:
                return found
        return self._text(self._end(self._through(word, {("^", "^"): (0.0, None)}))[1])

    def _read_letters(self, word: str, following: str) -> str | None:
        """The best reading of letters that another character or the end
        (``$``) follows. A run has two readings whose paths differ in the run's
        own trigrams and that of the next letter alone, so each is chosen by
        its neighbours; None where a choice is too close to call so."""
        s, at, out = f"^{word}{following}", 1, []
        for m in _REPEATED.finditer(s, 1, len(word) + 1):
            first, end = m.span()
            key = s[first - 1:end + 1] if end - first < 4 else s[first - 1:first + 3] + s[end]
            try:
                found = self.runs[key]
            except KeyError:
                found = self._run(key)
            if found is None:
                return None
            out += s[at:first], found
            at = end
        return "".join(out) + s[at:-1]

    def _run(self, key: str) -> str | None:
        """The reading of a run between two characters; cached."""
        a, c, b, log = key[0], key[1], key[-1], self.language.log
        two, one = (_SAME, _ONE_OF_TWO) if len(key) == 4 else (_LONG_RUN, _LONG_RUN)
        more = two + log(a, c, c) + log(c, c, b) - one - log(a, c, b)
        if len(self.runs) > CACHE_ENTRIES:
            self.runs.clear()
        found = self.runs[key] = None if abs(more) < CLOSE else c + c if more > 0 else c
        return found

    def _tail(self, before: str, run: str, tail: str) -> str | None:
        """The reading of the last run of letters, after ``before``, and of the
        signs behind it; cached. None where a choice is too close to call."""
        key = before + run[:3] + tail
        if key in self.tails:
            return self.tails[key]
        c, log = run[0], self.language.log
        if len(run) == 1:
            best = {(before, c): (0.0, (None, c))}
        else:
            two, one = (_SAME, _ONE_OF_TWO) if len(run) == 2 else (_LONG_RUN, _LONG_RUN)
            best = {(c, c): (two + log(before, c, c), (None, c + c)), (before, c): (one, (None, c))}
        self.close = False
        found = self._ending(tail, best)
        if self.close:
            found = None
        self.close = None
        if len(self.tails) > CACHE_ENTRIES:
            self.tails.clear()
        self.tails[key] = found
        return found

    def _read_tailed(self, body: str, tail: str) -> str | None:
        """The best reading of letters with signs behind them; None where the
        whole lattice has to tell."""
        if self._doubled(body):
            body = body[::2]
        rest = body.rstrip(body[-1])
        start = self._read_letters(rest, body[-1])
        end = self._tail(rest[-1:] or "^", body[len(rest):], tail)
        return None if start is None or end is None else start + end

    def _through(self, word: str, best: dict) -> dict:
        """States after the whole lattice of a word."""
        if len(best) == 1 and word.isalpha():
            return self._through_letters(word, *best.items())
        for options in self.lattice(word):
            best = self._step(best, options)
        return best

    def _through_letters(self, word: str, start: tuple) -> dict:
        """The same for letters alone, without the lattice: a run has two
        readings, and all states meet again at the next letter but its own."""
        if self._doubled(word):
            word = word[::2]
        log, known = self.language.log, self.language.held.get
        ((a, last), (score, path)), at = start, 0
        states = [(score, a, "")]                    # score, last character but one, text

        def best(out: str, channel: float) -> tuple:
            most = None
            for s, x, text in states:
                s, y = s + channel, last
                for c in out:
                    odds = known(x + y + c)
                    s += log(x, y, c) if odds is None else odds
                    x, y = y, c
                if most is None or s > most[0]:
                    most = s, x, text + out
            return most

        for m in _REPEATED.finditer(word):
            first, end = m.span()
            if at < first:
                states, last = [best(word[at:first], _same(first - at))], word[first - 1]
            c = word[first]
            states = ([best(c + c, _SAME), best(c, _ONE_OF_TWO)] if end - first == 2
                      else [best(c, _LONG_RUN), best(c + c, _LONG_RUN)])
            last, at = c, end
        if at < len(word):
            states, last = [best(word[at:], _same(len(word) - at))], word[-1]
        return {(x, last): (s, (path, text)) for s, x, text in states}

    def reading(self, token: str) -> str:
        """The best path, where outer signs may be read or be punctuation or a
        number that stays; what lies outside them stays as it is."""
        known = [i for i, c in enumerate(token) if c.isalnum()]
        first, last = known[0], known[-1]
        while first and token[first - 1] in LEET:
            first -= 1
        while last + 1 < len(token) and token[last + 1] in LEET:
            last += 1
        word = token[first:last + 1]
        head, body, tail = _ENDS.fullmatch(word).groups()
        if self._doubled(word):
            return token[:first] + self.viterbi(word) + token[last + 1:]
        if not head and len(tail) <= TAIL and body.isalpha():
            found = self._read_tailed(body, tail)
            if found is not None:
                return token[:first] + found + token[last + 1:]
        # the head: reading may begin after any of its signs
        best: dict = {}
        for i, c in enumerate(head + body[0]):
            fresh = self._plain(head[:i]), (None, head[:i]) if i else None
            if ("^", "^") not in best or best["^", "^"][0] < fresh[0]:
                best["^", "^"] = fresh
            if i < len(head):
                best = self._step(best, self._outer(c))
        return token[:first] + self._ending(tail, self._through(body, best)) + token[last + 1:]

    def _ending(self, tail: str, best: dict) -> str:
        """The best path on through the tail: reading may end before any of its
        signs."""
        ends = []
        plain = self._plains(tail)
        for i in range(len(tail) + 1):
            score, path = self._end(best)
            ends.append((score + plain[i], -i, path))
            if i < len(tail):
                best = self._step(best, self._outer(tail[i]))
        most, i, path = max(ends, key=lambda x: x[:2])
        if self.close is False:
            self.close = sum(most - s < CLOSE for s, _, _ in ends) > 1
        return self._text(path) + tail[-i:]

    @staticmethod
    def _doubled(word: str) -> bool:
        """Every character twice: the doubling is the disguise."""
        return len(word) > 5 and len(word) % 2 == 0 and word[::2] == word[1::2]

    @staticmethod
    @lru_cache(maxsize=1024)
    def _outer(sign: str) -> list[tuple[str, float]]:
        """The place of a sign at an end of a word that is read."""
        odds = _NOT_PUNCTUATED if sign in _PUNCTUATION else 0.0
        return [(out, channel + odds) for out, channel in Restorer.lattice(sign)[0]]

    @staticmethod
    def _plain(signs: str) -> float:
        """Log odds that signs around a word are no letters."""
        return 0.0 if not signs else _PUNCTUATED if _PUNCTUATION.issuperset(signs) else _NUMBERED

    @staticmethod
    def _plains(signs: str) -> list[float]:
        """``_plain`` of each ending of ``signs``, the whole one first."""
        out, odd = [0.0], False
        for c in reversed(signs):
            odd |= c not in _PUNCTUATION
            out.append(_NUMBERED if odd else _PUNCTUATED)
        return out[::-1]

    def _spaced(self, m: re.Match) -> str:
        run = m.group()
        return self.reading(run) if any(map(str.isalpha, run)) else run    # else numbers

    def restore(self, text: str) -> str:
        """Lower case, words divided by single spaces."""
        text = text.lower()
        cps, kinds = _kinds_of(text)
        if _may_be_spaced(kinds):
            text = SPACED.sub(self._spaced, text)
            cps, kinds = _kinds_of(text)
        words = text.split()
        for i in _suspects(cps, kinds):
            words[i] = self[words[i]]
        return " ".join(words)


def _places(text: str) -> np.ndarray:
    """The n-grams of a text, each once, ascending."""
    found = ngrams(letters(text), SIZES, BITS)
    if len(found) >> BITS - 2:
        there = np.zeros(1 << BITS, bool)
        there[found] = True
        return np.flatnonzero(there).astype(np.int32)
    found = found.astype(np.int32)
    found.sort()
    return found[np.diff(found, prepend=-1) > 0]


SLOTS = 1 << 26               # of the filter before the join; its table has at most a 64th as many rows


def training_rows(docs: DataFrame, labels: DataFrame, id_column="doc_id", text_column="text",
                  label_column="toxic") -> DataFrame:
    """``_id, _label, _text, _n`` (how often) of every document that a label
    trains. The labels grow with the input, so they are not broadcast; a filter
    of bounded size keeps most texts without one out of the join's shuffle."""
    label, slot = F.col(label_column).cast("int"), F.pmod(F.xxhash64("_id"), F.lit(SLOTS))
    mine = F.col(id_column).isNotNull() & (crc(F.col(id_column)) % 3 != 1)
    own = labels.filter(mine & label.isin(0, 1)).groupBy(F.col(id_column).cast("long").alias("_id")).agg(
        F.min(label).alias("_label"), F.max(label).alias("_most")).filter("_label = _most").drop("_most")
    slots = own.withColumn("_slot", slot).groupBy(F.expr("_slot div 64").alias("_word")).agg(
        F.expr("bit_or(shiftleft(1L, cast(_slot % 64 as int)))").alias("_bits"))
    maybe = docs.filter(mine).select(F.col(id_column).cast("long").alias("_id"), text_of(text_column).alias("_text"))
    maybe = maybe.withColumn("_slot", slot).withColumn("_word", F.expr("_slot div 64")).join(
        F.broadcast(slots), "_word").filter("bit_get(_bits, cast(_slot % 64 as int)) = 1")
    return maybe.select("_id", "_text").join(own, "_id").groupBy("_id", "_label", "_text").agg(
        F.count(F.lit(1)).alias("_n"))


ROWS, CHARS = "rows ", "chars"       # keys beside the trigrams, longer than these


def _packed_trigrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """``trigrams`` of all ``_WORD`` of the texts: each once, as one number of
    three code points, and how often it is there."""
    cps, kinds = _kinds_of("\n".join(texts).lower())
    edge = np.diff((kinds & _LETTERS).astype(np.int8), prepend=0, append=0)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    starts, size = starts[ends - starts > 1], (ends - starts)[ends - starts > 1]
    # every word with two places before it and one after it
    cuts = np.cumsum(size + 3) - size - 3
    at = np.arange(int((size + 3).sum())) + np.repeat(starts - cuts - 2, size + 3)
    row = cps[np.clip(at, 0, max(0, len(cps) - 1))].astype(np.uint64)
    row[cuts], row[cuts + 1], row[cuts + size + 2] = ord("^"), ord("^"), ord("$")
    found = (row[:-2] << np.uint64(42)) | (row[1:-1] << np.uint64(21)) | row[2:]
    inside = np.ones(len(row), bool)
    inside[cuts + size + 1] = inside[cuts + size + 2] = False
    return np.unique(found[inside[:-2]], return_counts=True)


def _cuts(texts: pd.Series) -> np.ndarray:
    """Places that cut texts into parts of about ``COUNTED_CHARS``."""
    return np.flatnonzero(np.diff(texts.str.len().cumsum().to_numpy() // COUNTED_CHARS)) + 1


def _unpacked(trigram: int) -> str:
    return chr(trigram >> 42) + chr(trigram >> 21 & 0x1FFFFF) + chr(trigram & 0x1FFFFF)


def counts(rows: DataFrame) -> dict[str, int]:
    """The trigrams of every training row; under ``ROWS`` and the label the rows
    of a class, under ``CHARS`` and the label their characters."""
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        three, total = Counter(), Counter()

        def told() -> pd.DataFrame:
            total.update({_unpacked(k): n for k, n in three.items()})
            out = pd.DataFrame(total.items(), columns=["key", "n"])
            three.clear()
            total.clear()
            return out
        for batch in batches:
            for n, same in batch.groupby("_n"):
                for texts in np.split(same["_text"].to_numpy(object), _cuts(same["_text"])):
                    found, times = _packed_trigrams(texts.tolist())
                    for k, m in zip(found.tolist(), (times * n).tolist()):
                        three[k] += m
            for label, own in batch.groupby("_label"):
                total[f"{ROWS}{label}"] += len(own)
                total[f"{CHARS}{label}"] += int(own["_text"].str.len().sum())
            if len(three) > CACHE_ENTRIES:
                yield told()
        yield told()
    summed = rows.mapInPandas(count, "key string, n long").groupBy("key").agg(F.sum("n").alias("n"))
    return {r["key"]: r["n"] for r in summed.collect()}      # one row a trigram


def deal(rows: DataFrame, n: dict[str, int], per_class: int = TRAIN_PER_CLASS, read=None) -> tuple[DataFrame, int]:
    """``_shard, _mix, _id, _label, _text, _n``, each training row in one shard
    or more, and the number of shards. ``read`` makes the texts of the shards."""
    of = {label: n[f"{ROWS}{label}"] for label in (0, 1)}
    chars = max(n[f"{CHARS}{label}"] for label in (0, 1))
    shards = max(1, round(max(of.values()) / per_class), -(-chars // SHARD_CHARS))
    # of the smaller class, what all shards want of it and have, shared out
    share = {label: min(shards, max(1, round(min(m, max(of.values()) / shards) * shards / m))) for label, m in of.items()}
    once = rows.withColumn("_mix", F.xxhash64(F.col("_id").cast("string"))).withColumn(
        "_deal", F.xxhash64("_id", "_text")).withColumn("_text", F.col("_text") if read is None else read)
    copies = F.sequence(F.lit(0), F.when(F.col("_label") == 1, share[1] - 1).otherwise(share[0] - 1))
    dealt = once.withColumn("_copy", F.explode(copies)).withColumn("_shard", F.pmod(F.col("_deal") + F.col("_copy"), F.lit(shards)))
    return dealt.drop("_copy", "_deal"), shards


def _restored(shared):
    """``_text`` as the classifier reads it."""
    @F.pandas_udf("string")
    def restore(texts: pd.Series) -> pd.Series:
        key, blob = shared.value
        restorer = held(("toxicity language", key), lambda: Restorer(pickle.loads(blob)))
        return texts.map(restorer.restore)
    return restore("_text")


def _fit(epochs: int):
    def fit(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["_mix", "_text"], kind="stable")
        bias = np.array([1 << BITS], np.int32)
        data = [(np.concatenate([_places(t), bias]), y, n)
                for t, y, n in zip(rows["_text"], rows["_label"], rows["_n"])]
        # the places of this shard side by side, frequent ones first, where they stay in the processor's cache
        times = np.zeros((1 << BITS) + 1, np.int64)
        for idx, _, _ in data:
            times[idx] += 1
        used = np.argsort(-times, kind="stable")[:np.count_nonzero(times)]
        at = np.zeros(len(times), np.int32)
        at[used] = np.arange(len(used))
        for idx, _, _ in data:
            idx[:] = at[idx]
        model = BinaryFtrl(len(used), alpha=0.3, l1=L1, l2=0.1)
        for _ in range(epochs):
            for idx, y, n in data:
                for _ in range(min(n, REPEATS)):
                    model.update(idx, y, max(1.0, n / REPEATS))
        w = np.zeros(len(times))
        w[used] = model.weights()
        places = np.flatnonzero(w)
        return pd.DataFrame({"place": places, "weight": w[places]})
    return fit


FIXED = 1 << 32               # weights are summed as whole numbers of this part, in any order alike


def train_model(docs: DataFrame, labels: DataFrame, id_column="doc_id", text_column="text", label_column="toxic",
                per_class: int = TRAIN_PER_CLASS, epochs: int = EPOCHS):
    """``(language, places, weights, intercept)``; None without both classes."""
    # joined once, read twice
    rows = stored(training_rows(docs, labels, id_column, text_column, label_column), "op9-training")
    n = counts(rows)
    if not n.get(f"{ROWS}0") or not n.get(f"{ROWS}1"):
        return None
    language = Language(Counter({k: m for k, m in n.items() if len(k) == 3}))
    blob = pickle.dumps(language)
    shared = docs.sparkSession.sparkContext.broadcast((hashlib.sha256(blob).hexdigest(), blob))   # a trigram an entry
    dealt, shards = deal(rows, n, per_class, _restored(shared))
    # a number of partitions of its own, as small shards would be put into one task
    fitted = dealt.repartition(2 * shards, "_shard").groupBy("_shard").applyInPandas(
        _fit(epochs), "place int, weight double")
    summed = fitted.groupBy("place").agg(F.sum((F.col("weight") * FIXED).cast("long")).alias("w"))
    found = {r["place"]: r["w"] / FIXED / shards for r in summed.collect()}      # at most 2 ** BITS + 1
    bias = found.pop(1 << BITS, 0.0)
    places = np.array(sorted(found), np.int64)
    return language, places, np.array([found[p] for p in places.tolist()], np.float32), bias


class Scorer:
    """A model as the workers use it."""

    def __init__(self, language: Language, places: np.ndarray, weights: np.ndarray, bias: float):
        self.restorer, self.bias = Restorer(language), bias
        self.weights = np.zeros(1 << BITS, np.float32)
        self.weights[places] = weights

    def scores(self, texts: pd.Series) -> np.ndarray:
        w, out = self.weights, []
        for text in texts:
            h = ngrams(letters(self.restorer.restore(text)), SIZES, BITS)
            told = h[w[h] != 0]
            out.append(self.bias + float(w[np.unique(told)].sum()))
        return 1 / (1 + np.exp(-np.clip(out, -40, 40)))


def scores(docs: DataFrame, model, text_column="text"):
    """A column: the score of each text."""
    blob = pickle.dumps(model)
    key = ("toxicity", hashlib.sha256(blob).hexdigest())
    shared = docs.sparkSession.sparkContext.broadcast(blob)   # a trigram or a place an entry
    nothing = model is None

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        if nothing:
            return pd.Series(np.zeros(len(texts)))
        return pd.Series(held(key, lambda: Scorer(*pickle.loads(shared.value))).scores(texts))
    return score(text_of(text_column))


def toxicity(docs: DataFrame, labels: DataFrame, id_column="doc_id", text_column="text", label_column="toxic",
             threshold: float = THRESHOLD, **options) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row."""
    model = train_model(docs, labels, id_column, text_column, label_column, **options)
    return docs.select(
        F.col(id_column).alias("doc_id"), (crc(F.col(id_column)) % 3 == 1).alias("held_out"),
        scores(docs, model, text_column).alias("score")).withColumn(
        "predicted", (F.col("score") >= threshold).cast("int"))


def drop_toxic(docs: DataFrame, labels: DataFrame, id_column="doc_id", text_column="text", label_column="toxic",
               threshold: float = THRESHOLD, **options) -> DataFrame:
    """The rows of ``docs`` whose score stays below the threshold."""
    model = train_model(docs, labels, id_column, text_column, label_column, **options)
    return docs.filter(scores(docs, model, text_column) < threshold)
