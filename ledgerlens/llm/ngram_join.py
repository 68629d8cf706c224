"""N-gram Jaccard join with a count-vector R-tree.

Every document is its set of distinct 5-word shingles, hashed. The hashes fall
into groups (more of them for larger sets); the counts per group are the
document's point. Two sets
overlap at most in the sum, over the groups, of the smaller count, so points
are packed into an R-tree whose boxes bound the overlap of everything below
them: ``sum(min(upper_a, upper_b))`` must reach ``t / (1 + t) * (|a| + |b|)``.
Pairs that survive are verified on the exact sets.

To run on many machines the points are dealt to trees by shingle: similar sets
share one among their first ``n / 5 + 1`` shingles in any fixed order of all
shingles. The order puts shingles that many documents share last, so a passage that many documents quote brings none of them
together by itself.

1. Equal sets are one vertex (``members`` keeps who has which set).
2. Per shared shingle the first vertex is paired with the others; box bound
   (one box per point), exact check, components.
3. Only shingles whose vertices still lie in different components are looked at
   again: their points are packed into R-trees, which tell the vertices that
   have a partner in another component, first by coarse points, then by finer
   ones. For what is left the exact sets lie together by shingle; the pairs that
   the trees leave over are checked exactly and a union-find joins their
   components, so a group gives fewer links than it has vertices, however many
   of its pairs are similar. Pairs inside a component need no check, and shingles that the same
   vertices share ask once. Very large groups are cut into blocks, and every
   pair of blocks is a tree of its own, so no pair is left out.

The result is exact up to collisions of 64-bit shingle hashes.

Edge cases: a null text or one without words has the empty set and is linked
with nothing (its component is itself); a null ``doc_id`` is a member like any
other, and its component is the smallest id there is, else null; repeated rows
are equal sets; an empty table gives an empty result; other columns are not
read. A pair of documents counts as linked when
``100 * intersection >= similarity * union``.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored, text_of
from .components import components
from .shingles import shingle_sets

WIDTH, SIMILARITY = 5, 80
MIN_GROUPS, MAX_GROUPS = 32, 1 << 14
LEAF = 32                        # points in a leaf of the tree
HEAVY, TWICE = 32, 2             # documents from which a shingle goes last in the order
MAX_HEAVY = 1_000_000            # so many go last at most (8 MB)
BITMAP_BITS = 27                 # bitmap of shared shingles: 16 MB at any size
BLOCK = 4096                     # points in a tree; larger groups are cut into blocks
BUCKET_ROWS = 8_000              # points a task holds, about
FINE = 8                         # groups per hash of the finer points, at least
PAIR_WORDS = 1 << 20             # words of pairs compared at once (8 MB a side)
BUCKET_HASHES = 8_000_000        # hashes of exact sets a task holds at most, about (64 MB)
MAX_BROADCAST_KEYS = 300_000


# ------------------------------------------------------------------ points

def _groups_of(n: int) -> int:
    """Groups of a set of ``n`` hashes: half the power of two at or below it,
    so a count is two to four on average at any size."""
    return min(MAX_GROUPS, max(MIN_GROUPS, (1 << n.bit_length()) // 4))


def _point(hashes: np.ndarray) -> bytes:
    """Counts per group, in the smallest integers that hold them; the first
    byte tells their width."""
    groups = _groups_of(len(hashes))
    counts = np.bincount((hashes & np.uint64(groups - 1)).astype(np.int64), minlength=groups)
    most = int(counts.max(initial=0))
    width = 1 if most < 1 << 8 else 2 if most < 1 << 16 else 4
    return bytes([width]) + counts.astype(f"<u{width}").tobytes()


def _counts(blob: bytes, groups: int | None = None) -> np.ndarray:
    """The counts, folded to fewer groups (places modulo ``groups``)."""
    counts = np.frombuffer(blob, f"<u{blob[0]}", offset=1).astype(np.int32)
    return counts if groups in (None, len(counts)) else counts.reshape(-1, groups).sum(axis=0)


def _overlap(a: bytes, b: bytes) -> int:
    """The most that two sets can share."""
    groups = min((len(a) - 1) // a[0], (len(b) - 1) // b[0])
    return int(np.minimum(_counts(a, groups), _counts(b, groups)).sum())


def _bits(hashes: np.ndarray) -> bytes:
    """The finer point of a set: which of about ten groups per hash it has,
    one bit each, a power of two of them (64 at least)."""
    places = 1 << max(6, (FINE * len(hashes) - 1).bit_length())
    bits = np.zeros(places, bool)
    bits[(hashes & np.uint64(places - 1)).astype(np.int64)] = True
    return np.packbits(bits, bitorder="little").tobytes()


class FinePoints:
    """The finer points of some sets. Two sets share at most the groups both
    have, and what either has twice in a group: the smaller such surplus."""

    def __init__(self, sizes: np.ndarray, blobs: list[bytes]):
        self.sizes = sizes
        self.words = [np.frombuffer(b, np.uint64) for b in blobs]
        self.length = np.array([len(w) for w in self.words], np.int64)
        self.row = np.zeros(len(blobs), np.int64)
        self.table, self.surplus = {}, {}
        for n in np.unique(self.length).tolist():
            own = np.flatnonzero(self.length == n)
            self.row[own] = np.arange(len(own))
            self.table[n] = np.stack([self.words[k] for k in own])
            self.surplus[n] = sizes[own] - np.bitwise_count(self.table[n]).sum(axis=1, dtype=np.int64)

    def _folded(self, k: int, n: int) -> np.ndarray:
        w = self.words[k]
        while len(w) > n:
            w = w[:len(w) // 2] | w[len(w) // 2:]
        return w

    def overlap(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """The most that the sets at these places can share, pair by pair."""
        out = np.zeros(len(i), np.int64)
        one, two = self.length[i], self.length[j]
        for n in np.unique(one[one == two]).tolist():
            at = np.flatnonzero((one == n) & (two == n))
            step = max(1, PAIR_WORDS // n)
            for a in range(0, len(at), step):
                part = at[a:a + step]
                x, y = self.row[i[part]], self.row[j[part]]
                both = np.bitwise_count(self.table[n][x] & self.table[n][y]).sum(axis=1, dtype=np.int64)
                out[part] = both + np.minimum(self.surplus[n][x], self.surplus[n][y])
        for k in np.flatnonzero(one != two).tolist():
            n = int(min(one[k], two[k]))
            x, y = self._folded(i[k], n), self._folded(j[k], n)
            spare = min(self.sizes[i[k]] - int(np.bitwise_count(x).sum()), self.sizes[j[k]] - int(np.bitwise_count(y).sum()))
            out[k] = int(np.bitwise_count(x & y).sum()) + spare
        return out


def _reach(low_a, high_a, low_b, high_b, overlap, t: int):
    """Whether sets with sizes in these ranges and at most this overlap may be
    similar."""
    return ((100 * high_a >= t * low_b) & (100 * high_b >= t * low_a)
            & ((100 + t) * overlap >= t * (low_a + low_b)))


class RTree:
    """Points packed by size into leaves; a box is the smallest and largest
    size and the largest count per group."""

    def __init__(self, sizes: np.ndarray, points: np.ndarray):
        self.order = np.lexsort((points.argmax(axis=1), sizes))
        self.sizes, self.points = sizes[self.order].astype(np.int64), points[self.order]
        self.cuts = np.arange(0, len(sizes), LEAF)
        self.low = np.minimum.reduceat(self.sizes, self.cuts)
        self.high = np.maximum.reduceat(self.sizes, self.cuts)
        self.upper = np.maximum.reduceat(self.points, self.cuts, axis=0)

    def folded(self, groups: int) -> RTree:
        """The same points with fewer groups."""
        points = np.empty((len(self.sizes), groups), np.int32)
        points[self.order] = self.points.reshape(len(self.sizes), -1, groups).sum(axis=1)
        sizes = np.empty_like(self.sizes)
        sizes[self.order] = self.sizes
        return RTree(sizes, points)

    def pairs(self, other: RTree, t: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Places (in the order given) of pairs that may be similar, leaf by
        leaf; of a tree with itself each pair once."""
        same = other is self
        for i, a in enumerate(self.cuts):
            j = np.arange(i if same else 0, len(other.cuts))
            bound = np.minimum(self.upper[i], other.upper[j]).sum(axis=1, dtype=np.int64)
            open_ = j[_reach(self.low[i], self.high[i], other.low[j], other.high[j], bound, t)]
            if not len(open_):
                continue
            own = slice(a, a + LEAF)
            theirs = (other.cuts[open_][:, None] + np.arange(LEAF)).ravel()
            theirs = theirs[theirs < len(other.sizes)]
            least = np.zeros((len(self.sizes[own]), len(theirs)), np.int64)
            for r, p in enumerate(self.points[own]):
                least[r] = np.minimum(p, other.points[theirs]).sum(axis=1, dtype=np.int64)
            x, y = self.sizes[own][:, None], other.sizes[theirs][None, :]
            ok = _reach(x, x, y, y, least, t)
            if same:
                ok &= (a + np.arange(len(ok)))[:, None] < theirs[None, :]
            r, c = np.nonzero(ok)
            if len(r):
                yield self.order[a + r], other.order[theirs[c]]


# ------------------------------------------------------------------ passes over the texts

def _key(hashes: np.ndarray) -> bytes:
    return hashlib.blake2b(hashes.tobytes(), digest_size=16).digest()


def _members(docs: DataFrame) -> DataFrame:
    @F.pandas_udf("key binary, n long")
    def keyed(texts: pd.Series) -> pd.DataFrame:
        found = [(_key(h), len(h)) for h in shingle_sets(list(texts), WIDTH)]
        return pd.DataFrame(found, columns=["key", "n"])
    return docs.select("doc_id", keyed("text").alias("s")).select("doc_id", "s.*")


def _heavy(docs: DataFrame, t: int) -> np.ndarray:
    """Sorted hashes of the shingles that go last: those that many documents
    have among their first ones. Every document is counted; a task tells only
    what it saw ``TWICE`` or more, so the bar rises with the number of tasks,
    that is with the corpus (only the order depends on it, never a result)."""
    def firsts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found = [np.zeros(0, np.uint64)]
        for batch in batches:
            found += [h[:_first(len(h), t)].copy() for h in shingle_sets(list(batch["text"]), WIDTH)]
        token, n = np.unique(np.concatenate(found), return_counts=True)
        yield pd.DataFrame({"token": token[n >= TWICE].view(np.int64), "n": n[n >= TWICE]})
    counted = docs.select("text").mapInPandas(firsts, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
    most = counted.filter(F.col("n") >= HEAVY).orderBy(F.desc("n"), "token").limit(MAX_HEAVY)
    rows = most.select("token").toArrow()                  # at most MAX_HEAVY numbers
    return np.sort(rows["token"].to_numpy().astype(np.int64).view(np.uint64))


def _first(n: int, t: int) -> int:
    """How many shingles of a set of ``n`` are sure to meet a similar set's."""
    return n * (100 - t) // 100 + 1 if n else 0


def _vertices(docs: DataFrame, heavy: np.ndarray, t: int) -> DataFrame:
    """One row per distinct set: ``v, key, rep, n, firsts, point``."""
    shared = docs.sparkSession.sparkContext.broadcast(heavy)

    @F.pandas_udf("key binary, n long, firsts array<long>, point binary")
    def described(texts: pd.Series) -> pd.DataFrame:
        last, rows = shared.value, []
        for h in shingle_sets(list(texts), WIDTH):
            k, firsts = _first(len(h), t), h
            if len(last) and len(h):
                late = last[np.minimum(np.searchsorted(last, h), len(last) - 1)] == h
                firsts = np.concatenate([h[~late][:k], h[late][:k]])
            rows.append((_key(h), len(h), firsts[:k].view(np.int64), _point(h)))
        return pd.DataFrame(rows, columns=["key", "n", "firsts", "point"])
    # so named, or the filter on its result would go below it with a second hashing of every text
    once = described.asNondeterministic()
    sets = docs.select("doc_id", once("text").alias("s")).select("doc_id", "s.*").filter("n > 0")
    one = sets.groupBy("key").agg(F.min("doc_id").alias("rep"), *[F.first(c).alias(c) for c in ("n", "firsts", "point")])
    return stored(one.withColumn("v", F.monotonically_increasing_id()), "op10-vertices")


def _exact_sets(docs: DataFrame, needed: DataFrame, fine: bool = False) -> DataFrame:
    """``v, hashes`` of the needed vertices ``(key, rep, v)``, from the texts
    of the documents that stand for them; if ``fine``, also ``n, point, bits``."""
    more = ("n", "point", "bits") if fine else ()

    @F.pandas_udf("key binary, hashes binary, n long, point binary, bits binary")
    def keyed(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([(_key(h), h.tobytes(), *((len(h), _point(h), _bits(h)) if fine else (0, None, None)))
                             for h in shingle_sets(list(texts), WIDTH)], columns=["key", "hashes", "n", "point", "bits"])
    once = keyed.asNondeterministic()                      # as in _vertices: the join's null check stays above
    needed = stored(needed, "op10-needed")
    small = needed.count() <= MAX_BROADCAST_KEYS           # 32 bytes each
    if small:      # texts of other documents are not hashed again
        docs = docs.join(F.broadcast(needed.select(F.col("rep").alias("_rep")).distinct()),
                         F.col("doc_id").eqNullSafe(F.col("_rep")), "left_semi")
    sets = docs.select("doc_id", once("text").alias("s")).select("doc_id", "s.*").alias("d").join(
        (F.broadcast(needed) if small else needed).alias("w"),
        (F.col("d.key") == F.col("w.key")) & F.col("d.doc_id").eqNullSafe(F.col("w.rep")))
    return stored(sets.select("v", "hashes", *more), "op10-sets")


# ------------------------------------------------------------------ pairs

def _similar(p: np.ndarray, q: np.ndarray, t: int) -> bool:
    """The exact check of two sorted sets."""
    at = np.searchsorted(q, p)
    at[at == len(q)] = 0
    both = int((q[at] == p).sum())
    return 100 * both >= t * (len(p) + len(q) - both)


def _verified(docs: DataFrame, vertices: DataFrame, pairs: DataFrame, t: int) -> DataFrame:
    """The pairs ``(a, b)`` that are similar."""
    ends = pairs.select(F.col("a").alias("v")).union(pairs.select("b")).distinct()
    sets = _exact_sets(docs, vertices.select("key", "rep", "v").join(ends, "v").select("key", "rep", "v"))

    @F.pandas_udf("boolean")
    def similar(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([_similar(np.frombuffer(p, np.uint64), np.frombuffer(q, np.uint64), t) for p, q in zip(x, y)],
                         dtype=bool)
    one = pairs.join(sets.select(F.col("v").alias("a"), F.col("hashes").alias("x")), "a")
    two = one.join(sets.select(F.col("v").alias("b"), F.col("hashes").alias("y")), "b")
    return stored(two.filter(similar("x", "y")).select("a", "b").distinct(), "op10-links")


def _bounded(vertices: DataFrame, pairs: DataFrame, t: int) -> DataFrame:
    """The pairs whose points allow them to be similar."""
    @F.pandas_udf("boolean")
    def may(na: pd.Series, pa: pd.Series, nb: pd.Series, pb: pd.Series) -> pd.Series:
        if not len(na):
            return pd.Series([], dtype=bool)
        x, y = na.to_numpy(np.int64), nb.to_numpy(np.int64)
        least = np.fromiter(map(_overlap, pa, pb), np.int64, len(pa))
        return pd.Series(_reach(x, x, y, y, least, t))
    at = lambda end: vertices.select(F.col("v").alias(end), F.col("n").alias(f"n{end}"), F.col("point").alias(f"p{end}"))
    size = (100 * F.least("na", "nb") >= t * F.greatest("na", "nb"))
    joined = pairs.join(at("a"), "a").join(at("b"), "b").filter(size)
    return stored(joined.filter(may("na", "pa", "nb", "pb")).select("a", "b"), "op10-pairs")


def _forest(sizes: np.ndarray, blobs: list[bytes], places: np.ndarray) -> dict[int, tuple[RTree, np.ndarray]]:
    """A tree per number of groups, with the places its points stand for."""
    groups = np.array([_groups_of(int(n)) for n in sizes[places]])
    forest = {}
    for g in np.unique(groups).tolist():
        own = places[groups == g]
        forest[g] = (RTree(sizes[own], np.array([_counts(blobs[k]) for k in own])), own)
    return forest


def _forest_pairs(one: dict, two: dict, t: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of pairs that may be similar. Similar sizes differ by less than a
    factor of two, so a tree meets its own and the neighbouring numbers of
    groups, folded to the smaller."""
    for g, (tree, own) in one.items():
        for h in (g // 2, g, 2 * g):
            if h not in two or (one is two and h < g):
                continue
            other, theirs = two[h]
            if h == g:
                left, right = tree, tree if one is two else other
            else:
                left, right = (tree, other.folded(g)) if h > g else (tree.folded(h), other)
            for i, j in left.pairs(right, t):
                yield own[i], theirs[j]


def _cells(rows: pd.DataFrame) -> tuple[pd.DataFrame, Iterator[tuple[np.ndarray, np.ndarray]]]:
    """The rows in order, and per (token, cell) the places of one side and of
    the other (the same array where a block meets itself)."""
    rows = rows.sort_values(["token", "x", "y", "blk", "v"], kind="stable")
    c, blk = rows["c"].to_numpy(np.int64), rows["blk"].to_numpy(np.int64)
    cell = rows[["token", "x", "y"]].to_numpy(np.int64)
    new = np.flatnonzero(np.r_[True, (cell[1:] != cell[:-1]).any(axis=1)]) if len(rows) else []

    def sides() -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for a, b in zip(new, [*new[1:], len(rows)]):
            places = np.arange(a, b)
            if b - a < 2 or (c[a:b] == c[a]).all():
                continue
            first = blk[a:b] == blk[a]
            if cell[a, 1] == cell[a, 2]:
                yield places, places
            elif not first.all():
                yield places[first], places[~first]
    return rows, sides()


def _candidates(sizes: np.ndarray, blobs: list[bytes], one: np.ndarray, two: np.ndarray,
                t: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of pairs between both sides that the trees leave over."""
    left = _forest(sizes, blobs, one)
    yield from _forest_pairs(left, left if one is two else _forest(sizes, blobs, two), t)


def _met(rows: pd.DataFrame, t: int) -> pd.DataFrame:
    """The rows that have a partner of another component in their (token,
    cell) as far as points tell, and the finer ones (``bits``) where they are
    given: never more rows than were given."""
    rows, sides = _cells(rows)
    blobs, sizes, c = rows["point"].tolist(), rows["n"].to_numpy(np.int64), rows["c"].to_numpy(np.int64)
    fine = FinePoints(sizes, rows["bits"].tolist()) if "bits" in rows and len(rows) else None
    met = np.zeros(len(rows), bool)
    for one, two in sides:
        for i, j in _candidates(sizes, blobs, one, two, t):
            open_ = (c[i] != c[j]) & ~(met[i] & met[j])
            i, j = i[open_], j[open_]
            if fine is not None and len(i):
                ok = _reach(sizes[i], sizes[i], sizes[j], sizes[j], fine.overlap(i, j), t)
                i, j = i[ok], j[ok]
            met[i] = met[j] = True
    return rows.loc[met, ["token", "low", "x", "y", "blk", "v", "c", "n"]]


def _tied(rows: pd.DataFrame, t: int) -> pd.DataFrame:
    """Links between the rows of each (token, cell), from trees over their
    points and the exact check. Components that a link has joined are one from
    then on, for every cell of the bucket, so a bucket of ``m`` components
    gives ``m - 1`` links at most."""
    rows, sides = _cells(rows)
    sets = [np.frombuffer(h, np.uint64) for h in rows["hashes"]]
    v, c = rows["v"].tolist(), rows["c"].tolist()
    blobs, sizes = [_point(h) for h in sets], rows["n"].to_numpy(np.int64)
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (up := parent.get(x, x)) != x:
            parent[x] = x = parent.get(up, up)
        return x

    links = []
    for one, two in sides:
        for places_i, places_j in _candidates(sizes, blobs, one, two, t):
            for i, j in zip(places_i.tolist(), places_j.tolist()):
                x, y = root(c[i]), root(c[j])
                if x != y and _similar(sets[i], sets[j], t):
                    parent[max(x, y)] = min(x, y)
                    links.append((min(v[i], v[j]), max(v[i], v[j])))
    return pd.DataFrame(links, columns=["a", "b"], dtype="int64")


def _across(docs: DataFrame, vertices: DataFrame, live: DataFrame, own: DataFrame, t: int) -> DataFrame:
    """Links ``(a, b)`` between vertices of different components that share a
    first shingle, enough of them to join all components that links join.
    R-trees over the points say which vertices have a partner at all, then the
    trees and finer points of these; only for what is left the exact sets lie
    together, and the trees, the exact check and a union-find make links. No
    step gives more rows than it gets."""
    placed = live.join(own, "v", "left").withColumn("c", F.coalesce("c", "v")).select("token", "v", "c")
    mixed = placed.groupBy("token").agg(
        F.min("c").alias("one"), F.max("c").alias("two"), F.count(F.lit(1)).alias("m"), F.min("v").alias("low"),
        F.max("v").alias("high"), F.sum(F.xxhash64("v").cast("decimal(38,0)")).alias("sign")).filter("one <> two")
    # shingles with the same vertices ask the same question: one of them does
    mixed = mixed.groupBy("m", "low", "high", "sign").agg(F.min("token").alias("token"))
    mixed = mixed.select("token", "low", F.ceil(F.col("m") / BLOCK).cast("int").alias("blocks"))
    rows = placed.join(mixed, "token").withColumn("blk", F.pmod(F.xxhash64("v"), F.col("blocks")))
    rows = rows.withColumn("o", F.explode(F.expr("sequence(0, blocks - 1)"))).select(
        "token", "low", "v", "c", "blk", F.least("blk", "o").alias("x"), F.greatest("blk", "o").alias("y"))
    rows = stored(rows, "op10-rows")
    buckets = max(1, -(-rows.count() // BUCKET_ROWS))
    first = rows.withColumn("bucket", F.pmod(_cell(), F.lit(buckets))).join(vertices.select("v", "n", "point"), "v")
    first = stored(first.groupBy("bucket").applyInPandas(lambda one: _met(one, t), _MET), "op10-met")
    needed = vertices.select("key", "rep", "v").join(first.select("v").distinct(), "v").select("key", "rep", "v")
    sets = _exact_sets(docs, needed, fine=True)
    second = stored(_beside(first.drop("n"), F.lit(1), BUCKET_ROWS, sets.select("v", "n", "point", "bits"),
                            lambda one, own: _met(one.merge(own, on="v"), t), _MET), "op10-finer")
    found = _beside(second, F.col("n"), BUCKET_HASHES, sets.select("v", "hashes"),
                    lambda one, own: _tied(one.merge(own, on="v"), t), "a long, b long")
    return stored(found.distinct(), "op10-across")


def _cell() -> Column:
    return F.xxhash64("token", "x", "y")


_MET = "token long, low long, x int, y int, blk int, v long, c long, n long"


def _beside(rows: DataFrame, weight: Column, most: int, payload: DataFrame, work, schema: str) -> DataFrame:
    """``work(rows, their payloads)`` per bucket of whole (token, cell)s. The
    shingles of one group of copies have the same documents and mostly the same
    first one (``low``), so they go to one bucket, and a payload is sent once
    per bucket and vertex, not once per row. A first document with more than
    ``most`` of weight is cut into several buckets by cell."""
    loads = rows.groupBy("low").agg(F.sum(weight).alias("w"))
    total = loads.agg(F.coalesce(F.sum("w"), F.lit(0))).first()[0]
    parts = loads.select(F.col("low").alias("_low"), F.ceil(F.col("w") / most).alias("_parts"))
    placed = rows.join(parts, F.col("low") == F.col("_low")).withColumn("bucket", F.pmod(
        F.xxhash64("low", F.pmod(_cell(), F.col("_parts"))), F.lit(max(1, -(-total // most))))).drop("_low", "_parts")
    # columns of their own, as both sides come from the same rows
    own = placed.select(F.col("bucket").alias("_to"), F.col("v").alias("_v")).distinct()
    own = own.join(payload.withColumnRenamed("v", "_v"), "_v")
    return placed.groupBy("bucket").cogroup(own.groupBy("_to")).applyInPandas(
        lambda one, two: work(one, two.drop(columns="_to").rename(columns={"_v": "v"})), schema)


def _shared(vertices: DataFrame) -> DataFrame:
    """``token, v, first`` of the first shingles that two vertices or more
    have; ``first`` is the smallest of them. All postings are counted once per
    shingle; a bitmap of fixed size then keeps back most of those that stand
    alone, so only the others are shuffled again."""
    postings = vertices.select("v", F.explode("firsts").alias("token"))
    shared = stored(postings.groupBy("token").agg(F.count(F.lit(1)).alias("m"), F.min("v").alias("first"))
                    .filter("m > 1").select("token", "first"), "op10-shared")
    place = f"((token & {(1 << BITMAP_BITS) - 1}) + 1)"       # the functions count from 1
    blocks = shared.groupBy(F.expr(f"bitmap_bucket_number({place})").alias("k")).agg(
        F.expr(f"bitmap_construct_agg(bitmap_bit_position({place}))").alias("bits")).collect()
    bitmap = np.zeros((1 << BITMAP_BITS - 15, 4096), np.uint8)   # at most as many rows of 4 KB
    for r in blocks:
        bitmap[r["k"] - 1] = np.frombuffer(r["bits"], np.uint8)
    bitmap = bitmap.ravel()
    told = vertices.sparkSession.sparkContext.broadcast(bitmap)

    @F.pandas_udf("array<long>")
    def maybe(firsts: pd.Series) -> pd.Series:
        bits, out = told.value, []
        for f in firsts:
            at = f.astype(np.int64) & ((1 << BITMAP_BITS) - 1)
            out.append(f[bits[at >> 3] >> (at & 7) & 1 == 1])
        return pd.Series(out)
    left = vertices.select("v", F.explode(maybe("firsts")).alias("token"))
    return stored(left.join(shared, "token"), "op10-live")


def similar_groups(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                   similarity: int = SIMILARITY) -> DataFrame:
    """One row per row: ``doc_id, n_shingles, component_id``."""
    if similarity < 50:        # trees meet only neighbouring numbers of groups
        raise ValueError(f"similarity {similarity} is under 50: pairs of sets more than twice as large would be lost")
    t = similarity
    docs = docs.select(F.col(id_column).cast("long").alias("doc_id"), text_of(text_column).alias("text"))
    members = stored(_members(docs), "op10-members")
    vertices = _vertices(docs, _heavy(docs, t), t)
    live = _shared(vertices)
    stars = live.filter("v <> first").select(F.col("first").alias("a"), F.col("v").alias("b")).distinct()
    links = _verified(docs, vertices, _bounded(vertices, stars, t), t)
    own = stored(components(links), "op10-own")
    links = links.union(_across(docs, vertices, live.select("token", "v"), own, t))
    final = stored(components(links), "op10-final")
    named = vertices.select("v", "key", "rep").join(final, "v", "left").withColumn("c", F.coalesce("c", "v"))
    smallest = named.groupBy("c").agg(F.min("rep").alias("component"))
    by_key = stored(named.join(smallest, "c").select("key", "component"), "op10-keys")
    return members.join(by_key, "key", "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("doc_id")).alias("component_id"))


def keep_one(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
             similarity: int = SIMILARITY) -> DataFrame:
    """One row of each group with all its columns: the one with the smallest
    id (null last), and of rows that share it the first written. Decided row by
    row, so near copies among rows without an id, or under one id, go as well;
    rows without words stay."""
    row = f"_row_{uuid.uuid4().hex[:8]}"
    rows = stored(docs.withColumn(row, F.monotonically_increasing_id()), "op10-docs")      # fixes the row numbers
    groups = stored(similar_groups(rows, row, text_column, similarity).select(
        F.col("doc_id").alias(row), F.col("component_id").alias("c")), "op10-groups")
    # rows that are linked with an earlier one, and the first rows of their groups
    later = groups.filter(F.col(row) != F.col("c"))
    members = later.union(later.select(F.col("c").alias(row), "c").distinct())
    named = members.join(rows.select(row, F.col(f"`{id_column}`").cast("long").alias("id")), row)
    best = named.groupBy("c").agg(F.min(F.struct(F.col("id").isNull(), "id", row)).alias("b"))
    gone = stored(named.join(best, "c").filter(F.col(row) != F.col(f"b.{row}")).select(row), "op10-gone")
    small = gone.count() <= MAX_BROADCAST_KEYS             # 8 bytes each
    return rows.join(F.broadcast(gone) if small else gone, row, "left_anti").select(
        *[F.col(f"`{c}`") for c in docs.columns])
