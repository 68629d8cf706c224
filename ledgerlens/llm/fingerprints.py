"""Document fingerprints: a Merkle tree over sections, paragraphs and phrases.

Leaves are phrases (up to four words, starting anew at each sentence end and
paragraph). A paragraph (a line) is hashed whole; a section is a run of
paragraphs whose end is marked by the content itself (the first hex digit of a
paragraph's hash is 0, 4, 8 or c), so that an insertion moves no other
section; the root hashes the sections. Equal roots mean equal texts, unequal
sections are walked down to the paragraph where an edit starts, and the
likeness of two trees is the Dice overlap of their distinct leaves (1 for equal
roots).

The fingerprint is text: ``root:sections:paragraphs:leaves``, the root as
SHA-256, sections and paragraphs as 8 hex digits each, leaves as 6.

``compare_with_next`` also fingerprints each document's edited text and meets
its next document (descending id; after the last the first). DataFrame
operations only. One shuffle moves the texts: documents are dealt to ranges of
ids cut at quantiles (equal numbers of rows, at most ``MAX_RANGES``), the last
of each range also goes to the range after it, and a window per range reads
the neighbour.

Edge cases: a null text counts as empty (a tree of one empty paragraph, no
leaves; likeness 1 to another empty text, else 0); a null ``doc_id`` is the
smallest; rows that repeat an id are neighbours, ordered by text; a table of one
row is its own next document; other columns are not touched.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import text_of

LEAF = r"[^\s.!?|]+(?:\s+[^\s.!?|]+){0,3}"
SECTION_ENDS = "('0', '4', '8', 'c')"
ROWS_PER_RANGE = 512
MAX_RANGES = 20_000


def with_tree(rows: DataFrame, text: Column, name: str) -> DataFrame:
    """Adds ``{name}_p`` (paragraph hashes), ``{name}_ends`` (the last
    paragraph of each section), ``{name}_s`` (section hashes), ``{name}_root``
    and ``{name}_l`` (leaf hashes)."""
    rows = rows.withColumn(f"{name}_lines", F.split(text, "\n", -1))
    rows = rows.withColumns({
        f"{name}_p": F.transform(f"{name}_lines", lambda p: F.md5(p.cast("binary"))),
        f"{name}_l": F.flatten(F.transform(f"{name}_lines", lambda p: F.transform(
            F.regexp_extract_all(p, F.lit(LEAF), F.lit(0)), lambda x: F.hash(x)))),
    }).drop(f"{name}_lines")
    rows = rows.withColumn(f"{name}_ends", F.expr(
        f"filter(sequence(1, size({name}_p)), i -> i = size({name}_p) OR substr({name}_p[i - 1], 1, 1) IN {SECTION_ENDS})"))
    rows = rows.withColumn(f"{name}_s", F.expr(
        f"zip_with(concat(array(0), slice({name}_ends, 1, size({name}_ends) - 1)), {name}_ends, "
        f"(a, b) -> md5(cast(array_join(slice({name}_p, a + 1, b - a), ',') as binary)))"))
    return rows.withColumn(f"{name}_root", F.sha2(F.array_join(f"{name}_s", ",").cast("binary"), 256))


def fingerprint(name: str) -> Column:
    short = f"array_join(transform({name}_{{0}}, x -> substr(x, 1, 8)), '')"
    return F.expr(f"concat_ws(':', {name}_root, {short.format('s')}, {short.format('p')}, "
                  f"array_join(transform({name}_l, x -> lpad(lower(hex(x & 16777215)), 6, '0')), ''))")


def likeness(a: str, b: str) -> Column:
    """Of two trees in the row; ``b`` needs its root and leaves only."""
    one, two = f"array_distinct({a}_l)", f"array_distinct({b}_l)"
    return F.expr(f"CASE WHEN {a}_root = {b}_root THEN 1D WHEN size({a}_l) + size({b}_l) = 0 THEN 0D "
                  f"ELSE 2D * size(array_intersect({one}, {two})) / (size({one}) + size({two})) END")


def first_edit(a: str, b: str) -> Column:
    """The paragraph (from 0) where two trees part, found below the first
    section that differs; null for equal trees."""
    same = f"array_position(zip_with({a}_s, {b}_s, (x, y) -> x <=> y), false)"
    skip = f"coalesce(try_element_at({a}_ends, cast({same} - 1 as int)), 0)"
    rest = "slice({0}_p, {1} + 1, size({0}_p))"
    below = f"array_position(zip_with({rest.format(a, skip)}, {rest.format(b, skip)}, (x, y) -> x <=> y), false)"
    return F.expr(f"CASE WHEN {a}_root = {b}_root THEN NULL ELSE "
                  f"CASE WHEN {same} <= 1 THEN array_position(zip_with({a}_p, {b}_p, (x, y) -> x <=> y), false) - 1 "
                  f"ELSE {skip} + {below} - 1 END END")


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, fingerprint, root``; no shuffle."""
    rows = docs.select(F.col(id_column).alias("doc_id"), text_of(text_column).alias("_text"))
    rows = with_tree(rows, F.col("_text"), "t")
    return rows.select("doc_id", fingerprint("t").alias("fingerprint"), F.col("t_root").alias("root"))


def _range_of(doc_id: str, bounds: list[int]) -> Column:
    """The number of bounds below the id, found in two steps of a square root."""
    step = max(1, math.isqrt(len(bounds)))
    every = F.from_json(F.lit(json.dumps(bounds)), "array<bigint>")
    top = F.from_json(F.lit(json.dumps(bounds[step - 1::step])), "array<bigint>")
    below = lambda xs: F.size(F.filter(xs, lambda b: b < F.col(doc_id)))
    chunk = below(top) * step
    return (chunk + below(F.slice(every, chunk + 1, F.lit(step)))).cast("int")


def with_next(rows: DataFrame, doc_id: str, carried: list[str], rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """Adds ``next``, a struct of the ``carried`` columns of the next row in
    descending order of ``doc_id``."""
    ids = rows.select(doc_id)
    n = ids.count()
    parts = min(MAX_RANGES, max(1, -(-n // rows_per_range)))
    cuts = []
    if parts > 1:
        shares = [i / parts for i in range(1, parts)]
        cuts = ids.agg(F.percentile_approx(doc_id, shares, max(10_000, 10 * parts))).first()[0] or []
    # at most MAX_RANGES numbers come to the driver
    bounds = sorted(set(cuts))
    ranged = rows.withColumn("_nx_range", _range_of(doc_id, bounds) if bounds else F.lit(0))
    last = ranged.select("_nx_range", doc_id).groupBy("_nx_range").agg(F.max(doc_id).alias("_nx_last"))
    found = sorted((r["_nx_range"], r["_nx_last"]) for r in last.collect())   # one row a range
    edges = rows.sparkSession.createDataFrame(
        [(r, m, found[(i + 1) % len(found)][0]) for i, (r, m) in enumerate(found)],
        "_nx_range int, _nx_last bigint, _nx_to int")
    ranged = ranged.join(F.broadcast(edges), "_nx_range", "left")
    own = F.struct(F.col("_nx_range").alias("r"), F.lit(1).alias("own"))
    ghost = F.struct(F.col("_nx_to").alias("r"), F.lit(0).alias("own"))
    dealt = ranged.withColumn("_nx_at", F.explode(F.when(
        F.col(doc_id).eqNullSafe(F.col("_nx_last")), F.array(own, ghost)).otherwise(F.array(own))))
    order = Window.partitionBy("_nx_at.r").orderBy("_nx_at.own", F.col(doc_id).asc_nulls_first(), *carried[:1])
    return (dealt.withColumn("next", F.lag(F.struct(*carried)).over(order))
            .filter("_nx_at.own = 1").drop("_nx_at", "_nx_range", "_nx_last", "_nx_to"))


def compare_with_next(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                      rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next, edit_paragraph``."""
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), text_of(text_column).alias("_text"))
    rows = with_next(rows, "doc_id", ["_text"], rows_per_range)
    rows = rows.withColumns({"n_chars": F.char_length("_text").cast("long"), "_next": F.col("next._text")}).drop("next")
    cut = F.floor(F.col("n_chars") / 3).cast("int")
    rows = rows.withColumn("_edited", F.concat(
        F.substring(F.col("_text"), F.lit(1), F.col("n_chars").cast("int") - cut), F.substring(F.col("_next"), F.lit(1), cut)))
    for column, name in (("_text", "t"), ("_edited", "e"), ("_next", "x")):
        rows = with_tree(rows, F.col(column), name)
    return rows.select(
        "doc_id", "n_chars", F.sha2(F.col("_edited").cast("binary"), 256).alias("edited_sha256"),
        fingerprint("t").alias("fingerprint"), fingerprint("e").alias("edited_fingerprint"),
        likeness("t", "e").alias("near_edited"), likeness("t", "x").alias("near_next"),
        first_edit("t", "e").alias("edit_paragraph"))
