"""Exact dedup by two-pass Bloom filtering, in DataFrame operations only.

Pass one reads the texts once and keeps a narrow row per document (hash,
length). Every hash sets two slots inside one block of a blocked Bloom filter;
slots set by two or more rows form the "seen twice" filter. Pass two probes
it: rows whose two slots are both in it may have a copy and are the only ones
that shuffle; all others pass straight through as groups of one.

Texts are equal when identical after deleting every character of
``[\\x20\\x09-\\x0D]``; of equal texts the row with the most code points in the
original text stays, then the smallest ``doc_id`` (null last).

Edge cases: a null text counts as empty and all empty texts are one group; a
null ``doc_id`` keeps its row (it stays only where no row with an id ties);
rows repeated whole are separate rows, of which exactly one stays; an empty
table gives an empty result; other columns are carried untouched, whatever
their names.

Scale: the filter takes ``BITS_PER_ROW`` bits a row. A filter that is
broadcast has at most ``max_filter_bits`` (a fixed bound, 128 MiB by default);
beyond that the hash space is cut into as many ranges as needed, each with a
filter of its own, so the share of false candidates stays the same at any
size. A hot group of copies is combined before its shuffle, and the join that
hands the verdict back to its rows is one that AQE can split.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE_CHARS, stored, text_of

BITS_PER_ROW = 16
BLOCK_WORDS = 64                      # 64 words of 64 bits: 4096 bits a block
BLOCK_BITS = BLOCK_WORDS * 64
MAX_FILTER_BITS = 1 << 30


def normalised(text: Column) -> Column:
    return F.translate(text, SPACE_CHARS, "")


def _keyed(docs: DataFrame, ranges: int, blocks: int) -> DataFrame:
    """Adds the place of the hash ``_h`` in the filters: range, block, slots."""
    a, b = F.xxhash64("_h"), F.xxhash64("_h", F.lit(1))
    return docs.withColumns({
        "_range": F.pmod(F.shiftrightunsigned(b, 32), F.lit(ranges)).cast("int"),
        "_block": F.pmod(a, F.lit(blocks)),
        "_s1": F.pmod(F.shiftrightunsigned(b, 3), F.lit(BLOCK_BITS)).cast("int"),
        "_s2": F.pmod(F.shiftrightunsigned(b, 17), F.lit(BLOCK_BITS)).cast("int"),
    })


def _seen_twice(keyed: DataFrame) -> DataFrame:
    """One row a block: the words whose bits were set by two rows or more."""
    slots = keyed.select("_range", "_block", F.explode(F.array_distinct(F.array("_s1", "_s2"))).alias("slot"))
    twice = slots.groupBy("_range", "_block", "slot").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    words = (twice.groupBy("_range", "_block", F.expr("slot div 64").cast("int").alias("w"))
             .agg(F.expr("bit_or(shiftleft(1L, slot % 64))").alias("bits")))
    by_word = words.groupBy("_range", "_block").agg(
        F.map_from_entries(F.collect_list(F.struct("w", "bits"))).alias("m"))
    return by_word.select("_range", "_block", F.expr(
        f"transform(sequence(0, {BLOCK_WORDS - 1}), w -> coalesce(try_element_at(m, w), 0L))").alias("_words"))


def _probe(keyed: DataFrame, seen: DataFrame, ranges: int) -> DataFrame:
    """Adds ``_maybe``: both slots of the row are in the filter of its range."""
    def one(r: int) -> DataFrame:
        part = keyed.filter(F.col("_range") == r) if ranges > 1 else keyed
        own = seen.filter(F.col("_range") == r).drop("_range")
        return part.join(F.broadcast(own), "_block", "left")   # at most MAX_FILTER_BITS
    probed = reduce(DataFrame.unionByName, [one(r) for r in range(ranges)])
    hit = lambda s: f"getbit(_words[{s} div 64], {s} % 64) = 1"
    return probed.withColumn("_maybe", F.expr(
        f"coalesce({hit('_s1')} AND {hit('_s2')}, false)")).drop("_words")


def _shape(rows: int, max_filter_bits: int) -> tuple[int, int]:
    """Ranges and blocks of a range for so many rows."""
    bits = max(BLOCK_BITS, rows * BITS_PER_ROW)
    ranges = -(-bits // max_filter_bits)
    return ranges, max(1, -(-bits // (ranges * BLOCK_BITS)))


def _candidates(docs: DataFrame, id_column: str, text_column: str, max_filter_bits: int):
    """The narrow table with places and ``_maybe``, the filter, its shape."""
    text = text_of(text_column)
    narrow = stored(docs.select(
        F.col(id_column).cast("long").alias("doc_id"),
        F.sha2(normalised(text), 256).alias("_h"),
        F.char_length(text).cast("long").alias("_n"),
        F.monotonically_increasing_id().alias("_row")), "op1-narrow")
    ranges, blocks = _shape(narrow.count(), max_filter_bits)
    keyed = _keyed(narrow, ranges, blocks)
    seen = stored(_seen_twice(keyed), "op1-filter")
    return _probe(keyed, seen, ranges), seen, ranges, blocks


def _groups(maybe: DataFrame) -> DataFrame:
    """Per hash: the row that stays and the number of rows. ``~doc_id`` turns
    the order round without overflow."""
    best = F.max(F.struct(F.col("_n"), F.col("doc_id").isNotNull().alias("has"),
                          F.expr("~doc_id").alias("low"), F.expr("~_row").alias("first")))
    return (maybe.groupBy("_h").agg(best.alias("b"), F.count(F.lit(1)).alias("group_size"))
            .select("_h", F.expr("~b.low").alias("keep_id"), F.expr("~b.first").alias("_keep_row"),
                    F.col("b._n").alias("_keep_n"), "group_size"))


def exact_dedup(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                max_filter_bits: int = MAX_FILTER_BITS) -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept,
    text_sha256, candidate`` (whether the row was shuffled)."""
    probed, _, _, _ = _candidates(docs, id_column, text_column, max_filter_bits)
    straight = probed.filter("NOT _maybe").select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"), F.col("_h").alias("text_sha256"), F.lit(False).alias("candidate"))
    maybe = probed.filter("_maybe").select("doc_id", "_h", "_n", "_row")
    # written, so that the join reads two plain shuffles and AQE can split a hot group
    groups = stored(_groups(maybe).filter("group_size > 1"), "op1-groups")
    joined = maybe.join(groups, "_h", "left").select(
        "doc_id", F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).alias("group_size"),
        F.coalesce(F.col("_row") == F.col("_keep_row"), F.lit(True)).alias("kept"),
        F.col("_h").alias("text_sha256"), F.lit(True).alias("candidate"))
    return straight.unionByName(joined)


def drop_copies(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                max_filter_bits: int = MAX_FILTER_BITS) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns. Rows without a
    possible copy are not shuffled; of the others only the kept row of each
    group is carried on."""
    probed, seen, ranges, blocks = _candidates(docs, id_column, text_column, max_filter_bits)
    keep = stored(_groups(probed.filter("_maybe")).select(
        "_h", F.col("keep_id").alias("_id"), F.col("_keep_n").alias("_n")), "op1-keep")
    text = text_of(text_column)
    whole = _keyed(docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"),
        F.sha2(normalised(text), 256).alias("_h"), F.char_length(text).cast("long").alias("_n"),
        F.col(id_column).cast("long").alias("_id")), ranges, blocks)
    probed = _probe(whole, seen, ranges)
    straight = probed.filter("NOT _maybe").select("_doc.*")
    maybe = probed.filter("_maybe").alias("m").join(
        keep.alias("k"), (F.col("m._h") == F.col("k._h")) & F.col("m._id").eqNullSafe(F.col("k._id"))
        & (F.col("m._n") == F.col("k._n"))).select(F.col("m._h").alias("_h"), "_doc")
    # rows repeated whole: one of them (min_by gives null where all it orders by is null; a struct never is)
    one = maybe.groupBy("_h").agg(F.min_by("_doc", F.struct(F.col(f"_doc.`{text_column}`"))).alias("_doc"))
    return straight.unionByName(one.select("_doc.*"))
