"""Mixing sources to target weights by Pareto order sampling.

Every document is to appear ``e = target / source_size`` times. ``floor(e)``
whole copies are certain; the rest is the inclusion probability ``p`` of one
more copy. Documents are ranked by the random odds over the inclusion odds,
``q = (u / (1 - u)) / (p / (1 - p))`` with ``u`` a hash of the id, and each
source takes its documents in the order of ``q`` until the words it still
needs are reached (the prefix that comes nearest). Reruns agree.

Targets: the sources, by code point with null last, weigh 3, 1, 2, repeating,
and share ``share`` (150 %) of all words; a target stops at ``most`` (2) times
the words of its source, and what is over is shared again by weight until
none is above. The closed form: ``target = min(cap, level * weight)``.

Edge cases: a null text has size 0; a null source is a source of its own;
documents of size 0 are never counted and take nothing; a null ``doc_id``
hashes as the empty string; repeated rows count each; an empty table gives an
empty result. Other columns are carried untouched.

Scale: the texts are read once for their sizes; every later pass reads a
narrow table. No source is sorted as a whole: ``LEVELS`` rounds of ``BINS``
pre-aggregated bins of ``q`` narrow the cut down to one bin in
``BINS ** LEVELS`` of a source, and only that bin is ranked. One window runs
over the table of sources (a row per source).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, stored, text_of

BINS, LEVELS = 256, 2
MAX_BROADCAST_SOURCES = 200_000


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def _uniform(doc_id: Column) -> Column:
    """A fixed number in (0, 1) for each id."""
    hexed = F.substring(F.md5(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), 1, 13)
    return (F.conv(hexed, 16, 10).cast("long") + F.lit(0.5)) / F.lit(float(1 << 52))


def targets(sizes: DataFrame, weights=(3.0, 1.0, 2.0), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """Per source: ``_source, source_size, target`` from ``(_source, size)``."""
    per = sizes.groupBy("_source").agg(F.sum("size").alias("source_size"))
    every = Window.partitionBy()
    place = F.row_number().over(Window.orderBy(F.col("_source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (place % len(weights) + 1).cast("int"))
    per = per.withColumn("weight", weight).withColumns({
        "cap": F.col("source_size") * F.lit(most),
        "total": F.sum("source_size").over(every) * F.lit(share)})
    order = Window.orderBy(F.col("cap") / F.col("weight"), F.col("_source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    level = ((F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
             / F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing)))
    per = per.withColumn("own", level)
    per = per.withColumn("level", F.max(F.when(
        F.col("own") <= F.col("cap") / F.col("weight"), F.col("own"))).over(every))
    return per.select("_source", "source_size",
                      F.least("cap", F.coalesce(F.col("level") * F.col("weight"), F.col("cap"))).alias("target"))


def _with_rank(rows: DataFrame) -> DataFrame:
    """Adds ``_z`` in [0, 1), which orders as the Pareto rank ``q`` does."""
    q = (F.col("_u") / (1 - F.col("_u"))) / (F.col("_p") / (1 - F.col("_p")))
    return rows.withColumn("_q", F.when(F.col("_p") > 0, q)).withColumn(
        "_z", F.when(F.col("_p") > 0, F.col("_q") / (1 + F.col("_q"))).otherwise(F.lit(1.0)))


def _bin(level: int) -> Column:
    """The bin of ``_z`` at a level, counted over the whole range."""
    n = BINS ** level
    return F.least(F.floor(F.col("_z") * n), F.lit(n - 1)).cast("long")


def _join_sources(rows: DataFrame, per: DataFrame, sources: int) -> DataFrame:
    small = F.broadcast(per) if sources <= MAX_BROADCAST_SOURCES else per
    return rows.alias("r").join(small.alias("s"), F.col("r._source").eqNullSafe(F.col("s._source"))).drop(F.col("s._source"))


def plan(docs: DataFrame, id_column="doc_id", text_column="text", source_column="source", **shares):
    """Per source: its target, whole copies, inclusion probability and the bin
    in which its sample ends; with the number of sources and the sizes."""
    sizes = stored(docs.select(
        F.col(id_column).cast("long").alias("_id"), F.col(source_column).cast("string").alias("_source"),
        word_count(text_of(text_column)).alias("size"), _uniform(F.col(id_column)).alias("_u")), "op3-sizes")
    each = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    per = stored(targets(sizes.select("_source", "size"), **shares).withColumn("_whole", F.floor(each)).withColumns({
        "_p": each - F.col("_whole"), "_need": (each - F.col("_whole")) * F.col("source_size"),
        "_cut": F.lit(0).cast("long"), "_before": F.lit(0).cast("long")}), "op3-sources")
    sources = per.count()
    for level in range(1, LEVELS + 1):
        inside = _with_rank(_join_sources(sizes, per, sources)).filter(_bin(level - 1) == F.col("_cut"))
        sums = inside.groupBy("_source", _bin(level).alias("_b")).agg(F.sum("size").alias("_sum"))
        order = Window.partitionBy("_source").orderBy("_b")
        upto = F.sum("_sum").over(order)
        cuts = _join_sources(sums.withColumn("_upto", upto), per, sources).filter(
            F.col("_before") + F.col("_upto") - F.col("_sum") <= F.col("_need"))
        last = cuts.groupBy("_source").agg(F.max(F.struct("_b", (F.col("_before") + F.col("_upto") - F.col("_sum")).alias("c"))).alias("m"))
        per = stored(per.alias("p").join(last.alias("l"), F.col("p._source").eqNullSafe(F.col("l._source")), "left").select(
            "p._source", "source_size", "target", "_whole", "_p", "_need",
            F.coalesce("m._b", F.col("_cut") * BINS).alias("_cut"), F.coalesce("m.c", "_before").alias("_before")), "op3-cut")
    return per, sources, sizes


def _copies(rows: DataFrame, per: DataFrame, sources: int) -> DataFrame:
    """Adds ``_copies`` to rows with ``_id, _source, size, _u``."""
    ranked = _with_rank(_join_sources(rows, per, sources)).withColumn("_b", _bin(LEVELS))
    sure = ranked.filter((F.col("_b") != F.col("_cut")) | (F.col("_p") <= 0)).withColumn(
        "_copies", F.col("_whole") + F.when((F.col("_p") > 0) & (F.col("_b") < F.col("_cut")), 1).otherwise(0))
    # one bin of BINS ** LEVELS of each source
    order = Window.partitionBy("_source").orderBy("_q", "_id", "size")
    so_far = F.col("_before") + F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0))
    edge = ranked.filter((F.col("_b") == F.col("_cut")) & (F.col("_p") > 0)).withColumn(
        "_copies", F.col("_whole") + F.when(so_far - F.col("size") / 2 <= F.col("_need"), 1).otherwise(0))
    return sure.unionByName(edge)


def mix_counts(docs: DataFrame, id_column="doc_id", text_column="text", source_column="source", **shares) -> DataFrame:
    """One row per row: ``doc_id, size, source_size, target, copies, taken``."""
    per, sources, sizes = plan(docs, id_column, text_column, source_column, **shares)
    return _copies(sizes, per, sources).select(
        F.col("_id").alias("doc_id"), "size", "source_size", "target",
        F.col("_copies").alias("copies"), (F.col("_copies") * F.col("size")).alias("taken"))


def mix(docs: DataFrame, id_column="doc_id", text_column="text", source_column="source", **shares) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it, all columns
    kept; whole rows are not shuffled but those of the bins that are ranked."""
    per, sources, _ = plan(docs, id_column, text_column, source_column, **shares)
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"),
        F.col(id_column).cast("long").alias("_id"), F.col(source_column).cast("string").alias("_source"),
        word_count(text_of(text_column)).alias("size"), _uniform(F.col(id_column)).alias("_u"))
    return (_copies(rows, per, sources).filter("_copies > 0")
            .select("_doc", F.explode(F.expr("sequence(1L, _copies)")).alias("_copy")).select("_doc.*"))
