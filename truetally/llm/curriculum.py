"""Operator 11: a time-varying curriculum over sources.

Training time runs from 0 to 1. Each source has a weight schedule, piecewise
linear between knots (t, weight); its integral is the source's total weight.

* Targets. The mix takes ``share`` of all words; sources share it by total
  weight, a target stops at ``repeat`` times its source's size, and the excess
  is shared anew by weight until none is above. Each round is one aggregation
  of the table of sources.
* Demand. The words of a source stand in one stream: its documents in the order
  of a digest of their ids (the same in every run), over and over up to
  ``repeat`` times. The mix takes the stream's first ``floor(target)`` words; the
  document at the end is cut there.
* Positions. By the time t a source is to have supplied the share of its target
  that the integral of its schedule up to t has of the whole integral. A visit of
  a document begins at some word of the stream; inverting the cumulative demand
  there (a square root within a linear piece) gives its training position.
* Order. Visits are range-sorted by position.

Scale. Texts are read once, for their sizes, and don't move. Rows that agree in
id, source and size are counted first and expanded last. Offsets in a source's
stream are prefix sums in three levels: groups of ``BUCKET`` buckets, buckets of
a group (ranges of the digest, ``BUCKET`` keys each on average, so a source of
any size spreads), and keys of a bucket. The ranking of sources is by ranges as well. The table of
sources is broadcast while it has at most ``SOURCES`` rows, else joined by
shuffle, where Spark splits large sources.

Defined cases: null or blank text has size 0 and is never taken; the null
source is a source of its own, last in order; a source without a schedule, or
with one of no area, has target 0; weights must not be negative; documents with
a null id come first in the digest's order; repeated rows are documents of their
own; further columns are ignored; empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from truetally.llm.common import small_side, written

WORD = r"[^\x20\x09-\x0D]+"
SHARE, REPEAT = 1.5, 2
BUCKET, SOURCES = 1_000, 10_000


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def ranked(df: DataFrame, *order: Column) -> DataFrame:
    """``df`` with ``rank`` from 0 in the given order, without bringing all rows into one task."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = written(df.repartitionByRange(parts, *order).withColumn("_part", F.spark_partition_id()), "ranges")
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    offsets = (dealt.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
               .select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset")))
    place = F.row_number().over(Window.partitionBy("_part").orderBy(*order)) - 1
    return dealt.withColumn("_place", place).join(offsets, "_part").withColumn(
        "rank", F.col("_offset") + F.col("_place")).drop("_part", "_place", "_offset")


def segments(knots: Column) -> Column:
    """Array of the pieces (t, w, slope, c) of a schedule; c: integral up to t. The last has no extent and holds the total."""
    sorted_ = F.array_sort(knots)
    steps = F.transform(F.sequence(F.lit(1), F.size(sorted_)), lambda i: F.struct(
        F.element_at(sorted_, i).alias("a"), F.element_at(sorted_, F.least(i + 1, F.size(sorted_))).alias("b")))
    none = F.array().cast("array<struct<t: double, w: double, slope: double, c: double, area: double>>")

    def add(done, step):
        a, b = step["a"], step["b"]
        width = b["t"] - a["t"]
        c = F.when(F.size(done) == 0, F.lit(0.0)).otherwise(F.element_at(done, -1)["c"] + F.element_at(done, -1)["area"])
        return F.concat(done, F.array(F.struct(
            a["t"].alias("t"), a["w"].alias("w"), F.when(width > 0, (b["w"] - a["w"]) / width).otherwise(F.lit(0.0)).alias("slope"),
            c.alias("c"), (width * (a["w"] + b["w"]) / 2).alias("area"))))

    return F.aggregate(steps, none, add)


def inverted(pieces: Column, demand: Column) -> Column:
    """The time at which the integral of a schedule reaches ``demand``."""
    piece = F.element_at(F.filter(pieces, lambda p: p["c"] <= demand), -1)
    rest = demand - piece["c"]
    root = piece["w"] + F.sqrt(F.greatest(piece["w"] * piece["w"] + 2 * piece["slope"] * rest, F.lit(0.0)))
    return piece["t"] + F.when(root > 0, 2 * rest / root).otherwise(F.lit(0.0))


def source_targets(sources: DataFrame, share: float = SHARE, repeat: int = REPEAT) -> DataFrame:
    """``sources`` (with ``source_size`` and ``weight``) with ``target``."""
    cap = repeat * F.col("source_size").cast("double")
    level = 0.0
    while True:  # each round caps a source more, or is the last
        over = F.col("weight") * F.lit(level) > cap
        s = sources.agg(F.sum("source_size").alias("all"), F.sum(F.when(over, repeat * F.col("source_size"))).alias("capped"),
                        F.sum(F.when(~over, F.col("weight"))).alias("free")).first()
        new = (share * (s["all"] or 0) - (s["capped"] or 0)) / s["free"] if s["free"] else level
        if new <= level:
            break
        level = new
    return sources.withColumn("target", F.least(cap, F.col("weight") * F.lit(level)))


def assign_positions(docs: DataFrame, schedules: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     source_col: str = "source", share: float = SHARE, repeat: int = REPEAT) -> DataFrame:
    """Per document: (id, source, size, source_size, target, taken, position, visits).

    ``schedules``: (source, knots array of (t double, w double)), one row per
    source. ``visits``: array of (position, words), in order; ``position`` is the
    first one's, null for documents that aren't taken.
    """
    sized = docs.select(F.col(id_col).alias("_id"), F.col(source_col).alias("_source"), word_count(F.col(text_col)).alias("size"))
    mark = F.conv(F.substring(F.md5(F.coalesce(F.col("_id").cast("string"), F.lit("")).cast("binary")), 1, 15), 16, 10).cast("long")
    rows = written(sized.groupBy("_id", "_source", "size").agg(F.count(F.lit(1)).alias("n")).withColumn("mark", mark), "sizes")
    given = schedules.select(F.col("source").alias("_source"), segments(F.col("knots")).alias("pieces"))
    sums = rows.groupBy("_source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"), F.count(F.lit(1)).alias("keys"))
    total = F.col("pieces")[F.size("pieces") - 1]
    weighed = written(sums.join(given, sums["_source"].eqNullSafe(given["_source"]), "left").drop(given["_source"])
                      .withColumn("weight", F.coalesce(total["c"] + total["area"], F.lit(0.0)))
                      .withColumn("buckets", F.ceil(F.col("keys") / BUCKET)), "sources")
    sources = small_side(written(source_targets(weighed, share, repeat), "targets"), SOURCES)

    def by_source(df: DataFrame, *columns: str) -> DataFrame:
        right = sources.select(F.col("_source").alias("_s"), *columns)
        return df.join(right, F.col("_source").eqNullSafe(F.col("_s"))).drop("_s")

    # mark < 2**60; buckets are ranges of it
    dealt = (by_source(rows, "buckets").withColumn("bucket", F.shiftright(F.shiftright("mark", 30) * F.col("buckets"), 30))
             .withColumn("group", F.floor(F.col("bucket") / BUCKET)))
    sums = dealt.groupBy("_source", "group", "bucket").agg(F.sum(F.col("size") * F.col("n")).alias("words"))
    groups = sums.groupBy("_source", "group").agg(F.sum("words").alias("words"))

    def earlier(df: DataFrame, keys: list, order: list, name: str, words: Column = F.col("words")) -> DataFrame:
        window = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
        return df.withColumn(name, F.coalesce(F.sum(words).over(window), F.lit(0)))

    def place(df: DataFrame, sums: DataFrame, *keys: str) -> DataFrame:
        right = sums.drop("words").withColumnsRenamed({"_source": "_s", **{k: f"_{k}" for k in keys}})
        on = F.col("_source").eqNullSafe(F.col("_s"))
        for k in keys:
            on &= F.col(k) == F.col(f"_{k}")
        return df.join(right, on).drop("_s", *[f"_{k}" for k in keys])

    bases = place(earlier(sums, ["_source", "group"], ["bucket"], "in_group"),
                  earlier(groups, ["_source"], ["group"], "before_group"), "group")
    offsets = bases.select("_source", "bucket", (F.col("in_group") + F.col("before_group")).alias("base"))
    streams = (place(earlier(dealt, ["_source", "bucket"], ["mark", F.col("_id").asc_nulls_first(), "size"], "before",
                             F.col("size") * F.col("n")), offsets, "bucket")
               .select("_id", "_source", "size", "n", (F.col("base") + F.col("before")).alias("start")))
    full = by_source(streams, "source_size", "target", "weight", "pieces")
    each = (full.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))))
            .withColumn("start", F.col("start") + (F.col("copy") - 1) * F.col("size")))
    left = lambda at: F.least(F.col("size"), F.floor("target") - at)
    begin = F.transform(F.sequence(F.lit(0).cast("long"), F.lit(repeat - 1).cast("long")),
                        lambda e: F.col("start") + e * F.col("source_size"))
    visit = lambda at: F.struct(
        inverted(F.col("pieces"), at.cast("double") / F.col("target") * F.col("weight")).alias("position"), left(at).alias("words"))
    out = (each.withColumn("visits", F.transform(F.filter(begin, lambda at: left(at) > 0), visit))
           .withColumn("taken", F.aggregate("visits", F.lit(0).cast("long"), lambda a, v: a + v["words"])))
    return out.select(F.col("_id").alias(id_col), F.col("_source").alias("source"), "size", "source_size", "target", "taken",
                      F.get("visits", F.lit(0))["position"].alias("position"), "visits")


def training_order(plan: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """One row per visit, range-sorted: (position, id, source, words); ties by source and id."""
    parts = int(plan.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["position", "source", id_col]
    return (plan.select(id_col, "source", F.explode("visits").alias("_v"))
            .select(F.col("_v.position").alias("position"), id_col, "source", F.col("_v.words").alias("words"))
            .repartitionByRange(parts, *order).sortWithinPartitions(*order))


def by_position(plan: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Documents range-sorted by their first position; those that aren't taken last."""
    parts = int(plan.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("position").asc_nulls_last(), F.col(id_col)]
    return plan.repartitionByRange(parts, *order).sortWithinPartitions(*order)
