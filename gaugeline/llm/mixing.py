"""Mixing sources to target weights by hash-threshold histograms, with DataFrame functions only.

Every row has a 60-bit hash of its key and text. A source that is to give ``f`` of its words takes every
row ``floor(f)`` times and, once more, the rows whose hash lies below a threshold. The
threshold is found by nested histograms: words are summed by source and hash bucket,
the bucket where the running sum meets the budget is the boundary, and only the rows
of boundary buckets are histogrammed again by the next bits. No rows are sorted, and
the same rows give the same result whatever the partitioning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, named

BITS = 10
HASH_BITS = 60
#: Words are runs of characters that are none of the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[float, ...], share: float, cap: float) -> DataFrame:
    """Add ``target`` to (source, source_size): weights by rank of the source, water-filled under ``cap`` times the size.

    The level at which the uncapped sources share the rest follows from the running
    sums of caps and weights in order of cap by weight, so no iteration is needed.
    The input has a row for each source; its order is found without moving rows of the corpus.
    """
    everything = Window.partitionBy(F.lit(0))
    rank = F.row_number().over(everything.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (rank % len(weights) + 1).cast("int"))
    t = sizes.withColumn("weight", weight).withColumn("most", F.col("source_size") * F.lit(float(cap)))
    upto = everything.orderBy(F.col("most") / F.col("weight"), F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    total = F.sum("source_size").over(everything) * F.lit(float(share))
    below = F.sum("most").over(upto) - F.col("most")
    rest = F.sum("weight").over(everything) - F.sum("weight").over(upto) + F.col("weight")
    t = t.withColumns({"total": total, "below": below, "rest": rest})
    # capped: the level with all sources of lower ratio capped reaches its own ratio
    t = t.withColumn("is_capped", (F.col("total") - F.col("below")) * F.col("weight") >= F.col("most") * F.col("rest"))
    free_weight = F.sum(F.when(~F.col("is_capped"), F.col("weight"))).over(everything)
    capped = F.coalesce(F.sum(F.when(F.col("is_capped"), F.col("most"))).over(everything), F.lit(0.0))
    shared = (F.col("total") - capped) * F.col("weight") / free_weight
    return t.withColumn("target", F.when(F.col("is_capped"), F.col("most")).otherwise(F.least(shared, F.col("most")))).select("source", "source_size", "target")


def thresholds(rows: DataFrame, goals: DataFrame) -> DataFrame:
    """For each source the hash below which rows are taken once more, and the share of the words at that very hash.

    ``rows``: source, h, size; ``goals``: source, base, budget. Result: source, base,
    threshold, tie_share. Each level narrows every source to one bucket of its hashes.
    """
    found = goals.select("source", "base", F.col("budget").cast("double"), F.lit(0).cast("long").alias("prefix"))
    level = 0
    while (level + 1) * BITS <= HASH_BITS:
        shift = HASH_BITS - (level + 1) * BITS
        inside = rows
        if level:
            edge = found.select(F.col("source").alias("edge_source"), F.col("prefix"))
            same = F.col("source").eqNullSafe(F.col("edge_source")) & (F.shiftright("h", shift + BITS) == F.col("prefix"))
            inside = rows.join(edge, same).select("source", "h", "size")
        sums = inside.groupBy("source", F.shiftright("h", shift).alias("bucket")).agg(F.sum("size").alias("words"), F.min("h").alias("lo"), F.max("h").alias("hi"), F.count(F.lit(1)).alias("n"))
        w = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
        sums = sums.withColumn("before", F.coalesce(F.sum("words").over(w), F.lit(0)))
        goal = found.select(F.col("source").alias("goal_source"), "base", "budget")
        over = sums.join(goal, F.col("source").eqNullSafe(F.col("goal_source"))).filter((F.col("before") <= F.col("budget")) & (F.col("budget") < F.col("before") + F.col("words")))
        found = over.select("source", "base", (F.col("budget") - F.col("before")).alias("budget"), F.col("bucket").alias("prefix"), F.col("words"), (F.col("lo") == F.col("hi")).alias("single"), F.col("lo").alias("h"), "n")
        found = materialize(found, "mix-boundaries")
        level += 1
        if not found.filter(~F.col("single")).limit(1).count():
            break
    share = F.col("budget") / F.col("words")
    share = F.when(F.col("n") == 1, F.floor(share + 0.5).cast("double")).otherwise(share)
    return found.select("source", F.col("h").alias("threshold"), share.alias("tie_share"))


def row_hash(key: Column, text: Column) -> Column:
    digest = F.md5(F.concat(F.coalesce(key.cast("string"), F.lit("")), F.lit(":"), F.coalesce(text, F.lit(""))).cast("binary"))
    return F.conv(F.substring(digest, 1, HASH_BITS // 4), 16, 10).cast("long")


def mix(df: DataFrame, weights: tuple[float, ...] = (3.0, 1.0, 2.0), share: float = 1.5, cap: float = 2.0, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """Sizes, targets and taken words of every row.

    Result: ``key`` (under its own name), ``source``, ``h`` (the row's hash), ``size``, ``source_size``,
    ``target``, ``copies`` and ``taken``. ``copies`` is how often the mix takes the row:
    ``taken = copies * size`` but for two or more rows that tie on the threshold's hash, such as
    exact copies of one row. They share what is left of the budget in equal parts: their ``taken``
    holds a part of a document in whole words, and ``copies`` counts that part as a copy if it is
    at least half of it.

    Null texts have size 0; a null source is a source of its own and the last; null keys and
    repeated rows are ordinary rows. An empty table gives an empty result. Sources of size 0
    have target 0. Other columns are not carried.
    """
    rows = df.select(named(key).alias("key"), named(source).alias("source"), word_count(named(text)).alias("size"), row_hash(named(key), named(text)).alias("h"))
    rows = materialize(rows, "mix-sizes")
    out = with_share(rows, mix_plan(rows, weights, share, cap))
    taken = F.col("base") * F.col("size") + F.floor(F.col("size") * F.col("part") + 0.5).cast("long")
    copies = F.col("base") + F.floor(F.col("part") + 0.5).cast("long")
    return out.select(F.col("key").alias(key), F.col("source").alias(source), "h", "size", "source_size", "target", copies.alias("copies"), taken.alias("taken"))


def mixed_rows(df: DataFrame, weights: tuple[float, ...] = (3.0, 1.0, 2.0), share: float = 1.5, cap: float = 2.0, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """All columns of ``df``, each row as often as the mix takes it (``copies`` of ``mix``); rows of no copies go.

    Only keys, sizes and hashes are written for the histograms; the texts are read once more
    and filtered by the thresholds. Nulls and repeated rows are treated as in ``mix``.
    """
    rows = df.select(named(source).alias("source"), word_count(named(text)).alias("size"), row_hash(named(key), named(text)).alias("h"))
    plan = mix_plan(materialize(rows, "mix-sizes"), weights, share, cap)
    whole = df.select(F.struct(*[named(c) for c in df.columns]).alias("row"), named(source).alias("source"), row_hash(named(key), named(text)).alias("h"))
    out = with_share(whole, plan)
    copies = (F.col("base") + F.floor(F.col("part") + 0.5)).cast("int")
    return out.select("row", F.explode(F.array_repeat(F.lit(0), copies))).select("row.*")


def mix_plan(rows: DataFrame, weights: tuple[float, ...], share: float, cap: float) -> DataFrame:
    """A row for each source: size, target, whole copies, threshold of one more copy and share of ties."""
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = materialize(source_targets(sizes, weights, share, cap), "mix-targets")
    times = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    goals = targets.withColumn("base", times.cast("long")).withColumn("budget", F.col("target") - F.col("base") * F.col("source_size"))
    edge = thresholds(rows, goals.filter(F.col("budget") > 0))
    edge = edge.withColumnRenamed("source", "edge_source")
    plan = goals.join(edge, F.col("source").eqNullSafe(F.col("edge_source")), "left").select(F.col("source").alias("plan_source"), "source_size", "target", "base", "threshold", "tie_share")
    return materialize(plan, "mix-plan")


def with_share(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """Join the plan; ``part`` is the share of one more copy of the row: 1 below the threshold, 0 above."""
    out = rows.join(plan, F.col("source").eqNullSafe(F.col("plan_source")))
    at_edge = F.col("h") == F.col("threshold")
    return out.withColumn("part", F.when(F.col("h") < F.col("threshold"), F.lit(1.0)).when(at_edge, F.col("tie_share")).otherwise(0.0))
