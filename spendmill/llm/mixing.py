"""Mixing sources to target weights by repeating documents.

Sizes are summed per source, targets and repetition rates follow from the sums, and each document is taken floor(rate)
times and once more with the rate's fraction as probability. That draw is a hash of the seed, the row's content and its
number among equal rows, so a rerun draws the same and equal rows draw apart. Built-in functions only; documents meet
the rates through a join on the source, which adaptive execution splits where one source is large.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .storage import stored

WEIGHTS, MOST_REPEATS, SEED = (1, 2, 3), 3, 12
ROWS_PER_BLOCK = 50_000
#: A draw is the first 52 bits of a SHA-256 as a fraction, which a double holds exactly.
DRAW_DIGITS = 13


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def ranked_sources(sizes: DataFrame, order: str = "source") -> DataFrame:
    """``sizes`` with ``rank`` from 0 by ``order``, nulls last.

    Spark range-partitions and sorts; only one count for each partition meets in one task, so sources may be many.
    """
    ordered = sizes.repartitionByRange(F.col(order).asc_nulls_last()).sortWithinPartitions(F.col(order).asc_nulls_last())
    at = F.monotonically_increasing_id()
    placed = stored(ordered.select("*", F.shiftright(at, 33).alias("_part"), at.bitwiseAND((1 << 33) - 1).alias("_within")), "sources")
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = placed.groupBy("_part").agg(F.count("*").alias("n"))
    offsets = counts.select("_part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_before"))
    return placed.join(offsets, "_part").withColumn("rank", F.col("_before") + F.col("_within")).drop("_part", "_within", "_before")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most_repeats: int = MOST_REPEATS) -> DataFrame:
    """``sizes`` (source, source_size) with ``target`` and ``rate``.

    The whole size is shared by weight, ``weights`` repeating over the sources in order of code points, null last. No
    target passes ``most_repeats`` times its source's size; what is over is shared again among the others by weight,
    until none is above. The driver sees one row of sums for each of these rounds. An empty source has rate 0.
    """
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights) + 1).cast("int")).cast("long")
    limit = F.col("source_size") * most_repeats
    sources = stored(ranked_sources(sizes).select("source", "source_size", weight.alias("weight"), limit.alias("limit")), "weights")
    total = sources.agg(F.sum("source_size").alias("s")).first()["s"] or 0
    unit, held = None, -1  # size for each unit of weight; sources held at their limit
    while True:
        at_limit = F.lit(False) if unit is None else F.col("weight") * F.lit(unit) >= F.col("limit")
        row = sources.agg(
            F.count_if(at_limit).alias("held"),
            F.sum(F.when(at_limit, F.col("limit"))).alias("fixed"),
            F.sum(F.when(~at_limit, F.col("weight"))).alias("open"),
        ).first()
        if row["held"] == held or not row["open"]:
            break
        held, unit = row["held"], (total - (row["fixed"] or 0)) / row["open"]
    target = F.least(F.col("weight") * F.lit(float(unit or 0)), F.col("limit").cast("double"))
    rate = F.when(F.col("source_size") > 0, target / F.col("source_size")).otherwise(0.0)
    return sources.select("source", "source_size", target.alias("target"), F.least(rate, F.lit(float(most_repeats))).alias("rate"))


def with_occurrence(rows: DataFrame, key: str = "key", *, rows_per_block: int = ROWS_PER_BLOCK) -> DataFrame:
    """``rows`` with ``occurrence``: 0 for a single row, else a number of its own among the rows of its key.

    Keys are counted first and only repeated ones are numbered, a block of rows at a time, so no task holds a key.
    """
    repeated = stored(rows.groupBy(key).agg(F.count("*").alias("_n")).where("_n > 1").select(key), "repeated")
    if repeated.isEmpty():
        return rows.withColumn("occurrence", F.lit(0).cast("long"))
    single = rows.join(repeated, key, "left_anti").withColumn("occurrence", F.lit(0).cast("long"))
    several = stored(rows.join(repeated, key, "left_semi"), "several")
    blocks = max(1, -(-several.count() // rows_per_block))
    blocked = stored(several.withColumn("_block", F.pmod(F.monotonically_increasing_id(), F.lit(blocks))), "blocked")
    before = Window.partitionBy(key).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    sizes = blocked.groupBy(key, "_block").agg(F.count("*").alias("_n"))
    offsets = sizes.select(key, "_block", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    within = F.row_number().over(Window.partitionBy(key, "_block").orderBy(F.lit(0)))
    numbered = blocked.withColumn("_within", within).join(offsets, [key, "_block"])
    numbered = numbered.withColumn("occurrence", (F.col("_before") + F.col("_within") - 1).cast("long"))
    return single.unionByName(numbered.select(*single.columns))


def content_key(doc_id: Column, text: Column, source: Column) -> Column:
    """SHA-256 (hex) of a row's id, text and source, null apart from empty text or source."""
    parts = (F.coalesce(doc_id.cast("string"), F.lit("-")), *(F.coalesce(F.sha2(c, 256), F.lit("-")) for c in (text, source)))
    return F.sha2(F.concat_ws(",", *parts), 256)


def draw(key: Column, occurrence: Column, seed: int) -> Column:
    """A number in [0, 1) for each row."""
    digest = F.sha2(F.concat_ws(",", F.lit(str(seed)), key, occurrence.cast("string")), 256)
    return F.conv(F.substring(digest, 1, DRAW_DIGITS), 16, 10).cast("long") / F.lit(float(1 << 4 * DRAW_DIGITS))


def repetitions(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, *, most_repeats: int = MOST_REPEATS, seed: int = SEED) -> DataFrame:
    """One row per row of ``docs``: doc_id, source, key, size, source_size, target, rate, copies.

    ``size`` is the number of words (runs of other than white space), 0 for null and empty texts. ``copies`` is
    floor(rate) plus one with the fraction's probability, never above ``most_repeats``. A null source is a source.
    Null and repeated ids have draws of their own; of equal rows each draws apart. Documents of an empty source, and so
    all where no text has a word, are taken 0 times; an empty table gives no row. Reads doc_id, text and source only.
    """
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        "source",
        content_key(F.col("doc_id"), F.col("text"), F.col("source")).alias("key"),
        word_count(F.col("text")).alias("size"),
    )
    rows = stored(rows, "rows")
    rates = targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, most_repeats)
    rates = rates.withColumnRenamed("source", "_source")
    mixed = with_occurrence(rows).join(rates, F.col("source").eqNullSafe(F.col("_source")))
    whole = F.floor("rate")
    extra = (draw(F.col("key"), F.col("occurrence"), seed) < F.col("rate") - whole).cast("long")
    copies = F.least(whole + extra, F.lit(most_repeats)).cast("long")
    return mixed.select("doc_id", "source", "key", "size", "source_size", "target", "rate", copies.alias("copies"))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, *, most_repeats: int = MOST_REPEATS, seed: int = SEED) -> DataFrame:
    """The mix itself: rows of ``docs`` (doc_id, text, source), each as often as it is taken, with ``copy`` from 0.

    Equal rows are interchangeable: of a content key as many rows are emitted as its draws say, the text read once.
    """
    taken = repetitions(docs, weights, most_repeats=most_repeats, seed=seed).groupBy("key").agg(F.sum("copies").alias("_copies")).where("_copies > 0")
    own = docs.select(F.col("doc_id"), "text", "source", content_key(F.col("doc_id"), F.col("text"), F.col("source")).alias("key"))
    first = own.groupBy("key").agg(*(F.first(c).alias(c) for c in ("doc_id", "text", "source")))
    out = first.join(taken, "key").withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_copies") - 1)))
    return out.select("doc_id", "text", "source", "copy")


def mixed(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, *, most_repeats: int = MOST_REPEATS, seed: int = SEED) -> DataFrame:
    """doc_id, size, source_size, target and ``taken``: the words that the mix takes from the document, repeats counted."""
    rows = repetitions(docs, weights, most_repeats=most_repeats, seed=seed)
    return rows.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))
