"""Mixing sources to target weights: repetition rates by source, whole copies plus one hash-seeded Bernoulli copy.

Only DataFrame functions. Words are aggregated per source, the water level that gives every source its weight's share
under the cap is found over the sources (one row each), and each document is taken floor(rate) times plus once more with
the rate's fraction as probability. The draw hangs on seed, source and doc_id alone, so reruns and retries agree. A few
seeds are tried for each source, and the one whose words come nearest the target is used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from supportlens.llm.common import small_side, stored, unit_draw, word_count

WEIGHTS = (3, 1, 2)
SHARE = 1.5
CAP = 2.0
SEEDS = 16


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """From (source, source_size), one row a source: source, source_size, target.

    Sources in order of code points, null last, get the weights in turn and share `share` of all words by weight; a target
    stops at `cap` times its source's size and the excess goes to the others by weight. A source is capped if, with all
    sources of smaller size by weight capped, its share of the rest is above its cap. The windows run over one row a source.
    """
    order = Window.orderBy(F.col("source").isNull(), "source")
    turn = (F.row_number().over(order) - 1) % len(weights)
    weighed = sizes.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), turn + 1).cast("double"))
    weighed = weighed.withColumn("most", F.lit(cap) * F.col("source_size"))
    by_level = Window.orderBy(F.col("most") / F.col("weight"), F.col("source").isNull(), "source")
    whole = Window.partitionBy()
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    levelled = weighed.select(
        "*",
        (F.lit(share) * F.sum("source_size").over(whole)).alias("words"),
        F.coalesce(F.sum("most").over(before), F.lit(0.0)).alias("used"),
        (F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))).alias("left"),
    )
    capped = F.col("most") * F.col("left") <= F.col("weight") * (F.col("words") - F.col("used"))
    rest = levelled.withColumn("capped", capped).select(
        "*",
        F.sum(F.when(F.col("capped"), F.col("most")).otherwise(0.0)).over(whole).alias("fixed"),
        F.sum(F.when(F.col("capped"), 0.0).otherwise(F.col("weight"))).over(whole).alias("open"),
    )
    shared = F.col("weight") * (F.col("words") - F.col("fixed")) / F.nullif(F.col("open"), F.lit(0.0))
    return rest.select("source", "source_size", F.when(F.col("capped"), F.col("most")).otherwise(shared).alias("target"))


def _copies(seed: Column) -> Column:
    """Times a document is taken at its source's rate."""
    whole = F.floor("rate")
    return whole + (unit_draw(seed, F.col("source"), F.col("doc_id")) < F.col("rate") - whole).cast("long")


def mixing_rates(sized: DataFrame, seeds: int = SEEDS, **targets) -> DataFrame:
    """From (doc_id, source, size), one row a source: source, source_size, target, rate, seed. A source without words
    has rate 0."""
    sources = stored(source_targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), **targets), "targets")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    rated = sources.withColumn("rate", rate)
    tried = join_sources(sized, rated).groupBy("source").agg(
        *(F.sum(F.col("size") * _copies(F.lit(k))).alias(f"taken{k}") for k in range(seeds))
    )
    options = F.array(*(F.struct(F.abs(F.col(f"taken{k}") - F.col("target")).alias("off"), F.lit(k).alias("seed")) for k in range(seeds)))
    near = rated.join(tried, rated["source"].eqNullSafe(tried["source"])).select(rated["*"], F.array_min(options)["seed"].alias("seed"))
    return stored(near, "rates")


def join_sources(rows: DataFrame, rates: DataFrame) -> DataFrame:
    """`rows` with their source's columns; null is a source like any other. The side of one row a source is broadcast only if
    its counted rows allow it."""
    side = small_side(rates, rates.count()).withColumnRenamed("source", "_source")
    return rows.join(side, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")


def sizes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """doc_id, source and size in words of every document, written once."""
    return stored(
        docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size")),
        "sizes",
    )


def mix_plan(docs: DataFrame, **options) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken (words the mix takes), copies.

    Null texts have size 0; repeated rows draw alike; a table without words takes nothing; other columns are ignored.
    """
    sized = sizes(docs)
    joined = join_sources(sized, mixing_rates(sized, **options)).withColumn("copies", _copies(F.col("seed")))
    return joined.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "copies")


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: each row of `docs`, all columns kept, as often as it is taken. Needs doc_id, text and source."""
    rates = mixing_rates(sizes(docs), **options).select("source", "rate", "seed")
    held = docs.select(F.struct("*").alias("_row"), F.col("doc_id").alias("doc_id"), F.col("source").alias("source"))
    taken = join_sources(held, rates).withColumn("_copies", _copies(F.col("seed"))).filter("_copies > 0")
    return taken.select("_row", F.explode(F.sequence(F.lit(1).cast("long"), "_copies")).alias("_copy")).select("_row.*")
