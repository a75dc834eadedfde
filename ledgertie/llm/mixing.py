"""Mixing sources to target weights by Poisson replication.

Each document is repeated a Poisson-distributed number of times, whose mean is the rate
that brings its source to its target weight. The number is the inverse of the Poisson
distribution at a uniform number hashed from the seed and the document's id, so it does
not depend on partitions or retries, and no source has to be counted out or sorted.
Where the id is null or several rows have it, the MD5 of source and text and the place
among equal rows are hashed with it: each row draws for itself, so weights are met and
rows spread whatever the ids.

Defined results: a null source is a source of its own; a source without a target weight
or with weight 0 is left out; a null id hashes as the word null; a null or empty text is
mixed like any other; an empty table gives an empty one. Texts are carried as they are.
New columns take other names if the table already has theirs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgertie.llm.tables import free_name, materialise, numbered
from ledgertie.operators.ordered import positions

TEMPERATURE = 0.5
SEED = "mix-1"


def uniform(seed: str, *columns: Column) -> Column:
    """A number in [0, 1) with 52 bits, from the MD5 of the seed and the columns."""
    return F.conv(F.substring(hashed(seed, *columns), 1, 13), 16, 10).cast("double") / 2.0**52


def hashed(seed: str, *columns: Column) -> Column:
    parts = [F.coalesce(column.cast("string"), F.lit("null")) for column in columns]
    return F.md5(F.concat_ws(":", F.lit(seed), *parts))


def poisson_steps(known: DataFrame) -> DataFrame:
    """Sources with P(X <= 0), P(X <= 1), ... at their rates, until the rest is below 1e-16.

    Takes (source, rate) and returns (source, steps). There are as many steps as a
    source's documents are repeated, and a few dozen more; their logarithms are summed.
    """
    rate, k = F.col("rate"), F.col("k").cast("double")
    last = F.ceil(rate + 12 * F.sqrt(rate) + 30).cast("int")
    so_far = Window.partitionBy("source").orderBy("k")
    log = F.sum(F.when(k > 0, F.log(rate) - F.log(k)).otherwise(-rate)).over(so_far)
    below = F.sum(F.exp("log")).over(so_far)
    steps = (
        known.select("source", "rate", F.explode(F.sequence(F.lit(0), last)).alias("k"))
        .withColumn("log", log)
        .withColumn("step", F.struct("k", below.alias("below")))
    )
    listed = F.array_sort(F.collect_list("step"))["below"]
    return steps.groupBy("source").agg(listed.alias("steps"))


def rates(
    docs: DataFrame,
    weights: DataFrame | None = None,
    source_col: str = "source",
    temperature: float = TEMPERATURE,
    epochs: float = 1.0,
) -> DataFrame:
    """Mean repetitions per source (source, rate).

    ``weights`` (source, weight) are the targets; without them a source's weight is its
    number of documents to the power ``temperature``. The mixture has about ``epochs``
    times as many documents as the table.
    """
    counted = docs.groupBy(F.col(source_col).alias("source")).agg(F.count("*").alias("n"))
    if weights is None:
        weight = F.pow(F.col("n").cast("double"), F.lit(temperature))
        counted = counted.withColumn("weight", weight)
    else:
        given = weights.select(
            weights["source"].alias("given"), weights["weight"].cast("double").alias("weight")
        )
        counted = counted.join(given, counted["source"].eqNullSafe(given["given"])).drop("given")
    counted = materialise(counted.filter("weight > 0"), "sources")
    n, weight = docs.count(), counted.agg(F.sum("weight")).first()[0] or 1.0
    share = F.lit(epochs * n) * F.col("weight") / F.lit(weight)
    return counted.select("source", (share / F.col("n")).alias("rate"))


def _places_among_equals(
    docs: DataFrame, repeated: DataFrame, row: str, id_col: str, source_col: str, text_col: str
) -> DataFrame:
    """Rows whose id is null or repeated: their number and what tells them apart (row, own).

    Equal rows are numbered across partitions, so that no task has all of them.
    """
    (again,) = repeated.columns
    parts = [source_col, *([text_col] if text_col in docs.columns else [])]
    told = [F.coalesce(F.col(f"`{part}`").cast("string"), F.lit("null")) for part in parts]
    rows = docs.select(
        F.col(row).alias("row"), F.col(f"`{id_col}`").alias("id"), F.md5(F.concat_ws(":", *told)).alias("content")
    )
    nameless = rows.filter(F.col("id").isNull())
    shared = rows.join(repeated, F.col("id") == F.col(again), "left_semi")
    name = F.concat_ws(":", F.coalesce(F.col("id").cast("string"), F.lit("null")), "content")
    kept = nameless.unionByName(shared).select("row", "content", name.alias("name"))
    placed = positions(kept, ["name"], ["row"], "place")
    return materialise(placed.select("row", F.concat_ws(":", "content", "place")), "places")


def mix(
    docs: DataFrame,
    weights: DataFrame | None = None,
    id_col: str = "doc_id",
    source_col: str = "source",
    temperature: float = TEMPERATURE,
    epochs: float = 1.0,
    seed: str = SEED,
    text_col: str = "text",
) -> DataFrame:
    """The documents of ``docs``, each as often as drawn, in random order.

    All columns stay, and ``copy`` numbers the repetitions of a document from 1. Rates
    are a row per source in a written table, so Spark broadcasts them by their size or
    else joins by shuffle. The one shuffle of texts is by a hash of document and copy:
    every partition is a random part of the mixture, in random order.
    """
    copy = free_name(docs, "copy")
    names = ["_of", "_steps", "_place", "_times", "_order", "_row", "_self", "_again"]
    of, steps, place, times, order, row, own, again = (free_name(docs, name) for name in names)
    known = rates(docs, weights, source_col, temperature, epochs)
    known = materialise(poisson_steps(known), "rates").toDF(of, steps)
    ids = docs.select(F.col(f"`{id_col}`").alias(again)).filter(F.col(again).isNotNull())
    ids = materialise(ids.groupBy(again).count().filter("count > 1").select(again), "repeated_ids")
    held = numbered(docs, row)
    alike = _places_among_equals(held, ids, row, id_col, source_col, text_col)
    drawn = held.join(known, held[source_col].eqNullSafe(known[of]))
    drawn = drawn.join(alike.toDF(again, own), F.col(row) == F.col(again), "left")
    text_id = F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("null"))
    text_id = F.when(F.col(own).isNull(), text_id).otherwise(F.concat_ws(":", text_id, own))
    repeated = (
        drawn.withColumn(own, text_id)
        .withColumn(place, uniform(seed, F.col(own)))
        .withColumn(times, F.size(F.filter(steps, lambda step: step <= F.col(place))))
        .filter(F.col(times) > 0)
        .withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(times))))
        .withColumn(order, hashed(f"{seed}-order", F.col(own), F.col(copy)))
    )
    return (
        repeated.repartition(order)
        .sortWithinPartitions(order)
        .select(*(F.col(f"`{name}`") for name in docs.columns), copy)
    )
