"""Mixing sources to target weights by weighted sampling without replacement."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tagwright.llm.common import in_order, nested, numbered, spread, without, word_count
from tagwright.session import fits_broadcast, written

SEED = 7
ADDED = ("source_size", "target", "epochs", "taken")


def uniform(*parts: Column, seed: int = SEED) -> Column:
    """A number in (0, 1) that depends on the given values alone."""
    bits = F.shiftrightunsigned(F.xxhash64(F.lit(seed), *parts), 11)
    return (bits.cast("double") + 0.5) / float(2**53)


def quality_weight(text: Column, size: Column) -> Column:
    """Weight of a document: 1 for words of a usual mean length (3 to 10 characters), else 0.5."""
    mean = F.length(text) / F.greatest(size, F.lit(1)) - 1
    return F.when(mean.between(3.0, 10.0), F.lit(1.0)).otherwise(F.lit(0.5))


def targets(sources: DataFrame, share: float, weights: list[float], most: float) -> DataFrame:
    """``(source, source_size)`` with the ``target`` of each source.

    The sources, in the order of their code points with null last, get the weights in turn and
    share ``share`` times the sum of all sizes. A target stops at ``most`` times its source's size; the
    excess goes to the others by weight until none is above. That is a level ``L`` with
    ``target = min(most * size, L * weight)``, found by raising ``L`` while further sources stop.
    Each step is one sum over the sources, of which three numbers reach the driver.
    """
    ranked = numbered(
        sources.withColumn("last", F.col("source").isNull()), "last", "source", number="rank", purpose="mix-sources"
    )
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") % len(weights)).cast("int") + 1)
    weighed = written(ranked.withColumn("weight", weight).withColumn("top", F.col("source_size") * most), "mix-weights")
    total = (weighed.agg(F.sum("source_size")).first()[0] or 0) * share
    level, stopped_before = 0.0, -1
    while True:
        stops = F.col("top") <= F.col("weight") * level
        stopped, held, open_weight = weighed.agg(
            F.count_if(stops), F.sum(F.when(stops, F.col("top"))), F.sum(F.when(~stops, F.col("weight")))
        ).first()
        if not open_weight or stopped == stopped_before:
            break
        stopped_before, level = stopped, max(level, (total - (held or 0.0)) / open_weight)
    level = level if open_weight else math.inf
    target = F.col("top") if math.isinf(level) else F.least(F.col("top"), F.col("weight") * level)
    return weighed.select("source", "source_size", target.alias("target"))


def mix(
    docs: DataFrame,
    key: list[str],
    size: str,
    weight: str,
    share: float = 1.5,
    weights: tuple[float, ...] = (3.0, 1.0, 2.0),
    most: float = 2.0,
    seed: int = SEED,
) -> DataFrame:
    """``docs`` with ``source_size``, ``target``, ``epochs`` (times the mix takes the document) and ``taken``.

    A source takes complete epochs first, as often as its target holds its size. What is left of the
    target is filled by a weighted sample without replacement: each document gets the exponential key
    ``-ln(u) / weight`` from a hash of its row, the documents of a source are put in the order of their
    keys, and their sizes are summed up from the front. A document is taken once more if that brings the
    sum nearer to what is left; so a source misses its target by half a document at most.

    ``docs`` needs ``source``, the ``key`` columns that tell documents apart, ``size`` (long, null as 0)
    and ``weight`` (above 0, else as 0.5). Order and sums are spread over ranges of (source, key), so a
    source with a third of all rows is split. Nulls form one source, the last. Equal rows get the same
    exponential key and may stand in any order: they are taken as often in all. An empty table gives no rows.
    Columns of the input named like an added one are replaced.
    """
    given = without(docs, *ADDED)
    sized = given.withColumn(size, F.coalesce(F.col(size), F.lit(0)).cast("long"))
    w = F.when(F.col(weight) > 0, F.col(weight)).otherwise(F.lit(0.5))
    row = F.xxhash64(*[F.col(f"`{name}`") for name in given.columns])
    drawn = nested(
        sized,
        F.col("source").isNull().alias("last"),
        F.col("source").alias("source"),
        (-F.ln(uniform(*[F.col(k) for k in key], row, seed=seed)) / w).alias("draw"),
        row.alias("tie"),
        F.col(size).alias("size"),
    )
    placed = in_order(drawn, "last", "source", "draw", *[f"given.`{k}`" for k in key], "tie", purpose="mix-order")
    parts = placed.groupBy("source", "part").agg(F.sum("size").alias("part_size"))
    earlier = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = written(
        parts.select("source", "part", "part_size", F.coalesce(F.sum("part_size").over(earlier), F.lit(0)).alias("start")),
        "mix-starts",
    )
    aims = targets(starts.groupBy("source").agg(F.sum("part_size").alias("source_size")), share, list(weights), most)
    aimed = starts.alias("s").join(aims.alias("a"), F.col("s.source").eqNullSafe(F.col("a.source"))).select(
        F.col("s.source").alias("aim_source"), F.col("part").alias("aim_part"), "start", "source_size", "target"
    )
    before = Window.partitionBy("part", "source").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    summed = placed.withColumn("before", F.coalesce(F.sum("size").over(before), F.lit(0)))
    joined = summed.join(
        aimed, (F.col("part") == F.col("aim_part")) & F.col("source").eqNullSafe(F.col("aim_source"))
    )
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    left = F.col("target") - whole * F.col("source_size")
    once_more = (F.col("start") + F.col("before") + F.col("size") / 2 <= left) & (F.col("size") > 0)
    epochs = whole + once_more.cast("int")
    return joined.select(
        "given.*",
        "source_size",
        "target",
        epochs.cast("int").alias("epochs"),
        (epochs * F.col("size")).cast("long").alias("taken"),
    )


def described(docs: DataFrame) -> DataFrame:
    """``(doc_id, source, size, quality, text_hash)``: what the mix needs of a document."""
    counted = spread(docs.select("doc_id", "source", "text")).withColumn("size", word_count(F.col("text")))
    return counted.select(
        "doc_id",
        "source",
        "size",
        F.coalesce(quality_weight(F.col("text"), F.col("size")), F.lit(0.5)).alias("quality"),
        F.xxhash64("text").alias("text_hash"),
    )


def document_mix(docs: DataFrame) -> DataFrame:
    mixed = mix(described(docs), ["doc_id"], "size", "quality")
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "source", "quality", "epochs")


def mixed_documents(docs: DataFrame) -> DataFrame:
    """``docs`` as the mix takes them: a row for each epoch of a document, none for those it leaves out.

    All columns stay as they are. Rows with the same ``doc_id``, source and text share what the mix takes of them: each gets as many
    epochs as the others, or one more. Null ids, sources and texts are values like others. The number of epochs is sent to
    where the texts are if it fits the library's bound, else joined by shuffle. An empty table gives no rows.
    """
    mixed = mix(described(docs), ["doc_id"], "size", "quality")
    taken = mixed.groupBy("doc_id", "source", "text_hash").agg(F.sum("epochs"), F.count(F.lit(1)))
    taken = taken.toDF("mix_id", "mix_source", "mix_hash", "mix_epochs", "mix_rows").where("mix_epochs > 0")
    taken = written(taken, "mix-epochs")
    repeated = not taken.where("mix_rows > 1").isEmpty()
    if fits_broadcast(taken, 48 + F.coalesce(F.octet_length("mix_source"), F.lit(0))):
        taken = F.broadcast(taken)
    same = (
        F.col("given.doc_id").eqNullSafe(F.col("mix_id"))
        & F.col("given.source").eqNullSafe(F.col("mix_source"))
        & (F.xxhash64("given.text") == F.col("mix_hash"))
    )
    met = nested(docs).join(taken, same)
    epochs = met.where("mix_rows = 1").select("given", "mix_epochs")
    if repeated:
        epochs = epochs.unionByName(_shared_epochs(met.where("mix_rows > 1")))
    times = F.explode(F.array_repeat(F.lit(0), F.col("mix_epochs").cast("int")))
    return epochs.select("given", times.alias("time")).select("given.*")


def _shared_epochs(met: DataFrame) -> DataFrame:
    """``(given, mix_epochs)`` of rows that are equal in id, source and text, whose epochs are dealt out evenly.

    The rows are numbered within their part of the input, of which each group has a count, so no group meets in one task.
    """
    group = ["mix_id", "mix_source", "mix_hash"]
    rows = written(met.withColumn("part", F.spark_partition_id()), "mix-repeated")
    counts = rows.groupBy(*group, "part").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy(*group).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(*[F.col(name).alias(f"start_{name}") for name in (*group, "part")], F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("start"))
    within = F.row_number().over(Window.partitionBy(*group, "part").orderBy(F.xxhash64("given")))
    same = [F.col(name).eqNullSafe(F.col(f"start_{name}")) for name in (*group, "part")]
    placed = rows.withColumn("place", within).join(starts, same)
    one_more = F.col("start") + F.col("place") <= F.col("mix_epochs") % F.col("mix_rows")
    share = F.floor(F.col("mix_epochs") / F.col("mix_rows")) + one_more.cast("int")
    return placed.select("given", share.alias("mix_epochs"))
