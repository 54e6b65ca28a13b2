"""Mixing sources to target weights by prefix sums of hash-random order.

Every document gets a random key by hash. Documents are range-sorted by source
and key, running word counts are summed within and across partitions, and each
source is cut where its budget is used up, after as many whole epochs as fit.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .tables import WORDS, store, word_count


def _targets(sizes: DataFrame, weights: Sequence[float], most_epochs: float) -> DataFrame:
    """(source, source_size, target) by sharing all sizes out by weight.

    Sources over their limit stay at it, and what they leave is shared out again
    by weight. With sources sorted by limit / weight, those at their limit come
    first, so the level of the rest follows from running sums, in one pass. One task
    holds a row of a few numbers for each source: sources are kinds of data, up to some
    hundred thousand. For hosts or users as sources, group them before.
    """
    by_name = Window.orderBy(F.col("source").isNull(), F.col("source").cast("binary"))
    weight = F.element_at(
        F.array(*[F.lit(float(w)) for w in weights]),
        (F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1).cast("int"),
    )
    ranked = sizes.withColumn("weight", weight).withColumn("most", F.col("source_size") * most_epochs)
    order = Window.orderBy(F.col("most") / F.col("weight"), F.col("source").isNull(), "source")
    upto = order.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    level = (F.sum("source_size").over(everything) - F.coalesce(F.sum("most").over(upto), F.lit(0.0))) / (
        F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(upto), F.lit(0.0))
    )
    # The first source that its share does not fill up sets the level for all.
    room = F.when(F.col("level") * F.col("weight") < F.col("most"), F.col("level"))
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    shared = ranked.withColumn("level", level).withColumn(
        "final", F.first(room, ignorenulls=True).over(whole)
    )
    full = F.col("final").isNull() | (F.col("final") * F.col("weight") >= F.col("most"))
    return shared.select(
        "source",
        "source_size",
        F.when(full, F.col("most").cast("double")).otherwise(F.col("final") * F.col("weight")).alias("target"),
    )


def _placed(
    rows: DataFrame,
    weights: Sequence[float],
    most_epochs: int,
    columns: Sequence[str],
) -> DataFrame:
    """Rows of (source, size, ``columns``) with their source's size, target and budget in
    whole words, whole epochs, words that are left for the last epoch, and the words of the
    source before them in the order of ``columns``."""
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = store(_targets(sizes, weights, most_epochs), "mix-targets")
    partitions = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["none", "source", *columns]
    ordered = rows.withColumn("none", F.col("source").isNull()).repartitionByRange(partitions, *order)
    ordered = ordered.sortWithinPartitions(*order).drop("none").withColumn("part", F.spark_partition_id())
    schema = type(ordered.schema)([*ordered.schema]).add("upto", "long")

    def running(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Words of a source in this partition up to and including each row."""
        source, total = None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            runs = pc.run_end_encode(batch.column("source"))
            ends = runs.run_ends.to_numpy()
            starts = np.concatenate([[0], ends[:-1]])
            upto = np.cumsum(batch.column("size").to_numpy())
            before = np.where(starts > 0, upto[starts - 1], 0)
            # The first source may go on from the batch before.
            if runs.values[0].as_py() == source:
                before[0] -= total
            upto = upto - np.repeat(before, ends - starts)
            source, total = runs.values[len(ends) - 1].as_py(), int(upto[-1])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(upto)], [*batch.schema.names, "upto"])

    summed = store(ordered.mapInArrow(running, schema), "mix-sums")
    # One row for each partition and source in it: as many as both together.
    parts = summed.groupBy("source", "part").agg(F.max("upto").alias("words"))
    earlier = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(
        "source", "part", F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("before")
    )
    placed = summed.alias("r").join(parts.alias("p"), F.expr("r.source <=> p.source and r.part = p.part"))
    placed = placed.join(targets.alias("t"), F.expr("r.source <=> t.source"))
    budget = F.floor("target")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(F.lit(0))
    return placed.select(
        "r.source", "size", *columns, "source_size", "target",
        epochs.alias("epochs"),
        (budget - epochs * F.col("source_size")).alias("rest"),
        (F.col("upto") + F.col("before") - F.col("size")).alias("earlier"),
    )


def _sized(docs: DataFrame, seed: int, id_column: str, text_column: str, source_column: str) -> list[Column]:
    """Source, size and random order of documents."""
    return [
        F.col(source_column).cast("string").alias("source"),
        word_count(text_column).alias("size"),
        F.md5(F.concat_ws(":", F.col(id_column).cast("string"), F.lit(str(seed)))).alias("key"),
        F.xxhash64(text_column).alias("tie"),  # for texts that share an id
    ]


def mix(
    docs: DataFrame,
    weights: Sequence[float] = (1, 2, 3),
    most_epochs: int = 3,
    seed: int = 7,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
) -> DataFrame:
    """One row per document: id, source, size, source_size, target and taken.

    Size is the number of words (null text: none). Sources in code point order,
    null last, weigh ``weights`` in turn and share the words of all of them;
    targets stop at ``most_epochs`` times their source's size. ``taken`` is the
    number of the document's words in the mix, repeats counted: whole epochs, and
    in the last one the documents that come first in random order, of which the
    one at the cut is taken in part, so a source's taken words are its target
    rounded down. Reruns give the same rows. Rows that share id and text follow
    one another in the order. Other columns are ignored; an empty table gives an
    empty result.
    """
    sized = docs.select(F.col(id_column).alias("id"), *_sized(docs, seed, id_column, text_column, source_column))
    sized = store(sized, "mix-sizes")  # narrow, so that texts are read once
    placed = _placed(sized, weights, most_epochs, ["key", "tie", "id"])
    part = F.greatest(F.lit(0), F.least(F.col("size"), F.col("rest") - F.col("earlier")))
    return placed.select(
        F.col("id").alias(id_column),
        F.col("source").alias(source_column),
        "size",
        "source_size",
        "target",
        (F.col("epochs") * F.col("size") + part).cast("long").alias("taken"),
    )


def mixed_rows(
    docs: DataFrame,
    weights: Sequence[float] = (1, 2, 3),
    most_epochs: int = 3,
    seed: int = 7,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
    length_column: str = "n_chars",
) -> DataFrame:
    """The mix as documents, with the columns of ``docs``: a row for each whole copy, and
    one with the first words only, joined by single spaces, where a source is cut.
    Documents without words take no part.

    Only sizes and keys are sorted. What they give is one row for each source, its epochs
    and the place of its cut in the random order, and with that every document says itself
    how often it is taken: whole documents meet a small table and are not shuffled.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    numbered = docs.select(row, *_sized(docs, seed, id_column, text_column, source_column))
    # Numbers tell rows apart that share id and text, so they must not change any more.
    numbered = store(numbered.withColumn("number", F.monotonically_increasing_id()), "mix-rows")
    order = ["key", "tie", "number"]
    placed = _placed(numbered.select("source", "size", *order), weights, most_epochs, order)
    at_cut = (F.col("earlier") < F.col("rest")) & (F.col("rest") <= F.col("earlier") + F.col("size"))
    cuts = placed.groupBy("source").agg(
        F.first("epochs").alias("epochs"),
        F.max(F.when(at_cut, F.struct(*order))).alias("cut"),
        F.max(F.when(at_cut, F.col("rest") - F.col("earlier"))).alias("part"),
    )
    cuts = store(cuts, "mix-cuts")
    here = F.struct(*order)
    # Without a cut nothing is left for the last epoch.
    part = F.when(here < F.col("cut"), F.col("size")).when(here == F.col("cut"), F.col("part")).otherwise(0)
    taken = F.col("epochs") * F.col("size") + part
    mixed = numbered.alias("r").join(cuts.alias("c"), F.expr("r.source <=> c.source"))
    mixed = mixed.select("row", "size", taken.alias("taken")).where("taken > 0")
    copies = F.ceil(F.col("taken") / F.col("size")).cast("int")
    each = mixed.withColumn("copy", F.explode(F.sequence(F.lit(1), copies)))
    left = (F.col("taken") - (F.col("copy") - 1) * F.col("size")).cast("int")
    cut = left < F.col("size")
    words = F.regexp_extract_all(F.col(f"row.{text_column}"), F.lit(f"({WORDS})"), F.lit(1))
    text = F.when(cut, F.array_join(F.slice(words, 1, left), " ")).otherwise(F.col(f"row.{text_column}"))
    changed = {text_column: text}
    if length_column in docs.columns:
        length = F.length(text).cast(docs.schema[length_column].dataType)
        changed[length_column] = F.when(cut, length).otherwise(F.col(f"row.{length_column}"))
    return each.select(*[changed.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])
