"""Hard-negative mining by slots between the positives' upper limits.

A negative is hard for an anchor and one of its positives if its score lies in a
window below the positive's. Windows of one anchor overlap, but their upper limits
cut the scores into disjoint slots: of each slot the best few rows are enough. Every
slab of rows keeps the best of each slot for every anchor, the slabs' bests are
reduced to those of all rows, and the windows are answered by merging the slots from
the highest limit downwards.

Rows are dealt into slabs of bounded size. The anchors, a stated part of all rows,
stream past each slab in blocks; nothing is broadcast, and no task holds more than a
slab and a block.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from .tables import store

# Scores computed at once: a block of anchors by the rows of a slab, or a part of it.
_SCORES = 1 << 20
_LOWEST = np.iinfo(np.int64).min


def _exact(a: np.ndarray, slab: _Slab) -> np.ndarray:
    """Integer inner products of anchors with the rows of a slab.

    Floats are exact as long as no sum of magnitudes passes their mantissa; beyond 64
    bits there is no result.
    """
    width = max(a.shape[1], slab.vector.shape[1])
    a, slab.vector = _widened(a, width), _widened(slab.vector, width)
    bound = _longest(a) * slab.longest * 1.01
    if bound < 2**24:
        return (a.astype(np.float32) @ slab.single().T).astype(np.int64)
    if bound < 2**53:
        return (a @ slab.vector.T).astype(np.int64)
    whole = [np.array([[int(v) for v in row] for row in x], object).reshape(x.shape) for x in (a, slab.vector)]
    scores = whole[0] @ whole[1].T
    if any(abs(v) >= 2**63 for v in scores.flat):
        raise OverflowError("scores of these vectors do not fit a long")
    return scores.astype(np.int64)


def _matrix(vectors: pa.Array) -> np.ndarray:
    """Lists of numbers as rows; shorter ones go on with zeros."""
    lengths = np.asarray(vectors.value_lengths())
    out = np.zeros((len(vectors), int(lengths.max(initial=0))))
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    at = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    out[np.repeat(np.arange(len(vectors)), lengths), at] = flat
    return out


def _longest(x: np.ndarray) -> float:
    return float(np.sqrt((x * x).sum(axis=1)).max(initial=0.0))


def _widened(x: np.ndarray, width: int) -> np.ndarray:
    return np.pad(x, ((0, 0), (0, width - x.shape[1]))) if x.shape[1] < width else x


class _Slab:
    """Rows of a slab by id: of equal scores the first has the smallest."""

    def __init__(self, batches: list[pa.RecordBatch]) -> None:
        rows = pa.Table.from_batches(batches).sort_by([("id", "ascending"), ("number", "ascending")])
        self.ids = rows["id"].combine_chunks()  # null ids are last
        self.number, self.label = rows["number"].to_numpy(), rows["label"].to_numpy()
        self.vector = _matrix(pa.concat_arrays(rows["vector"].chunks))
        self.longest = _longest(self.vector)
        self._single: np.ndarray | None = None

    def single(self) -> np.ndarray:
        """The vectors in single precision."""
        if self._single is None or self._single.shape != self.vector.shape:
            self._single = self.vector.astype(np.float32)
        return self._single


def _best(scores: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """(anchor, row) of the ``most`` highest scores of each anchor, the first row first
    where they are equal. Scores at the lowest number count as none. Overwrites."""
    anchors, rows = [], []
    every = np.arange(len(scores))
    for _ in range(min(most, scores.shape[1])):
        at = scores.argmax(axis=1)
        some = every[scores[every, at] > _LOWEST]
        if not len(some):
            break
        anchors.append(some)
        rows.append(at[some])
        scores[some, at[some]] = _LOWEST
    if not anchors:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(anchors), np.concatenate(rows)


Pick = Callable[[_Slab, np.ndarray, np.ndarray, pa.RecordBatch], Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]]


def _past_slabs(rows: DataFrame, anchors: DataFrame, slabs: int, pick: Pick) -> DataFrame:
    """(anchor, slot, score, number, id): what ``pick`` chooses of each slab for each anchor.

    Rows have id, number, label and vector, anchors also ``upper``, a list of numbers
    that may be empty. ``pick`` gets scores and yields (anchor, row, slot).
    """
    dealt = rows.select(
        F.pmod(F.xxhash64("number"), F.lit(slabs)).cast("int").alias("slab"), F.lit(0).alias("kind"),
        "id", "number", "label", "vector", F.lit(None).cast("array<long>").alias("upper"),
    )
    streamed = anchors.select(
        F.explode(F.sequence(F.lit(0), F.lit(slabs - 1))).alias("slab"), F.lit(1).alias("kind"),
        "id", "number", "label", "vector", "upper",
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slab, held, ready = None, [], None
        for batch in batches:
            kinds = batch.column(0).to_numpy().astype(np.int64) * 2 + batch.column(1).to_numpy()
            cuts = np.concatenate([[0], np.flatnonzero(np.diff(kinds)) + 1, [len(kinds)]])
            for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                if a == b:
                    continue
                part = batch.slice(a, b - a)
                if kinds[a] // 2 != slab:
                    slab, held, ready = kinds[a] // 2, [], None
                if kinds[a] % 2 == 0:
                    held.append(part)
                elif held:
                    ready = ready or _Slab(held)
                    yield from matched(ready, part)

    def matched(slab: _Slab, anchors: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        step = max(1, _SCORES // len(slab.number))
        for at in range(0, anchors.num_rows, step):
            some = anchors.slice(at, step)
            scores = _exact(_matrix(some.column("vector")), slab)
            number = some.column("number").to_numpy()
            for anchor, row, slot, score in pick(slab, scores, number, some):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(number[anchor]), pa.array(slot.astype(np.int32)), pa.array(score),
                     pa.array(slab.number[row]), slab.ids.take(pa.array(row))],
                    ["anchor", "slot", "score", "number", "id"],
                )

    both = dealt.union(streamed).repartition(slabs, "slab").sortWithinPartitions("slab", "kind")
    return both.mapInArrow(run, "anchor long, slot int, score long, number long, id long")


def _foremost(found: DataFrame, most: int) -> DataFrame:
    """The best of each anchor and slot over all slabs, as a sorted array ``best``.

    The limit on the rank is applied in each task before the shuffle already.
    """
    order = Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), F.col("id").isNull(), "id", "number")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)
    best = F.array_sort(F.collect_list(F.struct("rank", "id", "number", "score")))
    return ranked.groupBy("anchor", "slot").agg(best.alias("best"))


def _part(score: Column, percent: int, up: bool) -> Column:
    """A percentage of a long, rounded down or up, by hundreds and rest so as not to overflow."""
    rest = F.pmod(score, F.lit(100))
    hundreds = F.floor((score - rest).cast("decimal(20,0)") / 100).cast("long")
    small = F.ceil(rest * percent / 100) if up else F.floor(rest * percent / 100)
    return hundreds * percent + small.cast("long")


def _numbered_labels(rows: DataFrame) -> DataFrame:
    """Labels as long numbers; which does not matter, they are compared only."""
    if isinstance(rows.schema["label"].dataType, IntegralType):
        return rows.withColumn("label", F.col("label").cast("long"))
    names = rows.select("label").distinct().withColumn("of", F.monotonically_increasing_id())
    return rows.join(store(names, "labels"), "label").drop("label").withColumnRenamed("of", "label")


def hard_negatives(
    vectors: DataFrame,
    anchor: Column,
    positives: int = 5,
    negatives: int = 3,
    low_percent: int = 50,
    high_percent: int = 95,
    scale: int = 256,
    slab_rows: int = 100_000,
    id_column: str = "vec_id",
    label_column: str = "label",
    vector_column: str = "embedding",
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    A row's score is the inner product with the anchor of ``floor(scale * x)`` of all
    components; higher scores come first, of equal ones the smaller id (null ids last).
    Anchors are the rows for which ``anchor`` holds. An anchor's positives are its first
    ``positives`` other rows of the same label. Of the rows of another label, those whose
    score is from ``low_percent`` to ``high_percent`` of a positive's are hard for it, and
    the first ``negatives`` of them are given with their rank from 1. Positives without
    any have no row.

    Rows with a null label, a null vector or a null or non-finite component take no
    part. Vectors of different lengths are filled up with zeros. Repeated ids are rows of
    their own, also beside an anchor with the same id; only the anchor row itself is no
    positive of its own. Other columns are ignored; an empty table gives an empty result.
    Scores beyond 64 bits raise an error.

    A task holds a slab of about ``slab_rows`` rows, so their vectors must fit its
    memory; there are as many slabs as that takes, at least two for each core. Every
    anchor passes every slab twice, once for positives and once for negatives. An
    anchor's best rows are at most ``positives`` or ``negatives`` a slot and slab.
    """
    spark = vectors.sparkSession
    usable = F.forall(
        "vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    rows = (
        vectors.select(
            F.col(id_column).cast("long").alias("id"),
            F.coalesce(anchor, F.lit(False)).alias("asks"),
            F.col(label_column).alias("label"),
            F.col(vector_column).cast("array<double>").alias("vector"),
        )
        .where(F.col("label").isNotNull() & F.col("vector").isNotNull())
        .where(usable)
        .withColumn("vector", F.transform("vector", lambda x: F.floor(x * F.lit(float(scale))).cast("double")))
    )
    rows = store(_numbered_labels(rows).withColumn("number", F.monotonically_increasing_id()), "vectors")
    count = rows.count()
    slabs = max(-(-count // slab_rows), 2 * spark.sparkContext.defaultParallelism)
    asked = rows.where("asks").withColumn("upper", F.array().cast("array<long>"))

    def same(slab, scores, number, some):
        label = some.column("label").to_numpy()
        scores[label[:, None] != slab.label[None, :]] = _LOWEST
        scores[number[:, None] == slab.number[None, :]] = _LOWEST
        kept = scores.copy()
        a, r = _best(scores, positives)
        yield a, r, np.zeros(len(a)), kept[a, r]

    found = _past_slabs(rows, asked, slabs, same)
    best = store(_foremost(found, positives).select(F.col("anchor").alias("number"), "best"), "positives")

    # The highest score a hard negative can have, for each positive from the first on.
    limits = F.transform("best", lambda p: _part(p["score"], high_percent, up=False))
    limited = asked.drop("upper").join(best.select("number", limits.alias("upper")), "number")

    def other(slab, scores, number, some):
        label = some.column("label").to_numpy()
        scores[label[:, None] == slab.label[None, :]] = _LOWEST
        uppers = some.column("upper")
        upper = np.full((len(number), positives), _LOWEST)
        lengths = np.asarray(uppers.value_lengths())
        flat = uppers.flatten().to_numpy(zero_copy_only=False)
        at = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        upper[np.repeat(np.arange(len(number)), lengths), at] = flat
        for slot in range(positives):
            inside = scores <= upper[:, slot, None]
            if slot + 1 < positives:
                inside &= scores > upper[:, slot + 1, None]
            slotted = np.where(inside, scores, _LOWEST)
            a, r = _best(slotted, negatives)
            if len(a):
                yield a, r, np.full(len(a), slot), scores[a, r]

    found = _past_slabs(rows, limited, slabs, other)
    slots = _foremost(found, negatives)
    # At most negatives * positives rows for each anchor from here on.
    merged = slots.groupBy("anchor").agg(F.collect_list(F.struct("slot", "best")).alias("slots"))
    pairs = best.join(merged, best.number == merged.anchor).select(
        "number", "slots", F.posexplode("best").alias("slot", "positive")
    )
    # Slots from the positive's own downwards, each sorted: all scores up to its limit.
    lower = F.array_sort(F.filter("slots", lambda s: s["slot"] >= F.col("slot")))
    first = F.slice(F.flatten(F.transform(lower, lambda s: s["best"])), 1, negatives)
    hard = F.filter(first, lambda n: n["score"] >= _part(F.col("positive.score"), low_percent, up=True))
    answered = pairs.select("number", "positive", F.posexplode(hard).alias("at", "negative"))
    ids = asked.select("number", F.col("id").alias("anchor_id"))
    return answered.join(ids, "number").select(
        "anchor_id",
        F.col("positive.id").alias("positive_id"),
        (F.col("at") + 1).cast("int").alias("rank"),
        F.col("negative.id").alias("negative_id"),
        F.col("positive.score").alias("positive_score"),
        F.col("negative.score").alias("negative_score"),
    )
