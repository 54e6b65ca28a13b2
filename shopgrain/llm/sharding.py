"""Sharding of near-equal bytes by histogram sort.

Documents are ordered by a key of hashed text, hashed id and hashed row number. Candidate boundaries
are equally spaced keys; the exact bytes and rows between them are counted over
all partitions. Where a shard's splitter falls inside an interval that is too
large, the interval alone gets new candidates, until every splitter is within
tolerance. Then each row knows its interval, hence its shard, and one exchange by
interval numbers the rows. Only DataFrame functions are used.
"""

from __future__ import annotations

from bisect import bisect_right
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import store, text_or_empty

_KEY_BITS = 64
# Rows of an interval that one task puts in order, at most about this many.
_ROWS = 100_000


def _key(id_column: str, text_column: str) -> Column:
    """Equal texts have neighbouring keys; ids spread them within 16 further bits, and
    rows that share both by their ``number`` within the last 16."""
    text = F.expr(f"shiftrightunsigned(xxhash64(coalesce(`{text_column}`, '')), 32)")
    row = F.shiftleft(F.shiftrightunsigned(F.xxhash64(F.col(id_column), F.lit(1)), 48), 16)
    number = F.shiftrightunsigned(F.xxhash64("number", F.lit(2)), 48)
    return F.shiftleft(text, 32).bitwiseOR(row).bitwiseOR(number)


def _prefix(level: int, bits: int) -> Column:
    """The key's leading bits; the whole key, which may be negative, at the last level."""
    shift = _KEY_BITS - level * bits
    return F.shiftrightunsigned("key", shift) if shift > 0 else F.col("key")


def _interval(refined: list[set[int]], bits: int) -> Column:
    """(level, prefix) of the finest interval around a row's key."""
    place = F.struct(F.lit(len(refined) + 1).alias("level"), _prefix(len(refined) + 1, bits).alias("prefix"))
    for level in range(len(refined), 0, -1):
        here = F.struct(F.lit(level).alias("level"), _prefix(level, bits).alias("prefix"))
        chosen = sorted(refined[level - 1])
        place = F.when(_prefix(level, bits).isin(chosen), place).otherwise(here) if chosen else here
    return place


def _unsigned(level: int, prefix: int, bits: int) -> int:
    """Where an interval starts among unsigned keys."""
    return (prefix << max(0, _KEY_BITS - level * bits)) % (1 << _KEY_BITS)


def byte_shards(
    docs: DataFrame,
    shards: int = 40,
    id_column: str = "doc_id",
    text_column: str = "text",
    overhead: int = 16,
    tolerance: float = 0.002,
    bits: int | None = None,
    carry: bool = False,
) -> DataFrame:
    """One row per document: id, size, text_crc32, shard and slot.

    Size is the text's UTF-8 bytes (none if null) plus ``overhead``. Shards hold
    near-equal bytes: each splitter is within ``tolerance`` of a shard's share,
    or at the edge of one document if that is larger. Equal texts are neighbours,
    and a group of them is divided only where a splitter would miss its tolerance
    otherwise. Slots count the rows of a shard from 0 without gaps. A null text
    counts as empty, a null id as an id of its own; rows that share id and text
    are told apart by a number they get when they are stored, so they can be divided
    too. Other columns are ignored, but with ``carry`` they all come along, stored once,
    in a struct ``row``; an empty table gives an empty result.

    The driver sees candidate intervals only: 2**bits at first, and 2**bits for
    each interval refined, which are those around a splitter and those with more
    than a 2**(1-bits) part of all rows, fewer than shards + 2**(bits-1) a round.
    Rows are numbered interval by interval, so a task has to hold one interval's rows in
    order. ``bits`` follows the number of rows, so that an interval has some hundred
    thousand at most: 12 up to about 200 million rows, one more for each doubling, and 20
    from 50 billion on.
    """
    text = text_or_empty(text_column)
    columns = [
        F.col(id_column).alias("id"),
        (F.octet_length(text) + F.lit(overhead)).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    ]
    extra = ["row"] if carry else []
    row = [F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")] if carry else []
    # The key depends on the number, so both are computed and stored once.
    numbered = docs.select(*columns, text.alias("text"), F.monotonically_increasing_id().alias("number"), *row)
    whole = store(numbered.withColumn("key", _key("id", "text")).drop("text"), "shard-rows")
    rows = whole.drop(*extra)  # narrow: texts are read once, and rows that come along at the end

    if bits is None:
        bits = min(20, max(12, (2 * rows.count() // _ROWS).bit_length()))

    def count(frame: DataFrame, level: int) -> dict[tuple[int, int], tuple[int, int]]:
        counted = frame.groupBy(_prefix(level, bits).alias("prefix")).agg(
            F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows")
        )
        return {(level, r.prefix): (r.bytes, r.rows) for r in counted.collect()}

    found = count(rows, 1)
    total, n_rows = (sum(x[k] for x in found.values()) for k in (0, 1))
    goals = [total * k / shards for k in range(1, shards)]
    slack, most = total / shards * tolerance, max(1, n_rows >> (bits - 1))
    refined: list[set[int]] = []
    level = 1
    while level * bits < _KEY_BITS:
        order = sorted(found, key=lambda x: _unsigned(*x, bits))
        ends = list(accumulate(found[x][0] for x in order))
        split = {x for x in order if x[0] == level and found[x][1] > most}
        for goal in goals:
            k = bisect_right(ends, goal)
            if k < len(order) and min(ends[k] - goal, goal - (ends[k] - found[order[k]][0])) > slack:
                split.add(order[k])
        chosen = {prefix for at, prefix in split if at == level and found[(at, prefix)][1] > 1}
        if not chosen:
            break
        inside = rows.where(_prefix(level, bits).isin(sorted(chosen)))
        for prefix in chosen:
            del found[(level, prefix)]
        refined.append(chosen)
        level += 1
        found |= count(inside, level)

    order = sorted(found, key=lambda x: _unsigned(*x, bits))
    placed, before, used, shard = [], 0, 0, 0
    for x in order:
        size, n = found[x]
        # An interval goes to the side of a splitter on which most of it lies.
        while shard < shards - 1 and before + size / 2 > goals[shard]:
            shard, used = shard + 1, 0
        placed.append((x[0], x[1], shard, used))
        before, used = before + size, used + n
    places = docs.sparkSession.createDataFrame(
        placed, "level int, prefix long, shard int, first long"
    )
    at = whole.withColumn("at", _interval(refined, bits)).select(
        "id", "size", "text_crc32", "key", "number", "at.level", "at.prefix", *extra
    )
    numbered = at.join(places, ["level", "prefix"]).selectExpr(
        "id",
        "size",
        "text_crc32",
        "shard",
        "first + row_number() over (partition by level, prefix "
        "order by shiftright(key, 16), id, text_crc32, key, number) - 1 as slot",
        *extra,
    )
    return numbered.withColumnRenamed("id", id_column)
