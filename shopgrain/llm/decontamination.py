"""Benchmark decontamination by pigeonhole edit matching.

A test item that occurs in a document with at most k edits keeps at least one of any
k + 1 pieces intact. One automaton finds the pieces of all items exactly; around
each hit the least edit distance of the whole item is found with Myers' bit-parallel
method.

The same argument holds for halves of an item: of any run of L pieces with at most
L - 1 edits, one half has fewer edits than pieces. So some intact piece has all the
halves around it within their budgets, and a hit is tried on the smallest half
first, which turns most chance hits away at the price of a few characters.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import ahocorasick
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import smaller_batches, store

# Items are sent to the tasks in blocks of about this many characters.
_BLOCK = 16 << 20


def normalise(text: str | None) -> str:
    """Lower case, white space as single spaces."""
    return " ".join((text or "").lower().split())


def edit_budget(length: int, rate: float) -> int:
    return int(length * rate)


class Pattern:
    """Approximate search for one item."""

    def __init__(self, item: str) -> None:
        self.item, self.n = item, len(item)
        self.masks: dict[str, int] = {}
        for k, c in enumerate(item):
            self.masks[c] = self.masks.get(c, 0) | 1 << k

    def _columns(self, text: str) -> Iterator[int]:
        """Least distance of the item to a part of the text that ends at each place."""
        full, top = (1 << self.n) - 1, 1 << (self.n - 1)
        plus, minus, score = full, 0, self.n
        get = self.masks.get
        for c in text:
            match = get(c, 0)
            diagonal = (((match & plus) + plus) ^ plus) | match | minus
            up = minus | ~(diagonal | plus) & full
            down = plus & diagonal
            if up & top:
                score += 1
            elif down & top:
                score -= 1
            up, down = (up << 1) & full, (down << 1) & full
            plus = (down | ~((match | minus) | up)) & full
            minus = up & (match | minus)
            yield score

    def within(self, text: str, most: int) -> bool:
        """Whether the item occurs with at most ``most`` edits."""
        return self.item in text or any(score <= most for score in self._columns(text))

    def best(self, text: str, most: int) -> tuple[int, int] | None:
        """(distance, end) of the first best occurrence with at most ``most`` edits."""
        at = text.find(self.item)
        if at >= 0:
            return 0, at + self.n
        found = None
        for end, score in enumerate(self._columns(text), 1):
            if score <= most:
                found, most = (score, end), score - 1
                if not score:
                    break
        return found


class Matcher:
    """All items of a block."""

    def __init__(self, items: list[tuple], rate: float) -> None:
        self.items = []
        self.pieces = ahocorasick.Automaton()
        for name, text in items:
            text = normalise(text)
            if not text:
                continue
            budget = edit_budget(len(text), rate)
            self.items.append((name, Pattern(text), budget))
            cuts = [len(text) * k // (budget + 1) for k in range(budget + 2)]
            self._split(text, cuts, 0, budget + 1, ())
        if len(self.pieces):
            self.pieces.make_automaton()

    def _split(self, text: str, cuts: list[int], low: int, high: int, around: tuple) -> None:
        """Add the pieces ``low`` to ``high`` of the last item; ``around`` has the runs
        of pieces they are in, smallest first, but not the whole item."""
        start, end = cuts[low], cuts[high]
        if high - low == 1:
            piece = text[start:end]
            known = self.pieces.get(piece, None)
            if known is None:
                self.pieces.add_word(piece, known := (len(piece), []))
            known[1].append((len(self.items) - 1, start, around))
            return
        if high - low < len(cuts) - 1:
            around = ((start, end, high - low - 1, Pattern(text[start:end])), *around)
        middle = (low + high) // 2
        self._split(text, cuts, low, middle, around)
        self._split(text, cuts, middle, high, around)

    def hits(self, text: str | None) -> Iterator[tuple]:
        """(item, distance, start, end) for each item that occurs; the place, in
        characters of the normalised text, is that of its first best occurrence."""
        if not len(self.pieces):
            return
        text = normalise(text)
        found_at: dict[int, list[list[int]]] = {}
        for last, (length, uses) in self.pieces.iter(text):
            at = last + 1 - length
            for k, start, around in uses:
                if not all(
                    part.within(text[max(0, at - start + a - edits) : at - start + b + edits], edits)
                    for a, b, edits, part in around
                ):
                    continue
                _, pattern, budget = self.items[k]
                low = max(0, at - start - budget)
                high = min(len(text), at - start + pattern.n + budget)
                regions = found_at.setdefault(k, [])
                if regions and low <= regions[-1][1] and low >= regions[-1][0]:
                    regions[-1][1] = max(regions[-1][1], high)
                else:
                    regions.append([low, high])
        for k in sorted(found_at):
            name, pattern, budget = self.items[k]
            best = None
            most = budget
            for low, high in found_at[k]:
                if (found := pattern.best(text[low:high], most)) is not None:
                    best = (found[0], low + found[1])
                    most = found[0] - 1
                    if most < 0:
                        break
            if best is not None:
                distance, end = best
                # Searched backwards from its end, the item begins where its reverse ends.
                back = text[max(0, end - pattern.n - budget) : end][::-1]
                start = end - Pattern(pattern.item[::-1]).best(back, distance)[1]
                yield name, distance, start, end


def _stored_items(items: DataFrame, text_column: str) -> tuple[DataFrame, int]:
    """Different item texts with a number, and how many blocks they make."""
    texts = items.select(F.col(text_column).alias("text")).where("text is not null").distinct()
    texts = store(texts.withColumn("number", F.monotonically_increasing_id()), "items")
    size = texts.agg(F.sum(F.length("text"))).first()[0] or 0
    return texts, 1 + size // _BLOCK


def _block(texts: DataFrame, k: int, blocks: int) -> Broadcast:
    """A block of item texts: about _BLOCK characters, or one longer item."""
    rows = texts.where(F.pmod(F.xxhash64("text"), F.lit(blocks)) == k).select("number", "text").collect()
    return texts.sparkSession.sparkContext.broadcast([tuple(r) for r in rows])


def _scan(known: Broadcast, rate: float) -> Callable:
    """Batches of (id, text) to the hits of a block's items."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(known.value, rate)
        names = ["doc", "number", "distance", "start", "end"]
        for batch in batches:
            found = [(k, *hit) for k, text in enumerate(batch.column(1)) for hit in matcher.hits(text.as_py())]
            where, *numbers = zip(*found) if found else ((),) * 5
            ids = batch.column(0).take(pa.array(where, pa.int64()))
            yield pa.RecordBatch.from_arrays([ids, *(pa.array(n, pa.int64()) for n in numbers)], names)

    return run


def _free_of(known: Broadcast, rate: float) -> Callable:
    """A function of texts: whether none of a block's items occurs."""

    @F.arrow_udf("boolean")
    def free(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        matcher = Matcher(known.value, rate)
        for texts in batches:
            yield pa.array([next(matcher.hits(t.as_py()), None) is None for t in texts], pa.bool_())

    return free


def contaminated(
    docs: DataFrame,
    items: DataFrame,
    rate: float = 0.1,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_id_column: str = "item_id",
    item_text_column: str = "text",
) -> DataFrame:
    """One row for each document and item that occurs in it: id, item_id, distance,
    start and end of the first best occurrence in the normalised text.

    Both sides are lower-cased with white space as single spaces. An item of n
    characters occurs if some part of the text is within ``int(rate * n)`` edits of all
    of it. Null and empty items match nothing, null and empty texts contain nothing.
    A row that is repeated is reported as often; repeated items too. Other columns
    are ignored; an empty table gives an empty result.

    Items are reduced to different texts. These go to the tasks in blocks of about 16
    million characters, one after another: a block is collected, scanned for in one pass
    over the documents, its hits are stored, and it is dropped.
    """
    smaller_batches(docs.sparkSession)
    id_type = docs.schema[id_column].dataType.simpleString()
    schema = f"doc {id_type}, number long, distance long, start long, end long"
    rows = docs.select(F.col(id_column).alias("doc"), F.col(text_column))
    texts, blocks = _stored_items(items, item_text_column)
    hits = []
    for k in range(blocks):
        known = _block(texts, k, blocks)
        hits.append(store(rows.mapInArrow(_scan(known, rate), schema), "hits"))
        known.unpersist()
    named = items.select(F.col(item_id_column).alias("item"), F.col(item_text_column).alias("text"))
    numbered = texts.join(named, "text").select("number", "item")
    found = reduce(DataFrame.unionByName, hits).join(numbered, "number")
    return found.select(
        F.col("doc").alias(id_column), F.col("item").alias(item_id_column), "distance", "start", "end"
    )


def clean_documents(
    docs: DataFrame,
    items: DataFrame,
    rate: float = 0.1,
    text_column: str = "text",
    item_text_column: str = "text",
) -> DataFrame:
    """The documents, with all their columns, that contain none of the items, by the rules
    of ``contaminated``. What a block of items leaves is stored before the next one."""
    smaller_batches(docs.sparkSession)
    texts, blocks = _stored_items(items, item_text_column)
    for k in range(blocks):
        known = _block(texts, k, blocks)
        docs = docs.where(_free_of(known, rate)(F.col(text_column)))
        if k + 1 < blocks:
            docs = store(docs, "clean")
            known.unpersist()
    return docs
