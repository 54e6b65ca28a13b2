"""Periodic runs of words by longest common extensions in suffix trees.

A run is a stretch of words that repeats with a smallest period and cannot be made
longer. Every run with at least two periods has a Lyndon root: for the order of
words or its reverse, the longest Lyndon word at some place of it is one period
long. So two candidates for each place suffice. They come from the ranks of the
suffixes, are extended to the right by the longest common prefix of two suffixes and
to the left by that of two suffixes of the reversal, and those that reach two
periods are the runs.

Both texts get a suffix tree by Ukkonen's method; the common prefix of two suffixes
is the depth of their lowest common ancestor, the minimum over the Euler tour between
them, which a sparse table gives in constant time.

Only stretches of which every three consecutive words occur often enough for a run
are given a tree: a run of four periods, or of six words, holds each of them at least
three times. Longer exponents are asked for by ``least_periods``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .windows import Chunk, grams

Run = tuple[int, int, int]  # start, length, period

_GRAM = 3
# Words looked at together; longer texts are looked at on their own.
_WORDS = 200_000
# Texts for which results are sent together.
_ROWS = 2_000


class SuffixTree:
    """Suffixes of a list of numbers in order, with the common prefixes of neighbours.

    The list ends with a zero that occurs nowhere else.
    """

    def __init__(self, symbols: list[int]) -> None:
        self.n = len(symbols)
        self.children, self.begin, self.end = _ukkonen(symbols)

    def tour(self, reverse: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """(suffixes, depths): the leaves from left to right, and for each the depth of
        the inner node that the Euler tour visits last before it comes up from below,
        the lowest common ancestor of the leaf and the one before. ``reverse``
        turns the order of symbols around, but the end stays the least."""
        children, begin, end, n = self.children, self.begin, self.end, self.n
        suffixes, depths = [], []
        stack = [(0, 0, 0)]
        while stack:
            node, depth, above = stack.pop()
            below = children[node]
            if below is None:
                suffixes.append(begin[node] - depth)
                depths.append(above)
                continue
            if node:
                depth += end[node] - begin[node]
            named = sorted(below, reverse=reverse)
            if reverse and named[-1] == 0:
                named.insert(0, named.pop())
            for symbol in named[:0:-1]:
                stack.append((below[symbol], depth, depth))
            stack.append((below[named[0]], depth, above))
        return np.array(suffixes, np.int64), np.array(depths, np.int32)


def _ukkonen(symbols: list[int]) -> tuple[list, list[int], list[int]]:
    """Children by first symbol (None for a leaf), and edge labels as spans."""
    n = len(symbols)
    children: list[dict[int, int] | None] = [{}]
    begin, end, link = [0], [0], [0]
    node = edge = length = waiting = 0
    for i, symbol in enumerate(symbols):
        waiting += 1
        pending = 0
        while waiting:
            if not length:
                edge = i
            below = children[node]
            at = below.get(symbols[edge])
            if at is None:
                below[symbols[edge]] = len(begin)
                begin.append(i)
                end.append(n)
                link.append(0)
                children.append(None)
                if pending:
                    link[pending] = node
                    pending = 0
            else:
                span = (end[at] if end[at] <= i else i + 1) - begin[at]
                if length >= span:
                    edge += span
                    length -= span
                    node = at
                    continue
                other = symbols[begin[at] + length]
                if other == symbol:
                    length += 1
                    if pending:
                        link[pending] = node
                    break
                split = len(begin)
                begin += (begin[at], i)
                begin[at] += length
                end += (begin[at], n)
                link += (0, 0)
                children.append({symbol: split + 1, other: at})
                children.append(None)
                below[symbols[edge]] = split
                if pending:
                    link[pending] = split
                pending = split
            waiting -= 1
            if node:
                node = link[node]
            elif length:
                length -= 1
                edge = i - waiting + 1
    return children, begin, end


class Extensions:
    """Longest common prefixes of pairs of suffixes of one tree."""

    def __init__(self, suffixes: np.ndarray, depths: np.ndarray) -> None:
        self.n = len(suffixes)
        self.place = np.empty(self.n, np.int64)
        self.place[suffixes] = np.arange(self.n)
        self.least = [depths]
        width = 1
        while 2 * width <= self.n:
            last = self.least[-1]
            self.least.append(np.minimum(last[:-width], last[width:]))
            width *= 2

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """For pairs of different suffixes."""
        low = np.minimum(self.place[a], self.place[b]) + 1
        high = np.maximum(self.place[a], self.place[b])
        level = np.frexp((high - low + 1).astype(np.float64))[1] - 1
        out = np.empty(len(low), np.int64)
        for k in np.unique(level).tolist():
            some = np.flatnonzero(level == k)
            table = self.least[k]
            out[some] = np.minimum(table[low[some]], table[high[some] + 1 - (1 << k)])
        return out


def _next_smaller(ranks: list[int]) -> list[int]:
    """For each place the next one with a smaller rank; the last place has the least."""
    out = [0] * len(ranks)
    open_ones: list[int] = []
    for place, rank in enumerate(ranks):
        while open_ones and ranks[open_ones[-1]] > rank:
            out[open_ones.pop()] = place
        open_ones.append(place)
    return out


def runs(symbols: list[int]) -> list[Run]:
    """All runs of at least two periods of a list of positive numbers, sorted."""
    n = len(symbols)
    if n < 2:
        return []
    forward = SuffixTree([*symbols, 0])
    suffixes, depths = forward.tour()
    right = Extensions(suffixes, depths)
    ends = [_next_smaller(right.place.tolist())]
    turned = np.empty(n + 1, np.int64)
    turned[forward.tour(reverse=True)[0]] = np.arange(n + 1)
    ends.append(_next_smaller(turned.tolist()))
    del forward
    backward = SuffixTree([*symbols[::-1], 0])
    left = Extensions(*backward.tour())
    del backward
    place = np.tile(np.arange(n), 2)
    period = np.concatenate([np.array(e[:n], np.int64) for e in ends]) - place
    # A Lyndon word that ends with the text may go on to its end only; it is no period
    # of anything to the right, but may be of what is to its left.
    after = place + period
    start, stop = place.copy(), after.copy()
    inside = after < n
    stop[inside] += right.common(place[inside], after[inside])
    # The word before place k is number n - k of the reversal.
    first = place > 0
    start[first] -= left.common(n - place[first], n - after[first])
    long = stop - start >= 2 * period
    found = np.unique(np.stack([start[long], (stop - start)[long], period[long]], axis=1), axis=0)
    return [tuple(r) for r in found.tolist()]


def stretches(chunk: Chunk) -> Iterator[tuple[int, int, int]]:
    """(part, first word, words) of stretches outside of which no run can be: maximal
    ones of which each three consecutive words occur three times or more in the stretch."""
    codes = chunk.codes()
    if len(codes) < 2 * _GRAM:
        return
    hashed = grams(codes, _GRAM)
    ends = np.cumsum(chunk.bytes)
    at = np.arange(len(hashed))
    owner = np.searchsorted(ends, at, "right")
    at = at[at + _GRAM <= ends[owner]]
    # Equal hashes of different words can only make a stretch longer than needed.
    while len(at):
        breaks = np.ones(len(at), bool)
        breaks[1:] = (at[1:] != at[:-1] + 1) | (owner[at[1:]] != owner[at[:-1]])
        stretch = np.cumsum(breaks) - 1
        sizes = np.bincount(stretch)
        keep = sizes[stretch] > _GRAM
        at, stretch = at[keep], stretch[keep]
        if not len(at):
            return
        key = hashed[at] ^ (stretch.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        cut = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1], [True]]))
        counts = np.repeat(np.diff(cut), np.diff(cut))
        often = np.empty(len(at), bool)
        often[order] = counts >= 3
        if often.all():
            break
        at = at[often]
    else:
        return
    starts = ends - chunk.bytes
    cuts = np.concatenate([[0], np.flatnonzero(np.diff(stretch)) + 1, [len(at)]])
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        part = int(owner[at[a]])
        yield part, int(at[a] - starts[part]), b - a + _GRAM - 1


def text_runs(words: list[bytes], least_length: int, least_periods: int, where: list[tuple[int, int]]) -> list[Run]:
    """Runs of a text in the stretches ``where``, sorted by start and period."""
    found: list[Run] = []
    for first, n in where:
        names: dict[bytes, int] = {}
        symbols = [names.setdefault(w, len(names) + 1) for w in words[first : first + n]]
        for start, length, period in runs(symbols):
            if length >= max(least_length, least_periods * period):
                found.append((first + start, length, period))
    return sorted(found, key=lambda r: (r[0], r[2]))


def collapsed(words: list[bytes], found: list[Run]) -> list[bytes]:
    """The words without those that any run repeats."""
    if not found:
        return words
    gone = np.zeros(len(words) + 1, np.int64)
    for start, length, period in found:
        gone[start + period] += 1
        gone[start + length] -= 1
    kept = np.flatnonzero(np.cumsum(gone)[:-1] == 0)
    return [words[k] for k in kept.tolist()]


def _chunks(texts: pa.Array) -> Iterator[list[list[bytes]]]:
    held: list[list[bytes]] = []
    size = 0
    for text in texts:
        words = (text.as_py() or "").encode("utf-8", "surrogatepass").split()
        held.append(words)
        size += len(words)
        if size >= _WORDS or len(held) >= _ROWS:
            yield held
            held, size = [], 0
    if held:
        yield held


def _found(texts: list[list[bytes]], least_length: int, least_periods: int) -> list[list[Run]]:
    """Runs of each text."""
    chunk = Chunk(words=True)
    for row, words in enumerate(texts):
        if len(words) >= least_length:
            chunk.add(row, 0, b" ".join(words), len(words))
    where: list[list[tuple[int, int]]] = [[] for _ in texts]
    if chunk.rows:
        for part, first, n in stretches(chunk):
            where[chunk.rows[part]].append((first, n))
    return [text_runs(w, least_length, least_periods, s) if s else [] for w, s in zip(texts, where)]


def periodic_runs(
    docs: DataFrame,
    least_length: int = 6,
    least_periods: int = 4,
    id_column: str = "doc_id",
    text_column: str = "text",
    with_text: bool = False,
) -> DataFrame:
    """One row per document: id, n_runs, the run of the greatest exponent (start, length,
    period, exponent_milli), runs_sha256 and collapsed_sha256.

    A run is a stretch of words with smallest period q that no neighbouring word
    extends, at least ``least_length`` words and ``least_periods`` periods long (four and
    six at least). The greatest exponent is the greatest exact length / period; ties go
    to the smaller start, then period. ``runs_sha256`` is of the lines "start,length,period"
    of all runs, ``collapsed_sha256`` of the words that are left when each run keeps its
    first period only. ``with_text`` adds ``collapsed`` and ``runs``, an array.

    A null or wordless text has no run: start to exponent_milli are null, the sums are
    those of nothing. Repeated rows each get their row, ids are only carried, other
    columns are ignored; an empty table gives an empty result. Documents are independent:
    nothing is shuffled, and a task holds some 200,000 words at once, or one longer text.
    """
    if least_length < 6 or least_periods < 4:
        raise ValueError("runs are searched from six words and four periods on")
    id_type = docs.schema[id_column].dataType.simpleString()
    schema = (
        f"`{id_column}` {id_type}, n_runs long, start long, length long, period long, exponent_milli long, "
        "runs_sha256 string, collapsed_sha256 string"
    )
    numbers = ["n_runs", "start", "length", "period", "exponent_milli"]
    names = [id_column, *numbers, "runs_sha256", "collapsed_sha256"]
    run_type = pa.struct([(c, pa.int64()) for c in ("start", "length", "period")])
    if with_text:
        schema += ", collapsed string, runs array<struct<start: long, length: long, period: long>>"
        names += ["collapsed", "runs"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for texts in _chunks(batch.column(1)):
                rows, left_over = [], []
                all_found = _found(texts, least_length, least_periods)
                for words, found in zip(texts, all_found):
                    best = (None, None, None)
                    if found:
                        best = max(found, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]))
                    lines = "".join(f"{s},{n},{p}\n" for s, n, p in found)
                    left = b" ".join(collapsed(words, found))
                    exponent = 1000 * best[1] // best[2] if found else None
                    shas = (hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(left).hexdigest())
                    rows.append((len(found), *best, exponent, *shas))
                    if with_text:
                        left_over.append(left.decode("utf-8", "surrogatepass"))
                columns = list(zip(*rows))
                arrays = [pa.array(c, pa.int64()) for c in columns[:5]] + [pa.array(c, pa.string()) for c in columns[5:]]
                if with_text:
                    listed = [[dict(zip(("start", "length", "period"), r)) for r in f] for f in all_found]
                    arrays += [pa.array(left_over, pa.string()), pa.array(listed, pa.list_(run_type))]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(texts)), *arrays], names)
                at += len(texts)

    return docs.select(id_column, text_column).mapInArrow(run, schema)
