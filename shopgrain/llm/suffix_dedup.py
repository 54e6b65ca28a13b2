"""Repeated byte strings by threshold-bounded interval expansion.

Each bucket's fragments get a Burrows-Wheeler transform. Starting from single
bytes, the intervals of all strings are extended backwards, breadth first, so that
common prefixes of neighbouring suffixes are found in increasing order; the search
stops at the minimum length, and neighbours that are undecided by then share at
least that many bytes. An interval is expanded over the runs of equal bytes in the
transform, of which repetitive fragments have few.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .windows import Shape, cut_in_parts, merged, repeated_spans, with_spans

_FIRST = 7  # symbols of nine bits that fit one key


def suffix_order(symbols: np.ndarray, least: int) -> np.ndarray:
    """Suffixes sorted by at least ``least`` symbols. Zero ends a fragment; each zero
    is a symbol of its own, in order of place."""
    n = len(symbols)
    padded = np.concatenate([symbols, np.zeros(_FIRST, symbols.dtype)]).astype(np.uint64)
    key = np.zeros(n, np.uint64)
    ended = np.zeros(n, bool)
    for k in range(_FIRST):
        part = padded[k : k + n]
        ended |= part == 0
        key = (key << np.uint64(9)) | np.where(ended, np.uint64(0), part)
    order = np.argsort(key, kind="stable")
    ordered = key[order]
    new = np.ones(n, bool)
    new[1:] = (ordered[1:] != ordered[:-1]) | ended[order[1:]]
    rank = np.empty(n + 2 * least, np.int64)
    slot = np.flatnonzero(new)[np.cumsum(new) - 1]
    rank[order] = slot
    alone = new & np.concatenate([new[1:], [True]])
    open_ones = order[~alone]
    have = _FIRST
    while have < least and len(open_ones):
        key = (rank[open_ones].astype(np.uint64) << np.uint64(32)) | rank[open_ones + have].astype(np.uint64)
        by = np.argsort(key)
        open_ones, key = open_ones[by], key[by]
        group = (key >> np.uint64(32)).astype(np.int64)
        heads = np.concatenate([[True], group[1:] != group[:-1]])
        inside = np.arange(len(group)) - np.flatnonzero(heads)[np.cumsum(heads) - 1]
        order[group + inside] = open_ones
        new = np.concatenate([[True], key[1:] != key[:-1]])
        slot = (group + inside)[np.flatnonzero(new)[np.cumsum(new) - 1]]
        rank[open_ones] = slot
        alone = new & np.concatenate([new[1:], [True]])
        open_ones = open_ones[~alone]
        have *= 2
    return order


def undecided(symbols: np.ndarray, order: np.ndarray, ends: int, least: int) -> np.ndarray:
    """For each suffix in order, whether it shares ``least`` symbols with the one
    before. Suffixes that begin with one of the ``ends`` zeros come first."""
    n = len(symbols)
    before = symbols[order - 1]  # place -1 is the last zero, which ends the text
    # Last-to-first mapping; what follows an end of a fragment is not extended over it.
    step = np.empty(n, np.int64)
    step[np.argsort(before, kind="stable")] = np.arange(n)
    head = symbols[order]
    edge = np.concatenate([[True], before[1:] != before[:-1]]) | (before == 0)
    run = np.cumsum(edge) - 1
    run_start = np.flatnonzero(edge)
    run_stop = np.concatenate([run_start[1:], [n]]) - 1
    open_ones = np.ones(n + 1, bool)
    open_ones[0] = open_ones[n] = False
    first = np.concatenate([[True], (head[1:] != head[:-1]) | (head[1:] == 0)])
    low = np.flatnonzero(first)
    high = np.concatenate([low[1:], [n]]) - 1
    open_ones[high + 1] = False
    for _ in range(1, least):
        if not len(low):
            break
        a, b = run[low], run[high]
        width = b - a + 1
        owner = np.repeat(np.arange(len(low)), width)
        runs = np.arange(len(owner)) - np.repeat(np.cumsum(width) - width - a, width)
        start = np.maximum(run_start[runs], low[owner])
        inner = before[start] != 0
        owner, runs, start = owner[inner], runs[inner], start[inner]
        stop = np.minimum(run_stop[runs], high[owner])
        # Runs of one byte in one interval map to neighbouring places.
        new_low = step[start]
        new_high = new_low + (stop - start)
        by = np.argsort(new_low)
        new_low, new_high, owner = new_low[by], new_high[by], owner[by]
        split = np.ones(len(new_low), bool)
        split[1:] = (
            (new_low[1:] != new_high[:-1] + 1) | (owner[1:] != owner[:-1]) | (head[new_low[1:]] != head[new_high[:-1]])
        )
        at = np.flatnonzero(split)
        low = new_low[at]
        high = new_high[np.concatenate([at[1:], [len(new_low)]]) - 1] if len(at) else low
        fresh = open_ones[high + 1]
        low, high = low[fresh], high[fresh]
        open_ones[high + 1] = False
    return open_ones[:n]


def repeated_strings(fragments: list[bytes], weights: np.ndarray, window: int) -> Iterator[np.ndarray]:
    """For each fragment, which of its windows of bytes occur more than once."""
    raw = np.frombuffer(b"\0".join(fragments) + b"\0", np.uint8)
    lengths = np.array([len(f) for f in fragments])
    ends = np.cumsum(lengths + 1) - 1
    symbols = raw.astype(np.uint16) + np.uint16(1)
    symbols[ends] = 0
    order = suffix_order(symbols, window)
    shared = undecided(symbols, order, len(fragments), window)
    flags = np.zeros(len(symbols), bool)
    at = np.flatnonzero(shared)
    flags[order[at]] = True
    flags[order[at - 1]] = True
    for k in np.flatnonzero(weights > 1):
        flags[ends[k] - lengths[k] : ends[k] - window + 1] = True
    for end, length in zip(ends.tolist(), lengths.tolist()):
        yield flags[end - length : end - window + 1]


def repeated_bytes(
    docs: DataFrame,
    window: int = 200,
    gram: int = 24,
    id_column: str = "doc_id",
    text_column: str = "text",
    with_text: bool = False,
) -> DataFrame:
    """One row per document: id, n_bytes, n_removed, n_spans and kept_sha256.

    A byte of the UTF-8 text goes if a string of ``window`` bytes that covers it also
    starts anywhere else, in the same document too; strings never cross documents
    and are judged on the input. ``with_text`` adds ``kept``, what is left, and ``spans``, the
    maximal byte ranges that go. A null text counts as empty; texts shorter than the
    window lose nothing. Ids are only carried and may be null. Rows that share id and text
    are copies of each other like any. Other columns are ignored; an empty table gives an
    empty result.
    """
    shape = Shape(words=False, window=window, gram=gram, sampled=4, share=2e-5, chunk=1_000_000)

    def repeated(fragments, weights):
        return repeated_strings(fragments, weights, window)

    spans = repeated_spans(docs, shape, repeated, id_column, text_column)
    joined = with_spans(docs, spans, id_column, text_column)
    id_type = docs.schema[id_column].dataType.simpleString()
    schema = f"`{id_column}` {id_type}, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    names = [id_column, "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    if with_text:
        schema += ", kept binary, spans array<struct<start: long, end: long>>"
        names += ["kept", "spans"]
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def cut(ids: pa.Array, texts: pa.Array, spans: pa.Array) -> pa.RecordBatch:
        n, removed, parts, sha, left, ranges = [], [], [], [], [], []
        for text, found in zip(texts, spans):
            raw = (text.as_py() or "").encode("utf-8", "surrogatepass")
            gone = merged(found)
            kept, at = [], 0
            for start, end in gone:
                kept.append(raw[at:start])
                at = end
            whole = b"".join([*kept, raw[at:]])
            n.append(len(raw))
            removed.append(sum(e - s for s, e in gone))
            parts.append(len(gone))
            sha.append(hashlib.sha256(whole).hexdigest())
            if with_text:
                left.append(whole)
                ranges.append([{"start": s, "end": e} for s, e in gone])
        arrays = [ids, *(pa.array(x, pa.int64()) for x in (n, removed, parts)), pa.array(sha, pa.string())]
        if with_text:
            arrays += [pa.array(left, pa.binary()), pa.array(ranges, span)]
        return pa.RecordBatch.from_arrays(arrays, names)

    return joined.mapInArrow(lambda batches: cut_in_parts(batches, cut), schema)
