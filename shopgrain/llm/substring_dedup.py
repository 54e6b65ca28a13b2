"""Repeated passages of words by super-k-mer partitioning.

Consecutive windows that share a minimiser travel as one packed string to the
minimiser's bucket, where a sort of the windows counts them exactly.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .windows import Shape, cut_in_parts, merged, repeated_spans, with_spans


def repeated_windows(fragments: list[bytes], weights: np.ndarray, window: int) -> Iterator[np.ndarray]:
    """For each fragment, which of its windows of words occur more than once."""
    names: dict[bytes, int] = {}
    numbers: list[int] = []
    lengths = np.empty(len(fragments), np.int64)
    for k, fragment in enumerate(fragments):
        words = fragment.split(b" ")
        lengths[k] = len(words)
        numbers += [names.setdefault(w, len(names)) for w in words]
    word = np.array(numbers, np.int64)
    ends = np.cumsum(lengths)
    starts = ends - lengths
    counts = lengths - window + 1
    total = np.cumsum(counts)
    owner = np.repeat(np.arange(len(fragments)), counts)
    at = np.arange(int(total[-1])) - (total - counts)[owner] + starts[owner]
    # Windows are sorted by a hash of their word numbers; neighbours with one hash
    # are then compared word by word.
    hashed = np.zeros(len(word) - window + 1, np.uint64)
    code = word.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(1)
    code ^= code >> np.uint64(32)
    for k in range(window):
        hashed *= np.uint64(0xD6E8FEB86659FD93)
        hashed += code[k : k + len(hashed)]
    order = np.argsort(hashed[at], kind="stable")
    ordered = hashed[at[order]]
    same = ordered[1:] == ordered[:-1]
    pairs = np.flatnonzero(same)
    x, y = at[order[pairs]], at[order[pairs + 1]]
    equal = np.ones(len(pairs), bool)
    for k in range(window):
        equal &= word[x + k] == word[y + k]
    if not equal.all():  # two contents under one hash: sort by content instead
        content = np.stack([word[at + k] for k in range(window)])
        order = np.lexsort(content[::-1])
        same = (content[:, order[1:]] == content[:, order[:-1]]).all(axis=0)
    group = np.concatenate([[0], np.cumsum(~same)])
    counted = np.bincount(group, weights=weights[owner[order]])
    flags = np.zeros(len(order), bool)
    flags[order] = counted[group] > 1
    for k in range(len(fragments)):
        yield flags[total[k] - counts[k] : total[k]]


def repeated_passages(
    docs: DataFrame,
    window: int = 35,
    gram: int = 6,
    id_column: str = "doc_id",
    text_column: str = "text",
    with_text: bool = False,
) -> DataFrame:
    """One row per document: id, n_words, n_removed and kept_sha256.

    A word goes if a window of ``window`` words that covers it also starts anywhere
    else, in the same document too; windows are judged on the input. Words are kept
    as they are and joined by one space. ``with_text`` adds ``kept_text`` and ``spans``, the
    word ranges that go. Null and wordless texts have no words; texts with fewer words than
    a window lose none. Ids are only carried and may be null. Rows that share id and text are
    copies of each other like any. Other columns are ignored; an empty table gives an
    empty result.
    """
    shape = Shape(words=True, window=window, gram=gram, sampled=1, share=1e-4, chunk=400_000)

    def repeated(fragments, weights):
        return repeated_windows(fragments, weights, window)

    spans = repeated_spans(docs, shape, repeated, id_column, text_column)
    joined = with_spans(docs, spans, id_column, text_column)
    id_type = docs.schema[id_column].dataType.simpleString()
    schema = f"`{id_column}` {id_type}, n_words long, n_removed long, kept_sha256 string"
    names = [id_column, "n_words", "n_removed", "kept_sha256"]
    if with_text:
        schema += ", kept_text string, spans array<struct<start: long, end: long>>"
        names += ["kept_text", "spans"]
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def cut(ids: pa.Array, texts: pa.Array, spans: pa.Array) -> pa.RecordBatch:
        n, removed, sha, left, ranges = [], [], [], [], []
        for text, found in zip(texts, spans):
            words = (text.as_py() or "").encode("utf-8", "surrogatepass").split()
            gone = merged(found)
            kept, at = [], 0
            for start, end in gone:
                kept += words[at:start]
                at = end
            whole = b" ".join(kept + words[at:] if gone else words)
            n.append(len(words))
            removed.append(sum(e - s for s, e in gone))
            sha.append(hashlib.sha256(whole).hexdigest())
            if with_text:
                left.append(whole.decode("utf-8", "surrogatepass"))
                ranges.append([{"start": s, "end": e} for s, e in gone])
        arrays = [ids, pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(sha, pa.string())]
        if with_text:
            arrays += [pa.array(left, pa.string()), pa.array(ranges, span)]
        return pa.RecordBatch.from_arrays(arrays, names)

    return joined.mapInArrow(lambda batches: cut_in_parts(batches, cut), schema)
