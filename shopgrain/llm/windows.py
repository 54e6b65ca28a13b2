"""Finding every repeated window of a corpus: the part that windows of words and
windows of bytes share.

A window is a fixed number of consecutive elements (words or bytes) of one text.
Each window has a minimiser, the least hash among the shorter grams in it, which
depends on nothing but its content; consecutive windows with one minimiser travel
as one packed fragment to the bucket of that minimiser. Equal windows therefore
meet in one bucket, wherever they come from, and a bucket is settled on its own.

Hashes only route; equality is always decided by content in the bucket.

Frequent grams would make hot buckets. A first pass counts grams, and those that
occur more often than a fixed share of all positions (so there is a bounded number
of them) are chosen as minimiser only where a window has no other. Windows
made of frequent grams alone are equal throughout their fragment in most places,
and equal fragments are combined before the shuffle.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import row_keys, store

_MIX = np.uint64(0x9E3779B97F4A7C15)
_BASE = np.uint64(0xD6E8FEB86659FD93)  # odd, so it has an inverse modulo 2**64
_INVERSE = np.uint64(pow(0xD6E8FEB86659FD93, -1, 2**64))
_PLACE = 24  # low bits of a minimiser hold its place in the chunk
_PLACES = np.uint64((1 << _PLACE) - 1)


@dataclass(frozen=True)
class Shape:
    """window, gram: lengths in elements. sampled: grams are counted if their hash
    is in the lowest 1 / 2**sampled part. share: a gram is frequent if it has more
    than this part of all positions. chunk: elements handled at once. The bytes are
    those of a bucket on average, of fragments held before they are sent, and of
    fragments whose windows are settled at once."""

    words: bool
    window: int
    gram: int
    sampled: int
    share: float
    chunk: int
    at_least: int = 8
    bucket_bytes: int = 6 << 20
    flush_bytes: int = 24 << 20
    settle_bytes: int = 3 << 19


def _mix(x: np.ndarray) -> np.ndarray:
    x ^= x >> np.uint64(31)
    x *= _MIX
    x ^= x >> np.uint64(29)
    return x


class _Powers:
    """Powers of the base and of its inverse, grown when needed."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            m = 1 << (n - 1).bit_length()
            self.up = np.cumprod(np.concatenate([[np.uint64(1)], np.full(m, _BASE)]), dtype=np.uint64)
            self.down = np.cumprod(np.concatenate([[np.uint64(1)], np.full(m, _INVERSE)]), dtype=np.uint64)
        return self.up, self.down


_powers = _Powers()
_BYTE_CODES = _mix(np.arange(1, 257, dtype=np.uint64) * _MIX)


def _spans(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Polynomial hashes of codes[start:end], for all spans at once."""
    up, down = _powers.get(len(codes) + 1)
    sums = np.empty(len(codes) + 1, np.uint64)
    sums[0] = 0
    np.cumsum(codes * up[: len(codes)], out=sums[1:])
    return _mix((sums[ends] - sums[starts]) * down[starts])


def grams(codes: np.ndarray, width: int) -> np.ndarray:
    n = len(codes) - width + 1
    up, down = _powers.get(len(codes) + 1)
    sums = np.empty(len(codes) + 1, np.uint64)
    sums[0] = 0
    np.cumsum(codes * up[: len(codes)], out=sums[1:])
    return _mix((sums[width:] - sums[:n]) * down[:n])


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Least of each run of ``width`` values, by doubling."""
    out, have = values, 1
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out[: len(out) - step], out[step:])
        have += step
    return out


class Chunk:
    """Texts of some rows side by side, as bytes, with the place of each element."""

    def __init__(self, words: bool) -> None:
        self.words, self.parts, self.rows, self.first, self.bytes = words, [], [], [], []

    def add(self, row: int, first: int, part: bytes, elements: int) -> None:
        self.rows.append(row)
        self.first.append(first)
        self.parts.append(part)
        self.bytes.append(elements)

    def codes(self) -> np.ndarray:
        """A hash for each element; ``start`` and ``end`` get its byte offsets."""
        # Words are joined by single spaces, so texts are too; bytes need nothing between.
        self.text = (b" " if self.words else b"").join(self.parts)
        raw = np.frombuffer(self.text, np.uint8)
        if not self.words:
            return _BYTE_CODES[raw]
        gaps = np.flatnonzero(raw == 32)
        self.start = np.concatenate([[0], gaps + 1])
        self.end = np.concatenate([gaps, [len(raw)]])
        return _spans(_BYTE_CODES[raw], self.start, self.end)


def chunks(texts: pa.Array, shape: Shape) -> Iterator[Chunk]:
    """Whole texts in chunks; a text longer than a chunk goes on with an overlap, so
    that each of its windows is in exactly one chunk."""
    chunk, size = Chunk(shape.words), 0
    for row in range(len(texts)):
        text = texts[row].as_py()
        raw = (text or "").encode("utf-8", "surrogatepass")
        pieces = raw.split() if shape.words else raw
        n = len(pieces)
        if n < shape.window:
            continue
        for first in range(0, n - shape.window + 1, shape.chunk):
            piece = pieces[first : first + shape.chunk + shape.window - 1]
            chunk.add(row, first, b" ".join(piece) if shape.words else piece, len(piece))
            size += len(piece)
            if size >= shape.chunk:
                yield chunk
                chunk, size = Chunk(shape.words), 0
    if size:
        yield chunk


@dataclass
class Runs:
    """Fragments of a chunk: byte span, minimiser, row, first element, windows."""

    begin: np.ndarray
    stop: np.ndarray
    key: np.ndarray
    again: np.ndarray  # the minimiser occurs in more than one place
    row: np.ndarray
    first: np.ndarray
    count: np.ndarray


def runs_of(chunk: Chunk, shape: Shape, frequent: np.ndarray) -> Runs:
    codes = chunk.codes()
    hashed = grams(codes, shape.gram)
    key = hashed >> np.uint64(1)
    if len(frequent):
        low = np.flatnonzero(hashed <= np.uint64((1 << (64 - shape.sampled)) - 1))
        at = np.minimum(np.searchsorted(frequent, hashed[low]), len(frequent) - 1)
        low = low[frequent[at] == hashed[low]]
        key[low] |= np.uint64(1 << 63)
    key &= ~_PLACES
    key |= np.arange(len(key), dtype=np.uint64)
    least = _sliding_min(key, shape.window - shape.gram + 1)
    value = least >> np.uint64(_PLACE)
    ends = np.cumsum(chunk.bytes)
    starts = ends - chunk.bytes
    n = len(value)
    valid = np.ones(n, bool)
    for end in ends[:-1].tolist():
        valid[max(0, end - shape.window + 1) : end] = False
    differs = value[1:] != value[:-1]
    opens = valid.copy()
    opens[1:] &= differs | ~valid[:-1]
    closes = valid.copy()
    closes[:-1] &= differs | ~valid[1:]
    a, b = np.flatnonzero(opens), np.flatnonzero(closes)
    part = np.searchsorted(ends, a, "right")
    last = b + shape.window
    return Runs(
        begin=chunk.start[a] if shape.words else a,
        stop=chunk.end[last - 1] if shape.words else last,
        key=value[a],
        again=(least[a] & _PLACES) != (least[b] & _PLACES),
        row=np.asarray(chunk.rows)[part],
        first=np.asarray(chunk.first)[part] + a - starts[part],
        count=b - a + 1,
    )


_ZSTD = {"level": 6}


def _pack(kind: int, arrays: list[np.ndarray], text: bytes = b"") -> bytes:
    n = np.array([kind, len(arrays[0])], "<i8").tobytes()
    raw = b"".join([n, *(x.tobytes() for x in arrays), text])
    return zstandard.ZstdCompressor(**_ZSTD).compress(raw)


_FRAGMENTS = ("<u8", "<u4", "u1", "<i8", "<i4", "<i8")  # minimiser, bytes, flags, key, tie, first
_FOUND = ("<i8", "<i4", "<i8", "<i8")  # key, tie, start, end


def _unpack(blob: bytes) -> tuple[int, list[np.ndarray], bytes]:
    raw = zstandard.ZstdDecompressor().decompress(blob)
    kind, n = np.frombuffer(raw, "<i8", 2).tolist()
    at, arrays = 16, []
    for code in _FRAGMENTS if kind == 0 else _FOUND:
        arrays.append(np.frombuffer(raw, code, n, at))
        at += n * np.dtype(code).itemsize
    return kind, arrays, raw[at:]


_MANY, _AGAIN = 1, 2


def _fragments(shape: Shape, buckets: int, frequent) -> Callable:
    """Batches of (key, tie, text) to packed fragments by bucket.

    Equal fragments that meet here are sent once, marked as occurring more than
    once; their windows are known to repeat, so their places are passed on as found.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often = frequent.value
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            ties = batch.column(1).to_numpy(zero_copy_only=False)
            seen: dict[bytes, list] = {}
            found: list[tuple[int, int, int, int]] = []
            size = 0
            for chunk in chunks(batch.column(2), shape):
                r = runs_of(chunk, shape, often)
                text = chunk.text
                for begin, stop, key, again, row, first, count in zip(
                    *(x.tolist() for x in (r.begin, r.stop, r.key, r.again, r.row, r.first, r.count))
                ):
                    fragment = text[begin:stop]
                    known = seen.get(fragment)
                    if known is None:
                        seen[fragment] = [key, again * _AGAIN, row, first]
                        size += stop - begin
                        continue
                    if not known[1] & _MANY:
                        known[1] |= _MANY
                        found.append((known[2], known[3], known[3] + count + shape.window - 1))
                    found.append((row, first, first + count + shape.window - 1))
                if size >= shape.flush_bytes:
                    yield sent(seen, found, ids, ties)
                    seen, found, size = {}, [], 0
            if seen:
                yield sent(seen, found, ids, ties)

    def sent(seen, found, ids, ties) -> pa.RecordBatch:
        values = list(seen.values())
        key = np.array([v[0] for v in values], np.uint64)
        flags = np.array([v[1] for v in values], np.uint8)
        row = np.array([v[2] for v in values], np.int64)
        first = np.array([v[3] for v in values], np.int64)
        texts = list(seen)
        size = np.array([len(t) for t in texts], np.uint32)
        bucket = (_mix(key.copy()) % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        cuts = np.flatnonzero(np.diff(bucket[order], prepend=-1))
        names, blobs = [], []
        for part in np.split(order, cuts[1:]):
            single = (flags[part] & _MANY) == 0
            arrays = [
                key[part],
                size[part],
                flags[part],
                np.where(single, ids[row[part]], 0),
                np.where(single, ties[row[part]], 0).astype("<i4"),
                np.where(single, first[part], 0),
            ]
            names.append(int(bucket[part[0]]))
            blobs.append(_pack(0, arrays, b"".join([texts[k] for k in part.tolist()])))
        if found:
            at = np.array(found, np.int64)
            rows = at[:, 0]
            names.append(names[0])
            blobs.append(_pack(1, [ids[rows], ties[rows].astype("<i4"), at[:, 1], at[:, 2]]))
        return pa.RecordBatch.from_arrays(
            [pa.array(names, pa.int64()), pa.array(blobs, pa.large_binary()).cast(pa.binary())],
            ["bucket", "blob"],
        )

    return run


def _settle(shape: Shape, repeated: Callable) -> Callable:
    """Rows sorted by bucket to found spans (key, tie, start, end).

    ``repeated(fragments, weights)`` gives, for each fragment, which of its windows
    occur more than once, counting a fragment of weight two as two copies.
    """

    def settle(blobs: list[bytes]) -> pa.RecordBatch | None:
        found: list[np.ndarray] = []
        keys: dict[int, dict[bytes, list]] = {}
        places: list[tuple[int, int, int]] = []
        for blob in blobs:
            kind, arrays, text = _unpack(blob)
            if kind:
                found.append(np.stack([a.astype(np.int64) for a in arrays], axis=1))
                continue
            at = 0
            for key, size, flags, i, tie, first in zip(*(a.tolist() for a in arrays)):
                fragment = text[at : at + size]
                at += size
                group = keys.get(key)
                if group is None:
                    group = keys[key] = {}
                known = group.get(fragment)
                if known is None:
                    known = group[fragment] = [0, flags & _AGAIN, -1, None]
                known[0] += 2 if flags & _MANY else 1
                if not flags & _MANY:
                    if known[2] < 0:
                        known[2] = len(places)
                        places.append((i, tie, first))
                    else:  # the same fragment from elsewhere
                        if known[3] is None:
                            known[3] = []
                        known[3].append(len(places))
                        places.append((i, tie, first))
        whole: list[tuple[int, int]] = []  # place, bytes or words covered
        rows: list[tuple[int, int, int, int]] = []
        asked: list[bytes] = []
        asked_for: list[list] = []

        def ask() -> None:
            weights = np.array([min(k[0], 2) for k in asked_for])
            for known, flags in zip(asked_for, repeated(asked, weights)):
                if known[0] > 1 or not flags.any():
                    continue
                i, tie, first = places[known[2]]
                edge = np.diff(np.concatenate([[0], flags.astype(np.int8), [0]]))
                for s, e in zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)):
                    rows.append((i, tie, first + int(s), first + int(e) - 1 + shape.window))
            asked.clear()
            asked_for.clear()

        size = 0
        for group in keys.values():
            # Fragments of different minimisers have no window in common, so they
            # can be settled one group after another.
            if size > shape.settle_bytes:
                ask()
                size = 0
            alone = len(group) == 1
            open_ones = any(v[0] == 1 for v in group.values())
            for fragment, known in group.items():
                if known[0] > 1 and known[2] >= 0:
                    length = fragment.count(b" ") + 1 if shape.words else len(fragment)
                    whole.append((known[2], length))
                    whole.extend((p, length) for p in known[3] or ())
                if open_ones and (not alone or known[1]):
                    asked.append(fragment)
                    asked_for.append(known)
                    size += len(fragment)
        if asked:
            ask()
        rows += [(*places[p], places[p][2] + n) for p, n in whole]
        if rows:
            found.append(np.array(rows, np.int64))
        if not found:
            return None
        both = np.concatenate(found)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(both[:, 0].copy()),
                pa.array(both[:, 1].astype(np.int32)),
                pa.array(both[:, 2].copy()),
                pa.array(both[:, 3].copy()),
            ],
            ["key", "tie", "start", "end"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, blobs = None, []
        for batch in batches:
            for bucket, blob in zip(batch.column(0).to_pylist(), batch.column(1)):
                if bucket != held and blobs:
                    if (out := settle(blobs)) is not None:
                        yield out
                    blobs = []
                held = bucket
                blobs.append(blob.as_py())
        if blobs and (out := settle(blobs)) is not None:
            yield out

    return run


def _frequent(texts: DataFrame, shape: Shape) -> tuple[np.ndarray, int]:
    """Frequent grams, sorted, and the number of bytes of all texts.

    A gram counts from ``at_least`` occurrences in a batch, so the count is a lower
    bound; it only balances buckets. At most 1 / share grams can be frequent.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        most = np.uint64((1 << (64 - shape.sampled)) - 1)
        for batch in batches:
            places = size = 0
            low: list[np.ndarray] = []
            for chunk in chunks(batch.column(2), shape):
                hashed = grams(chunk.codes(), shape.gram)
                places += len(hashed)
                size += len(chunk.text)
                low.append(hashed[hashed <= most])
            values, counts = np.unique(np.concatenate(low or [np.empty(0, np.uint64)]), return_counts=True)
            kept = counts >= shape.at_least
            gram = np.concatenate([values[kept].view(np.int64), [0, 0]])
            count = np.concatenate([counts[kept], [places, size]]).astype(np.int64)
            kind = np.concatenate([np.zeros(int(kept.sum()), np.int32), [1, 2]]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(kind), pa.array(gram), pa.array(count)], ["kind", "gram", "count"]
            )

    counted = texts.mapInArrow(run, "kind int, gram long, count long")
    counted = store(counted.groupBy("kind", "gram").agg(F.sum("count").alias("count")), "grams")
    totals = dict(counted.where("kind > 0").select("kind", "count").collect())
    limit = max(4 * shape.at_least, int(totals.get(1, 0) * shape.share))
    rows = counted.where((F.col("kind") == 0) & (F.col("count") > limit)).select("gram").toPandas()
    return np.sort(rows["gram"].to_numpy(np.int64).view(np.uint64)), totals.get(2, 0)


def repeated_spans(
    docs: DataFrame, shape: Shape, repeated: Callable, id_column: str, text_column: str
) -> DataFrame:
    """(key, tie, spans) of texts with repeated windows: spans of elements covered by
    a window that also starts elsewhere. Spans may overlap or touch. Rows that share
    id and text share their key."""
    spark = docs.sparkSession
    texts = docs.select(*row_keys(id_column, text_column), F.col(text_column).alias("text"))
    frequent, size = _frequent(texts, shape)
    overlap = 2 * shape.window / (shape.window - shape.gram) + 1
    buckets = max(1, int(size * overlap / shape.bucket_bytes))
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), buckets // 16)
    known = spark.sparkContext.broadcast(frequent)  # at most 1 / share numbers
    packed = texts.mapInArrow(_fragments(shape, buckets, known), "bucket long, blob binary")
    dealt = packed.repartition(parts, "bucket").sortWithinPartitions("bucket")
    found = dealt.mapInArrow(_settle(shape, repeated), "key long, tie int, start long, end long")
    return found.groupBy("key", "tie").agg(F.collect_set(F.struct("start", "end")).alias("spans"))


def with_spans(
    docs: DataFrame, spans: DataFrame, id_column: str, text_column: str
) -> DataFrame:
    """Every document as (row_id, text, spans); spans is null where nothing repeats."""
    left = docs.select(
        F.col(id_column).alias("row_id"), F.col(text_column).alias("text"), *row_keys(id_column, text_column)
    )
    return left.join(spans, ["key", "tie"], "left").select("row_id", "text", "spans")


def cut_in_parts(batches: Iterator[pa.RecordBatch], cut: Callable, most: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """``cut(ids, texts, spans)`` over parts of the batches of ``with_spans`` that hold
    about this many bytes of text, or one longer text."""
    for batch in batches:
        ends = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(batch.column(1)), 0), np.int64) + 64)
        at = 0
        while at < batch.num_rows:
            before = int(ends[at - 1]) if at else 0
            stop = max(at + 1, int(np.searchsorted(ends, before + most, "right")))
            part = batch.slice(at, stop - at)
            yield cut(part.column(0), part.column(1), part.column(2))
            at = stop


def merged(spans: pa.Scalar) -> list[tuple[int, int]]:
    """Disjoint maximal spans in order."""
    out: list[list[int]] = []
    for start, end in sorted((s["start"], s["end"]) for s in spans.as_py() or ()):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return [(s, e) for s, e in out]
