"""SimHash near-duplicates by deletion-variant signatures.

A 64-bit fingerprint is cut into two segments of 32 bits. If two fingerprints differ in
at most two bits, one of their segments differs in at most one. Each segment is indexed
under its variants with one bit made a wildcard, 64 in all; two segments that differ in at
most one bit share a variant. Fingerprints that meet under a variant are verified by
counting the bits in which they differ.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .tables import smaller_batches, store

_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
# Shingles hashed at once, members compared at once, members of a variant that one
# task settles. All three bound memory; none leaves anything out.
_SHINGLES = 1 << 16
_COMPARED = 2048
_IN_TASK = 1 << 16
_BITS = 2


def fingerprint(text: str | None, width: int = 3, seed: int = 42) -> int:
    """Majority bits of the hashed word shingles of a text, as a signed number."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    lengths = list(map(len, words))
    ends = [end + k for k, end in enumerate(accumulate(lengths))]
    starts = [0] + [end + 1 for end in ends[:-1]]
    last = ends[width - 1 :] or ends[-1:]
    digest = xxhash.xxh64_intdigest
    set_bits = np.zeros(64, np.int64)
    for at in range(0, len(last), _SHINGLES):
        spans = zip(starts[at : at + _SHINGLES], last[at : at + _SHINGLES])
        hashes = np.array([digest(joined[s:e], seed) for s, e in spans], dtype="<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        set_bits += bits.sum(axis=0, dtype=np.int32)
    chosen = np.packbits(2 * set_bits > len(last), bitorder="little")
    return int(chosen.view("<i8")[0])


def fingerprints(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", carry: bool = False
) -> DataFrame:
    """(id, fp) of every document; a null or wordless text has fingerprint zero.
    With ``carry`` also a struct ``row`` of all columns."""
    rows = docs.select(
        F.col(id_column).alias("id"),
        F.col(text_column).alias("text"),
        *([F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")] if carry else []),
    )
    schema = rows.drop("text").schema.add("fp", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1)
            prints = np.fromiter((fingerprint(t.as_py()) for t in texts), np.int64, len(texts))
            kept = [k for k in range(batch.num_columns) if k != 1]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k) for k in kept), pa.array(prints)],
                [*(batch.schema.names[k] for k in kept), "fp"],
            )

    return rows.mapInArrow(run, schema)


def _variants(nodes: DataFrame) -> DataFrame:
    """The rows under 64 values of ``key``, each a segment of ``fp`` with one bit cleared."""
    variants = nodes.select("*", F.explode(F.sequence(F.lit(0), F.lit(63))).alias("v"))
    segment = "(shiftrightunsigned(fp, if(v < 32, 0, 32)) & 4294967295L)"
    key = f"shiftleft(cast(v as bigint), 32) | ({segment} & ~shiftleft(1L, v % 32))"
    return variants.select(F.expr(key).alias("key"), *nodes.columns)


def _near(group: np.ndarray) -> list[tuple[int, int]]:
    """A spanning forest of the members that differ in at most two bits.

    Small groups are searched breadth first; larger ones by two wildcards, under
    which at most four different members can meet, all of them linked.
    """
    found: list[tuple[int, int]] = []
    if len(group) <= _COMPARED:
        rest = group.copy()
        while len(rest) > 1:
            queue, rest = [rest[0]], rest[1:]
            while queue and len(rest):
                at = queue.pop()
                close = np.bitwise_count(rest ^ at) <= _BITS
                if close.any():
                    new = rest[close]
                    found.extend((int(at), int(x)) for x in new)
                    queue.extend(new)
                    rest = rest[~close]
        return found
    parent = np.arange(len(group))

    def top(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    free = np.flatnonzero([(int(np.bitwise_or.reduce(group ^ group[0])) >> k) & 1 for k in range(64)])
    pairs = combinations(free.tolist(), 2) if len(free) > 1 else [(int(f), int(f)) for f in free]
    for i, j in pairs:
        masked = group & np.uint64(~((1 << i) | (1 << j)) & (2**64 - 1))
        order = np.argsort(masked)
        for k in np.flatnonzero(masked[order][1:] == masked[order][:-1]):
            x, y = top(order[k]), top(order[k + 1])
            if x != y:
                parent[max(x, y)] = min(x, y)
                found.append((int(group[order[k]]), int(group[order[k + 1]])))
    return found


def _link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges within each variant of a stream sorted by variant.

    A variant with more members than one task should hold passes its members on
    (b is null); they are settled by two wildcards in a shuffle of their own.
    """
    held_keys, held = np.empty(0, np.int64), np.empty(0, np.uint64)
    passing = None

    def edges(a: np.ndarray, b: np.ndarray | None = None) -> pa.RecordBatch:
        second = pa.nulls(len(a), pa.int64()) if b is None else pa.array(b.view(np.int64))
        return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), second], ["a", "b"])

    def forest(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
        both = np.array(pairs, np.uint64).reshape(-1, 2)
        return edges(both[:, 0].copy(), both[:, 1].copy())

    for batch in batches:
        keys = np.concatenate([held_keys, batch.column(0).to_numpy()])
        prints = np.concatenate([held, batch.column(1).to_numpy().astype(np.int64).view(np.uint64)])
        if passing is not None:
            n = int(np.searchsorted(keys, passing, "right"))
            if n:
                yield edges(prints[:n])
            keys, prints = keys[n:], prints[n:]
        if not len(keys):
            continue
        passing = None
        cuts = np.concatenate([[0], np.flatnonzero(keys[1:] != keys[:-1]) + 1, [len(keys)]])
        sizes = np.diff(cuts)
        complete = sizes[:-1]  # the last run may go on in the next batch
        two = cuts[:-2][complete == 2]
        close = np.bitwise_count(prints[two] ^ prints[two + 1]) <= _BITS
        if close.any():
            yield edges(prints[two[close]], prints[two[close] + 1])
        pairs: list[tuple[int, int]] = []
        for k in np.flatnonzero(complete > 2):
            pairs += _near(prints[cuts[k] : cuts[k + 1]])
        if pairs:
            yield forest(pairs)
        held_keys, held = keys[cuts[-2] :], prints[cuts[-2] :]
        if len(held) > _IN_TASK:
            yield edges(held)
            passing = held_keys[0]
            held_keys, held = held_keys[:0], held[:0]
    if len(held) > 1 and (pairs := _near(held)):
        yield forest(pairs)


def _two_wildcards(members: DataFrame) -> DataFrame:
    """Edges among fingerprints by two wildcards: at most four share a variant."""
    masks = [(1 << i) | (1 << j) for i, j in combinations(range(64), 2)]
    signed = [m - 2**64 if m >= 2**63 else m for m in masks]
    return (
        members.select("fp", F.explode(F.lit(signed)).alias("mask"))
        .groupBy("mask", F.expr("fp & ~mask").alias("rest"))
        .agg(F.collect_set("fp").alias("near"))
        .where(F.size("near") > 1)
        .select(F.array_min("near").alias("a"), F.explode("near").alias("b"))
        .where("a <> b")
        .distinct()
    )


def _linked(prints: DataFrame) -> DataFrame:
    """(fp, root) of all different fingerprints of (id, tie, fp)."""
    nodes = store(prints.select("fp").distinct(), "nodes")
    met = _variants(nodes).repartition("key").sortWithinPartitions("key", "fp")
    links = store(met.mapInArrow(_link, "a long, b long"), "links")
    edges = links.where("b is not null")
    large = links.where("b is null").select(F.col("a").alias("fp")).distinct()
    if not large.isEmpty():
        edges = edges.union(_two_wildcards(large))
    roots = components(edges)
    joined = nodes.join(roots, nodes.fp == roots.node, "left")
    return joined.select("fp", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: id, fingerprint (16 hex digits), component_id.

    Fingerprints link at two or fewer differing bits; component_id is the smallest
    id that can be reached over links. Null and wordless texts have fingerprint
    zero and are linked like any other. Null ids are passed over when the smallest
    is sought (null only if a component has no other). Repeated rows each get
    their row; other columns are ignored; an empty table gives an empty result.

    Documents are reduced to different fingerprints first, so copies cost nothing
    further. Links are kept as spanning forests, never as all pairs of a group.
    """
    prints = store(fingerprints(docs, id_column, text_column), "fingerprints")
    roots = store(_linked(prints), "linked")
    least = prints.groupBy("fp").agg(F.min("id").alias("least"))
    rooted = roots.join(least, "fp")
    smallest = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = roots.join(smallest, "root").select("fp", "component_id")
    return prints.join(named, "fp").select(
        F.col("id").alias(id_column),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def one_per_group(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The documents, with all their columns, less all but one of each linked group.

    Texts link as in ``near_duplicates``. The row with the smallest id stays (null ids
    last, then by hash of the text); of repeated rows one.
    """
    smaller_batches(docs.sparkSession)
    rows = fingerprints(docs, id_column, text_column, carry=True)
    rows = store(rows.withColumn("number", F.monotonically_increasing_id()), "fingerprints")
    tie = F.xxhash64(f"row.{text_column}")
    order = F.struct(F.col("id").isNull().alias("none"), "id", tie.alias("tie"), "number")
    # The best of each fingerprint first, so that copies do not meet in the joins.
    first = rows.groupBy("fp").agg(F.min(order).alias("best"))
    best = first.join(_linked(rows), "fp").groupBy("root").agg(F.min("best").alias("best"))
    return rows.join(best.select("best.number"), "number", "left_semi").select("row.*")
