"""Exact, substring, SimHash and suffix dedup against plain versions."""

from collections import Counter

import numpy as np
import plain
import pytest
from plain import ODD, odd_docs, sha
from pyspark.sql import functions as F
from tables import documents, texts  # noqa: F401

from shopgrain.llm import queries, simhash
from shopgrain.llm.components import components
from shopgrain.llm.exact_dedup import exact_groups
from shopgrain.llm.simhash import near_duplicates, one_per_group
from shopgrain.llm.substring_dedup import repeated_passages, repeated_windows
from shopgrain.llm.windows import Shape, cut_in_parts, repeated_spans, with_spans
from shopgrain.llm.suffix_dedup import repeated_bytes, repeated_strings


def check_exact(result, rows):
    groups = plain.exact_groups(rows)
    got = Counter(tuple(r) for r in result.drop("kept").collect())
    expected = Counter()
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        expected.update((i, min(known, default=None), len(ids), sha(text)) for i in ids)
    assert got == expected
    kept = Counter(r.text_sha256 for r in result.where("kept").collect())
    assert kept == {sha(t): 1 for t in groups}
    assert result.where("kept and not doc_id <=> keep_id").count() == 0


def test_exact_groups(spark, folder, texts):
    check_exact(queries.op1_exact_dedup(spark, folder), texts)
    check_exact(exact_groups(odd_docs(spark)), ODD)
    # Narrow digits: several rounds, with texts that end exactly at a digit's edge.
    check_exact(exact_groups(odd_docs(spark), first_digit=2, growth=3), ODD)
    assert exact_groups(odd_docs(spark, ODD[:0])).count() == 0


def check_passages(result, rows, window):
    got = Counter((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in result.collect())
    expected = Counter(
        (i, len(e), sum(gone), sha(" ".join(w for w, g in zip(e, gone) if not g)))
        for (i, _), (e, gone) in zip(rows, plain.repeated(rows, window, plain.words))
    )
    assert got == expected


def test_repeated_passages(spark, folder, texts):
    check_passages(queries.op2_substring_dedup(spark, folder), texts, 35)
    check_passages(repeated_passages(odd_docs(spark)), ODD, 35)
    check_passages(repeated_passages(odd_docs(spark), window=5, gram=2), ODD, 5)
    assert repeated_passages(odd_docs(spark, ODD[:0])).count() == 0


def check_bytes(result, rows, window):
    got = Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in result.collect())
    expected = Counter()
    for (i, _), (e, gone) in zip(rows, plain.repeated(rows, window, lambda t: (t or "").encode())):
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        kept = bytes(b for b, g in zip(e, gone) if not g)
        expected[(i, len(e), sum(gone), spans, sha(kept))] += 1
    assert got == expected


def test_repeated_bytes(spark, folder, texts):
    check_bytes(queries.op4_suffix_dedup(spark, folder), texts, 200)
    short = [(i, t) for i, t in ODD if len(t or "") < 2000]
    check_bytes(repeated_bytes(odd_docs(spark, short)), short, 200)
    check_bytes(repeated_bytes(odd_docs(spark, short), window=12, gram=5), short, 12)
    assert repeated_bytes(odd_docs(spark, ODD[:0])).count() == 0


def test_ids_of_any_type(spark):
    rows = [(i, t) for i, t in ODD if len(t or "") < 2000]
    named = [(None if i is None else f"doc {i}", t) for i, t in rows]
    docs = odd_docs(spark, rows).withColumn("doc_id", F.concat(F.lit("doc "), "doc_id"))
    check_passages(repeated_passages(docs, window=5, gram=2), named, 5)
    check_bytes(repeated_bytes(docs, window=12, gram=5), named, 12)
    # Texts without an id that repeat nowhere lose nothing, next to others that do.
    alone = [(None, " ".join(f"{k}n{j}" for j in range(40))) for k in range(300)]
    shared = [(None, f"{k} {plain.PASSAGE}") for k in range(300)]
    check_passages(repeated_passages(odd_docs(spark, alone + shared)), alone + shared, 35)


def test_what_is_left_and_what_went(spark):
    rows = [(i, t) for i, t in ODD if len(t or "") < 2000]
    for r in repeated_passages(odd_docs(spark, rows), window=5, gram=2, with_text=True).collect():
        assert sha(r.kept_text) == r.kept_sha256 and sum(s.end - s.start for s in r.spans) == r.n_removed
    for r in repeated_bytes(odd_docs(spark, rows), window=12, gram=5, with_text=True).collect():
        assert sha(bytes(r.kept)) == r.kept_sha256 and len(r.spans) == r.n_spans


def test_batches_are_cut_by_bytes():
    import pyarrow as pa

    texts = ["x" * 50, None, "y" * 5000, "", "z" * 10] * 40
    batch = pa.RecordBatch.from_arrays([pa.array(range(200)), pa.array(texts), pa.nulls(200)], ["a", "b", "c"])
    parts = list(cut_in_parts(iter([batch, batch.slice(0, 0)]), lambda *columns: columns, most=1000))
    assert [t for _, part, _ in parts for t in part.to_pylist()] == texts
    assert max(sum(len(t or "") + 64 for t in part.to_pylist()) for _, part, _ in parts if len(part) > 1) <= 1000


@pytest.mark.parametrize("seed", range(40))
def test_windows_of_fragments(seed):
    """Random fragments over few symbols, so that everything repeats somewhere."""
    rng = np.random.default_rng(seed)
    text = bytes(rng.choice(list(b"ab\0"), 60).astype(np.uint8))
    fragments = list({text[s : s + n] for s, n in zip(rng.integers(0, 40, 8), rng.integers(8, 20, 8))})
    weights = rng.integers(1, 3, len(fragments))
    counts = Counter()
    for f, w in zip(fragments, weights):
        for k in range(len(f) - 5):
            counts[f[k : k + 6]] += int(w)
    expected = [[counts[f[k : k + 6]] > 1 for k in range(len(f) - 5)] for f in fragments]
    assert [x.tolist() for x in repeated_strings(fragments, weights, 6)] == expected
    spelled = [b" ".join(bytes([c + 1]) for c in f) for f in fragments]
    assert [x.tolist() for x in repeated_windows(spelled, weights, 6)] == expected


@pytest.mark.parametrize("words", [True, False])
def test_windows_over_many_chunks_flushes_and_buckets(spark, words):
    """Texts cut into chunks, fragments sent in several parts, groups settled one by one,
    and frequent grams set aside: the same windows are found."""
    rows = [(k, t) for k, (_, t) in enumerate(ODD) if len(t or "") < 2000] + [(90, plain.LONG[:9000]), (91, plain.LONG[50:8000])]
    shape = Shape(
        words=words, window=9, gram=4, sampled=1, share=1e-3, chunk=40, at_least=2,
        bucket_bytes=400, flush_bytes=500, settle_bytes=1,
    )
    settle = repeated_windows if words else repeated_strings
    docs = odd_docs(spark, rows)
    found = repeated_spans(docs, shape, lambda f, w: settle(f, w, 9), "doc_id", "text")
    joined = with_spans(docs, found, "doc_id", "text").collect()
    got = {r.row_id: {p for s in r.spans or () for p in range(s.start, s.end)} for r in joined}
    split = plain.words if words else lambda t: (t or "").encode()
    for (i, _), (_, gone) in zip(rows, plain.repeated(rows, 9, split)):
        assert got.get(i, set()) == {p for p, g in enumerate(gone) if g}


def check_components(result, rows):
    prints = [plain.fingerprint(t) for _, t in rows]
    roots = plain.components(prints)
    least = {}
    for (i, _), p in zip(rows, prints):
        if i is not None:
            least[roots[p]] = min(i, least.get(roots[p], i))
    expected = Counter((i, f"{p:016x}", least.get(roots[p])) for (i, _), p in zip(rows, prints))
    assert Counter((r.doc_id, r.fingerprint, r.component_id) for r in result.collect()) == expected


def test_near_duplicates(spark, folder, texts):
    check_components(queries.op3_simhash(spark, folder), texts)
    check_components(near_duplicates(odd_docs(spark)), ODD)
    assert near_duplicates(odd_docs(spark, ODD[:0])).count() == 0


def test_one_per_group(spark):
    docs = odd_docs(spark)
    kept = one_per_group(docs)
    assert kept.columns == docs.columns
    prints = {p: r for p, r in plain.components([plain.fingerprint(t) for _, t in ODD]).items()}
    left = Counter(prints[plain.fingerprint(r.text)] for r in kept.collect())
    assert set(left) == set(prints.values()) and set(left.values()) == {1}
    assert one_per_group(odd_docs(spark, ODD[:0])).count() == 0


def near_prints(n, seed=3):
    rng = np.random.default_rng(seed)
    base = rng.integers(0, 2**63, 1 + n // 20, dtype=np.uint64)
    prints = np.repeat(base, 20)[:n]
    for _ in range(3):
        prints = prints ^ (np.uint64(1) << rng.integers(0, 64, n).astype(np.uint64))
    return np.unique(prints)


@pytest.mark.parametrize("compared, in_task", [(2048, 1 << 16), (2, 1 << 16), (2048, 3)])
def test_every_way_of_linking_gives_the_same_components(spark, monkeypatch, compared, in_task):
    monkeypatch.setattr(simhash, "_COMPARED", compared)
    monkeypatch.setattr(simhash, "_IN_TASK", in_task)
    prints = near_prints(300)
    nodes = spark.createDataFrame([(int(x),) for x in prints.view(np.int64)], "fp long")
    if in_task < 300:  # workers import the module afresh, so the large groups come from here
        edges = simhash._two_wildcards(nodes)
    else:
        keyed = simhash._variants(nodes).orderBy("key", "fp").toPandas()
        import pyarrow as pa

        batches = (pa.RecordBatch.from_pandas(keyed.iloc[k : k + 97], preserve_index=False) for k in range(0, len(keyed), 97))
        pairs = [(a, b) for batch in simhash._link(batches) for a, b in zip(*(c.to_pylist() for c in batch.columns))]
        edges = spark.createDataFrame(pairs, "a long, b long")
    found = {r.node % 2**64: r.root for r in components(edges).collect()}
    roots = plain.components([int(x) for x in prints])
    for a in roots:
        for b in roots:
            same = a == b or (a in found and b in found and found[a] == found[b])
            assert same == (roots[a] == roots[b])


def test_large_variants_are_passed_on(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(simhash, "_IN_TASK", 3)
    keys = [1] * 10 + [2] * 2
    batch = pa.RecordBatch.from_arrays([pa.array(keys), pa.array(list(range(12)))], ["key", "fp"])
    out = [r for part in (batch.slice(0, 4), batch.slice(4, 4), batch.slice(8)) for r in [part]]
    rows = [x for b in simhash._link(iter(out)) for x in zip(*(c.to_pylist() for c in b.columns))]
    assert sorted(a for a, b in rows if b is None) == list(range(10))
    assert [(a, b) for a, b in rows if b is not None] == [(10, 11)]
