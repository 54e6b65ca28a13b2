"""Periodic runs, hard negatives and toxicity against plain versions."""

import math
import random
import zlib
from collections import Counter
from fractions import Fraction
from itertools import product

import numpy as np
import oracle
import plain
import pytest
from plain import ODD, odd_docs, sha
from pyspark.sql import functions as F
from tables import documents, texts  # noqa: F401

from shopgrain.llm import queries, toxicity
from shopgrain.llm.hard_negatives import hard_negatives
from shopgrain.llm.periodic_runs import SuffixTree, periodic_runs, runs


def plain_runs(words):
    """All runs of at least two periods: stretches by period, the smallest period of each."""
    number = np.unique(np.array(words, object).astype(str), return_inverse=True)[1] if words else np.empty(0, int)
    stretch = {}
    for q in range(1, len(words) // 2 + 1):
        edge = np.diff(np.concatenate([[0], (number[:-q] == number[q:]).astype(np.int8), [0]]))
        for k, end in zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist()):
            if end - k >= q:
                stretch.setdefault((k, end - k + q), q)
    return sorted((k, n, q) for (k, n), q in stretch.items())


def expected_runs(text, least_length=6, least_periods=4):
    words = plain.words(text)
    found = [r for r in plain_runs(words) if r[1] >= max(least_length, least_periods * r[2])]
    gone = {k for s, n, q in found for k in range(s + q, s + n)}
    best = max(found, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=(None,) * 3)
    exponent = 1000 * best[1] // best[2] if found else None
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in found)
    left = " ".join(w for k, w in enumerate(words) if k not in gone)
    return (len(found), *best, exponent, sha(lines), sha(left))


def test_runs_of_small_alphabets():
    rng = random.Random(3)
    for size in (1, 2, 3):
        for _ in range(400):
            words = [rng.randint(1, size) for _ in range(rng.randint(0, 30))]
            assert runs(words) == plain_runs(words)
    for base in ([1, 2], [2, 1, 1], [3, 1, 2, 1]):
        for n in range(2, 30):
            words = [base[k % len(base)] for k in range(n)]
            assert runs(words) == plain_runs(words) and runs([9, *words, 9, 9]) == plain_runs([9, *words, 9, 9])


def test_suffix_tree_orders_all_suffixes():
    rng = random.Random(8)
    for _ in range(200):
        words = [rng.randint(1, 3) for _ in range(rng.randint(1, 25))] + [0]
        suffixes, depths = SuffixTree(words).tour()
        assert suffixes.tolist() == sorted(range(len(words)), key=lambda k: words[k:])
        for a, b, n in zip(suffixes, suffixes[1:], depths[1:]):
            assert words[a : a + n] == words[b : b + n] and words[a + n] != words[b + n]


def test_periodic_runs_of_odd_rows(spark):
    more = [(30, "a b " * 4 + "a"), (31, "a b c " * 3 + "a b"), (32, "x x x x x"), (33, "x x x x x x"),
            (34, ("a b c d " * 5 + "x y ") * 6), (35, ("to be or not " * 4 + "é é ") * 3)]
    rows = ODD + more
    got = Counter(tuple(r) for r in periodic_runs(odd_docs(spark, rows)).collect())
    assert got == Counter((i, *expected_runs(t)) for i, t in rows)
    looser = periodic_runs(odd_docs(spark, rows), least_length=9, least_periods=5, with_text=True).collect()
    for r in looser:
        assert r.n_runs == len(r.runs) and sha(r.collapsed) == r.collapsed_sha256
    assert Counter(tuple(r)[:8] for r in looser) == Counter((i, *expected_runs(t, 9, 5)) for i, t in rows)
    assert periodic_runs(odd_docs(spark, ODD[:0])).count() == 0
    with pytest.raises(ValueError):
        periodic_runs(odd_docs(spark), least_periods=3)


def test_periodic_runs_query(spark, folder, texts):
    con = oracle.connect(folder)
    sql = queries.ORACLES["op11_periodic_runs"]
    assert oracle.differences(queries.op11_periodic_runs(spark, folder), con, sql) is None
    got = {r.doc_id: tuple(r)[1:] for r in queries.op11_periodic_runs(spark, folder).collect()}
    assert set(got) == {i for i, _ in texts}
    for i, text in texts:
        words, h = plain.words(text), zlib.crc32(str(i).encode())
        if h % 10 == 0 and words:
            g, n = h // 10, len(words)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[k] if k < a else words[a + (k - a) % p] for k in range(n)]
        if len(words) < 3000:
            assert got[i] == expected_runs(" ".join(words))


def plain_negatives(rows, positives=5, negatives=3):
    """Rows are (id, label, vector); every id divisible by 50 asks."""

    def usable(r):
        return r[1] is not None and r[2] is not None and all(x is not None and math.isfinite(x) for x in r[2])

    rows = [(i, y, [math.floor(256 * float(np.float32(x))) for x in v]) for i, y, v in filter(usable, rows)]
    out = []
    for a, (i, y, v) in enumerate(rows):
        if i is None or i % 50:
            continue
        scored = [(-sum(p * q for p, q in zip(v, u)), j is None, j, z) for k, (j, z, u) in enumerate(rows) if k != a]
        scored.sort(key=lambda s: (s[0], s[1], s[2] or 0))
        same = [s for s in scored if s[3] == y][:positives]
        for p in same:
            window = [s for s in scored if s[3] != y and 50 * -p[0] <= 100 * -s[0] <= 95 * -p[0]]
            out += [(i, p[2], k + 1, s[2], -p[0], -s[0]) for k, s in enumerate(window[:negatives])]
    return Counter(out)


SCHEMA = "vec_id long, label {}, embedding array<float>, id int, number int, vector int, slab int, upper int"


@pytest.mark.parametrize("kind, slab_rows", [("int", 100_000), ("string", 7), ("int", 1)])
def test_hard_negatives_of_odd_rows(spark, kind, slab_rows):
    rng = random.Random(6)
    vector = lambda n=8: [rng.gauss(0.2, 0.4) for _ in range(n)]
    label = lambda k: k if kind == "int" else f"l{k}"
    rows = [(k, label(rng.choice([0, 0, 0, 1, 2])), vector()) for k in range(150)]
    hot = vector()
    rows += [(200 + k, label(k % 2), hot) for k in range(30)]
    rows += [(50, label(1), rows[50][2])] * 2 + [(100, label(0), vector())]  # ids repeated
    rows += [(250, None, vector()), (251, label(0), None), (252, label(1), [1.0, None]), (300, label(1), [math.nan]),
             (301, label(1), [math.inf, 0.0]), (302, label(2), []), (350, label(1), vector(5)), (351, label(0), vector(11)),
             (None, label(1), vector()), (None, label(0), hot)]
    df = spark.createDataFrame([(*r, 1, 2, 3, 4, 5) for r in rows], SCHEMA.format(kind))
    got = hard_negatives(df, F.col("vec_id") % 50 == 0, slab_rows=slab_rows)
    assert Counter(tuple(r) for r in got.collect()) == plain_negatives(rows)
    few = hard_negatives(df, F.col("vec_id") % 50 == 0, positives=2, negatives=1, slab_rows=slab_rows)
    assert Counter(tuple(r) for r in few.collect()) == plain_negatives(rows, 2, 1)
    assert hard_negatives(df.limit(0), F.col("vec_id") % 50 == 0).count() == 0


def test_large_components_are_exact(spark):
    rng = random.Random(2)
    rows = [(k, k % 2, [float(np.float32(rng.gauss(0.0, 1.0) * 2.0**20)) for _ in range(4)]) for k in range(60)]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>")
    assert Counter(tuple(r) for r in hard_negatives(df, F.col("vec_id") % 50 == 0).collect()) == plain_negatives(rows)


def test_hard_negatives_query(spark, folder):
    con = oracle.connect(folder)
    sql = queries.ORACLES["op12_hard_negatives"]
    assert oracle.differences(queries.op12_hard_negatives(spark, folder), con, sql) is None


def test_marginals_are_those_of_all_tag_sequences():
    rng = np.random.default_rng(5)
    for n in range(1, 7):
        odds, links = np.exp(rng.normal(size=n)), np.exp(rng.normal(size=3))
        factor = {(0, 0): 1.0, (0, 1): links[0], (1, 1): links[1], (1, 0): links[2]}
        total, on = 0.0, np.zeros(n)
        for tags in product((0, 1), repeat=n):
            weight = math.prod(o for o, y in zip(odds, tags) if y) * math.prod(map(factor.get, zip(tags, tags[1:])))
            total += weight
            on += weight * np.array(tags)
        np.testing.assert_allclose(toxicity.marginals(odds.tolist(), tuple(links)), on / total)


def test_gradient_of_the_likelihood(monkeypatch):
    monkeypatch.setattr(toxicity, "_PIECE", 4)
    rng = np.random.default_rng(1)
    corpus = toxicity.Corpus([("you foul thing and you foul beast again", 1), ("a fine day and a calm sea", 0), ("", 0), ("x", 1)])
    tags = np.array([corpus.words[k] in ("foul", "beast") for k in corpus.word])
    trainer = toxicity.Trainer(corpus, tags, 0.3)
    w = rng.normal(size=trainer.size) * 0.5
    value, gradient = trainer(w)
    for k in rng.choice(trainer.size, 25, replace=False).tolist() + list(range(trainer.size - 4, trainer.size)):
        step = np.zeros(trainer.size)
        step[k] = 1e-5
        slope = (trainer(w + step)[0] - trainer(w - step)[0]) / 2e-5
        assert slope == pytest.approx(gradient[k], abs=1e-5)
    # The value is the negative log likelihood over all tag sequences of each chain.
    score, (_, _, _, _, links) = trainer.scores(w), trainer.parts(w)
    link = {(0, 0): 0.0, (0, 1): links[0], (1, 1): links[1], (1, 0): links[2]}
    expected, at = 0.15 * float(w @ w), 0
    for length in corpus.length.tolist():
        for first in range(at, at + length, 4):
            here = range(first, min(first + 4, at + length))

            def weight(tags, here=here):
                return sum(score[k] for k, y in zip(here, tags) if y) + sum(map(link.get, zip(tags, tags[1:])))

            expected += np.logaddexp.reduce([weight(t) for t in product((0, 1), repeat=len(here))])
            expected -= weight([int(tags[k]) for k in here])
        at += length
    assert value == pytest.approx(expected)


def test_toxicity_of_held_out_documents(spark):
    folder = "/root/testdata/sf0.1"
    rows = {r.doc_id: r for r in queries.op13_toxicity(spark, folder).collect()}
    assert len(rows) == spark.read.parquet(f"{folder}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in rows.items())
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows.values())
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    held = [(rows[i].predicted, y) for i, y in labels.items() if i in rows and rows[i].held_out]
    toxic = [p for p, y in held if y == 1]
    clean = [p for p, y in held if y == 0]
    assert sum(toxic) >= 0.9 * len(toxic) and sum(clean) <= 0.03 * len(clean)


def planted(spark, n=240):
    rng = random.Random(9)
    calm = "the sea was calm and all of them went home after a long day at work in town by train".split()
    foul = ["grubbish", "vilestump", "vilemarsh", "viletrout"]
    rows, marks = [], []
    for k in range(n):
        words = rng.choices(calm, k=rng.randint(12, 40))
        toxic = k % 3 == 0
        for _ in range(3 * toxic):
            words.insert(rng.randint(0, len(words)), rng.choice(foul))
        rows.append((k, " ".join(words).capitalize() + "."))
        marks.append((k, int(toxic), "x"))
    labels = spark.createDataFrame(marks, "doc_id long, toxic int, text string")
    return rows, labels, foul


def test_offending_spans(spark):
    rows, labels, foul = planted(spark)
    rows += [(1000, "All of them went home to VILEmarsh, by train, İ."), (1001, "All of them went home by train.")]
    got = {r.doc_id: r for r in toxicity.toxicity(odd_docs(spark, rows), labels, with_spans=True).collect()}
    for i, text in rows[:-2]:
        assert got[i].predicted == (i % 3 == 0)
        marked = Counter(text[s.start : s.end].lower() for s in got[i].spans)
        assert Counter(w for run in marked.elements() for w in run.split()) == Counter(
            w for w in text.lower().rstrip(".").split() if w in foul
        )
    (span,) = got[1000].spans
    assert "All of them went home to VILEmarsh"[span.start : span.end] == "VILEmarsh" and span.probability > 0.5
    assert got[1001].spans == [] and got[1001].predicted == 0


def test_toxicity_of_odd_rows(spark):
    _, labels, _ = planted(spark)
    odd = odd_docs(spark).withColumn("toxic", F.lit(1)).withColumn("score", F.lit("x"))
    both = odd_docs(spark, planted(spark)[0] + ODD)
    rows = toxicity.toxicity(both, labels).where("doc_id is null or doc_id < 20").collect()
    assert all(0 <= r.score <= 1 for r in rows)
    assert toxicity.toxicity(odd_docs(spark, ODD[:0]), labels).count() == 0
    nothing = toxicity.toxicity(odd, labels.limit(0)).collect()
    assert Counter(r.doc_id for r in nothing) == Counter(i for i, _ in ODD)
    assert all(r.score < 1e-6 and r.predicted == 0 for r in nothing)
    unsure = labels.union(spark.createDataFrame([(None, 1, ""), (5, None, ""), (7, 1, ""), (7, 0, "")], labels.schema))
    again = toxicity.toxicity(odd, unsure, with_spans=True).collect()
    assert Counter(r.doc_id for r in again) == Counter(i for i, _ in ODD)
