"""Token counts, decontamination, mixing, URL filter, language, shards and pipeline."""

import math
import zlib
from bisect import bisect_right
from collections import Counter, defaultdict

import oracle
import plain
import pytest
from pyspark.sql import functions as F
from plain import ODD, odd_docs
from tables import documents, texts  # noqa: F401

import corpus_pipeline
from shopgrain.llm import decontamination, queries
from shopgrain.llm.decontamination import Matcher, Pattern, clean_documents, contaminated, edit_budget, normalise
from shopgrain.llm.language_id import held_out, identify, learn, learn_with_limit, predicted
from shopgrain.llm.mixing import mix, mixed_rows
from shopgrain.llm.sharding import byte_shards
from shopgrain.llm.token_counts import PATTERN, RULES, VOCABULARY, Encoder, allocate, token_counts
from shopgrain.llm.url_filter import Rule, judge_urls


@pytest.fixture(scope="module")
def encoder():
    with open(VOCABULARY, "rb") as file:
        return Encoder(file.read(), PATTERN)


def test_token_counts(spark, folder, documents, encoder):
    whole = {
        r.doc_id: "\n\n".join(x for x in (r.source, r.lang, r.text) if x is not None)
        for r in documents.collect()
    }
    parts = defaultdict(list)
    for r in queries.op5_token_counts(spark, folder).collect():
        parts[r.doc_id].append((r.start, r.end, r.field, r.section, r.n_tokens))
    assert set(parts) == set(whole)
    for i, text in whole.items():
        rows = sorted(parts[i])
        assert sum(r[4] for r in rows) == len(encoder.encoding.encode_ordinary(text))
        assert [r[0] for r in rows] == [0] + [r[1] for r in rows[:-1]] and rows[-1][1] == len(text)
        assert "".join(text[r[0] : r[1]] for r in rows) == text
        # Token by token: each goes to the section that its first byte is in.
        ends, at, expected = encoder.ends(text).tolist(), 0, Counter()
        edges = [len(text[: r[0]].encode()) for r in rows]
        for end in ends:
            expected[bisect_right(edges, at) - 1] += 1
            at = end
        assert [r[4] for r in rows] == [expected[k] for k in range(len(rows))]


@pytest.mark.parametrize("rule", RULES)
def test_token_allocation_by_rule(encoder, rule):
    text = "naïve\n\n\n  été 漢字\nx" + "🙂\n" * 3 + " end"
    starts = [0, 6, 7, 8, 11, 17, 18]
    ends = encoder.ends(text)
    char_of = [k for k, c in enumerate(text) for _ in c.encode()]
    expected = Counter()
    begin = 0
    for end in ends.tolist():
        chars = sorted(set(char_of[begin:end]))
        owners = [max(k for k, s in enumerate(starts) if s <= c) for c in chars]
        if rule == "majority":
            most = Counter(owners)
            expected[min(most, key=lambda k: (-most[k], k))] += 1
        else:
            expected[owners[0] if rule == "start" else owners[-1]] += 1
        begin = end
    assert allocate(text, ends, starts, rule).tolist() == [expected[k] for k in range(len(starts))]


def test_token_counts_of_odd_rows(spark, encoder):
    got = Counter((r.doc_id, r.n_tokens) for r in token_counts(odd_docs(spark), section=None).collect())
    assert got == Counter((i, len(encoder.encoding.encode_ordinary(t))) for i, t in ODD if t is not None)
    assert token_counts(odd_docs(spark, ODD[:0])).count() == 0
    with pytest.raises(ValueError):
        token_counts(odd_docs(spark), rule="nearest")


def test_pattern_search():
    import random

    rng = random.Random(5)
    for _ in range(300):
        text = "".join(rng.choice("abc ") for _ in range(rng.randint(0, 60)))
        item = "".join(rng.choice("abc ") for _ in range(rng.randint(1, 15)))
        least = plain.edit_distance(item, text)
        found = Pattern(item).best(text, len(item))
        assert (found[0] if found else len(item)) == least


def edited(rng, item, edits):
    for _ in range(edits):
        at = rng.randrange(len(item))
        item = item[:at] + rng.choice(["", "q", item[at] + "z"]) + item[at + 1 :]
    return item


@pytest.mark.parametrize("block", [16 << 20, 60])
def test_contaminated(spark, folder, texts, monkeypatch, block):
    """With one block of items, and with several."""
    import random

    monkeypatch.setattr(decontamination, "_BLOCK", block)
    rng = random.Random(8)
    items = [(k, "".join(rng.choice("abcdefgh ") for _ in range(rng.randint(25, 60)))) for k in range(8)]
    items += [(8, None), (9, "  "), (10, "short"), (None, "item without id xx"), (20, items[0][1]), (21, items[1][1])]
    items += [(22, items[2][1])] * 2
    docs = [(i, t) for i, t in ODD if len(t or "") < 3000]
    for k in range(60):
        _, item = items[k % 8]
        around = "".join(rng.choice("abcdefgh ") for _ in range(80))
        docs.append((100 + k, around[:40] + edited(rng, item, k % 9) + around[40:]))
    docs += [(200, "a SHORT one"), (201, "an item\twithout  id xx here")]
    frame = spark.createDataFrame(items, "item_id long, text string")
    got = Counter((r.doc_id, r.item_id, r.distance) for r in contaminated(odd_docs(spark, docs), frame).collect())
    expected = Counter()
    for i, text in docs:
        for name, item in items:
            item = normalise(item)
            if item:
                distance = plain.edit_distance(item, normalise(text))
                if distance <= edit_budget(len(item), 0.1):
                    expected[(i, name, distance)] += 1
    assert got == expected
    dirty = {i for i, _, _ in expected}
    frame_docs = odd_docs(spark, docs)
    clean = clean_documents(frame_docs, frame)
    assert clean.columns == frame_docs.columns
    left = Counter(r.doc_id for r in clean.collect())
    assert left == Counter(i for i, _ in docs if i not in dirty)
    # Every item that a given document contains is found.
    items = [(r.item_id, normalise(r.text)) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    found = {(r.doc_id, r.item_id) for r in queries.op6_decontamination(spark, folder).collect()}
    assert {(i, k) for i, t in texts for k, item in items if item in normalise(t)} <= found


def test_occurrence_is_where_it_is_said_to_be():
    item = "the quick brown fox jumps over the lazy dog and sleeps"
    text = normalise("Before it. The quick brwn fox jumps over the lazzy dog and sleeps, after it.")
    ((_, distance, start, end),) = Matcher([(1, item)], 0.1).hits(text)
    assert distance == 2 and text[start:end] == "the quick brwn fox jumps over the lazzy dog and sleeps"


def shares(sizes, weights=(1, 2, 3), most=3):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    target, free, left = {}, set(names), float(sum(sizes.values()))
    while free:
        level = left / sum(weight[s] for s in free)
        full = {s for s in free if level * weight[s] > most * sizes[s]}
        if not full:
            target |= {s: level * weight[s] for s in free}
            break
        target |= {s: float(most * sizes[s]) for s in full}
        left -= sum(target[s] for s in full)
        free -= full
    return target


def check_mix(rows, source_of):
    sizes = Counter()
    for r in rows:
        sizes[source_of(r)] += r.size
    target = shares(sizes)
    taken = Counter()
    for r in rows:
        assert r.source_size == sizes[source_of(r)]
        assert r.target == pytest.approx(target[source_of(r)])
        assert 0 <= r.taken <= 3 * r.size
        taken[source_of(r)] += r.taken
    for source, t in target.items():
        assert abs(taken[source] - t) <= 1
    for source in sizes:  # whole epochs first, then at most one document in part
        epochs = {r.taken // r.size for r in rows if source_of(r) == source and r.size}
        assert not epochs or max(epochs) - min(epochs) <= 1
        assert sum(1 for r in rows if source_of(r) == source and r.size and r.taken % r.size) <= 1


def test_mix(spark, folder, documents):
    source = {r.doc_id: (r.source, len(plain.words(r.text))) for r in documents.collect()}
    rows = queries.op7_mixing(spark, folder).collect()
    assert {r.doc_id: r.size for r in rows} == {i: s[1] for i, s in source.items()}
    check_mix(rows, lambda r: source[r.doc_id][0])
    assert sorted(rows) == sorted(queries.op7_mixing(spark, folder).collect())
    odd = odd_docs(spark)
    rows = mix(odd).collect()
    check_mix(rows, lambda r: r.source)
    assert Counter((r.doc_id, r.size) for r in rows) == Counter((i, len(plain.words(t))) for i, t in ODD)
    assert mix(odd_docs(spark, ODD[:0])).count() == 0
    unequal = spark.createDataFrame(
        [(k, "w " * n, s) for k, (n, s) in enumerate([(5, "a"), (2, "b"), (1, "c"), (500, None), (0, "d")])],
        "doc_id long, text string, source string",
    )
    check_mix(mix(unequal).collect(), lambda r: r.source)


def test_mixed_rows(spark):
    odd = odd_docs(spark)
    assert mixed_rows(odd).columns == odd.columns
    words = Counter()
    for r in mixed_rows(odd).collect():
        words[r.doc_id] += len(plain.words(r.text))
        assert r.n_chars == len(r.text)
    taken = Counter()
    for r in mix(odd).collect():
        taken[r.doc_id] += r.taken
    assert words == +taken


def test_judge_urls(spark, folder):
    con = oracle.connect(folder)
    assert oracle.differences(queries.op8_url_filter(spark, folder), con, queries.ORACLES["op8_url_filter"]) is None


def test_judge_odd_urls(spark):
    urls = [None, "", "no mark", "http://", "HTTP://A.Example.COM?x", "x://a.b/p?q://c/#", "a://É.Com/Ö#?",
            "http://farm.org/free-track", "http://spamfarm.org/x", "http://x.org/SPAM", "http://com/xxx"]
    pages = spark.createDataFrame([(k, u, "html", "host") for k, u in enumerate(urls)], "page_id int, url string, html string, host string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in judge_urls(pages, [Rule("com", "/", "allow")]).collect()}
    assert got == {
        0: ("", "", None, "allow"), 1: ("", "", None, "allow"), 2: ("", "", None, "allow"), 3: ("", "", None, "allow"),
        4: ("a.example.com", "", None, "allow"), 5: ("a.b", "/p", None, "allow"), 6: ("É.com", "/Ö", "com/", "allow"),
        7: ("farm.org", "/free-track", None, "block"), 8: ("spamfarm.org", "/x", None, "allow"),
        9: ("x.org", "/SPAM", None, "block"), 10: ("com", "/xxx", "com/", "allow"),
    }
    assert judge_urls(pages.limit(0)).count() == 0
    twice = judge_urls(pages.union(pages), [Rule("com", "/", "allow")]).collect()
    assert Counter((r.page_id, r.verdict) for r in twice) == Counter({(i, v[3]): 2 for i, v in got.items()})


def test_identify(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = queries.op9_language_id(spark, "/root/testdata/sf0.01").collect()
    lang = {r.doc_id: r.lang for r in docs.collect()}
    assert len(rows) == len(lang)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert all(0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) > 0.97 * len(held)


def is_held_out(i):
    return zlib.crc32(str("" if i is None else i).encode()) % 4 == 2


@pytest.mark.parametrize("bounds", [{}, {"words_per_language": 60, "grams_per_length": 40}])
def test_scores_are_those_of_the_plain_version(spark, documents, bounds):
    rows = documents.collect()
    taught = [(r.lang, r.text) for r in rows if not is_held_out(r.doc_id) and r.lang and r.text is not None]
    model = plain.language_model(taught, *bounds.values())
    expected = {r.doc_id: plain.language_of(r.text, model) for r in rows}
    learned = learn(documents.where(~held_out()), **bounds)
    named = predicted(documents.select("doc_id", "text"), learned).select("doc_id", "language.*").collect()
    for r in named:
        lang, score, known = expected[r.doc_id]
        assert r.lang == lang and r.score == pytest.approx(score) and r.known == pytest.approx(known, abs=1e-6)
    got = {r.doc_id: (r.lang_pred, r.held_out) for r in identify(documents, **bounds).collect()}
    assert got == {i: (x[0], is_held_out(i)) for i, x in expected.items()}


def test_every_language_is_learned(spark):
    """More languages than any bound on rows, words or grams; the rare ones too."""
    name = ["".join(chr(97 + k // 26**p % 26) for p in (0, 1)) * 3 for k in range(300)]
    rows = [(k, f"{name[k % 300]}wort {name[k % 300]} und{name[k % 300]}", f"l{k % 300:03d}") for k in range(2400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r.doc_id: r.lang_pred for r in identify(docs).collect()}
    assert all(got[i] == lang for i, _, lang in rows)


def test_every_text_teaches(spark):
    """No text is left out, however many a language has, and the words kept are the most
    frequent of all."""
    rows = [(k, "aa", f"common w{chr(97 + k % 26)}{'x' * (k % 5)}") for k in range(5_000)]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    model = learn(docs)
    counts = Counter(w for _, _, text in rows for w in text.split())
    for word, n in counts.items():
        k = model.starts[model.items[0][word]]
        assert model.gain[k] == pytest.approx(math.log1p(2 * n)), word
    top = sorted(counts, key=lambda w: (-counts[w], w))[:10]
    assert sorted(learn(docs, words_per_language=10).items[0]) == sorted(top)


def test_one_more_row_changes_nothing_abruptly(spark):
    """The limit of the filter is fitted the same way with few labelled texts as with many."""
    rows = [(k, "the cat and the dog " * (1 + k % 3), "en") for k in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    for n in (60, 120, 150, 200):
        model, least = learn_with_limit(docs.where(F.col("doc_id") < n))
        assert model.langs == ("en",) and least == pytest.approx(0.5)


def test_identify_odd_rows(spark):
    rows = identify(odd_docs(spark)).collect()
    assert Counter(r.doc_id for r in rows) == Counter(i for i, _ in ODD)
    text = dict(ODD)
    for r in rows:
        if r.doc_id in (3, 4, 5, 17):
            assert (r.lang_pred, r.score) == ("und", 0.0), text[r.doc_id]
        elif r.doc_id is not None:
            assert r.lang_pred == "en"
    assert identify(odd_docs(spark, ODD[:0])).count() == 0
    unlabelled = odd_docs(spark).withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in identify(unlabelled).collect()} == {"und"}


def check_splitters(rows, shards, tolerance=0.002):
    """Each splitter is within tolerance of its goal or lies at an edge of the one
    document around the goal, in the order of keys."""
    sizes = [0] * shards
    largest = max(r["size"] for r in rows)
    for r in rows:
        sizes[r.shard] += r["size"]
    total = sum(sizes)
    before = 0
    for k in range(shards - 1):
        before += sizes[k]
        assert abs(before - total * (k + 1) / shards) <= max(total / shards * tolerance, largest)


def check_shards(rows, texts, shards, slack):
    sizes = [0] * shards
    slots = defaultdict(list)
    for r in rows:
        sizes[r.shard] += r.size
        slots[r.shard].append(r.slot)
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in rows) == Counter(
        (i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in texts
    )
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    share = sum(sizes) / shards
    assert all(abs(s - share) <= slack for s in sizes)


def test_byte_shards(spark, folder, texts):
    largest = max(len(t or "") for _, t in texts)
    rows = queries.op10_sharding(spark, folder).collect()
    check_shards(rows, texts, 40, 2 * largest)
    check_splitters(rows, 40)
    many = [(k, "some words of equal length") for k in range(5000)]
    check_splitters(byte_shards(odd_docs(spark, many), 7).collect(), 7)
    longest = 2 * max(len((t or "").encode()) for _, t in ODD)
    check_shards(byte_shards(odd_docs(spark), 3).collect(), ODD, 3, longest)
    assert byte_shards(odd_docs(spark, ODD[:0])).count() == 0
    # One text in a third of all rows is divided; other equal texts stay together.
    rows = [(k, "hot " * 20 if k % 3 == 0 else f"text {k // 6} " * 20) for k in range(6000)]
    sharded = byte_shards(odd_docs(spark, rows), 10, bits=6)
    check_shards(sharded.collect(), rows, 10, 400)
    spread = sharded.groupBy("text_crc32").agg({"shard": "max"}).collect()
    assert len(spread) == len({t for _, t in rows})
    assert len({(r.text_crc32, r.shard) for r in sharded.collect()}) <= len(spread) + 10


def test_sharding_is_native(spark, folder):
    plan = queries.op10_sharding(spark, folder)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_pipeline_stages(spark, folder, documents):
    kept, items = documents, spark.read.parquet(f"{folder}/benchmark.parquet")
    before = {r.doc_id: r for r in documents.collect()}
    stages = dict(corpus_pipeline.STAGES)
    language = {r.doc_id: r for r in stages["language"](spark, kept, folder).collect()}
    fitting = {i for i in before if zlib.crc32(str(i).encode()) % 8 == 3}
    taught = [i for i, r in before.items() if not is_held_out(i) and r.lang and r.text is not None]
    model = plain.language_model([(before[i].lang, before[i].text) for i in taught if i not in fitting])
    named = {i: plain.language_of(r.text, model) for i, r in before.items()}
    known = sorted(named[i][2] for i in taught if i in fitting and named[i][0] != "und")
    limit = known[math.ceil(0.01 * len(known)) - 1] / 2
    assert language == {i: r for i, r in before.items() if named[i][0] != "und" and named[i][2] >= limit}
    kept = spark.createDataFrame(list(language.values()), documents.schema)
    near = {r.doc_id: r for r in stages["near_duplicates"](spark, kept, folder).collect()}
    prints = {i: plain.fingerprint(r.text) for i, r in language.items()}
    roots, least = plain.components(list(prints.values())), {}
    for i in sorted(prints):
        least.setdefault(roots[prints[i]], i)
    assert set(near) == set(least.values())
    kept = spark.createDataFrame(list(near.values()), documents.schema)
    clean = {r.doc_id for r in stages["decontamination"](spark, kept, folder).collect()}
    wanted = [normalise(r.text) for r in items.collect()]
    dirty = {i for i, r in near.items() if any(w in normalise(r.text) for w in wanted)}
    assert clean <= set(near) - dirty and len(clean) >= 0.95 * len(set(near) - dirty)
    kept = kept.where(kept.doc_id.isin(sorted(clean)))
    mixed = stages["mixing"](spark, kept, folder)
    assert mixed.columns == documents.columns
    total = sum(len(plain.words(near[i].text)) for i in clean)
    assert abs(sum(len(plain.words(r.text)) for r in mixed.collect()) - total) <= 25
    sharded = stages["sharding"](spark, mixed, folder)
    assert sharded.columns == [*documents.columns, "shard", "slot"]
    assert Counter(r.text for r in sharded.collect()) == Counter(r.text for r in mixed.collect())
    result = corpus_pipeline.run(spark, folder)
    # Which copy of a text is in which shard may follow the numbers that rows get.
    assert Counter((r.text, r.shard) for r in result.collect()) == Counter((r.text, r.shard) for r in sharded.collect())


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stages_take_odd_rows(spark, folder, name, stage):
    odd = odd_docs(spark)
    out = stage(spark, odd, folder)
    assert out.columns[: len(odd.columns)] == odd.columns and out.count() > 0
    assert stage(spark, odd_docs(spark, ODD[:0]), folder).count() == 0


def test_gibberish_and_unlearned_languages_are_rejected(spark):
    import random

    rng = random.Random(4)
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text", "lang")
    letters = "abcdefghijklmnopqrstuvwxyz"
    planted = [(10**6 + k, " ".join("".join(rng.choices(letters, k=rng.randint(3, 9))) for _ in range(40)), None)
               for k in range(50)]
    polish = "szczęście dziękuję książka wszystko przyjaciel źródło łódź jest nie się która wiosna dzień".split()
    planted += [(2 * 10**6 + k, " ".join(rng.choices(polish, k=30)), None) for k in range(50)]
    both = docs.union(spark.createDataFrame(planted, docs.schema))
    kept = {r.doc_id for r in dict(corpus_pipeline.STAGES)["language"](spark, both, folder).collect()}
    assert kept == {r.doc_id for r in docs.collect() if any(c.isalpha() for c in r.text or "")}
    # The operator itself names a language for every text with a letter.
    assert "und" not in {r.lang_pred for r in identify(both).collect() if r.doc_id >= 10**6}


@pytest.mark.parametrize("one", [None, 5])
def test_rows_that_share_id_and_text_are_divided(spark, one):
    rows = [(one if k % 3 else k, "hot " * 20 if k % 3 else f"text {k} " * 20) for k in range(6000)]
    check_shards(byte_shards(odd_docs(spark, rows), 10, bits=6).collect(), rows, 10, 800)
    carried = byte_shards(odd_docs(spark, rows).withColumn("number", F.lit(1)), 10, bits=6, carry=True).collect()
    check_shards(carried, rows, 10, 800)
    assert Counter((r.row.doc_id, r.row.text) for r in carried) == Counter(rows)
