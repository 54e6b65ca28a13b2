"""Language identification with word-first backoff.

Known words are scored by their log frequency in each language. A word that was not
learned is scored by the longest known character gram at each of its places, from
long grams down to single characters. A filter can reject texts of which too little is
known to the best language: words, and of other words grams of three or four.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .tables import smaller_batches, store

_WORD = re.compile(r"[^\W\d_]+")
_LONGEST = 4
# Scores that a task remembers, one for each word and language; forgotten as a whole when full.
_REMEMBERED = 1_000_000
# Different words that a task counts before it gives them on.
_COUNTED = 100_000
# Parts that the items of a language are ranked in before they are ranked together.
_PARTS = 64
_CERTAIN = 20.0
UNKNOWN = "und"
# Grams shorter than this occur in any text and show nothing.
_TELLING = 3


def words_of(text: str | None) -> list[str]:
    """Lower-cased runs of letters; none if there is no letter."""
    found = _WORD.findall((text or "").lower())
    if found and not any(c.isalpha() for c in found[0]):
        found = [w for w in found if any(map(str.isalpha, w))]
    return found


def _grams(word: str) -> Iterator[tuple[str, int]]:
    padded = f" {word} "
    for n in range(1, _LONGEST + 1):
        for at in range(len(padded) - n + 1):
            yield padded[at : at + n], n


def _word_counts(counts: dict[str, Counter]) -> pa.RecordBatch:
    langs = [lang for lang, words in counts.items() for _ in range(len(words))]
    return pa.RecordBatch.from_arrays(
        [pa.array(langs, pa.string()), pa.array([w for words in counts.values() for w in words], pa.string()),
         pa.array([n for words in counts.values() for n in words.values()], pa.int64())],
        ["lang", "word", "n"],
    )


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of many texts together; given on whenever a task holds very many words."""
    counts: dict[str, Counter] = defaultdict(Counter)
    held = 0
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            words = counts[lang]
            held -= len(words)
            words.update(words_of(text.as_py()))
            held += len(words)
            if held > _COUNTED:
                yield _word_counts(counts)
                counts.clear()
                held = 0
    yield _word_counts(counts)


def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts: Counter = Counter()
        for lang, word, n in zip(*(c.to_pylist() for c in batch.columns)):
            for gram, length in _grams(word):
                counts[(lang, length, gram)] += n
        keys = list(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.int32()),
             pa.array([k[2] for k in keys], pa.string()), pa.array(list(counts.values()), pa.int64())],
            ["lang", "length", "item", "n"],
        )


@dataclass(frozen=True)
class Model:
    """Log frequencies of items by language, where an item was seen; ``items`` are numbered
    by length (0: whole words) and ``starts`` says where the entries of a number begin.
    ``floors`` are those of items that a language does not have, by length."""

    langs: tuple[str, ...]
    items: dict[int, dict[str, int]]
    starts: np.ndarray
    lang: np.ndarray
    gain: np.ndarray  # over the floor
    length: np.ndarray  # of each numbered item
    floors: np.ndarray


def learn(
    labelled: DataFrame,
    words_per_language: int = 20_000,
    grams_per_length: int = 5_000,
    text_column: str = "text",
    lang_column: str = "lang",
) -> Model | None:
    """Counts of words (length 0) and of grams by language, from every labelled text.

    Rows without text or language teach nothing. Of each language the most frequent words,
    and of each length the most frequent grams, are kept, so the model is bounded for each
    language, and every language is learned. None if there is nothing to learn.
    """
    rows = labelled.select(
        F.col(lang_column).cast("string").alias("lang"), F.col(text_column).alias("text")
    ).where("lang is not null and text is not null")
    langs = sorted(r["lang"] for r in rows.select("lang").distinct().collect())
    if not langs:
        return None
    smaller_batches(labelled.sparkSession)
    words = rows.mapInArrow(_count_words, "lang string, word string, n long")
    # Stored, because they are read twice and every text was read for them.
    words = store(words.groupBy("lang", "word").agg(F.sum("n").alias("n")), "words")
    grams = words.mapInArrow(_count_grams, "lang string, length int, item string, n long")
    grams = grams.groupBy("lang", "length", "item").agg(F.sum("n").alias("n"))
    both = words.select("lang", F.lit(0).alias("length"), F.col("word").alias("item"), "n").union(grams)
    most = F.when(F.col("length") == 0, words_per_language).otherwise(grams_per_length)
    kept = both.withColumn("part", F.pmod(F.xxhash64("item"), F.lit(_PARTS)))
    # The most frequent of all are among the most frequent of their part.
    for groups in (["lang", "length", "part"], ["lang", "length"]):
        order = Window.partitionBy(*groups).orderBy(F.desc("n"), "item")
        kept = kept.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)
    return _model(langs, kept.select("lang", "length", "item", "n").toPandas())


def _model(langs: list[str], found: pd.DataFrame) -> Model:
    """Every count is half an occurrence higher, so an item that a language does not have
    has half of one there."""
    found = found.sort_values(["length", "item", "lang"], ignore_index=True)
    place = {lang: k for k, lang in enumerate(langs)}
    items: dict[int, dict[str, int]] = {}
    floors = np.zeros((_LONGEST + 1, len(langs)))
    first = (found["length"].ne(found["length"].shift()) | found["item"].ne(found["item"].shift())).to_numpy()
    number = np.cumsum(first) - 1
    for length, rows in found.groupby("length"):
        known = rows.loc[first[rows.index], "item"]
        items[int(length)] = dict(zip(known, number[known.index].tolist()))
        totals = np.full(len(langs), 0.5 * len(known))
        np.add.at(totals, rows["lang"].map(place).to_numpy(), rows["n"].to_numpy())
        floors[int(length)] = np.log(0.5 / totals)
    return Model(
        tuple(langs), items,
        starts=np.append(np.flatnonzero(first), len(found)),
        lang=found["lang"].map(place).to_numpy(np.int64),
        gain=np.log1p(2.0 * found["n"].to_numpy(np.float64)),
        length=found["length"].to_numpy(np.int64)[first],
        floors=floors,
    )


class Scorer:
    """Scores texts with a learned model; remembers words in bounded memory."""

    def __init__(self, model: Model | None, least: float = 0.0) -> None:
        self.model, self.least = model, least
        self.langs = model.langs if model else ()
        self.words = model.items.get(0, {}) if model else {}
        # Grams differ in length, so one dictionary holds them all.
        self.grams = {g: k for n, known in model.items.items() if n for g, k in known.items()} if model else {}
        self._forget()

    def _forget(self) -> None:
        self.place: dict[str, int] = {}
        self.scores = np.empty((1024, len(self.langs)))
        self.known = np.empty((1024, len(self.langs)), np.float32)

    def _parts(self, word: str) -> list[int]:
        """Numbers of the items that a word is scored by."""
        known = self.words.get(word)
        if known is not None:
            return [known]
        padded, found, get = f" {word} ", [], self.grams.get
        for at in range(len(padded) - 1):
            for end in range(at + _LONGEST, at, -1):
                k = get(padded[at:end])
                if k is not None:
                    found.append(k)
                    break
        return found

    def _remember(self, words: list[str]) -> None:
        """Score words that are the last in ``place``."""
        model, width = self.model, len(self.langs)
        parts, counts = [], []
        for word in words:
            found = self._parts(word)
            parts += found
            counts.append(len(found))
        part, each = np.array(parts, np.int64), np.array(counts)
        owner = np.repeat(np.arange(len(words)), each)
        # How many parts of each length a word has gives its floor, and the entries of the
        # parts what languages have beyond it.
        levels = np.bincount(owner * len(model.floors) + model.length[part], minlength=len(words) * len(model.floors))
        totals = levels.reshape(len(words), -1) @ model.floors
        begin, sizes = model.starts[part], model.starts[part + 1] - model.starts[part]
        entry = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes - begin, sizes)
        cell = np.repeat(owner, sizes) * width + model.lang[entry]
        totals += np.bincount(cell, weights=model.gain[entry], minlength=totals.size).reshape(totals.shape)
        telling = (model.length[part] == 0) | (model.length[part] >= _TELLING)
        known = np.bincount(cell, weights=np.repeat(telling, sizes), minlength=totals.size).reshape(totals.shape)
        n = len(self.place)
        while n > len(self.scores):
            self.scores = np.concatenate([self.scores, np.empty_like(self.scores)])
            self.known = np.concatenate([self.known, np.empty_like(self.known)])
        divided = np.maximum(each, 1)[:, None]
        self.scores[n - len(words) : n] = totals / divided
        self.known[n - len(words) : n] = known / divided

    def predict(self, text: str | None) -> tuple[str, float, float]:
        """Language, score, and how much of the text the language knows."""
        words = words_of(text)
        if not words or not self.langs:
            return UNKNOWN, 0.0, 0.0
        if len(self.place) * max(1, len(self.langs)) > _REMEMBERED:
            self._forget()
        place, at, new = self.place, [], []
        for word in words:
            k = place.get(word)
            if k is None:
                k = place[word] = len(place)
                new.append(word)
            at.append(k)
        if new:
            self._remember(new)
        mean = self.scores[at].mean(axis=0)
        best = int(mean.argmax())
        known = float(self.known[at, best].mean(dtype=np.float64))
        if known < self.least:
            return UNKNOWN, 0.0, known
        odds = np.exp((mean - mean[best]) * min(len(words), _CERTAIN))
        return self.langs[best], float(1 / odds.sum()), known


def predicted(docs: DataFrame, model: Model | None, text_column: str = "text", least: float = 0.0) -> DataFrame:
    """The documents with a column ``language``, a struct of lang, score and known.

    Texts of which less than ``least`` is known to their best language are ``und``. Texts
    are taken from their batch one by one, and batches are bounded in bytes.
    """
    smaller_batches(docs.sparkSession)
    known = docs.sparkSession.sparkContext.broadcast(model)  # bounded by learn()
    fields = [("lang", pa.string()), ("score", pa.float64()), ("known", pa.float64())]

    @F.arrow_udf("lang string, score double, known double")
    def predict(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scorer = Scorer(known.value, least)
        for texts in batches:
            found = [scorer.predict(t.as_py()) for t in texts]
            columns = zip(*found) if found else [()] * len(fields)
            arrays = [pa.array(c, kind) for c, (_, kind) in zip(columns, fields)]
            yield pa.StructArray.from_arrays(arrays, names=[name for name, _ in fields])

    return docs.withColumn("language", predict(F.col(text_column)))


def _checksum(id_column: str):
    return F.crc32(F.coalesce(F.col(id_column).cast("string"), F.lit("")).cast("binary"))


def held_out(id_column: str = "doc_id"):
    """One in four documents, by the checksum of its id as text (null: empty)."""
    return _checksum(id_column) % 4 == 2


def learn_with_limit(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    lang_column: str = "lang",
    **bounds: int,
) -> tuple[Model | None, float]:
    """A model, and how much of a text must be known for its language to be named.

    Both come from labelled documents that are not held out: one in eight of all is
    kept from ``learn``, and half of what is known of the hundredth of those that is
    known least is the limit. With none of them nothing is rejected (limit zero).
    """
    fitting = _checksum(id_column) % 8 == 3
    taught = docs.where(~held_out(id_column))
    labelled = taught.where(fitting & F.col(lang_column).isNotNull() & (F.trim(text_column) != ""))
    bounds |= {"text_column": text_column, "lang_column": lang_column}
    model = learn(taught.where(~fitting), **bounds)
    if model is None:
        return None, 0.0
    rows = predicted(labelled.select(F.col(text_column).alias("text")), model)
    rows = rows.where(F.col("language.lang") != UNKNOWN)
    low = rows.agg(F.percentile_approx("language.known", 0.01, F.lit(10_000))).first()[0]
    return model, (low or 0.0) / 2


def identify(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    lang_column: str = "lang",
    **bounds: int,
) -> DataFrame:
    """One row per document: id, held_out, lang_pred and score.

    Learns from documents that are not held out and have text and language, within
    the bounds of ``learn``; predicts every whole text, from the text alone.
    ``lang_pred`` is ``und`` with score zero if the text is null or has no letter, or if
    nothing could be learned. Ties go to the language that sorts first. The score
    compares the mean log frequencies of a text's words, counted at most 20 times.
    Repeated rows get equal rows; other columns are ignored; an empty table gives an
    empty result. A limit on what must be known of a text, as in ``learn_with_limit``, is
    for filters.
    """
    taught = docs.where(~held_out(id_column))
    model = learn(taught, text_column=text_column, lang_column=lang_column, **bounds)
    rows = docs.select(F.col(id_column), F.col(text_column).alias("text"))
    return predicted(rows, model).select(
        id_column,
        held_out(id_column).alias("held_out"),
        F.col("language.lang").alias("lang_pred"),
        F.col("language.score").alias("score"),
    )
