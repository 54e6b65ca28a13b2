"""Toxicity by a linear-chain conditional random field.

Every word of a text is tagged as offending or not. Labels of words are projected
from those of documents: in a toxic document the words are offending that, whole or by
their beginning, occur many times more often in toxic documents than in clean ones,
in different contexts and different texts, so that copies prove nothing. The field
has weights for words, their beginnings and endings, their neighbours, and for going
from one tag to the next. Forward-backward marginals give the offending words, and
their expected number, as a number and as a share, the score of the document.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .language_id import held_out
from .tables import smaller_batches

_WORD = re.compile(r"[^\W\d_]+")
_PREFIXES, _SUFFIXES = (3, 4, 5, 6, 7), (3, 4, 5)
# Beginnings that may show a word to be offending; shorter ones are in too many words.
_TELLING = (4, 5, 6, 7)
# Words of a chain in training; a longer text becomes several chains.
_PIECE = 256
_STEEPEST = 30.0
# Words whose weights a task remembers; forgotten as a whole when full.
_REMEMBERED = 200_000


def _features(word: str) -> list[str]:
    """The word, its beginnings and its endings, as names."""
    n = len(word)
    return [
        f"={word}",
        *(f"<{word[:k]}" for k in _PREFIXES if k < n),
        *(f">{word[-k:]}" for k in _SUFFIXES if k < n),
    ]


@dataclass(frozen=True)
class Field:
    """Weights by feature name; of the word before and the word after; ``odds`` are those
    of going from tag to tag (clean to offending, stays offending, back to clean), compared
    with staying clean."""

    own: dict[str, float]
    before: dict[str, float]
    after: dict[str, float]
    bias: float
    odds: tuple[float, float, float]
    # Coefficients of the document score: constant, log number, log share.
    document: tuple[float, float, float]

    def weights(self, word: str) -> tuple[float, float, float]:
        lower = word.lower()
        own = self.bias + sum(self.own.get(f, 0.0) for f in _features(lower))
        return own, self.before.get(lower, 0.0), self.after.get(lower, 0.0)


def marginals(odds: list[float], links: tuple[float, float, float]) -> np.ndarray:
    """Probability of each word to be offending, from the odds of the words themselves
    and of going from tag to tag, by the forward-backward recursion on odds."""
    into, stay, back = links
    forward = list(accumulate(odds, lambda r, e: e * (into + stay * r) / (1 + back * r)))
    # The odds of what follows, given that a word is offending or not.
    after = accumulate(odds[:0:-1], lambda s, e: (back + stay * e * s) / (1 + into * e * s), initial=1.0)
    both = np.array(forward) * np.array(list(after)[::-1])
    return both / (1 + both)


def _evidence(probability: np.ndarray) -> tuple[float, float]:
    """Expected number of offending words, and their share, as logarithms."""
    number = float(probability.sum())
    return float(np.log(number + 0.01)), float(np.log((number + 0.01) / (len(probability) + 10)))


class Tagger:
    """Applies a field to texts; remembers words in bounded memory."""

    def __init__(self, field: Field) -> None:
        self.field = field
        self._forget()

    def _forget(self) -> None:
        self.place: dict[str, int] = {}
        self.known = np.empty((1024, 3))

    def _numbers(self, words: list[str]) -> np.ndarray:
        if len(self.place) > _REMEMBERED:
            self._forget()
        place, get, at = self.place, self.place.get, []
        for word in words:
            k = get(word)
            if k is None:
                k = place[word] = len(place)
                if k >= len(self.known):
                    self.known = np.concatenate([self.known, np.empty_like(self.known)])
                self.known[k] = self.field.weights(word)
            at.append(k)
        return self.known[at]

    def tag(self, words: list[str]) -> np.ndarray:
        """Marginal probability of each word to be offending."""
        if not words:
            return np.empty(0)
        own, before, after = self._numbers(words).T
        score = own.copy()
        score[1:] += before[:-1]
        score[:-1] += after[1:]
        odds = np.exp(np.clip(score, -_STEEPEST, _STEEPEST))
        return marginals(odds.tolist(), self.field.odds)

    def score(self, text: str | None) -> float:
        return _sigmoid(self.field.document, _evidence(self.tag(_WORD.findall(text or ""))))

    def spans(self, text: str | None, least: float) -> tuple[float, list[tuple[int, int, float]]]:
        """The score, and (start, end, greatest probability) of runs of words that are
        offending with at least this probability, in characters."""
        found = list(_WORD.finditer(text or ""))
        probability = self.tag([m.group() for m in found])
        out: list[tuple[int, int, float]] = []
        last = -2
        for k in np.flatnonzero(probability >= least).tolist():
            p = float(probability[k])
            if k == last + 1:
                out[-1] = (out[-1][0], found[k].end(), max(out[-1][2], p))
            else:
                out.append((found[k].start(), found[k].end(), p))
            last = k
        return _sigmoid(self.field.document, _evidence(probability)), out


def _sigmoid(weights: tuple[float, float, float], evidence: tuple[float, float]) -> float:
    x = weights[0] + weights[1] * evidence[0] + weights[2] * evidence[1]
    return float(1 / (1 + np.exp(-np.clip(x, -_STEEPEST, _STEEPEST))))


class Corpus:
    """Labelled texts as numbers of their different words."""

    def __init__(self, texts: list[tuple[str, int]]) -> None:
        # Copies teach once: texts in the order of their content.
        texts = sorted({(t or "", y) for t, y in texts})
        names: dict[str, int] = {}
        flat: list[int] = []
        lengths = []
        for text, _ in texts:
            words = _WORD.findall(text)
            flat += [names.setdefault(w.lower(), len(names)) for w in words]
            lengths.append(len(words))
        self.words = list(names)
        self.word = np.array(flat, np.int64)
        self.length = np.array(lengths, np.int64)
        self.text = np.repeat(np.arange(len(texts)), self.length)
        self.toxic = np.array([y for _, y in texts], np.int64)

    def part(self, texts: np.ndarray) -> Corpus:
        """Some of the texts."""
        out = object.__new__(Corpus)
        kept = np.isin(self.text, texts)
        out.words, out.word = self.words, self.word[kept]
        out.length, out.toxic = self.length[texts], self.toxic[texts]
        out.text = np.repeat(np.arange(len(texts)), out.length)
        return out

    def offending(self, least_ratio: float, least_evidence: float) -> np.ndarray:
        """Whether each word of a toxic text is labelled as offending."""
        toxic = self.toxic[self.text].astype(bool)
        if not toxic.any() or toxic.all():
            return np.zeros(len(self.word), bool)
        n = len(self.words) + 1
        first = np.concatenate([[True], self.text[1:] != self.text[:-1]])
        last = np.concatenate([first[1:], [True]])
        before = np.where(first, 0, np.concatenate([[0], self.word[:-1]]) + 1)
        after = np.where(last, 0, np.concatenate([self.word[1:], [0]]) + 1)
        # Up to 2**21 different words: the sample is bounded.
        context = (before * n + self.word) * n + after
        telling = np.zeros(len(self.words), bool)
        for width in (0, *_TELLING):
            names: dict[str, int] = {}
            of = np.array(
                [names.setdefault(w[:width] if width else w, len(names)) if len(w) > width else -1 for w in self.words]
            )
            counts = []
            for kind in (toxic, ~toxic):
                some = np.flatnonzero(kind & (of[self.word] >= 0))
                _, one = np.unique(context[some], return_index=True)
                contexts = np.bincount(of[self.word[some[one]]], minlength=len(names))
                _, one = np.unique(self.text[some] * n + of[self.word[some]], return_index=True)
                texts = np.bincount(of[self.word[some[one]]], minlength=len(names))
                counts.append(np.minimum(contexts, texts))
            a, b = counts
            share = self.toxic.mean()  # of texts, as both counts are of texts at most
            ratio = (a + 0.5) / (b + 0.5) * (1 - share) / share
            expected = (a + b) * share
            evidence = 2 * (a * np.log(np.maximum(a, 1) / np.maximum(expected, 1e-9))
                            + b * np.log(np.maximum(b, 1) / np.maximum(a + b - expected, 1e-9)))
            good = (ratio >= least_ratio) & (evidence >= least_evidence)
            telling |= (of >= 0) & good[of]
        return telling[self.word] & toxic


def _chains(corpus: Corpus) -> tuple[np.ndarray, np.ndarray]:
    """Places of words as a matrix of chains by step, and the number of open chains at
    each step; the longest chains come first."""
    ends = np.cumsum(corpus.length)
    begin, size = [], []
    for end, length in zip(ends.tolist(), corpus.length.tolist()):
        for at in range(end - length, end, _PIECE):
            begin.append(at)
            size.append(min(_PIECE, end - at))
    order = np.argsort(-np.array(size, np.int64), kind="stable")
    first, size = np.array(begin, np.int64)[order], np.array(size, np.int64)[order]
    places = first[None, :] + np.arange(_PIECE)[:, None]
    return places, np.array([np.count_nonzero(size > t) for t in range(_PIECE)])


class Trainer:
    """Regularised log likelihood of tags, and its gradient."""

    def __init__(self, corpus: Corpus, tags: np.ndarray, ridge: float) -> None:
        self.corpus, self.tags, self.ridge = corpus, tags.astype(np.float64), ridge
        self.places, self.open = _chains(corpus)
        used = np.bincount(corpus.word, minlength=len(corpus.words))
        names: dict[str, int] = {}
        rows, columns = [], []
        for k in np.flatnonzero(used).tolist():
            for name in _features(corpus.words[k]):
                columns.append(names.setdefault(name, len(names)))
                rows.append(k)
        self.names, self.rows, self.columns = list(names), np.array(rows, np.int64), np.array(columns, np.int64)
        self.n_own, self.n_words = len(names), len(corpus.words)
        self.size = self.n_own + 2 * self.n_words + 4  # and bias, three links
        first = np.zeros(len(corpus.word), bool)
        first[self.places[0, : self.open[0]]] = True
        self.inner = np.flatnonzero(~first)  # words with one before them in the chain

    def parts(self, w: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, float, np.ndarray]:
        a, b = self.n_own, self.n_own + self.n_words
        return w[:a], w[a:b], w[b : b + self.n_words], w[-4], w[-3:]

    def scores(self, w: np.ndarray) -> np.ndarray:
        own, before, after, bias, _ = self.parts(w)
        by_word = np.bincount(self.rows, weights=own[self.columns], minlength=self.n_words) + bias
        out = by_word[self.corpus.word]
        out[self.inner] += before[self.corpus.word[self.inner - 1]]
        out[self.inner - 1] += after[self.corpus.word[self.inner]]
        return out

    def __call__(self, w: np.ndarray) -> tuple[float, np.ndarray]:
        """What is to be made small, and its gradient."""
        if not len(self.corpus.word):
            return 0.5 * self.ridge * float(w @ w), self.ridge * w
        links = w[-3:]
        into, stay, back = np.exp(np.clip(links, -_STEEPEST, _STEEPEST))
        score = self.scores(w)
        odds = np.exp(np.clip(score, -_STEEPEST, _STEEPEST))
        forward, rest = np.empty_like(odds), np.ones_like(odds)
        total = 0.0
        for t in range(_PIECE):
            here = self.places[t, : self.open[t]]
            if not len(here):
                break
            if t:
                r = forward[here - 1]
                total += np.log1p(back * r).sum()
                forward[here] = odds[here] * (into + stay * r) / (1 + back * r)
            else:
                forward[here] = odds[here]
        last = np.ones(len(odds), bool)
        last[self.inner - 1] = False
        total += np.log1p(forward[last]).sum()
        for t in range(_PIECE - 1, 0, -1):
            here = self.places[t, : self.open[t]]
            if len(here):
                c = odds[here] * rest[here]
                rest[here - 1] = (back + stay * c) / (1 + into * c)
        both = forward * rest
        expected = both / (1 + both)
        # Pairs of neighbouring tags.
        x, y = self.inner - 1, self.inner
        r, c = forward[x], odds[y] * rest[y]
        whole = 1 + into * c + back * r + stay * r * c
        p, q = self.tags[x], self.tags[y]
        pairs = [(1 - p) * q - into * c / whole, p * q - stay * r * c / whole, p * (1 - q) - back * r / whole]
        seen = [float((1 - p) @ q), float(p @ q), float(p @ (1 - q))]
        value = total - float(self.tags @ score) - float(np.dot(links, seen)) + 0.5 * self.ridge * float(w @ w)
        miss = expected - self.tags
        by_word = np.bincount(self.corpus.word, weights=miss, minlength=self.n_words)
        gradient = np.concatenate([
            np.bincount(self.columns, weights=by_word[self.rows], minlength=self.n_own),
            np.bincount(self.corpus.word[x], weights=miss[y], minlength=self.n_words),
            np.bincount(self.corpus.word[y], weights=miss[x], minlength=self.n_words),
            [miss.sum()],
            [-g.sum() for g in pairs],
        ])
        return value, gradient + self.ridge * w


def _minimum(f, n: int, steps: int, memory: int = 8) -> np.ndarray:
    """A minimum by limited-memory quasi-Newton steps with halving."""
    w = np.zeros(n)
    value, gradient = f(w)
    history: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(steps):
        direction, used = gradient.copy(), []
        for s, y in reversed(history):
            a = float(s @ direction) / float(s @ y)
            direction -= a * y
            used.append(a)
        if history:
            s, y = history[-1]
            direction *= float(s @ y) / float(y @ y)
        else:
            direction /= max(1.0, float(np.abs(gradient).max()))
        for (s, y), a in zip(history, reversed(used)):
            direction += (a - float(y @ direction) / float(s @ y)) * s
        slope, step = float(gradient @ direction), 1.0
        while True:
            new = w - step * direction
            new_value, new_gradient = f(new)
            if new_value <= value - 1e-4 * step * slope or step < 1e-6:
                break
            step /= 2
        s, y = new - w, new_gradient - gradient
        if float(s @ y) > 1e-10:
            history = [*history[1 - memory :], (s, y)]
        done = value - new_value < 1e-6 * abs(value)
        w, value, gradient = new, new_value, new_gradient
        if done:
            break
    return w


def _fitted(corpus: Corpus, tags: np.ndarray, ridge: float, steps: int) -> Field:
    trainer = Trainer(corpus, tags, ridge)
    own, before, after, bias, links = trainer.parts(_minimum(trainer, trainer.size, steps))

    def named(names: list[str], weights: np.ndarray) -> dict[str, float]:
        return {names[k]: float(weights[k]) for k in np.flatnonzero(np.abs(weights) > 1e-3).tolist()}

    odds = np.exp(np.clip(links, -_STEEPEST, _STEEPEST))
    return Field(
        named(trainer.names, own), named(corpus.words, before), named(corpus.words, after),
        float(bias), tuple(odds.tolist()), (0.0, 0.0, 0.0),
    )


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 0.1) -> np.ndarray:
    """Coefficients of a weighted logistic regression, by Newton's method."""
    x = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(x.shape[1])
    penalty = ridge * np.diag([1e-3, 1.0, 1.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -_STEEPEST, _STEEPEST)))
        gradient = x.T @ (weight * (p - y)) + penalty @ w
        step = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + penalty, gradient)
        size = float(np.abs(step).max())
        w -= step * min(1.0, 4.0 / max(size, 1e-9))
        if size < 1e-8:
            break
    return w


def fit(
    texts: list[tuple[str, int]],
    clean_weight: float = 1.0,
    least_ratio: float = 10.0,
    least_evidence: float = 15.0,
    ridge: float = 0.5,
    steps: int = 60,
) -> Field:
    """A field from labelled texts (1: toxic).

    The document score is fitted on texts that the field was not trained on: each half
    of the texts is tagged by a field from the other half. ``clean_weight`` is the number
    of clean texts that one in the sample stands for, compared with toxic ones.
    """
    corpus = Corpus(texts)
    tags = corpus.offending(least_ratio, least_evidence)
    evidence, labels = [], []
    every = np.arange(len(corpus.length))
    for fold in (0, 1):
        rest = every[every % 2 != fold]
        taught = _fitted(corpus.part(rest), tags[np.isin(corpus.text, rest)], ridge, steps)
        tagger = Tagger(taught)
        ends = np.cumsum(corpus.length)
        for k in every[every % 2 == fold].tolist():
            words = [corpus.words[i] for i in corpus.word[ends[k] - corpus.length[k] : ends[k]].tolist()]
            evidence.append(_evidence(tagger.tag(words)))
            labels.append(corpus.toxic[k])
    y = np.array(labels, np.float64)
    weight = np.where(y == 1, 1.0, clean_weight)
    document = np.array([-_STEEPEST, 0.0, 0.0])
    if y.any():
        document = _logistic(np.array(evidence).reshape(-1, 2), y, weight)
    whole = _fitted(corpus, tags, ridge, steps)
    return Field(whole.own, whole.before, whole.after, whole.bias, whole.odds, tuple(document.tolist()))


def learn(
    docs: DataFrame,
    labels: DataFrame,
    sample_bytes: int = 3_000_000,
    id_column: str = "doc_id",
    text_column: str = "text",
    toxic_column: str = "toxic",
    **options: float,
) -> Field:
    """A field from labelled documents that are not held out.

    Texts of each label are drawn by hash of their id, about ``sample_bytes`` of each (64
    bytes more for each text, so their number is bounded too); the sample is trained on
    the driver. A document with several labels is toxic if any says so; null labels, null
    ids and labels without a document teach nothing.
    """
    spark = docs.sparkSession
    marked = labels.select(F.col(id_column).alias("id"), (F.col(toxic_column) != 0).cast("int").alias("toxic"))
    marked = marked.where("id is not null and toxic is not null").groupBy("id").agg(F.max("toxic").alias("toxic"))
    size = F.coalesce(F.octet_length(text_column), F.lit(0)) + 64
    sized = docs.where(~held_out(id_column)).select(F.col(id_column).alias("id"), size.cast("long").alias("size"))
    sized = sized.join(marked, "id")
    totals = {r["toxic"]: (r["bytes"], r["n"]) for r in sized.groupBy("toxic").agg(
        F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n")).collect()}
    shares = {y: min(1.0, sample_bytes / totals[y][0]) if y in totals else 0.0 for y in (0, 1)}
    share = F.when(F.col("toxic") == 1, F.lit(shares[1])).otherwise(F.lit(shares[0]))
    drawn = F.pmod(F.xxhash64(F.col("id"), F.lit(17)), F.lit(1_000_000)) < share * 1_000_000
    picked = [tuple(r) for r in sized.where(drawn).select("id", "toxic").distinct().collect()]
    # At most sample_bytes / 64 rows of each label.
    chosen = F.broadcast(spark.createDataFrame(picked, marked.schema))
    texts = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text")).join(chosen, "id")
    sample = [(r["text"], r["toxic"]) for r in texts.select("text", "toxic").collect()]
    clean_weight = shares[1] / shares[0] if shares[0] and shares[1] else 1.0
    return fit(sample, clean_weight, **options)


def toxicity(
    docs: DataFrame,
    labels: DataFrame,
    threshold: float = 0.3,
    least: float = 0.5,
    with_spans: bool = False,
    id_column: str = "doc_id",
    text_column: str = "text",
    toxic_column: str = "toxic",
    **options: float,
) -> DataFrame:
    """One row per document: id, held_out, score and predicted.

    Learns as ``learn`` says and scores every whole text, from the text alone.
    ``predicted`` is 1 from ``threshold`` on. ``with_spans`` adds ``spans``: start and end
    in characters, and the greatest probability, of runs of words that are offending with
    probability ``least`` or more. Null, empty and wordless texts have no offending word
    and the score that says. If no toxic document is there to learn from, every score is
    next to zero. Repeated rows get equal rows; null ids are held out or not like the
    empty id; other columns are ignored; an empty table gives an empty result.
    """
    smaller_batches(docs.sparkSession)
    field = learn(docs, labels, id_column=id_column, text_column=text_column, toxic_column=toxic_column, **options)
    known = docs.sparkSession.sparkContext.broadcast(field)  # bounded by the sample
    names = ("start", "end", "probability")
    span = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("probability", pa.float64())])
    result = "score double, spans array<struct<start: long, end: long, probability: double>>"

    @F.arrow_udf(result)
    def judge(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tagger = Tagger(known.value)
        for texts in batches:
            rows = [tagger.spans(t.as_py(), least) if with_spans else (tagger.score(t.as_py()), ()) for t in texts]
            scores = pa.array([s for s, _ in rows], pa.float64())
            spans = pa.array([[dict(zip(names, x)) for x in found] for _, found in rows], pa.list_(span))
            yield pa.StructArray.from_arrays([scores, spans], names=["score", "spans"])

    judged = docs.select(
        F.col(id_column).alias("id"), held_out(id_column).alias("held_out"), judge(F.col(text_column)).alias("judged")
    )
    return judged.select(
        F.col("id").alias(id_column),
        "held_out",
        F.col("judged.score").alias("score"),
        (F.col("judged.score") >= threshold).cast("int").alias("predicted"),
        *([F.col("judged.spans").alias("spans")] if with_spans else []),
    )
