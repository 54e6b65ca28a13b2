"""URL filter by a weighted vocabulary.

One Aho-Corasick automaton finds all terms of the vocabulary in a lower-cased URL.
A hit counts if no letter or digit stands directly before or after it. One strict
term, or several different soft ones, reject the URL. Rules for hosts and paths come
before the vocabulary.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

STRICT = ("casino", "malware", "phishing", "porn", "spam", "viagra", "warez", "xxx")
SOFT = (
    "ads", "adult", "banner", "bet", "cheap", "click", "deals", "farm", "free", "loan", "pills", "poker",
    "popup", "promo", "sex", "sponsor", "track", "tracker", "win",
)

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_TO_LOWER = str.maketrans(_UPPER, _LOWER)
_INNER = frozenset(_LOWER + "0123456789")


@dataclass(frozen=True)
class Rule:
    """Fits a host with all its subdomains, and paths that start with ``path``."""

    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


def _parts(url: str | None) -> tuple[str, str]:
    """Lower-cased host and path; both empty without ``://``."""
    _, mark, rest = (url or "").partition("://")
    if not mark:
        return "", ""
    ends = [k for c in "?#" if (k := rest.find(c)) >= 0]
    rest = rest[: min(ends, default=len(rest))]
    host, slash, path = rest.partition("/")
    return host.translate(_TO_LOWER), slash + path


class Filter:
    """Rules and vocabulary, ready to judge one URL after another."""

    def __init__(self, rules: Sequence[Rule], strict: Sequence[str], soft: Sequence[str], least_soft: int) -> None:
        self.least_soft = least_soft
        self.rules: dict[str, list[Rule]] = {}
        for rule in sorted(rules, key=lambda r: -len(r.path)):
            self.rules.setdefault(rule.host, []).append(rule)
        self.terms = ahocorasick.Automaton()
        for terms, is_strict in ((soft, False), (strict, True)):
            for term in terms:
                self.terms.add_word(term, (term, is_strict))
        if len(self.terms):
            self.terms.make_automaton()

    def rule(self, host: str, path: str) -> Rule | None:
        """The longest rule that fits; of equally long ones that of the longer host."""
        best, suffix = None, host
        while suffix:
            for rule in self.rules.get(suffix, ()):
                if path.startswith(rule.path):
                    if best is None or len(rule.name) > len(best.name):
                        best = rule
                    break
            suffix = suffix.partition(".")[2]
        return best

    def hits(self, url: str | None) -> tuple[int, int]:
        """Numbers of different strict and soft terms."""
        found: tuple[set, set] = (set(), set())
        if url and len(self.terms):
            text = url.translate(_TO_LOWER)
            for last, (term, is_strict) in self.terms.iter(text):
                first = last - len(term) + 1
                if (first == 0 or text[first - 1] not in _INNER) and text[last + 1 : last + 2] not in _INNER:
                    found[not is_strict].add(term)
        return len(found[0]), len(found[1])

    def judge(self, url: str | None) -> tuple[str, str, str | None, str, int, int]:
        host, path = _parts(url)
        rule = self.rule(host, path)
        strict, soft = self.hits(url)
        if rule is not None:
            return host, path, rule.name, rule.verdict, strict, soft
        rejected = strict > 0 or soft >= self.least_soft
        return host, path, None, "block" if rejected else "allow", strict, soft


def judge_urls(
    pages: DataFrame,
    rules: Sequence[Rule] = (),
    strict: Sequence[str] = STRICT,
    soft: Sequence[str] = SOFT,
    least_soft: int = 2,
    id_column: str = "page_id",
    url_column: str = "url",
) -> DataFrame:
    """One row per page: id, host, path, rule, verdict, strict_hits and soft_hits.

    ``verdict`` is that of the longest fitting rule, or else ``block`` for a URL with
    one strict or ``least_soft`` different soft terms and ``allow`` for the rest.
    Hits are numbers of different terms in the whole URL. A null URL has no host,
    path or hits and is allowed. Rows are judged one by one, so order, repeats and
    other columns play no part; an empty table gives an empty result. Vocabulary and
    rules are parameters and travel with the task.
    """
    id_type = pages.schema[id_column].dataType.simpleString()
    schema = f"`{id_column}` {id_type}, host string, path string, rule string, verdict string, strict_hits long, soft_hits long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = Filter(rules, strict, soft, least_soft).judge
        kinds = [pa.string()] * 4 + [pa.int64()] * 2
        names = [id_column, "host", "path", "rule", "verdict", "strict_hits", "soft_hits"]
        for batch in batches:
            columns = list(zip(*map(judge, batch.column(1).to_pylist()))) or [()] * 6
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], names)

    return pages.select(F.col(id_column), F.col(url_column)).mapInArrow(run, schema)
