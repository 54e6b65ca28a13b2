"""Token counts of fields and sections by offset-mapped attribution.

The fields of a document are joined and encoded once, as a model would read them.
Each token's character span is joined with the spans of the sections; a token that
crosses a boundary is allocated by an explicit rule.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: how texts are cut before the vocabulary's merges apply.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
RULES = ("start", "end", "majority")


class Encoder:
    """Byte-level encoding with the byte length of each token."""

    def __init__(self, vocabulary: bytes, pattern: str) -> None:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, vocabulary.splitlines())}
        self.encoding = tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.lengths = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, rank in ranks.items():
            self.lengths[rank] = len(token)

    def ends(self, text: str) -> np.ndarray:
        """Byte offset at which each token ends."""
        return np.cumsum(self.lengths[self.encoding.encode_ordinary(text)])


def allocate(text: str, token_ends: np.ndarray, section_starts: Sequence[int], rule: str) -> np.ndarray:
    """Number of tokens of each section; sections cover the text, by first character.

    A token's characters are those it has a byte of. It goes to the section of its
    first character (``start``), of its last (``end``), or to the one with most of its
    characters, the earliest of several (``majority``).
    """
    n = len(section_starts)
    if not len(token_ends):
        return np.zeros(n, np.int64)
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    starts_in = np.asarray(section_starts, np.int64)
    if len(raw) == len(text):
        first = np.concatenate([[0], token_ends[:-1]])
        last = token_ends - 1
    else:
        char = np.cumsum((raw & 0xC0) != 0x80) - 1
        first = char[np.concatenate([[0], token_ends[:-1]])]
        last = char[token_ends - 1]
    # Empty sections share their start with the next one, and no character is theirs.
    low = np.searchsorted(starts_in, first, "right") - 1
    high = np.searchsorted(starts_in, last, "right") - 1
    chosen = high if rule == "end" else low
    if rule == "majority":
        chosen = low.copy()
        for k in np.flatnonzero(low != high):
            bounds = [first[k], *starts_in[low[k] + 1 : high[k] + 1], last[k] + 1]
            chosen[k] = low[k] + int(np.argmax(np.diff(bounds)))
    return np.bincount(chosen, minlength=n)


def token_counts(
    docs: DataFrame,
    fields: Sequence[str] = ("text",),
    separator: str = "\n\n",
    section: str | None = r"\n",
    rule: str = "start",
    vocabulary: str = VOCABULARY,
    pattern: str = PATTERN,
    id_column: str = "doc_id",
) -> DataFrame:
    """One row for each section: id, field, section, start, end and n_tokens.

    A document is its non-null fields joined by ``separator``; each field is cut into
    sections after every match of ``section`` (None: one section for a field).
    Separators and matches belong to the section before them, so sections cover the
    document, and their counts add up to the tokens of the whole document. ``start``
    and ``end`` are characters of the joined document; sections are numbered within
    their field. Null fields have no sections, empty fields one without characters of
    its own; a document whose fields are all null has no row. Rows are handled one by
    one: repeated rows give equal rows, other columns are ignored, and an empty table
    gives an empty result. The vocabulary is read on the driver and sent to the tasks.
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    with open(vocabulary, "rb") as file:
        known = docs.sparkSession.sparkContext.broadcast(file.read())  # one vocabulary file
    cut = re.compile(section) if section else None
    id_type = docs.schema[id_column].dataType.simpleString()
    schema = f"`{id_column}` {id_type}, field string, section int, start long, end long, n_tokens long"
    names = [id_column, "field", "section", "start", "end", "n_tokens"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(known.value, pattern)
        for batch in batches:
            where, field_of, number, start_of, end_of, tokens = [], [], [], [], [], []
            for row in range(batch.num_rows):
                texts = [(f, v) for f, c in zip(fields, batch.columns[1:]) if (v := c[row].as_py()) is not None]
                if not texts:
                    continue
                starts, at = [], 0
                for k, (field, value) in enumerate(texts):
                    ends = [m.end() for m in cut.finditer(value)] if cut else []
                    inner = [0, *(e for e in ends if 0 < e < len(value))]
                    starts += [at + s for s in inner]
                    field_of += [field] * len(inner)
                    number += range(len(inner))
                    at += len(value) + (len(separator) if k + 1 < len(texts) else 0)
                whole = separator.join(v for _, v in texts)
                counted = allocate(whole, encoder.ends(whole), starts, rule)
                where += [row] * len(starts)
                start_of += starts
                end_of += [*starts[1:], at]
                tokens.append(counted)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(where, pa.int64())),
                    pa.array(field_of, pa.string()),
                    pa.array(number, pa.int32()),
                    pa.array(start_of, pa.int64()),
                    pa.array(end_of, pa.int64()),
                    pa.array(np.concatenate(tokens or [np.empty(0, np.int64)])),
                ],
                names,
            )

    return docs.select(F.col(id_column), *[F.col(f).cast("string").alias(f"f{k}") for k, f in enumerate(fields)]).mapInArrow(run, schema)
