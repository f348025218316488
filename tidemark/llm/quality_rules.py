"""Quality rules: counts per text and how much of it is repetition."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm.annotate import annotate
from tidemark.llm.words import find_words, lines, mix, span_hashes, text_bytes

U64 = np.uint64


@dataclass(frozen=True)
class Rules:
    """Limits a document must keep; percentages are of its word characters.

    ``ngram_percent`` has, per n-gram length, the largest share of characters
    in n-grams that occur twice or more in the text; ``line_percent`` that of
    characters in lines that do. What repeated 12-grams cover, repeated 5-grams cover
    too, so only limits that fall with the length let the longer ones decide: long
    repetitions count for more than short ones.
    """

    min_words: int = 10
    window: int = 5
    repeat_percent: int = 20
    ngram_percent: dict[int, int] = field(
        default_factory=lambda: {5: 20, 8: 18, 12: 16}
    )
    line_percent: int = 30


FIELDS = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, "
    "n_repeat_words long, repeat_chars array<long>, dup_line_chars long, "
    "base_failed boolean, kept boolean"
)


def _flags(characters: str) -> np.ndarray:
    table = np.zeros(256, bool)
    table[[ord(c) for c in characters]] = True
    return table


_SYMBOL = _flags("#*$%&|<>")
_LEADS = np.ones(256, bool)  # bytes that begin a character
_LEADS[0x80:0xC0] = False


def _running(values: np.ndarray) -> np.ndarray:
    out = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=out[1:])
    return out


def _again(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Flags of keys that occur twice or more, and of those that occurred before."""
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    same = ordered[1:] == ordered[:-1]
    later = np.zeros(len(keys), bool)
    later[order[1:]] = same
    twice = later.copy()
    twice[order[:-1]] |= same
    return twice, later


def _covered(words, hashes: np.ndarray, text_of: np.ndarray, n: int) -> np.ndarray:
    """Flags of words inside n-word windows that their text has twice or more."""
    first, windows = words.windows(hashes, n)
    if not len(first):
        return np.zeros(len(hashes), bool)
    twice, _ = _again(mix(windows ^ mix(text_of[first].astype(U64), 7)))
    step = np.zeros(len(hashes) + 1, np.int64)
    np.add.at(step, first[twice], 1)
    np.subtract.at(step, first[twice] + n, 1)
    return np.cumsum(step[:-1]) > 0


def measure(column: pa.Array, rules: Rules) -> dict[str, pa.Array]:
    """All columns of FIELDS for a column of texts."""
    offsets, data = text_bytes(column)
    words = find_words(offsets, data)
    bound, counts = words.bound, words.counts
    hashes, text_of = words.hashes(), words.text_of()

    leads = _running(_LEADS[data])
    chars = leads[words.end] - leads[words.start]
    in_words = _running(chars)
    word_chars = in_words[bound[1:]] - in_words[bound[:-1]]
    symbols = _running(_SYMBOL[data])
    n_symbols = symbols[offsets[1:]] - symbols[offsets[:-1]]

    repeat_chars = []
    covered = _covered(words, hashes, text_of, rules.window)
    repeated = _running(covered)
    n_repeat = repeated[bound[1:]] - repeated[bound[:-1]]
    for n in rules.ngram_percent:
        inside = covered if n == rules.window else _covered(words, hashes, text_of, n)
        sums = _running(np.where(inside, chars, 0))
        repeat_chars.append(sums[bound[1:]] - sums[bound[:-1]])

    start, end, first_line = lines(offsets, data)
    word_at = np.searchsorted(words.start, start), np.searchsorted(words.start, end)
    owner = np.repeat(np.arange(len(counts)), np.diff(first_line))
    full = word_at[0] < word_at[1]
    start, end, owner = start[full], end[full], owner[full]
    line_chars = in_words[word_at[1][full]] - in_words[word_at[0][full]]
    keys = mix(span_hashes(data, start, end) ^ mix(owner.astype(U64), 9))
    twice, later = _again(keys)
    n_dup = np.bincount(owner[later], minlength=len(counts))
    dup_chars = np.bincount(owner[twice], line_chars[twice], len(counts)).astype(np.int64)

    base_failed = (counts < rules.min_words) | (
        100 * n_repeat > rules.repeat_percent * counts
    )
    kept = ~base_failed & (100 * dup_chars <= rules.line_percent * word_chars)
    for found, most in zip(repeat_chars, rules.ngram_percent.values(), strict=True):
        kept &= 100 * found <= most * word_chars
    shares = np.stack(repeat_chars, axis=1) if repeat_chars else np.zeros((len(counts), 0))
    lists = pa.ListArray.from_arrays(
        np.arange(len(counts) + 1, dtype=np.int32) * shares.shape[1],
        pa.array(shares.ravel().astype(np.int64)),
    )
    return {
        "n_words": pa.array(counts, pa.int64()),
        "word_chars": pa.array(word_chars, pa.int64()),
        "n_symbols": pa.array(n_symbols, pa.int64()),
        "n_dup_lines": pa.array(n_dup, pa.int64()),
        "n_repeat_words": pa.array(n_repeat, pa.int64()),
        "repeat_chars": lists,
        "dup_line_chars": pa.array(dup_chars, pa.int64()),
        "base_failed": pa.array(base_failed),
        "kept": pa.array(kept),
    }


def with_quality(docs: DataFrame, rules: Rules | None = None, name: str = "quality") -> DataFrame:
    """``docs`` with a struct column of counts, repetition and the verdict.

    Words are runs of anything but ASCII blanks; texts are not lower-cased.
    A null or blank text has no words and fails ``min_words``. Repeated rows,
    nulls in other columns and further columns pass through; an empty table
    stays empty. A text of any length is measured whole.
    """
    rules = rules or Rules()
    return annotate(docs, lambda part: measure(part["text"], rules), FIELDS, name)
