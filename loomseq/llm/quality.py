"""Quality rules on whole texts: word statistics and suffix-array repetition.

For each document a suffix array over its words is built by prefix doubling,
where after the first three doublings only suffixes that still share their
eight-word prefix with another are refined: all others are singletons and end
no longest-common-prefix interval of the threshold or more. From the ordered
suffixes, neighbouring longest common prefixes give, for every position, the
longest repeat that starts there; the union of these spans is the union of all
maximal repeated substrings of at least ``min_repeat`` words. The share of the
document under that union and the length of the longest repeat are limited.

Everything is per row, in one Arrow pass: no shuffle, no state across rows.

Defined results: null or empty text has no words, counts zero everywhere and
fails the base rules; a null id is kept; repeated rows are judged each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MIN_WORDS = 20
#: Percent of words in repeated windows above which the base rules fail.
MAX_REPEAT_PERCENT = 30
WINDOW = 8
#: The method's own limits: share of the words' bytes under repeats, words of the longest repeat, and its share of all words.
MAX_COVERED = 0.30
MAX_LONGEST_WORDS = 200
MAX_LONGEST_SHARE = 0.25
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"

_MIX = np.uint64(0x9E3779B97F4A7C15)


def _paired(h: np.ndarray, step: int) -> np.ndarray:
    """Hashes of runs twice as long: of positions i and i + step."""
    a, b = h[: len(h) - step], h[step:]
    x = (a ^ (a >> np.uint64(29))) * _MIX + b
    return x ^ (x >> np.uint64(32))


def repeats(words: list[bytes], window: int = WINDOW) -> tuple[np.ndarray, int]:
    """For each word whether a repeat of ``window`` (a power of two) words or more covers it; the longest repeat in words."""
    n = len(words)
    covered = np.zeros(n, bool)
    if n <= window:
        return covered, 0
    levels = [np.fromiter(map(hash, words), np.int64, n).view(np.uint64)]
    while 1 << (len(levels) - 1) < window:
        levels.append(_paired(levels[-1], 1 << (len(levels) - 1)))
    top = levels[-1]
    order = np.argsort(top, kind="stable")
    same = top[order[1:]] == top[order[:-1]]
    if not same.any():
        return covered, 0
    inside = np.zeros(len(top), bool)
    inside[1:] |= same
    inside[:-1] |= same
    at = np.sort(order[inside])  # suffixes that share their first ``window`` words with another
    order = np.unique(levels[0], return_inverse=True)[1].astype(np.int64)  # any order of the words serves, kept by each doubling
    for step in range(len(levels) - 1):
        ahead = np.full(n, -1, np.int64)
        ahead[: n - (1 << step)] = order[1 << step :]
        order = np.unique(order * np.int64(n + 1) + ahead + 1, return_inverse=True)[1].astype(np.int64)
    # A suffix's rank is the number of suffixes that are smaller by their present length; equal ranks share that prefix.
    counts = np.bincount(order)
    rank = np.append((np.cumsum(counts) - counts)[order], -1)
    length, ranks = window, []
    while True:
        ranks.append((length, rank.copy()))
        key = rank[at] * np.int64(n + 2) + rank[np.minimum(at + length, n)] + 1
        by_key = np.argsort(key, kind="stable")
        key, old = key[by_key], rank[at[by_key]]
        first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        first_old = np.flatnonzero(np.r_[True, old[1:] != old[:-1]])
        sizes = np.diff(np.r_[first, len(key)])
        start, start_old = np.repeat(first, sizes), np.repeat(first_old, np.diff(np.r_[first_old, len(key)]))
        rank[at[by_key]] = old + start - start_old
        length *= 2
        if sizes.max() == 1:
            break
    suffixes = at[by_key]
    a, b = suffixes[:-1], suffixes[1:]
    common = np.zeros(len(a), np.int64)
    for step, r in reversed(ranks):
        x, y = np.minimum(a + common, n), np.minimum(b + common, n)
        common += np.where((r[x] == r[y]) & (x < n) & (y < n), step, 0)
    for level in range(len(levels) - 2, -1, -1):
        h, step = levels[level], 1 << level
        x, y = a + common, b + common
        fits = (x < len(h)) & (y < len(h))
        common += np.where(fits & (h[np.minimum(x, len(h) - 1)] == h[np.minimum(y, len(h) - 1)]), step, 0)
    longest = np.zeros(len(suffixes), np.int64)
    longest[:-1] = common
    longest[1:] = np.maximum(longest[1:], common)
    edges = np.zeros(n + 1, np.int64)
    keep = longest >= window
    np.add.at(edges, suffixes[keep], 1)
    np.add.at(edges, suffixes[keep] + longest[keep], -1)
    return np.cumsum(edges[:-1]) > 0, int(longest.max())


def judge(text: str) -> tuple:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, covered_share, longest_repeat, kept."""
    words = text.encode("utf-8", "replace").split()
    n = len(words)
    seen, dup_lines = set(), 0
    for line in text.split("\n"):
        if line in seen:
            dup_lines += 1
        elif line.strip(SPACES):
            seen.add(line)
    covered, longest = repeats(words)
    repeated = int(covered.sum())
    share = 0.0
    if repeated:
        sizes = np.fromiter(map(len, words), np.int64, n)
        share = float(sizes[covered].sum() / sizes.sum())
    failed = n < MIN_WORDS or 100 * repeated > MAX_REPEAT_PERCENT * n
    kept = not failed and share <= MAX_COVERED and not (longest > MAX_LONGEST_WORDS and longest > MAX_LONGEST_SHARE * n)
    return n, len(text) - sum(map(text.count, SPACES)), sum(map(text.count, SYMBOLS)), dup_lines, repeated, failed, share, longest, kept


_NAMES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "covered_share", "longest_repeat", "kept"]
_TYPES = [pa.int64()] * 5 + [pa.bool_(), pa.float64(), pa.int64(), pa.bool_()]
_DDL = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, covered_share double, longest_repeat long, kept boolean"


def quality_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id and what ``judge`` finds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = list(zip(*(judge(t.as_py() or "") for t in batch.column(1)), strict=True)) or [[]] * len(_NAMES)
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, t) for c, t in zip(found, _TYPES))], names=["doc_id", *_NAMES])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, f"doc_id long, {_DDL}")


def keep_good(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns as they are, whose text is kept."""
    names = docs.columns
    at = names.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array([judge(t.as_py() or "")[-1] for t in batch.column(at)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
