"""Quality rules: repetition by a suffix array over the code points of each document.

The suffixes of a text are ranked by prefix doubling, from ranks of several code points at once. The longest common
prefix of neighbours in that order makes intervals, each of one repeated substring and all its occurrences; the deepest
interval that holds a suffix is the longest substring which begins there and occurs elsewhere, the larger of its two
common prefixes. The union of all repeats of MIN_REPEAT code points or more, those of maximal ones being enough, is the
covered part. A document fails if more than MOST_COVERED of its word characters are covered or if its longest repeat is
longer than MOST_REPEAT. Base windows are found by the same array over the document's words.

Cases: a null text is an empty one: no words, so base_failed; lines without a word are never duplicates; occurrences may
overlap one another, and may begin within a word, so text without blanks is judged as any other; of equally long repeats
all count; every text is read whole, and one text has to fit in a worker's memory (some 60 bytes a code point); equal rows
get equal results; no rows give none; extra columns pass through (an input column named like an output column, in
whatever case, is replaced).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orthoweave.llm.common import bounded_batches

#: Words of a base window; code points of a repeat that counts as covered; most of the word characters; longest repeat.
BASE_WINDOW, MIN_REPEAT, MOST_COVERED, MOST_REPEAT = 5, 16, 0.2, 600
#: Symbols that are ranked at once; a longer document is ranked alone.
AT_ONCE = 200_000
SYMBOLS = b"#*$%&|<>"


def repeats(tokens: np.ndarray, doc: np.ndarray, least: int = 1) -> np.ndarray:
    """For each place, the symbols of the longest substring from there that occurs at another place of its document.

    tokens: ids of symbols from 0 on; doc: number of the document, ascending. Repeats shorter than least count as 0.
    """
    n = len(tokens)
    if not n:
        return np.zeros(0, np.int64)
    ends = np.flatnonzero(np.r_[doc[1:] != doc[:-1], True])
    # A document's end is a symbol of its own (0), so a substring that reaches it occurs once.
    at = np.arange(n) + np.repeat(np.arange(len(ends)), np.diff(np.r_[-1, ends]))
    size = n + len(ends)
    text = np.zeros(size, np.int64)
    text[at] = tokens + 1
    owner = np.repeat(np.arange(len(ends)), np.diff(np.r_[-1, ends]) + 1)
    bits, own_bits = int(tokens.max() + 1).bit_length(), int(len(ends)).bit_length()
    step = max(1, min((62 - own_bits) // bits, least))
    key, alive = owner.copy(), np.ones(size, bool)
    for j in range(step):
        symbol = text if not j else np.concatenate([text[j:], np.zeros(min(j, size), np.int64)])[:size]
        alive &= symbol > 0
        key = key << bits | np.where(alive, symbol, 0)
    order = np.argsort(key)
    ranks = []
    rank, active = _rank(order, key[order], np.zeros(size, np.int64), np.zeros(size, np.int64))
    ranks.append(rank)
    h = step
    while len(active):
        key = rank[active] * np.int64(size + 1) + rank[active + h]
        order = np.argsort(key)
        moved = active[order]
        rank, active = _rank(moved, key[order], rank[moved], rank)
        ranks.append(rank)
        h *= 2
    sa = np.empty(size, np.int64)
    sa[rank] = np.arange(size)
    a, b = sa[:-1], sa[1:]
    for level, known in enumerate(ranks[:-1]):  # neighbours that share step << level symbols
        if level and step << level > least:
            break
        near = known[a] == known[b]
        a, b = a[near], b[near]
    common = np.zeros(len(a), np.int64)
    for level in range(len(ranks) - 2, -1, -1):
        same = ranks[level][a + common] == ranks[level][b + common]
        common[same] += step << level
    open_ = np.arange(len(a))
    for _ in range(step - 1):
        x, y = text[a[open_] + common[open_]], text[b[open_] + common[open_]]
        open_ = open_[(x == y) & (x > 0)]
        common[open_] += 1
    longest = np.zeros(size, np.int64)
    np.maximum.at(longest, a, common)
    np.maximum.at(longest, b, common)
    longest = longest[at]
    return np.where(longest >= least, longest, 0)


def _rank(places: np.ndarray, keys: np.ndarray, old: np.ndarray, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ranks after places were sorted by keys within their old groups, and the places that still share one."""
    n = len(places)
    index = np.arange(n)
    first = np.r_[True, keys[1:] != keys[:-1]]
    start = np.maximum.accumulate(np.where(first, index, 0))
    group = np.maximum.accumulate(np.where(np.r_[True, old[1:] != old[:-1]], index, 0))
    ranks = ranks.copy()
    ranks[places] = old + start - group
    alone = first & np.r_[first[1:], True]
    return ranks, places[~alone]


def covered(longest: np.ndarray, least: int, cut: int | None = None) -> np.ndarray:
    """Places within a repeat of at least so many symbols; cut: only its first ones count."""
    n = len(longest)
    at = np.flatnonzero(longest >= least)
    delta = np.zeros(n + 1, np.int64)
    delta[at] += 1
    np.subtract.at(delta, at + (longest[at] if cut is None else cut), 1)
    return np.cumsum(delta[:n]) > 0


FIELDS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "covered_chars", "longest_repeat")


def _together(symbols: list[np.ndarray], least: int) -> list[np.ndarray]:
    """repeats for each of some documents, given as symbols that need not be dense."""
    out, at = [], 0
    while at < len(symbols):
        to, size = at, 0
        while to < len(symbols) and (to == at or size + len(symbols[to]) <= AT_ONCE):
            size += len(symbols[to])
            to += 1
        part = symbols[at:to]
        lengths = [len(x) for x in part]
        data = np.concatenate(part) if size else np.zeros(0, np.int64)
        if size and data.max() >= 1 << 22:
            _, data = np.unique(data, return_inverse=True)
        elif size:
            seen = np.zeros(int(data.max()) + 1, np.int64)
            seen[data] = 1
            data = (np.cumsum(seen) - 1)[data]
        out += np.split(repeats(data, np.repeat(np.arange(len(part)), lengths), least), np.cumsum(lengths)[:-1])
        at = to
    return out


def measure(texts: list[str | None]) -> Iterator[tuple[int, ...]]:
    """FIELDS for each text."""
    raw = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    split = [r.split() for r in raw]  # bytes.split parts at exactly the six ASCII white-space characters
    ids: dict[bytes, int] = {}
    words = _together([np.fromiter((ids.setdefault(w, len(ids)) for w in ws), np.int64, len(ws)) for ws in split], BASE_WINDOW)
    codes = [np.frombuffer((t or "").encode("utf-32-le", "surrogatepass"), np.uint32) for t in texts]
    for r, ws, windows, code, longest in zip(raw, split, words, codes, _together(codes, MIN_REPEAT), strict=True):
        size = np.bincount(np.frombuffer(r, np.uint8), minlength=256)
        blank = (code == 32) | ((code >= 9) & (code <= 13))
        lines = [x for x in r.split(b"\n") if x.strip()]
        in_long = int((covered(longest, MIN_REPEAT) & ~blank).sum()) if len(code) else 0
        yield len(ws), len(code) - int(blank.sum()), int(sum(size[c] for c in SYMBOLS)), len(lines) - len(set(lines)), int(covered(windows, BASE_WINDOW, BASE_WINDOW).sum()), in_long, int(longest.max()) if len(code) else 0


def judge(docs: DataFrame, *, text: str = "text") -> DataFrame:
    """docs with FIELDS, base_failed and kept."""
    bounded_batches(docs.sparkSession)

    @F.pandas_udf(", ".join(f"{f} long" for f in FIELDS))
    def measured(column: pd.Series) -> pd.DataFrame:
        return pd.DataFrame(list(measure(column.tolist())), columns=list(FIELDS), dtype="int64")

    new = {*FIELDS, "base_failed", "kept"}
    got = docs.withColumn("__ow_m", measured(F.col(text))).select(*[c for c in docs.columns if c.lower() not in new], "__ow_m.*")
    failed = (F.col("n_words") < 10) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 20)
    repetitive = (F.col("covered_chars") > F.col("word_chars") * MOST_COVERED) | (F.col("longest_repeat") > MOST_REPEAT)
    return got.withColumn("base_failed", failed).withColumn("kept", ~(failed | repetitive))
