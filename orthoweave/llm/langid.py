"""Language ID: multinomial naive Bayes over hashed character n-grams.

Counts of hashed 1- to 3-grams per language come from every labelled training text, summed per task before the shuffle.
The matrix of log-probabilities has HASHED rows and a column for each language: 256 KB a language, whatever the number of
texts. It is fetched LANGS_AT_ONCE languages at a time and broadcast. The grams of a batch of texts are one sparse matrix,
rows of grams of one text after the other, whose product with the log-probabilities is a sum over runs of rows; a text that
is longer than a piece is several runs.

Cases: text that is null or has no letter is ``und`` with score 0; so is every text if nothing was learned; of equal
languages the first by name wins; there may be any number of them; a null lang or text teaches nothing; a very long text is
scored a piece at a time; repeated rows count as often as they occur;
extra columns pass through (an input column named like an output column is replaced).
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orthoweave.llm.common import bounded_batches, materialize

#: Rows of the matrix, orders of n-grams, code points of a piece, languages fetched at a time, count added to each n-gram,
#: figures gathered at a time.
HASHED, ORDERS, PIECE, LANGS_AT_ONCE, ADDED, AT_ONCE = 1 << 16, (1, 2, 3), 1 << 18, 64, 0.5, 1 << 22
UNKNOWN = "und"


@functools.cache
def _fold_table() -> np.ndarray:
    """Code point to itself for letters, to a blank for the rest."""
    letters = np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)
    return np.where(letters, np.arange(0x110000), 32).astype(np.uint32)


def grams(text: str) -> Iterator[np.ndarray]:
    """Hashed n-grams of the lower-cased text, a piece at a time; an n-gram is in one piece only."""
    table = _fold_table()
    widest = max(ORDERS)
    codes = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), np.uint32)
    for at in range(0, len(codes), PIECE):
        c = table[codes[at : at + PIECE + widest - 1]]
        n = min(PIECE, len(codes) - at)
        got = []
        h = np.zeros(len(c), np.uint32)
        for order in range(1, widest + 1):
            h = h[: len(c) - order + 1] * np.uint32(0x01000193) ^ c[order - 1 :] * np.uint32(0x9E3779B1)
            if order in ORDERS:
                got.append(((h ^ np.uint32(order * 0x85EBCA6B & 0xFFFFFFFF)) * np.uint32(0xC2B2AE35) >> np.uint32(16))[:n])
        yield np.concatenate(got)


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def train(docs: DataFrame, *, text: str = "text", lang: str = "lang") -> tuple[list[str], np.ndarray, np.ndarray]:
    """Languages, log-probabilities [HASHED, languages] and log-priors."""

    bounded_batches(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for name, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                to = sums.setdefault(name, np.zeros(HASHED + 1, np.int64))
                to[HASHED] += 1
                for g in grams(t):
                    to[:HASHED] += np.bincount(g, minlength=HASHED)
            pa.default_memory_pool().release_unused()
        for name, n in sums.items():
            at = np.flatnonzero(n)
            yield pa.record_batch({"lang": pa.array([name] * len(at), pa.string()), "gram": pa.array(at, pa.int64()), "n": pa.array(n[at], pa.int64())})

    rows = docs.select(F.col(lang).cast("string"), F.col(text)).dropna().mapInArrow(count, "lang string, gram long, n long")
    summed = materialize(rows.groupBy("lang", "gram").agg(F.sum("n").alias("n")), "grams")
    langs = sorted(r[0] for r in summed.select("lang").distinct().collect())
    matrix, n_docs = np.zeros((HASHED, len(langs)), np.float32), np.zeros(len(langs))
    for at in range(0, len(langs), LANGS_AT_ONCE):
        part = langs[at : at + LANGS_AT_ONCE]
        got = summed.filter(F.col("lang").isin(part)).toPandas()
        counts = np.zeros((HASHED + 1, len(part)))
        place = {name: i for i, name in enumerate(part)}
        counts[got["gram"].to_numpy(), got["lang"].map(place).to_numpy(np.int64)] = got["n"].to_numpy()
        n_docs[at : at + len(part)] = counts[HASHED]
        counts = counts[:HASHED] + ADDED
        matrix[:, at : at + len(part)] = np.log(counts / counts.sum(0))
    return langs, matrix, np.log(n_docs / n_docs.sum()) if langs else n_docs


def score_batch(texts: list[str], matrix: np.ndarray, prior: np.ndarray) -> np.ndarray:
    """Log-probability of each text and language, together: the sparse batch of grams times the matrix, in runs of rows."""
    total = np.tile(prior, (len(texts), 1))
    most = max(1, AT_ONCE // max(1, len(prior)))
    held: list[np.ndarray] = []
    owner: list[int] = []

    def flush() -> None:
        if held:
            lengths = np.array([len(h) for h in held])
            rows = np.concatenate(held)
            sums = np.add.reduceat(matrix[rows], np.cumsum(lengths) - lengths, axis=0, dtype=np.float64)
            np.add.at(total, owner, sums)
            held.clear()
            owner.clear()

    size = 0
    for i, text in enumerate(texts):
        for g in grams(text):
            for at in range(0, len(g), most):
                part = g[at : at + most]
                if size + len(part) > most:
                    flush()
                    size = 0
                held.append(part)
                owner.append(i)
                size += len(part)
    flush()
    return total


def predictor(docs: DataFrame, model: tuple[list[str], np.ndarray, np.ndarray]):
    """A function of a text column that returns struct<lang_pred, score>; the score is the language's posterior."""
    bounded_batches(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double")
    def predict(texts: pd.Series) -> pd.DataFrame:
        langs, matrix, prior = held.value
        named, score = np.full(len(texts), UNKNOWN, object), np.zeros(len(texts))
        asked = [i for i, t in enumerate(texts) if t and langs and has_letter(t)]
        if asked:
            at = score_batch([texts.iloc[i] for i in asked], matrix, prior)
            best = at.argmax(1)
            named[asked] = np.array(langs, object)[best]
            score[asked] = 1 / np.exp(at - at.max(1, keepdims=True)).sum(1)
        return pd.DataFrame({"lang_pred": named, "score": score})

    return predict


def identify(docs: DataFrame, teaches: Column, *, text: str = "text", lang: str = "lang") -> DataFrame:
    """docs with lang_pred and score; learns from the rows for which ``teaches`` holds."""
    predict = predictor(docs, train(docs.filter(teaches), text=text, lang=lang))
    kept = [c for c in docs.columns if c.lower() not in ("lang_pred", "score")]
    return docs.withColumn("__ow_p", predict(F.col(text))).select(*kept, F.col("__ow_p.lang_pred").alias("lang_pred"), F.col("__ow_p.score").alias("score"))


def recognised(docs: DataFrame, *, least: float = 0.5, wanted: list[str] | None = None, text: str = "text", lang: str = "lang") -> DataFrame:
    """The rows of docs, with their columns, whose language is predicted with a posterior of at least ``least``.

    Learns from all rows that have a language. wanted: the languages that may stay; None: any that was learned. Rows without
    text or letters go, and so does every row if no row has a language; rows are judged one by one, so repeated rows stay or
    go together.
    """
    predict = predictor(docs, train(docs, text=text, lang=lang))
    got = docs.withColumn("__ow_p", predict(F.col(text)))
    keep = (F.col("__ow_p.lang_pred") != UNKNOWN) & (F.col("__ow_p.score") >= least)
    if wanted is not None:
        keep &= F.col("__ow_p.lang_pred").isin(wanted)
    return got.filter(keep).drop("__ow_p")
