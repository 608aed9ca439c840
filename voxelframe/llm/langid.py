"""Language of texts: multinomial naive Bayes over hashed character n-grams.

Features are the n-grams of one to ``ORDER`` code points of the lower-cased text, each
hashed into ``2 ** BITS`` cells of its own order's seed. Counts of cells by language come from
all training rows, summed within a task before they are shuffled, so a language or source with
a third of the rows costs one row per cell and task. The matrix of log probabilities, languages
by cells, is broadcast; where it would exceed ``MATRIX_MB``, neighbouring cells are added up
until it does not. Scoring gathers matrix rows
for the n-grams of a slice of texts at once; a text longer than a slice is scored in parts.

Null texts and texts without a letter are ``und`` with score 0, as is every text if nothing was
learnt. Otherwise the score is the posterior probability of the language; ties go to the
language that sorts first. Rows without a language are not learnt from.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from voxelframe.llm.common import crc_mod, table, written
from voxelframe.llm.registry import query

ORDER, BITS, SMOOTH, MATRIX_MB = 3, 15, 0.1, 256
SLICE, LANGUAGES = 1 << 17, 64
_ODD = [0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F, 0x165667B1]


def cells(text: str, order: int = ORDER, bits: int = BITS) -> Iterator[np.ndarray]:
    """Cells of a text's n-grams, in parts of at most ``SLICE`` starting places."""
    codes = np.frombuffer(text.lower().encode("utf-32-le"), dtype="<u4")
    for at in range(0, len(codes), SLICE):
        part = codes[at:at + SLICE + order - 1]
        starts = min(SLICE, len(codes) - at)
        sums = np.zeros(len(part), dtype=np.uint32)
        out = []
        for n in range(order):
            m = min(starts, len(part) - n)
            if m <= 0:
                break
            sums = sums[:len(part) - n] + part[n:] * np.uint32(_ODD[n])
            mixed = (sums[:m] ^ (sums[:m] >> np.uint32(15))) * np.uint32(_ODD[(n + 1) % 5]) + np.uint32(n * 7919)
            out.append(mixed >> np.uint32(32 - bits))
        yield np.concatenate(out)


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def counts(rows: DataFrame, lang_col: str = "lang", text_col: str = "text", order: int = ORDER, bits: int = BITS) -> DataFrame:
    """(lang, cell, n) over all rows with a language and a text; cell -1 holds the number of rows."""

    def summed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[str, np.ndarray] = {}

        def out():
            for lang, n in held.items():
                there = np.flatnonzero(n)
                yield pd.DataFrame({"lang": lang, "cell": there - 1, "n": n[there]})
            held.clear()

        for batch in batches:
            for lang, text in zip(batch["lang"], batch["text"]):
                if lang not in held:
                    if len(held) >= LANGUAGES:
                        yield from out()
                    held[lang] = np.zeros((1 << bits) + 1, dtype=np.int64)
                held[lang][0] += 1
                for part in cells(text, order, bits):
                    held[lang][1:] += np.bincount(part, minlength=1 << bits)
        yield from out()

    known = rows.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text")).where("lang IS NOT NULL AND text IS NOT NULL")
    return known.mapInPandas(summed, "lang string, cell int, n long").groupBy("lang", "cell").agg(F.sum("n").alias("n"))


class Model:
    """Languages in order, log priors, and log probabilities by cell."""

    def __init__(self, langs: list[str], prior: np.ndarray, logp: np.ndarray):
        self.langs, self.prior, self.logp = langs, prior, logp

    def score(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """Language and posterior of each text."""
        total = np.zeros((len(texts), len(self.langs)))
        bits = int(np.log2(max(2, len(self.logp))))
        parts, owners, size = [], [], 0

        def flush():
            if parts:
                starts = np.cumsum([0] + [len(p) for p in parts[:-1]])
                np.add.at(total, owners, np.add.reduceat(self.logp[np.concatenate(parts)], starts, axis=0, dtype=np.float64))
            parts.clear()
            owners.clear()

        sure = [bool(self.langs) and has_letter(t) for t in texts]
        for i, text in enumerate(texts):
            for part in cells(text, ORDER, bits) if sure[i] else ():
                parts.append(part)
                owners.append(i)
                size += len(part)
                if size >= SLICE:
                    flush()
                    size = 0
        flush()
        if not self.langs:
            return ["und"] * len(texts), np.zeros(len(texts))
        total += self.prior
        best = total.argmax(axis=1)
        post = 1 / np.exp(total - total.max(axis=1, keepdims=True)).sum(axis=1)
        return [self.langs[b] if s else "und" for b, s in zip(best, sure)], np.where(sure, post, 0.0)


def train(rows: DataFrame, lang_col: str = "lang", text_col: str = "text", bits: int = BITS, smooth: float = SMOOTH) -> Model:
    """Naive Bayes model from all ``rows``; languages times cells come to the driver."""
    found, room = written(counts(rows, lang_col, text_col, ORDER, bits), "cells"), MATRIX_MB << 18
    many, least = found.where("cell = -1").count(), bits
    while many << bits > room and bits > 1:
        bits -= 1
    if bits < least:  # neighbouring cells become one: a cell is the upper bits of a hash
        found = found.groupBy("lang", F.when(F.col("cell") < 0, F.col("cell")).otherwise(F.shiftright("cell", least - bits)).alias("cell")).agg(F.sum("n").alias("n"))
    langs = sorted(r["lang"] for r in found.where("cell = -1").select("lang").limit(1 + (room >> bits)).collect())
    if len(langs) << bits > room:
        raise ValueError(f"{len(langs)} languages are more than a matrix of {MATRIX_MB} MB holds at two cells each")
    n = np.zeros((len(langs), (1 << bits) + 1))
    at = found.toPandas() if langs else pd.DataFrame({"lang": [], "cell": [], "n": []})
    n[pd.Categorical(at["lang"], categories=langs).codes, at["cell"].to_numpy(dtype=np.int64) + 1] = at["n"]
    rows_of, grams = n[:, 0], n[:, 1:]
    prior = np.log((rows_of + 1) / (rows_of.sum() + len(langs)))
    logp = np.log((grams + smooth) / (grams.sum(axis=1, keepdims=True) + smooth * (1 << bits)))
    return Model(langs, prior, np.ascontiguousarray(logp.T.astype(np.float32)))


def predict(docs: DataFrame, model: Model, text_col: str = "text") -> Column:
    """Struct (lang, score) of a text column. It is told to be non-deterministic, so that a filter on it is not computed apart from its use."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang string, score double")
    def guess(texts: pd.Series) -> pd.DataFrame:
        lang, score = shared.value.score(texts.tolist())
        return pd.DataFrame({"lang": lang, "score": score})

    return guess.asNondeterministic()(F.col(text_col).cast("string"))


def learnt(docs: DataFrame) -> Model:
    """Model from the rows of ``documents`` that are not held out."""
    return train(docs.where(crc_mod("doc_id", 4) != 2))


@query("op2_language_id")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learnt from three quarters of them."""
    docs = table(spark, sf_dir, "documents")
    told = docs.select("doc_id", (crc_mod("doc_id", 4) == 2).alias("held_out"), predict(docs, learnt(docs)).alias("p"))
    return told.select("doc_id", "held_out", F.col("p.lang").alias("lang_pred"), F.col("p.score").alias("score"))
