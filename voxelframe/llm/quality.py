"""Quality of texts by weak labels: heuristic labellers, their accuracies by EM, a hashed linear scorer.

Each labeller votes good, bad or abstains. A document's votes are one number, so all documents
together are at most 3 ** labellers rows of (pattern, count); on these expectation maximisation
estimates the share of good documents and how each labeller votes in either class when it does
vote, from majority votes as a start. A pattern's posterior is its documents' soft label.

The scorer is logistic regression over hashed character shapes (case, digits, spaces, single
signs; n-grams of one to four), square roots of counts, scaled to unit length, and hashed
bins of word and line variety. It is fitted on about ``SAMPLE`` documents drawn by a hash of id
and text, in rounds: tasks take gradient steps from common weights, which are then averaged.
Every whole text is scored.

Null texts and texts without a word get votes that all abstain, and score 0. Ties of a score with
the threshold keep the document. Equal texts get equal scores; no rows give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from math import log

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxelframe.llm.common import table, written
from voxelframe.llm.registry import query

ABSTAIN, BAD, GOOD = 0, 1, 2
LABELLERS = ["symbols", "capitals", "variety", "lines", "ending", "word_length", "sentences", "short_words", "loose_signs"]
BITS, ORDER, SAMPLE, TASKS, ROUNDS, RATE, KEEP = 14, 4, 20_000, 8, 10, 2.0, 0.5
_SLICE = 1 << 18
_LOWER, _UPPER, _DIGIT, _SPACE, _LINE, _OTHER = 1, 2, 3, 4, 5, 6


@lru_cache(maxsize=1)
def _shapes() -> np.ndarray:
    """Shape of each code point; ASCII signs have their own."""
    out = np.full(0x110000, _OTHER, dtype=np.uint8)
    for c in range(0x110000):
        s = chr(c)
        if s.isalpha():
            out[c] = _UPPER if s.isupper() else _LOWER
        elif s.isdigit():
            out[c] = _DIGIT
        elif s.isspace():
            out[c] = _LINE if s == "\n" else _SPACE
        elif c < 128:
            out[c] = 7 + sum(not chr(k).isalnum() and not chr(k).isspace() for k in range(c))
    return out


def shapes(text: str) -> np.ndarray:
    return _shapes()[np.frombuffer(text.encode("utf-32-le"), dtype="<u4")]


def variety(items: list[str]) -> float:
    """log distinct / log all; 1 where all differ."""
    return log(len(set(items))) / log(len(items)) if len(items) > 1 else 1.0


def _vote(bad: bool, good: bool) -> int:
    return BAD if bad else GOOD if good else ABSTAIN


def votes(text: str | None) -> list[int]:
    """Votes of ``LABELLERS`` on a text."""
    words = text.split() if text else []
    if not words:
        return [ABSTAIN] * len(LABELLERS)
    kinds = np.bincount(shapes(text), minlength=64)
    letters, signs, n = kinds[_LOWER] + kinds[_UPPER], kinds[_OTHER:].sum(), len(words)
    dense = max(1, len(text) - kinds[_SPACE] - kinds[_LINE])
    lines = [x for x in text.split("\n") if x.strip()]
    ends = sum(w[-1] in ".!?…" for w in words)
    loose = sum(not any(map(str.isalnum, w)) for w in words) / n
    share, capital, length = signs / dense, kinds[_UPPER] / max(1, letters), dense / n
    wide, tall, short = variety([w.lower() for w in words]), len(set(lines)) / len(lines), sum(len(w) <= 3 for w in words) / n
    return [ABSTAIN if letters < 20 else _vote(share > 0.12, share < 0.06),
            ABSTAIN if letters < 20 else _vote(capital > 0.3, capital < 0.15),
            ABSTAIN if n < 20 else _vote(wide < 0.75, wide > 0.85),
            ABSTAIN if len(lines) < 3 else _vote(tall < 0.7, tall > 0.9),
            GOOD if text.rstrip()[-1] in ".!?…\"'»”)" else BAD,
            _vote(length < 2.5 or length > 12, 3.5 <= length <= 9),
            ABSTAIN if n < 10 else _vote(ends == 0 or n / ends > 80 or n / ends < 2, ends > 0 and 4 <= n / ends <= 50),
            ABSTAIN if n < 20 else _vote(short < 0.05, short > 0.15),
            BAD if loose > 0.05 else ABSTAIN]


def pattern(text: str | None) -> int:
    return int(sum(v * 3 ** i for i, v in enumerate(votes(text))))


def expectation(counts: dict[int, int], rounds: int = 200, change: float = 1e-9) -> tuple[float, np.ndarray, dict[int, float]]:
    """Share of good, vote probabilities (labeller, class, vote; classes bad, good) and posterior of each pattern."""
    keys = sorted(counts)
    if not keys:
        return 0.5, np.full((len(LABELLERS), 2, 3), 1 / 3), {}
    cast = np.array([[k // 3 ** i % 3 for i in range(len(LABELLERS))] for k in keys])
    n = np.array([counts[k] for k in keys], dtype=float)
    said = (cast == GOOD).sum(axis=1) - (cast == BAD).sum(axis=1)
    post = np.clip(0.5 + 0.15 * said, 0.02, 0.98)
    share, said_by = 0.5, np.zeros((len(LABELLERS), 2, 3))
    for _ in range(rounds):
        old = share
        share = (n @ post + 1) / (n.sum() + 2)
        for v in (BAD, GOOD):
            there = cast == v
            said_by[:, 1, v] = (n * post) @ there + 1
            said_by[:, 0, v] = (n * (1 - post)) @ there + 1
        said_by[:, :, 1:] /= said_by[:, :, 1:].sum(axis=2, keepdims=True)
        said_by[:, :, ABSTAIN] = 1.0  # no vote, no evidence
        odds = np.full(len(keys), np.log(share) - np.log1p(-share))
        for j in range(len(LABELLERS)):
            odds += np.log(said_by[j, 1, cast[:, j]]) - np.log(said_by[j, 0, cast[:, j]])
        post = 1 / (1 + np.exp(-np.clip(odds, -500, 500)))
        if abs(share - old) < change:
            break
    return float(share), said_by, dict(zip(keys, post.tolist()))


def cells(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Cells and values of a text's features; the values have unit length."""
    kinds = shapes(text).astype(np.uint32)
    n = np.zeros(1 << BITS, dtype=np.int64)
    for at in range(0, len(kinds), _SLICE):
        part, starts = kinds[at:at + _SLICE + ORDER - 1], min(_SLICE, len(kinds) - at)
        code = np.zeros(len(part), dtype=np.uint32)
        for i in range(ORDER):
            m = min(starts, len(part) - i)
            if m <= 0:
                break
            code = (code[:len(part) - i] << np.uint32(6)) | part[i:]
            n += np.bincount(((code[:m] + np.uint32(1 + i)) * np.uint32(0x9E3779B1)) >> np.uint32(32 - BITS), minlength=1 << BITS)
    value = np.sqrt(n)
    for seed, items in ((11, text.lower().split()), (12, text.split("\n"))):
        place = (seed * 0x85EBCA77 + int(variety(items) * 20) * 0xC2B2AE3D) % (1 << BITS)
        value[place] += np.sqrt(len(text))
    there = np.flatnonzero(value)
    return there, (value[there] / np.linalg.norm(value)).astype(np.float32)


def soft_labels(docs: DataFrame, text_col: str = "text") -> tuple[dict[int, float], np.ndarray]:
    """Posteriors by pattern and vote probabilities, from all rows."""

    @F.pandas_udf("int")
    def cast(texts: pd.Series) -> pd.Series:
        return pd.Series([pattern(t) for t in texts], dtype="int32")

    counted = docs.select(cast(F.col(text_col).cast("string")).alias("pattern")).groupBy("pattern").agg(F.count(F.lit(1)).alias("n"))
    _, said, post = expectation({r["pattern"]: r["n"] for r in counted.collect()})
    return post, said


def fit(docs: DataFrame, post: dict[int, float], id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> np.ndarray:
    """Weights of the scorer, the last one its bias, from about ``sample`` documents and their soft labels."""
    share = int(min(1.0, sample / max(1, docs.count())) * (1 << 40))
    drawn = docs.where(F.pmod(F.xxhash64(F.col(id_col), F.col(text_col)), F.lit(1 << 40)) < share).select(F.col(text_col).cast("string").alias("text"))

    def prepare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [(at.astype(np.int32).tobytes(), value.tobytes(), post[pattern(t)]) for t in b["text"] if t and t.split() for at, value in [cells(t)]]
            yield pd.DataFrame(rows, columns=["at", "value", "y"])

    rows = written(drawn.mapInPandas(prepare, "at binary, value binary, y double").repartition(TASKS), "sample")
    weights = np.zeros((1 << BITS) + 1)
    for r in range(ROUNDS):
        rate = RATE / (1 + r)

        def steps(batches: Iterator[pd.DataFrame], weights=weights, rate=rate) -> Iterator[pd.DataFrame]:
            w, n = weights.copy(), 0
            for b in batches:
                for at, value, y in zip(b["at"], b["value"], b["y"]):
                    at, value = np.frombuffer(at, dtype=np.int32), np.frombuffer(value, dtype=np.float32)
                    wrong = 1 / (1 + np.exp(-np.clip(w[at] @ value + w[-1], -50, 50))) - y
                    w[at] -= rate * wrong * value
                    w[-1] -= 0.1 * rate * wrong
                    n += 1
            if n:
                yield pd.DataFrame({"n": [n], "w": [w.tobytes()]})

        parts = rows.coalesce(TASKS).mapInPandas(steps, "n long, w binary").collect()  # TASKS rows at most
        if parts:
            weights = sum(p["n"] * np.frombuffer(p["w"]) for p in parts) / sum(p["n"] for p in parts)
    return weights


def score(docs: DataFrame, post: dict[int, float], weights: np.ndarray, keep: list[str], text_col: str = "text") -> DataFrame:
    """Columns ``keep``, the votes as a string (in the order of LABELLERS: 0 abstains, 1 bad, 2 good), posterior and score."""
    shared = docs.sparkSession.sparkContext.broadcast((post, weights))

    @F.pandas_udf("votes string, posterior double, score double")
    def judge(texts: pd.Series) -> pd.DataFrame:
        post, w = shared.value
        out = []
        for t in texts:
            cast = votes(t)
            value = 0.0
            if t and t.split():
                at, x = cells(t)
                value = 1 / (1 + np.exp(-np.clip(w[at] @ x + w[-1], -50, 50)))
            out.append(("".join(map(str, cast)), post[sum(v * 3 ** i for i, v in enumerate(cast))], float(value)))
        return pd.DataFrame(out, columns=["votes", "posterior", "score"])

    return docs.select(*keep, judge(F.col(text_col).cast("string")).alias("j")).select(*keep, "j.*")


@query("op6_quality_classifier")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Votes, posterior and score of every document, and whether it is kept."""
    docs = table(spark, sf_dir, "documents")
    post, _ = soft_labels(docs)
    return score(docs, post, fit(docs, post), ["doc_id"]).withColumn("keep", F.col("score") >= KEEP)
