"""Language model of words: hashed maximum entropy over word classes, counts within a class.

The probability of a token is that of its class times that of the token within its class. The
class has two softmax factors, its group and its place in the group, over hashed n-gram and skip
features of the three tokens before; so a token costs two sums over ``GROUP`` outputs, not one
over all classes. Within a class smoothed counts decide, with one place for all unknown tokens.
Frequent tokens are classes of their own, the others go by their last two bytes, so a class is
known for any token without a table.

Counts cover all training tokens and stay distributed: they grow with the corpus. Only the
``FREQUENT`` most frequent tokens are broadcast; the rest of a document's tokens meet their
counts in a shuffle, which by then holds no frequent word. The weights (2 ** BITS cells) are
trained in ``ROUNDS`` rounds, each over its own part of the training rows, so that every row is
used once: each task starts from the broadcast weights, takes steps on its rows and returns what
it changed; changes are averaged cell by cell, weighted by how often a task saw the cell, in
groups of at most ``FAN`` tasks at a time. A round has a part of the rows and as large a part of
the tasks, so all rounds together move one set of weights per input partition.

Texts are lower-cased in A-Z; words are split at ASCII white space; one end follows. Null and
empty texts are an end alone. Without training rows nothing is known, and base and model give
the same. Equal rows get equal scores.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import chain
from math import log10
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxelframe.llm.common import ascii_lower, crc_mod, table, written
from voxelframe.llm.registry import query

GROUP, SINGLES, BITS, FREQUENT = 8, 32, 13, 65_536
CLASSES, OUTPUTS = GROUP * GROUP, GROUP * (GROUP + 1)
ROUNDS, STEP, RATE, DAMP, FAN, BLOCK, LIMIT = 4, 16_384, 0.5, 20.0, 32, 1024, 40.0
FEATURES, FIRST, RUN = 5, 1024, 1 << 18
SMOOTH = 0.1
END = ""  # no word is empty
GAP = r"[\x20\x09-\x0D]+"
_ODD = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], dtype=np.uint32)


@dataclass
class Vocabulary:
    """train_tokens and distinct of the training tokens, counts of the frequent ones, and by class tokens and distinct tokens."""

    tokens: int
    distinct: int
    frequent: dict[bytes, int]
    singles: dict[bytes, int]
    class_tokens: np.ndarray
    class_distinct: np.ndarray

    def class_of(self, word: bytes) -> int:
        at = self.singles.get(word)
        return SINGLES + crc32(word[-2:]) % (CLASSES - SINGLES) if at is None else at

    def base_rest(self) -> float:
        return log10(self.tokens + SMOOTH * (self.distinct + 1))

    def class_rest(self) -> np.ndarray:
        return np.log10(self.class_tokens + SMOOTH * (self.class_distinct + 1))


def counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(word, n) of all tokens; the end is the empty word."""
    words = F.array_remove(F.split(ascii_lower(F.coalesce(F.col(text_col).cast("string"), F.lit(""))), GAP), "")
    return docs.select(F.explode(F.concat(words, F.array(F.lit(END)))).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def vocabulary(words: DataFrame) -> Vocabulary:
    """Vocabulary of a written table of counts. The end and the most frequent words are classes of their own.

    How many words are how frequent is counted first, so that at most ``FREQUENT`` rows come to the driver."""
    level = F.floor(F.log2("n") * 64)
    other = words.where(F.col("word") != END)
    levels = sorted(((r["l"], r["v"]) for r in other.groupBy(level.alias("l")).agg(F.count(F.lit(1)).alias("v")).collect()), reverse=True)
    total, least = 0, None
    for at, v in levels:  # a few thousand at most
        if (total := total + v) >= FREQUENT:
            break
        least = at
    top = [] if least is None else sorted(other.where(level >= least).collect(), key=lambda r: (-r["n"], r["word"]))
    singles = {END.encode(): 0} | {r["word"].encode(): i for i, r in enumerate(top[:SINGLES - 1], 1)}
    suffix = F.substring(F.col("word").cast("binary"), F.greatest(F.lit(1), F.octet_length("word") - 1), F.lit(2))
    single = F.create_map(*[F.lit(x) for k, v in singles.items() for x in (k.decode(), v)])
    mine = F.coalesce(single[F.col("word")], (F.lit(SINGLES) + F.crc32(suffix) % (CLASSES - SINGLES)).cast("int"))
    by = {r["c"]: (r["n"], r["v"]) for r in words.groupBy(mine.alias("c")).agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v")).collect()}
    n, v = (np.array([by.get(c, (0, 0))[i] for c in range(CLASSES)], dtype=np.int64) for i in (0, 1))
    end = words.where(F.col("word") == END).first()
    frequent = {r["word"].encode(): r["n"] for r in top} | ({END.encode(): end["n"]} if end else {})
    return Vocabulary(int(n.sum()), int(v.sum()), frequent, singles, n, v)


class _Codes:
    """Word to hash (32 bits), class (6 bits) and place among the frequent words (0: none), packed."""

    def __init__(self, vocab: Vocabulary):
        self.known = {w: (i << 38) | (vocab.class_of(w) << 32) | crc32(w) for i, w in enumerate(vocab.frequent, 1)}

    @staticmethod
    def rare(word: bytes) -> int:
        """Code of a word that is not frequent, and so no class of its own; or of an end that was never seen."""
        return ((SINGLES + crc32(word[-2:]) % (CLASSES - SINGLES)) << 32) | crc32(word) if word else 0

    def of(self, words: list[bytes]) -> np.ndarray:
        get, rare = self.known.get, self.rare
        return np.array([get(w) or rare(w) for w in words], dtype=np.int64)


def split(text: str | None) -> list[bytes]:
    return text.encode().lower().split() if text else []


def features(a: np.ndarray, b: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Cells (FEATURES, tokens) by the hashes of the tokens one, two and three places before (0: none):
    bias, previous, pair before, and two skips."""
    cells = np.zeros((FEATURES, len(a)), dtype=np.int64)
    for i, mix in enumerate((a * _ODD[0] + np.uint32(1), a * _ODD[0] + b * _ODD[1] + np.uint32(2), b * _ODD[2] + np.uint32(3), c * _ODD[1] + np.uint32(4)), 1):
        mix ^= mix >> np.uint32(15)
        mix *= np.uint32(0x2C1B3C6D)
        np.maximum(mix >> np.uint32(32 - BITS), 1, out=cells[i], casting="unsafe")
    return cells


def encoded(texts: list[str | None], codes: _Codes) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray]:
    """Tokens of texts, their codes, the text each belongs to, and their cells."""
    words = [split(t) + [b""] for t in texts]
    tokens = list(chain.from_iterable(words))
    code, owner = codes.of(tokens), np.repeat(np.arange(len(texts)), [len(w) for w in words])
    at = np.arange(len(code)) + 3 * (owner + 1)  # three empty places in front of each text
    hashes = np.zeros(len(code) + 3 * len(texts), dtype=np.uint32)
    hashes[at] = code.astype(np.uint32)  # the low half
    return tokens, code, owner, features(hashes[at - 1], hashes[at - 2], hashes[at - 3])


def runs(texts: Iterable[str | None]) -> Iterator[list[str | None]]:
    """Consecutive texts of about ``RUN`` characters together."""
    held, size = [], 0
    for t in texts:
        held.append(t)
        size += len(t or "")
        if size >= RUN:
            yield held
            held, size = [], 0
    if held:
        yield held


Weights = tuple[np.ndarray, np.ndarray]  # (cells, groups) and (cells * groups, places)


def sums(weights: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """exp of the outputs (tokens, GROUP) of the rows (features, tokens); outputs are kept within +-LIMIT."""
    z = weights.take(rows[0], axis=0)
    for row in rows[1:]:
        z += weights.take(row, axis=0)
    np.clip(z, -LIMIT, LIMIT, out=z)
    return np.exp(z, out=z)


def logp(weights: Weights, cells: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """Natural log probability of each token's class."""
    out, one = np.zeros(len(classes)), np.ones(GROUP, dtype=np.float32)
    for at in range(0, len(classes), STEP):
        here = slice(at, at + STEP)
        group, place, c = classes[here] // GROUP, classes[here] % GROUP, cells[:, here]
        for w, rows, pick in ((weights[0], c, group), (weights[1], c * GROUP + group, place)):
            e = sums(w, rows)
            out[here] += np.log(e[np.arange(len(pick)), pick] / (e @ one))
    return out


def _steps(weights: Weights, batches: Iterator[tuple[np.ndarray, np.ndarray]], rate: float) -> np.ndarray:
    """Adaptive gradient steps (their scale starts at ``DAMP``) on ``weights``, in place; returns how often each cell was seen."""
    seen, power = np.zeros(len(weights[0]), dtype=np.int64), [np.full(len(w), DAMP) for w in weights]
    one = np.ones(GROUP, dtype=np.float32)
    for cells, classes in batches:
        at, group, place = np.arange(len(classes)), classes // GROUP, classes % GROUP
        for w, p, rows, pick in ((weights[0], power[0], cells, group), (weights[1], power[1], cells * GROUP + group, place)):
            e = sums(w, rows)
            wrong = e / (e @ one)[:, None]
            wrong[at, pick] -= 1
            flat = rows.ravel()
            slope = np.empty(w.shape)
            for k, column in enumerate(np.ascontiguousarray(wrong.T, dtype=np.float64)):
                slope[:, k] = np.bincount(flat, weights=np.tile(column, FEATURES), minlength=len(w))
            p += np.einsum("rg,rg->r", slope, slope)
            w -= (rate / np.sqrt(p))[:, None] * slope
        seen += np.bincount(cells.ravel(), minlength=len(seen))
    return seen


def _batches(texts: Iterable[str | None], codes: _Codes) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Cells and classes of the tokens of texts, ``FIRST`` tokens at a time, then twice as many, up to ``STEP``."""
    n = 0
    for run in runs(texts):
        _, code, _, cells = encoded(run, codes)
        classes, at = (code >> 32) & 63, 0
        while at < len(code):
            size = min(STEP, FIRST << (n // 8))
            yield cells[:, at:at + size], classes[at:at + size]
            at, n = at + size, n + 1


_CHANGE = "block int, task long, seen binary, change binary"


def _mean(frames: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    seen = [np.frombuffer(s, dtype=np.float32) for s in frames["seen"]]
    total = np.sum(seen, axis=0, dtype=np.float32)
    change = sum(np.frombuffer(c, dtype=np.float16).reshape(-1, OUTPUTS) * s[:, None] for c, s in zip(frames["change"], seen))
    return total, (change / np.maximum(total, 1)[:, None]).astype(np.float16)


def flat(weights: Weights) -> np.ndarray:
    """Both factors as one array (cells, OUTPUTS)."""
    return np.concatenate([weights[0], weights[1].reshape(len(weights[0]), -1)], axis=1)


def _start(vocab: Vocabulary) -> Weights:
    """Weights whose bias gives the classes' frequencies."""
    by = (vocab.class_tokens + SMOOTH).reshape(GROUP, GROUP)
    outer, inner = np.zeros((1 << BITS, GROUP), dtype=np.float32), np.zeros((GROUP << BITS, GROUP), dtype=np.float32)
    outer[0] = np.log(by.sum(axis=1) / by.sum())
    inner[:GROUP] = np.log(by / by.sum(axis=1, keepdims=True))
    return outer, inner


def train(rows: DataFrame, vocab: Vocabulary, text_col: str = "text", part: str = "part", rounds: int = ROUNDS) -> Weights:
    """Weights after one pass over ``rows``; column ``part`` (0 to rounds - 1) says in which round a row is used."""
    spark = rows.sparkSession
    weights = _start(vocab)
    words = spark.sparkContext.broadcast(vocab)
    for r in range(rounds):
        shared = spark.sparkContext.broadcast(weights)

        def change(batches: Iterator[pd.DataFrame], shared=shared, rate=RATE / (1 + r)) -> Iterator[pd.DataFrame]:
            mine, codes, task = tuple(w.copy() for w in shared.value), _Codes(words.value), None

            def stream():
                nonlocal task
                for b in batches:
                    if len(b):
                        task = int(b["task"].iloc[0])
                        yield from b["text"]

            seen = _steps(mine, _batches(stream(), codes), rate).astype(np.float32)
            if task is not None:
                delta = (flat(mine) - flat(shared.value)).astype(np.float16)
                for at in range(0, len(seen), BLOCK):
                    if seen[at:at + BLOCK].any():
                        yield pd.DataFrame({"block": [at // BLOCK], "task": [task], "seen": [seen[at:at + BLOCK].tobytes()], "change": [delta[at:at + BLOCK].tobytes()]})

        def merge(key: tuple, frames: pd.DataFrame) -> pd.DataFrame:
            seen, mean = _mean(frames)
            return pd.DataFrame({"block": [key[0]], "task": [key[1]], "seen": [seen.tobytes()], "change": [mean.tobytes()]})

        mine = rows.where(F.col(part) == r).select(F.col(text_col).cast("string").alias("text"))
        tasks = -(-mine.rdd.getNumPartitions() // rounds)
        mine = mine.coalesce(max(1, tasks)).select(F.spark_partition_id().cast("long").alias("task"), "text")
        changes = mine.mapInPandas(change, _CHANGE)
        while True:
            changes = changes.withColumn("task", F.floor(F.col("task") / FAN)).groupBy("block", "task").applyInPandas(merge, _CHANGE)
            if (tasks := -(-tasks // FAN)) <= 1:
                break
        total = flat(weights)
        for row in changes.collect():  # the weights once
            at = row["block"] * BLOCK
            total[at:at + BLOCK] += np.frombuffer(row["change"], dtype=np.float16).reshape(-1, OUTPUTS)
        weights = np.ascontiguousarray(total[:, :GROUP]), np.ascontiguousarray(total[:, GROUP:]).reshape(-1, GROUP)
        shared.destroy()
    return weights


def score(docs: DataFrame, words: DataFrame, vocab: Vocabulary, weights: Weights, keep: list[str], text_col: str = "text") -> DataFrame:
    """Columns ``keep`` of every row with n_tokens, n_known, base_score and score; ``keep`` must not name these."""
    shared = docs.sparkSession.sparkContext.broadcast((vocab, weights))

    @F.pandas_udf("n_tokens long, n_known long, near double, model double, rare string")
    def local(texts: pd.Series) -> pd.DataFrame:
        vocab, weights = shared.value
        codes, rest = _Codes(vocab), vocab.class_rest()
        known = np.log10(np.array([1.0] + list(vocab.frequent.values())) + SMOOTH)
        out = []
        for run in runs(texts):
            tokens, code, owner, cells = encoded(run, codes)
            place, classes = code >> 38, (code >> 32) & 63
            each = lambda x: np.bincount(owner, weights=x, minlength=len(run))
            model = each(logp(weights, cells, classes) / np.log(10) - rest[classes])
            found = pd.DataFrame({"n_tokens": np.bincount(owner, minlength=len(run)), "n_known": each(place > 0).astype(np.int64),
                                  "near": each(np.where(place > 0, known[place], 0.0)), "model": model})
            far = defaultdict(list)
            for i in np.flatnonzero(place == 0):
                far[owner[i]].append(tokens[i])
            found["rare"] = [b" ".join(far[i]).decode() if i in far else "" for i in range(len(run))]
            out.append(found)
        return pd.concat(out) if out else pd.DataFrame({"n_tokens": [], "n_known": [], "near": [], "model": [], "rare": []})

    rows = written(docs.select(F.monotonically_increasing_id().alias("uid"), F.struct(*keep).alias("row"), local(F.col(text_col).cast("string")).alias("s")), "scored")
    rare = rows.where(F.col("s.rare") != "").select("uid", F.explode(F.split("s.rare", " ")).alias("word")).where(F.col("word") != "")
    # an unknown end is the empty word, which is counted below
    met = rare.join(words, "word", "left").groupBy("uid").agg(F.count("n").alias("known"), F.sum(F.log10(F.coalesce("n", F.lit(0)) + SMOOTH)).alias("far"), F.count(F.lit(1)).alias("met"))
    done = rows.join(met, "uid", "left").select("row", "s.*", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("known", "far", "met")])
    lost = (F.col("n_tokens") - F.col("n_known") - F.col("met")) * F.lit(log10(SMOOTH))
    total = F.col("near") + F.col("far") + lost
    return done.select("row.*", "n_tokens", (F.col("n_known") + F.col("known")).alias("n_known"),
                       (total - F.col("n_tokens") * F.lit(vocab.base_rest())).alias("base_score"), (total + F.col("model")).alias("score"))


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, Vocabulary, Weights]:
    """Written counts, vocabulary and weights learnt from all rows of ``docs``."""
    words = written(counts(docs, text_col), "words")
    vocab = vocabulary(words)
    part = F.pmod(F.xxhash64(F.col(id_col), F.col(text_col)), F.lit(ROUNDS))
    return words, vocab, train(docs.withColumn("part", part), vocab, text_col)


@query("op5_lm_scoring")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log probabilities of every document by the word counts alone and by the model."""
    docs = table(spark, sf_dir, "documents")
    held = (crc_mod("doc_id", 10) == 0).alias("held_out")
    words, vocab, weights = fit(docs.where(crc_mod("doc_id", 10) != 0))
    done = score(docs.withColumn("held_out", held), words, vocab, weights, ["doc_id", "held_out"])
    return done.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(vocab.tokens).cast("long").alias("train_tokens"), "base_score", "score")
