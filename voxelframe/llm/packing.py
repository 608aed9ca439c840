"""Best-fit packing of documents into sequences of several permitted lengths.

A document's tokens are its words with the white space that follows, and one end; null and
empty texts are an end alone. Documents longer than the longest permitted sequence are cut
into pieces, none is dropped. Pieces are packed by decreasing length: each goes to the open
sequence with the least room that holds it; if there is none, a new one is opened. Finally each
sequence takes the shortest permitted length that holds its contents.

Which length is opened is chosen over all lengths jointly: for every length that holds the piece
the sequence is filled, on trial, with the longest pieces not yet planned for, and the length
whose filled and downsized sequence costs least per token is opened, as often as these pieces
last. That packing is held against those that open the length cheapest for the piece alone, and
one length only where it holds the piece; the cheapest of all is taken.

Equal pieces are interchangeable, so the packing is worked out on the histogram of lengths, at
most as many rows as the longest sequence has tokens, and gives one packing over all data. Its
steps say which ranks of a length go to which sequences. Ranks are counted per input partition
and added up, so a length that a third of the documents share is not one task's work. Repeated
rows are separate documents.
"""

from __future__ import annotations

import bisect
from collections.abc import Callable
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from voxelframe.llm.common import table, written
from voxelframe.llm.registry import query

LENGTHS = (512, 1024, 2048, 4096, 8192)
# Where a token begins: after white space, before something else.
BORDER = r"(?<=\s)(?=\S)"


def cost(length: int) -> float:
    """Default cost of a sequence: its tokens, attention that grows with their square, and a fixed part."""
    return 64 + length + length * length / 65536


def tokens(text: Column) -> Column:
    """Tokens of a text without the end; joined they are the text again."""
    text = text.cast("string")
    return F.when(F.length(text) > 0, F.split(text, BORDER, -1)).otherwise(F.array().cast("array<string>"))


@dataclass
class Step:
    """``count`` sequences opened at ``length`` that get ``each`` pieces of ``size`` at ``offset``; ``rank``: the first of these pieces."""

    size: int
    each: int
    count: int
    rank: int
    offset: int
    length: int
    parent: int
    first: int = 0
    children: list[int] = field(default_factory=list)


Opener = Callable[[int, int], tuple[int, int]]  # size and number of pieces left -> length to open, and how often


def by_piece(lengths: tuple[int, ...], price: Callable[[int], float]) -> Opener:
    """The length that costs least per token, of those that hold the piece."""
    return lambda size, rest: (min((n for n in lengths if n >= size), key=lambda n: (price(n) / n, n)), rest)


def preferring(length: int, lengths: tuple[int, ...]) -> Opener:
    """One length; the shortest that holds the piece where it does not."""
    return lambda size, rest: (length if length >= size else min(n for n in lengths if n >= size), rest)


def jointly(histogram: dict[int, int], lengths: tuple[int, ...], price: Callable[[int], float]) -> Opener:
    """The length whose sequence, filled with the longest pieces not yet planned for, costs least per token."""
    spare, order, lengths = dict(histogram), sorted(histogram), sorted(lengths)

    def filled_with(size: int, length: int) -> tuple[dict[int, int], int]:
        free, inside, i = length, {}, bisect.bisect_left(order, size)
        while i >= 0 and free:
            s = order[i]
            if k := min(spare[s], free // s):
                inside[s], free = k, free - k * s
            i = min(i, bisect.bisect_right(order, free)) - 1
        return inside, length - free

    def opened(size: int, rest: int) -> tuple[int, int]:
        if size not in spare:
            bisect.insort(order, size)
        spare[size] = max(spare.get(size, 0), rest)
        best = None
        for n in lengths[bisect.bisect_left(lengths, size):]:
            inside, used = filled_with(size, n)
            key = (price(lengths[bisect.bisect_left(lengths, used)]) / used, n)
            if best is None or key < best[0]:
                best = key, n, inside
        _, length, inside = best
        times = min(spare[s] // k for s, k in inside.items())
        for s, k in inside.items():
            spare[s] -= k * times
            if not spare[s]:
                del spare[s], order[bisect.bisect_left(order, s)]
        return length, times

    return opened


def total(steps: list[Step], lengths: tuple[int, ...], price: Callable[[int], float]) -> float:
    """Price of all sequences after downsizing."""
    ends = filled(steps, lengths)
    after = [e[0] for e in ends[1:]] + [sum(s.count for s in steps if s.parent < 0)]
    return sum((b - a) * price(n) for (a, _, n), b in zip(ends, after))


def cheapest(histogram: dict[int, int], lengths: tuple[int, ...] = LENGTHS, price: Callable[[int], float] = cost) -> list[Step]:
    """Steps of the cheapest of the packings that differ in the lengths they open."""
    openers = [jointly(histogram, lengths, price), by_piece(lengths, price), *[preferring(n, lengths) for n in sorted(lengths)]]
    return min((plan(histogram, o) for o in openers), key=lambda steps: total(steps, lengths, price))


def plan(histogram: dict[int, int], opener: Opener) -> list[Step]:
    """Steps of the best-fit packing of ``histogram`` (size to number of pieces) that opens what ``opener`` says."""
    steps: list[Step] = []
    room: dict[int, list[tuple[int, int]]] = {}  # free tokens -> (step, sequences that still end with it)
    order: list[int] = []

    def put(size, each, count, rank, offset, length, parent):
        steps.append(Step(size, each, count, rank, offset, length, parent))
        at = len(steps) - 1
        if parent >= 0:
            steps[parent].children.append(at)
        left(length - offset - size * each, at, count)

    def left(free, at, count):
        if free and count:
            if free not in room:
                room[free] = []
                bisect.insort(order, free)
            room[free].append((at, count))

    for size in sorted(histogram, reverse=True):
        rest, rank = histogram[size], 0
        while rest:
            i = bisect.bisect_left(order, size)
            if i < len(order):
                free = order[i]
                at, count = room[free].pop()
                if not room[free]:
                    del room[free], order[i]
                offset, length = steps[at].offset + steps[at].size * steps[at].each, steps[at].length
            else:
                length, count = opener(size, rest)
                at, free, offset = -1, length, 0
            each = free // size
            full = min(count, rest // each)
            if full:
                put(size, each, full, rank, offset, length, at)
                rank, rest = rank + full * each, rest - full * each
            if full < count:
                if rest and (at < 0 or full < count):
                    put(size, rest, 1, rank, offset, length, at)
                    rank, rest, full = rank + rest, 0, full + 1
                if at >= 0:
                    left(free, at, count - full)
    first = 0
    for i, s in enumerate(steps):  # the sequences of a step lie together, its children's in front of those that end with it
        if s.parent < 0:
            s.first, first = first, first + s.count
        at = s.first
        for c in s.children:
            steps[c].first, at = at, at + steps[c].count
    return steps


def filled(steps: list[Step], lengths: tuple[int, ...] = LENGTHS) -> list[tuple[int, int, int]]:
    """(first sequence, used tokens, final length) of runs of equal sequences, in order of the first."""
    lengths = sorted(lengths)
    out = []
    for s in steps:
        ends = s.count - sum(steps[c].count for c in s.children)
        if ends:
            used = s.offset + s.size * s.each
            out.append((s.first + s.count - ends, used, lengths[bisect.bisect_left(lengths, used)]))
    return sorted(out)


def pieces(docs: DataFrame, keep: list[str], text_col: str = "text", longest: int = LENGTHS[-1]) -> DataFrame:
    """``keep``, piece (from 0), start (its first token) and size of every piece of every row, and uid, a number of the row."""
    n = F.size(tokens(F.col(text_col))) + 1
    rows = docs.select(F.monotonically_increasing_id().alias("uid"), F.struct(*keep).alias("row"), n.alias("n"))
    rows = rows.select("uid", "row", "n", F.explode(F.sequence(F.lit(0), F.floor((F.col("n") - 1) / longest).cast("int"))).alias("piece"))
    start = F.col("piece") * longest
    return rows.select("uid", "row.*", "piece", start.alias("start"), F.least(F.lit(longest), F.col("n") - start).alias("size"))


def pack(items: DataFrame, lengths: tuple[int, ...] = LENGTHS, price: Callable[[int], float] = cost) -> DataFrame:
    """Add bin (from 0), bin_offset and bin_length to a written table with columns uid, piece and size.

    Every size must be from 1 to the longest of ``lengths``. No rows give no sequences."""
    chunk = F.shiftright("uid", 33).alias("chunk")  # the partition that numbered the row
    counts = items.groupBy("size", chunk).agg(F.count(F.lit(1)).alias("n"))
    histogram = {r["size"]: r["n"] for r in counts.groupBy("size").agg(F.sum("n").alias("n")).collect()}
    steps = cheapest(histogram, lengths, price)
    ends = filled(steps, lengths)
    steps = sorted(steps, key=lambda s: (s.size, s.rank))
    key = np.array([(s.size << 44) + s.rank for s in steps], dtype=np.int64)
    cells = np.array([(s.rank, s.each, s.first, s.offset, s.size) for s in steps], dtype=np.int64).reshape(-1, 5)
    bins, final = np.array([e[0] for e in ends], dtype=np.int64), np.array([e[2] for e in ends], dtype=np.int64)

    @F.pandas_udf("bin long, bin_offset int, bin_length int")
    def place(size: pd.Series, rank: pd.Series) -> pd.DataFrame:
        rank = rank.to_numpy()
        first, each, start, offset, step = cells[np.searchsorted(key, (size.to_numpy().astype(np.int64) << 44) + rank, side="right") - 1].T
        bin = start + (rank - first) // each
        return pd.DataFrame({"bin": bin, "bin_offset": offset + (rank - first) % each * step, "bin_length": final[np.searchsorted(bins, bin, side="right") - 1]})

    before = F.sum("n").over(W.partitionBy("size").orderBy("chunk")) - F.col("n")
    offsets = counts.select("size", "chunk", before.alias("before"))
    local = F.row_number().over(W.partitionBy("size", "chunk").orderBy("uid", "piece")) - 1
    ranked = items.withColumn("chunk", chunk).withColumn("local", local).join(offsets, ["size", "chunk"])
    return ranked.withColumn("at", place("size", F.col("before") + F.col("local"))).select(*items.columns, "at.*")


def sequences(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lengths: tuple[int, ...] = LENGTHS) -> DataFrame:
    """One row per sequence: bin, length, used, n_pieces, pieces (id, piece, start, size, offset) and texts, in order.

    The texts of a document's pieces, by ``start``, join to its text."""
    longest = max(lengths)
    rows = docs.select(F.monotonically_increasing_id().alias("uid"), F.col(id_col).alias("id"), tokens(F.col(text_col)).alias("w"))
    rows = rows.select("uid", "id", "w", F.explode(F.sequence(F.lit(0), F.floor(F.size("w") / longest).cast("int"))).alias("piece"))
    start = F.col("piece") * longest
    cut = written(rows.select("uid", "id", "piece", start.alias("start"), F.least(F.lit(longest), F.size("w") + 1 - start).alias("size"),
                              F.array_join(F.slice("w", start + 1, longest), "").alias("text")), "pieces")
    one = F.struct(F.col("bin_offset").alias("offset"), "id", "piece", "start", "size", "text")
    packed = pack(cut, lengths).groupBy("bin").agg(F.first("bin_length").alias("length"), F.sum("size").alias("used"), F.array_sort(F.collect_list(one)).alias("all"))
    told = F.transform("all", lambda p: F.struct(p["id"].alias("id"), p["piece"].alias("piece"), p["start"].alias("start"), p["size"].alias("size"), p["offset"].alias("offset")))
    return packed.select("bin", "length", "used", F.size("all").alias("n_pieces"), told.alias("pieces"), F.transform("all", lambda p: p["text"]).alias("texts"))


@query("op9_best_fit_packing")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sequence, place and final sequence length of every piece of every document."""
    items = written(pieces(table(spark, sf_dir, "documents"), ["doc_id"]), "pieces")
    done = pack(items)
    return done.select("doc_id", *[F.col(c).cast("long").alias(c) for c in ("piece", "start", "size", "bin", "bin_offset", "bin_length")])
