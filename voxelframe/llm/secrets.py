"""Secrets in texts: fixed patterns, and a likelihood ratio of two character Markov models.

Patterns (base spans): an assignment to a name such as ``password`` whose value has six
characters or more, an access key id of 20 or more, a run of 24 or more lower-case hex
digits. Markov spans: stretches of 16 or more characters of ``ALPHABET`` whose letters
follow each other as in random strings rather than as in ordinary identifiers. A running sum
of the log ratios, less ``FLOOR`` a character and reset at zero or ``DROP`` below its best,
finds them inside longer runs, so a key in a path or after a name is reported without these;
a run without such a stretch that is random as a whole is reported whole. A stretch that
overlaps a base span, or lies behind one that begins inside its run, is left out. Both models are first-order, with a start state; the random one learns from the values of base
spans with a uniform prior, the ordinary one from other runs of ten characters or more and
from names made of the first ``WORDS`` words of a text (joined by a sign, or capitalised), both
from a sample of about ``SAMPLE`` documents. Only ``(len(ALPHABET) + 1) ** 2`` log
ratios leave the cluster.

Offsets count code points, ends excluded. They are running sums over the pieces between
matches, by a window over one document's matches, so a long text costs no more than its
length. Null and empty texts have no spans; repeated rows give a row each. All is
DataFrame code.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from voxelframe.llm.common import ascii_lower, table
from voxelframe.llm.registry import query

# The patterns of the base spans. A hex or key run that is long enough is the
# same run whether its length is asked for in the pattern or afterwards; an assignment is not.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
VALUE = 6

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-"
RUN = r"[A-Za-z0-9+/_-]{%d,}"
LEAST, LEARN, WORDS, SAMPLE = 16, 10, 12, 20_000
TOTAL, MEAN = 20.0, 1.5  # nats: of a whole run, and of one of its characters, from which it counts as random
FLOOR = MEAN / 2  # nats a character that a stretch must win to go on
DROP = TOTAL  # nats lost since its best place at which a stretch ends there
KINDS = ["assign", "access", "hex", "markov"]
_NONE = "array<string>"


def _found(text: Column, pattern: str, may: Column, group: int = 0) -> Column:
    return F.when(may, F.regexp_extract_all(text, F.lit(pattern), F.lit(group))).otherwise(F.array().cast(_NONE))


def _pieces(text: Column, pattern: str, may: Column) -> Column:
    return F.when(may, F.split(text, pattern, -1)).otherwise(F.array(text))


def _may(text: Column) -> dict[str, Column]:
    """Cheap tests that no text with a match fails."""
    low = ascii_lower(text)
    return {"assign": low.contains("passw") | low.contains("secret") | low.contains("token") | low.contains("key"),
            "access": text.contains("AKIA"), "hex": text.rlike(HEX), "markov": text.rlike(RUN % LEAST)}


def _codes(run: Column) -> Column:
    """Places of a run's characters in the alphabet, from 1; others are left out."""
    return F.filter(F.transform(F.split(run, ""), lambda c: F.instr(F.lit(ALPHABET), c)), lambda i: i > 0)


def _transitions(strings: DataFrame) -> dict[tuple[int, int], int]:
    """Counts of (state, next) over the column ``s``; state 0 is the start. At most 67 x 66 rows."""
    codes = strings.select(_codes(F.col("s")).alias("c")).where(F.size("c") > 0)
    steps = codes.select(F.explode(F.arrays_zip(F.concat(F.array(F.lit(0)), "c").alias("p"), F.concat("c", F.array(F.lit(0))).alias("n"))).alias("z"))
    counts = steps.select("z.p", "z.n").where("n > 0").groupBy("p", "n").count()
    return {(r["p"], r["n"]): r["count"] for r in counts.collect()}


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> list[float]:
    """Log ratio random : ordinary of each (state, next), row by row, learnt from about ``sample`` documents.

    Documents are drawn by a hash of their id. Without base spans the random model is uniform, without
    ordinary runs the other one is; without both every ratio is 0 and no run is reported."""
    total = docs.count()
    share = min(1.0, sample / max(1, total))
    drawn = docs.where(F.pmod(F.xxhash64(F.col(id_col)), F.lit(1 << 40)) < F.lit(int(share * (1 << 40))))
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    may = _may(text)
    values = F.concat(F.filter(_found(text, ASSIGN, may["assign"], 2), lambda v: F.length(v) >= VALUE),
                      _found(text, ACCESS, may["access"]), _found(text, HEX, may["hex"]))
    random = _transitions(drawn.select(F.explode(values).alias("s")))
    rest = F.regexp_replace(F.regexp_replace(F.regexp_replace(text, ASSIGN, " "), ACCESS, " "), HEX, " ")
    runs = F.regexp_extract_all(rest, F.lit(RUN % LEARN), F.lit(0))
    words = F.slice(F.filter(F.split(rest, "[^A-Za-z]+"), lambda w: F.length(w) > 1), 1, WORDS)
    named = [F.array_join(words, mark) for mark in ("_", "-", "/")] + [F.array_join(F.transform(words, F.initcap), "")]
    ordinary = _transitions(drawn.select(F.explode(F.concat(runs, F.array(*named))).alias("s")))
    return ratios(random, ordinary)


def ratios(random: dict, ordinary: dict, weight: float = 10.0) -> list[float]:
    """Log ratios of the two models. A state's counts are mixed with ``weight`` of a prior: uniform for the
    random model, the smoothed frequencies of characters for the ordinary one."""
    size = len(ALPHABET)
    single = [0.5 + sum(n for (_, c), n in ordinary.items() if c == i) for i in range(1, size + 1)]
    common = [x / sum(single) for x in single]
    out = []
    for p in range(size + 1):
        seen, usual = (sum(m.get((p, n), 0) for n in range(1, size + 1)) for m in (random, ordinary))
        out += [0.0] + [math.log((random.get((p, n), 0) + weight / size) / (seen + weight)) - math.log(
            (ordinary.get((p, n), 0) + weight * common[n - 1]) / (usual + weight)) for n in range(1, size + 1)]
    return out


def _ratios(run: Column, model: list[float]) -> Column:
    """Log ratio of each character of a run."""
    cells = F.split(F.lit(",".join(map(repr, model))), ",").cast("array<double>")  # folded to one constant
    size = len(ALPHABET) + 1
    look = lambda p, c: F.get(cells, p * size + c)
    before = lambda cs: F.concat(F.array(F.lit(0)), F.slice(cs, 1, F.size(cs) - 1))
    return F.get(F.transform(F.array(_codes(run)), lambda cs: F.zip_with(before(cs), cs, look)), F.lit(0))


def _stretches(run: Column, model: list[float]) -> Column:
    """Random stretches of a run, as an array of (a, b), or the whole run."""
    pair = lambda a, b: F.array(F.struct(a.alias("a"), b.alias("b")))
    zero, none = F.lit(0.0), F.array().cast("array<struct<a:int,b:int>>")
    start = F.struct(F.lit(0).alias("i"), zero.alias("s"), zero.alias("t"), zero.alias("whole"), F.lit(0).alias("a"), F.lit(0).alias("b"),
                     zero.alias("best"), zero.alias("won"), none.alias("out"))

    def closed(x: Column) -> Column:
        size = x["b"] - x["a"]
        good = (size >= LEAST) & (x["won"] >= TOTAL) & (x["won"] >= MEAN * size)
        return F.when(good, F.concat(x["out"], pair(x["a"], x["b"]))).otherwise(x["out"])

    def step(x: Column, r: Column) -> Column:
        s, after = x["s"] + r - FLOOR, x["i"] + 1
        reset, higher = (s <= 0) | (s < x["best"] - DROP), s > x["best"]
        kept = lambda new, old: F.when(reset, new).otherwise(old)
        return F.struct(after.alias("i"), kept(zero, s).alias("s"), kept(zero, x["t"] + r).alias("t"), (x["whole"] + r).alias("whole"),
                        kept(after, x["a"]).alias("a"), F.when(reset | higher, after).otherwise(x["b"]).alias("b"),
                        kept(zero, F.greatest(s, x["best"])).alias("best"),
                        kept(zero, F.when(higher, x["t"] + r).otherwise(x["won"])).alias("won"), kept(closed(x), x["out"]).alias("out"))

    def done(x: Column) -> Column:
        return F.struct(closed(x).alias("out"), ((x["whole"] >= TOTAL) & (x["whole"] >= MEAN * x["i"])).alias("good"), x["i"].alias("n"))

    found = F.transform(F.array(F.aggregate(_ratios(run, model), start, step, done)), lambda x: F.when((F.size(x["out"]) == 0) & x["good"], pair(F.lit(0), x["n"])).otherwise(x["out"]))
    return F.get(found, F.lit(0))


def _parts(rank: int, model: list[float], z: Column) -> Column:
    """The parts of a hit that are secrets, as an array of (a, b)."""
    if rank == 3:
        return _stretches(z["hit"], model)
    whole = F.array(F.struct(F.lit(0).alias("a"), F.length(z["hit"]).alias("b")))
    return F.filter(whole, lambda _: F.length(z["value"]) >= VALUE) if rank == 0 else whole


def _measured(rank: int, model: list[float]):
    return lambda z, i: F.struct(F.lit(rank).alias("rank"), i.alias("i"), F.length(z["gap"]).alias("gap"),
                                 F.length(z["hit"]).alias("size"), _parts(rank, model, z).alias("parts"))


def _replaced(rank: int, model: list[float], mark: str):
    def fn(z: Column) -> Column:
        cut = lambda a, b: F.substring(z["hit"], a + 1, b - a)
        start = F.struct(F.lit(0).alias("at"), z["gap"].alias("text"))
        step = lambda x, p: F.struct(p["b"].alias("at"), F.concat(x["text"], cut(x["at"], p["a"]), F.lit(mark)).alias("text"))
        rest = F.aggregate(_parts(rank, model, z), start, step, lambda x: F.concat(x["text"], cut(x["at"], F.length(z["hit"]))))
        return F.when(z["hit"].isNull(), z["gap"]).otherwise(rest)

    return fn


def spans(docs: DataFrame, model: list[float], keep: list[str], text_col: str = "text") -> DataFrame:
    """Columns ``keep`` of every row, ``base`` and ``spans``: arrays of (start, rank, end), sorted; rank is the place in KINDS."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    may = _may(text)
    values = _found(text, ASSIGN, may["assign"], 2)
    lists = []
    for rank, pattern in enumerate([ASSIGN, ACCESS, HEX, RUN % LEAST]):
        hits, gaps = _found(text, pattern, may[KINDS[rank]]), _pieces(text, pattern, may[KINDS[rank]])
        extra = values if rank == 0 else hits
        zipped = F.arrays_zip(hits.alias("hit"), gaps.alias("gap"), extra.alias("value"))
        lists.append(F.transform(F.filter(zipped, lambda z: z["hit"].isNotNull()), _measured(rank, model)))
    rows = docs.select(F.monotonically_increasing_id().alias("uid"), F.struct(*keep).alias("row"), F.concat(*lists).alias("found"))
    rows = rows.select("uid", "row", F.explode_outer("found").alias("m")).select("uid", "row", "m.*").repartition("uid")
    upto = W.partitionBy("uid", "rank").orderBy("i").rowsBetween(W.unboundedPreceding, 0)
    rows = rows.withColumn("end", F.sum(F.col("gap") + F.col("size")).over(upto)).withColumn("start", F.col("end") - F.col("size"))
    # a Markov span only adds: it must not touch a base span before or after it
    order = W.partitionBy("uid").orderBy("start", "rank")
    solid = (F.col("rank") < 3) & (F.size("parts") > 0)
    rows = rows.withColumn("left", F.max(F.when(solid, F.col("end"))).over(order.rowsBetween(W.unboundedPreceding, -1)))
    rows = rows.withColumn("right", F.min(F.when(solid, F.col("start"))).over(order.rowsBetween(1, W.unboundedFollowing)))
    found = F.transform("parts", lambda p: F.struct((F.col("start") + p["a"]).alias("start"), F.col("rank").alias("rank"), (F.col("start") + p["b"]).alias("end")))
    free = F.filter(found, lambda s: (s["rank"] < 3) | ((F.coalesce("left", F.lit(0)) <= s["start"]) & F.coalesce(F.col("right") >= s["end"], F.lit(True))))
    rows = rows.withColumn("all", free)
    done = rows.groupBy("uid").agg(F.first("row").alias("row"), F.array_sort(F.flatten(F.collect_list(F.when(solid, F.col("all"))))).alias("base"),
                                   F.array_sort(F.flatten(F.collect_list("all"))).alias("spans"))
    return done.select("row.*", "base", "spans")


def redact(docs: DataFrame, model: list[float], text_col: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every secret in the text replaced by ``mark``; other columns stay, null texts stay null.

    The patterns are applied in the order of KINDS; a later one sees what the earlier ones left."""
    out = F.col(text_col)
    for rank, pattern in enumerate([ASSIGN, ACCESS, HEX, RUN % LEAST]):
        docs = docs.withColumn(text_col, out)
        text = F.col(text_col)
        may = _may(text)[KINDS[rank]]
        hits, gaps = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)
        values = F.regexp_extract_all(text, F.lit(pattern), F.lit(2)) if rank == 0 else hits
        zipped = F.arrays_zip(gaps.alias("gap"), hits.alias("hit"), values.alias("value"))
        parts = F.transform(zipped, _replaced(rank, model, mark))
        out = F.when(may, F.array_join(parts, "")).otherwise(text)
    return docs.withColumn(text_col, out)


def _of(rank: int):
    return lambda s: s["rank"] == rank


def _told(found: str) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.concat_ws(",", F.transform(F.col(found), lambda s: F.concat_ws(":", F.get(names, s["rank"]), s["start"].cast("string"), s["end"].cast("string"))))


@query("op7_secret_scans")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document, as spans."""
    docs = table(spark, sf_dir, "documents")
    found = spans(docs, train(docs), ["doc_id"])
    n = [F.size(F.filter("base", _of(rank))).cast("long").alias(f"n_{KINDS[rank]}") for rank in range(3)]
    return found.select("doc_id", *n, F.sha2(_told("base"), 256).alias("base_sha256"), _told("spans").alias("spans"))
