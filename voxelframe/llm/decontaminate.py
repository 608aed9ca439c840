"""Benchmark passages in documents, by a positional inverted index of the documents.

Words are runs of digits, letters a-z (A-Z lower-cased) and characters beyond ASCII.
The index holds one posting (term, uid, pos) for each occurrence of a test word; it
is partitioned by documents and sorted by term within a partition, so building it
moves nothing and a frequent word never meets in one task. A posting of the term -1
holds each document's length.

A window is 13 consecutive words of an item (all of a shorter item). Its two rarest
words, by their postings in the corpus, are looked up first: a posting at ``pos`` of
the item's word at ``ipos`` says that the item may lie at offset ``pos - ipos``, and
both lists must name that offset. The offsets left are intersected with the lists of
all other words of the item; runs of a window's length or more are exact matches.
Proximity matches let words be missing or moved: see ``proximity_matches``.

Null and wordless texts have no words and no hits; equal items are looked up once and
all their ids reported; a null item id is written as empty text; repeated rows of
documents give a row each. All is DataFrame code.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from voxelframe.llm.common import LOWER, UPPER, ascii_lower, sized, table, written
from voxelframe.llm.registry import query

WINDOW, SLACK = 13, 4
# Fixed value: what separates words.
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    return F.coalesce(F.array_remove(F.split(ascii_lower(text.cast("string")), GAP), ""), F.array().cast("array<string>"))


@dataclass
class Index:
    """terms (term, word, n): test words and their postings' number; postings (term, uid, pos, id)."""

    terms: DataFrame
    postings: DataFrame


def build_index(docs: DataFrame, vocabulary: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Index:
    """Postings of every word of ``vocabulary`` (a column ``word``) in whole ``docs``."""
    listed = vocabulary.select("word").distinct().select(F.xxhash64("word").alias("term"), "word")
    # numbers without gaps are not needed: a term is its hash unless two words share it
    clash = listed.groupBy("term").count().where("count > 1").isEmpty()
    if not clash:
        raise ValueError("two test words share a 64-bit hash")
    listed = written(listed, "terms")
    lookup = sized(listed.select("word", "term").unionByName(docs.sparkSession.range(1).select(F.lit("").alias("word"), F.lit(-1).cast("long").alias("term"))), "lookup")
    rows = docs.select(F.monotonically_increasing_id().alias("uid"), F.col(id_col).alias("id"), words(F.col(text_col)).alias("w"))
    # the empty word at the end is the posting that holds the length
    rows = rows.select("uid", "id", F.posexplode(F.concat("w", F.array(F.lit("")))).alias("pos", "word")).join(lookup, "word")
    rows = rows.select("term", "uid", "pos", F.when(F.col("term") == -1, F.col("id")).alias("id"))
    postings = written(rows.sortWithinPartitions("term", "uid", "pos"), "postings")
    counts = postings.groupBy("term").count().withColumnRenamed("count", "n")
    return Index(written(listed.join(counts, "term", "left").select("term", "word", F.coalesce("n", F.lit(0)).alias("n")), "counts"), postings)


def test_items(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(item, ids) and (item, ipos, word, length): different items by their words, in order."""
    spoken = benchmark.select(F.col(id_col).cast("string").alias("id"), words(F.col(text_col)).alias("w")).where(F.size("w") > 0)
    spoken = spoken.groupBy("w").agg(F.array_sort(F.collect_set(F.coalesce("id", F.lit("")))).alias("ids"))
    spoken = written(spoken.select(F.monotonically_increasing_id().alias("item"), "ids", "w"), "items")
    return spoken.select("item", "ids"), spoken.select("item", F.size("w").alias("length"), F.posexplode("w").alias("ipos", "word"))


def _anchors(spoken: DataFrame, terms: DataFrame, window: int) -> DataFrame:
    """(item, ip1, ip2, t1, t2): places of the two rarest words of each window; equal choices once.

    A window with a word that the corpus lacks matches nothing and is left out."""
    known = spoken.join(terms, "word")
    length = F.least(F.lit(window), F.col("length"))
    mine = W.partitionBy("item").orderBy("ipos").rangeBetween(0, window - 1)
    near = known.withColumn("span", F.array_sort(F.collect_list(F.struct("n", "ipos", "term")).over(mine)))
    # a short item's later places see fewer words than its length, and so are no start
    starts = near.where((F.size("span") == length) & (F.col("span")[0]["n"] > 0))
    second = F.when(F.size("span") > 1, F.col("span")[1]).otherwise(F.col("span")[0])
    return starts.select("item", F.col("span")[0]["ipos"].alias("ip1"), F.col("span")[0]["term"].alias("t1"),
                         second["ipos"].alias("ip2"), second["term"].alias("t2")).distinct()


def phrase_matches(index: Index, spoken: DataFrame, window: int = WINDOW) -> DataFrame:
    """(uid, item, lo, hi): the runs of document words, both ends included, that occurrences of windows cover."""
    pairs = written(_anchors(spoken, index.terms, window), "anchors")
    places = pairs.select("item", F.col("ip1").alias("ipos"), F.col("t1").alias("term")).unionByName(
        pairs.select("item", F.col("ip2").alias("ipos"), F.col("t2").alias("term"))).distinct()
    at = index.postings.select("term", "uid", "pos").join(sized(places, "places"), "term")
    at = written(at.select("uid", "item", "ipos", (F.col("pos") - F.col("ipos")).alias("delta")), "offsets")
    first = at.join(sized(pairs.select("item", F.col("ip1").alias("ipos"), "ip2"), "pairs"), ["item", "ipos"])
    both = first.select("uid", "item", "delta", F.col("ip2").alias("ipos")).join(at, ["uid", "item", "delta", "ipos"], "left_semi")
    found = written(both.select("uid", "item", "delta").distinct(), "found")
    asked = found.join(sized(spoken.join(index.terms, "word").select("item", "length", "ipos", "term"), "spoken"), "item").select(
        "uid", "item", "length", "delta", "ipos", "term", (F.col("delta") + F.col("ipos")).alias("pos"))
    there = index.postings.select("term", "uid", "pos").join(sized(found.select("uid").distinct(), "uids", 1_000_000), "uid", "left_semi")
    same = asked.join(there, ["uid", "term", "pos"], "left_semi")
    run = F.col("ipos") - F.row_number().over(W.partitionBy("uid", "item", "delta").orderBy("ipos"))
    runs = same.withColumn("run", run).groupBy("uid", "item", "delta", "run").agg(
        F.min("pos").alias("lo"), F.max("pos").alias("hi"), F.first("length").alias("length"))
    return runs.where(F.col("hi") - F.col("lo") + 1 >= F.least(F.lit(window), F.col("length"))).select("uid", "item", "lo", "hi")


def needed(length: Column) -> Column:
    """Words of a window that a proximity match must hold: four in five."""
    return F.ceil(length * 4 / 5)


def _near_anchors(spoken: DataFrame, terms: DataFrame, window: int) -> DataFrame:
    """(item, ipos, term): the rarest words of each window that the corpus has, two more than may still be missing. Words that
    the corpus lacks are missing from the start; a window that lacks too many, or asks for one word only, is left out."""
    known = spoken.join(terms.select("word", "term", "n"), "word")
    length = F.least(F.lit(window), F.col("length"))
    mine = W.partitionBy("item").orderBy("ipos").rangeBetween(0, window - 1)
    near = known.withColumn("span", F.collect_list(F.struct("n", "ipos", "term")).over(mine)).withColumn("size", length)
    there = F.array_sort(F.filter("span", lambda w: w["n"] > 0))
    near = near.where((F.size("span") == F.col("size")) & (needed(F.col("size")) > 1)).withColumn("there", there)
    spare = F.size("there") - needed(F.col("size"))
    near = near.where(spare >= 0).select("item", F.explode(F.slice("there", F.lit(1), (spare + 2).cast("int"))).alias("w"))
    return near.select("item", "w.ipos", "w.term").distinct()


def proximity_matches(index: Index, spoken: DataFrame, window: int = WINDOW, slack: int = SLACK) -> DataFrame:
    """(uid, item): items of which some window lies in the document within ``slack``: there is an offset ``low`` so that four
    in five of the window's words, or more, stand at offsets low to low + slack (offset: place in the text less place in the item).

    Of the rarest words looked up first, two at least are in any such match, so their lists must agree in an offset range;
    the ranges left are intersected with the lists of all words of the item. Items of one word have exact matches only."""
    places = written(_near_anchors(spoken, index.terms, window), "near-anchors")
    at = index.postings.select("term", "uid", "pos").join(sized(places, "near-places"), "term")
    at = at.groupBy("uid", "item").agg(F.array_sort(F.collect_list(F.struct((F.col("pos") - F.col("ipos")).cast("int").alias("delta"), F.col("ipos").cast("int").alias("ipos")))).alias("at"))
    # of different words in a range some two are neighbours by offset
    ends = F.transform(F.sequence(F.lit(1), F.size("at") - 1), lambda i: F.struct(F.element_at("at", i).alias("a"), F.element_at("at", i + 1).alias("b")))
    ends = F.filter(ends, lambda e: (e["b"]["delta"] - e["a"]["delta"] <= slack) & (e["a"]["ipos"] != e["b"]["ipos"]))
    lows = F.array_distinct(F.flatten(F.transform(ends, lambda e: F.sequence(e["b"]["delta"] - slack, e["a"]["delta"]))))
    agree = written(at.where(F.size("at") > 1).select("uid", "item", F.explode(lows).alias("low")), "near-ranges")
    asked = agree.select("uid", "item").distinct().join(sized(spoken.join(index.terms, "word").select("item", "length", "ipos", "term"), "spoken"), "item")
    there = index.postings.select("term", "uid", "pos").join(sized(agree.select("uid").distinct(), "near-uids", 1_000_000), "uid", "left_semi")
    same = asked.join(there, ["uid", "term"]).select("uid", "item", "length", "ipos", (F.col("pos") - F.col("ipos")).alias("delta"))
    held = same.join(agree, ["uid", "item"]).where(F.col("delta").between(F.col("low"), F.col("low") + slack)).select("uid", "item", "length", "ipos", "low").distinct()
    size = F.least(F.lit(window), F.col("length"))
    starts = F.explode(F.sequence(F.greatest(F.lit(0), F.col("ipos") - size + 1), F.least(F.col("ipos"), F.col("length") - size)))
    full = held.select("uid", "item", "low", size.alias("size"), starts.alias("start")).groupBy("uid", "item", "low", "start").agg(F.count(F.lit(1)).alias("n"), F.first("size").alias("size"))
    return full.where(F.col("n") >= needed(F.col("size"))).select("uid", "item").distinct()


def _named(matches: DataFrame, ids: DataFrame, out: str) -> DataFrame:
    """Ids of the items matched in each document, sorted as strings."""
    one = matches.select("uid", "item").distinct().join(sized(ids, "ids"), "item").select("uid", F.explode("ids").alias("one")).distinct()
    return one.groupBy("uid").agg(F.array_sort(F.collect_list("one")).alias(out))


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                  item_text: str = "text", window: int = WINDOW, near: bool = False, slack: int = SLACK) -> DataFrame:
    """(uid, id, n_words, n_hit, items): one row per document; items are the ids found, sorted as strings. With ``near``
    also ``near_items``, the ids of proximity matches (an exact match of two words or more is one)."""
    ids, spoken = test_items(benchmark, item_col, item_text)
    index = build_index(docs, spoken, id_col, text_col)
    runs = written(phrase_matches(index, spoken, window), "runs")
    hits = runs.select("uid", F.explode(F.sequence("lo", "hi")).alias("pos")).distinct().groupBy("uid").agg(F.count(F.lit(1)).alias("n_hit"))
    named = _named(runs, ids, "items")
    lengths = index.postings.where("term = -1").select("uid", "id", F.col("pos").cast("long").alias("n_words"))
    nothing, out = F.array().cast("array<string>"), lengths.join(hits, "uid", "left").join(named, "uid", "left")
    if near:
        out = out.join(_named(proximity_matches(index, spoken, window, slack), ids, "near_items"), "uid", "left")
    return out.select("uid", "id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.coalesce("items", nothing).alias("items"),
                      *([F.coalesce("near_items", nothing).alias("near_items")] if near else []))


def contaminated() -> Column:
    """A hit document of which one word in twenty or more is hit."""
    return (F.col("n_hit") > 0) & (F.col("n_hit") * 20 >= F.col("n_words"))


def clean(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id") -> DataFrame:
    """``docs`` without the contaminated rows, all columns kept."""
    key = [F.col(id_col).alias("id"), F.xxhash64(F.col(text_col)).alias("h")]
    found = contamination(docs.select(F.struct(*key).alias("id"), F.col(text_col).alias("text")), benchmark, "id", "text", item_col)
    bad = sized(found.where(contaminated()).select("id.id", "id.h").distinct(), "bad", 1_000_000)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), *key)
    same = rows["id"].eqNullSafe(bad["id"]) & (rows["h"] == bad["h"])
    return rows.join(bad, same, "left_anti").select("row.*")


SQL = rf"""
WITH spoken AS (SELECT item_id, regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
items AS (SELECT item_id, w, least(13, len(w)) AS size FROM spoken WHERE len(w) > 0),
windows AS (SELECT DISTINCT item_id, size, array_to_string(w[i:i + size - 1], ' ') AS gram FROM (SELECT item_id, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM items)),
docs AS (SELECT doc_id, coalesce(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM documents),
grams AS (SELECT doc_id, i, size, array_to_string(w[i:i + size - 1], ' ') AS gram
          FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM docs, (SELECT DISTINCT size FROM windows))),
found AS (SELECT doc_id, item_id, i, size FROM grams JOIN windows USING (size, gram)),
hits AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + size)) AS p FROM found) GROUP BY doc_id),
named AS (SELECT doc_id, count(*) AS n, string_agg(one, ',' ORDER BY one) AS ids FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS one FROM found) GROUP BY doc_id),
spots AS (SELECT item_id, len(w) AS length, size, unnest(w) AS word, generate_subscripts(w, 1) - 1 AS ipos FROM items),
posts AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) - 1 AS pos FROM docs),
deltas AS (SELECT DISTINCT doc_id, item_id, length, size, ipos, pos - ipos AS delta FROM posts JOIN spots USING (word) WHERE ceil(size * 4 / 5.0) > 1),
lows AS (SELECT DISTINCT doc_id, item_id, length, size, ipos, unnest(range(delta - {SLACK}, delta + 1)) AS low FROM deltas),
rich AS (SELECT doc_id, item_id, low FROM lows GROUP BY ALL HAVING count(*) >= any_value(ceil(size * 4 / 5.0))),
starts AS (SELECT doc_id, item_id, low, size, unnest(range(greatest(0, ipos - size + 1), least(ipos, length - size) + 1)) AS start FROM lows JOIN rich USING (doc_id, item_id, low)),
close AS (SELECT DISTINCT doc_id, item_id FROM (SELECT doc_id, item_id, low, start FROM starts GROUP BY ALL HAVING count(*) >= any_value(ceil(size * 4 / 5.0)))),
near AS (SELECT doc_id, count(*) AS n, string_agg(one, ',' ORDER BY one) AS ids FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS one FROM close) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(hits.n, 0) AS BIGINT) AS n_hit, CAST(coalesce(named.n, 0) AS BIGINT) AS n_items,
       sha256(coalesce(named.ids, '')) AS items_sha256, coalesce(hits.n, 0) > 0 AND 20 * coalesce(hits.n, 0) >= len(w) AS contaminated,
       CAST(coalesce(near.n, 0) AS BIGINT) AS n_near_items, sha256(coalesce(near.ids, '')) AS near_items_sha256
FROM docs LEFT JOIN hits USING (doc_id) LEFT JOIN named USING (doc_id) LEFT JOIN near USING (doc_id)"""


@query("op10_benchmark_decontamination", SQL)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words hit by windows of the benchmark, and items that lie near, for every document."""
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), near=True)
    return found.select(F.col("id").alias("doc_id"), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), contaminated().alias("contaminated"),
                        F.size("near_items").cast("long").alias("n_near_items"), F.sha2(F.concat_ws(",", "near_items"), 256).alias("near_items_sha256"))
