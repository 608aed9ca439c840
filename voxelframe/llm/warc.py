"""Derived WARC records: metadata and plain-text conversions linked to their responses.

A response is a row (record_id, target_uri, date, http, payload): ``http`` is the status line and
header lines, ``payload`` the page. From each come a metadata record (title, the source's status,
headers and digests, outlinks in order) and a conversion record (the text of the page). Both name
the response in WARC-Refers-To and carry its address and date; record ids are hashes of what the
record is made from, so a run that is repeated gives the same ids. Digests are SHA-256 of UTF-8.

All is column work on one row, so nothing is shuffled and a source with a third of the pages
needs no care. A null payload is an empty page with an empty conversion; a null address leaves the
header out; repeated rows give repeated records.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from voxelframe.llm.common import table
from voxelframe.llm.registry import query

CRLF = "\r\n"
EPOCH = "1970-01-01T00:00:00Z"
STATUS = "HTTP/1.1 200 OK"
MIME = "text/html; charset=utf-8"
# Elements whose content is not text, elements that end a line, named characters.
HIDDEN = ["script", "style", "title", "noscript", "template"]
LINES = ("address|article|aside|blockquote|br|dd|div|dl|dt|fieldset|figcaption|figure|footer|form|h1|h2|h3|h4|h5|h6|header|hr|li|main|nav|ol|"
         "option|p|pre|section|select|table|td|tfoot|th|thead|tr|ul")
NAMED = {"lt": "<", "gt": ">", "quot": '"', "apos": "'", "nbsp": " ", "copy": "©", "reg": "®", "middot": "·", "hellip": "…",
         "ndash": "–", "mdash": "—", "lsquo": "‘", "rsquo": "’", "ldquo": "“", "rdquo": "”", "laquo": "«", "raquo": "»"}
COMMENT = r"(?s)<!--.*?(?:-->|\z)"
TITLE = r"(?is)<title[^>]*>(.*?)</title"
LINK = r"""(?is)<a\s[^>]*?\bhref\s*=\s*"([^"]*)\""""
# Runs of white space, and what a scan for single characters does faster in Spark, with the same result.
SPACE, BLANK, BREAK, HEAD, TAIL = r"[ \t\r\n\f]+", r"[ \t]+", r" ?\n[ \n]*", r"^[ \n]+", r"[ \n]+\z"
FASTER = {SPACE: lambda t: F.regexp_replace(reduce(lambda u, c: F.replace(u, F.lit(c), F.lit(" ")), "\t\r\n\f", t), "  +", " "),
          BLANK: lambda t: F.regexp_replace(F.replace(t, F.lit("\t"), F.lit(" ")), "  +", " "),
          BREAK: lambda t: F.regexp_replace(F.replace(t, F.lit(" \n"), F.lit("\n")), r"\n[ \n]+", "\n"), HEAD: lambda t: F.ltrim(t, F.lit(" \n")), TAIL: lambda t: F.rtrim(t, F.lit(" \n"))}
STEPS = [(COMMENT, ""), ("(?is)<(?:" + "|".join(rf"{t}\b.*?(?:</{t}[^>]*>|\z)" for t in HIDDEN) + ")", " "),
    (SPACE, " "), (rf"(?i)</?(?:{LINES})\b[^>]*(?:>|\z)", "\n"), (r"<[A-Za-z/!?][^>]*(?:>|\z)", "")]
TIDY = [(BLANK, " "), (BREAK, "\n"), (HEAD, ""), (TAIL, "")]


def _replaced(text: Column, steps: list[tuple[str, str]]) -> Column:
    for pattern, by in steps:
        text = FASTER[pattern](text) if pattern in FASTER else F.regexp_replace(text, pattern, by)
    return text


def _numbered(text: Column, pattern: str, base: int) -> Column:
    """Decode numeric references; those that name no character stay."""
    number = lambda s: F.conv(s, base, 10).cast("long")
    good = lambda n: (n > 0) & (n <= 0x10FFFF) & ~n.between(0xD800, 0xDFFF)
    char = lambda n: F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32")
    pairs = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("all"),
                         F.regexp_extract_all(text, F.lit(pattern), F.lit(1)).alias("digits"))
    put = lambda z: F.concat(z["gap"], F.when(z["all"].isNull(), "").when(good(number(z["digits"])), char(number(z["digits"]))).otherwise(z["all"]))
    return F.when(text.contains("&#"), F.array_join(F.transform(pairs, put), "")).otherwise(text)


def _named(text: Column) -> Column:
    """Decode named references; what follows an ampersand and is no known name stays."""
    names = F.create_map(*[F.lit(x) for pair in [*NAMED.items(), ("amp", "&")] for x in pair])
    known = lambda p: F.when(p.contains(";"), names[F.substring_index(p, ";", 1)])
    put = lambda p, i: F.when(i == 0, p).otherwise(F.coalesce(F.concat(known(p), F.substring(p, F.instr(p, ";") + 1, F.length(p))), F.concat(F.lit("&"), p)))
    return F.when(text.contains("&"), F.array_join(F.transform(F.split(text, "&", -1), put), "")).otherwise(text)


def with_decoded(rows: DataFrame, name: str) -> DataFrame:
    """Replace the character references in a column of texts, each once.

    Columns made in steps are worked out once each, though the next step names them several times."""
    rows = rows.withColumn(name, _numbered(F.col(name), r"&#([0-9]{1,7});", 10))
    rows = rows.withColumn(name, _numbered(F.col(name), r"&#[xX]([0-9A-Fa-f]{1,6});", 16))
    return rows.withColumn(name, _named(F.col(name)))


def with_text(rows: DataFrame, html: str, name: str, bare: bool = False) -> DataFrame:
    """Add the text of a page: no comments (``bare``: they are gone already), scripts or tags; a line for each block;
    no white space at line ends."""
    rows = with_decoded(rows.withColumn(name, _replaced(F.col(html), STEPS[1:] if bare else STEPS)), name)
    rows = rows.withColumn(name, _replaced(F.col(name), TIDY[:2]))
    # by now at most one blank or line end is left at either end
    text, blank = F.col(name), lambda test: test(" ") | test("\n")
    rows = rows.withColumn(name, F.when(blank(text.startswith), F.substring(text, 2, F.length(text))).otherwise(text))
    return rows.withColumn(name, F.when(blank(text.endswith), F.substring(text, 1, F.length(text) - 1)).otherwise(text))


def _urn(*parts: Column) -> Column:
    h = F.sha2(F.concat_ws("|", *parts), 256)
    cut = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cut), F.lit(">"))


def _digest(text: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(text, 256))


def responses(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", date: str = EPOCH) -> DataFrame:
    """Response rows of a table of pages, with ``id_col`` kept as source_id."""
    payload = F.coalesce(F.col(html_col).cast("string"), F.lit(""))
    http = F.array(F.lit(STATUS), F.lit(f"Content-Type: {MIME}"), F.concat(F.lit("Content-Length: "), F.octet_length(payload).cast("string")))
    made = [F.lit("response"), F.col(id_col).cast("string"), F.col(url_col), F.sha2(payload, 256)]
    return pages.select(F.col(id_col).alias("source_id"), _urn(*[F.coalesce(c, F.lit("")) for c in made]).alias("record_id"),
                        F.col(url_col).alias("target_uri"), F.lit(date).alias("date"), http.alias("http"), payload.alias("payload"))


def _record(kind: str, record_id: Column, refers: Column, mime: str, block: Column) -> Column:
    return F.struct(F.lit(kind).alias("warc_type"), record_id.alias("record_id"), refers.alias("refers_to"), F.lit(mime).alias("content_type"),
                    F.octet_length(block).cast("long").alias("content_length"), _digest(block).alias("block_digest"), block.alias("block"))


def derive(found: DataFrame) -> DataFrame:
    """source_id, target_uri, date, source_digest and the fields of the metadata and the conversion record of every response."""
    source, meta, text = F.col("record_id"), _urn(F.lit("metadata"), F.col("record_id")), _urn(F.lit("conversion"), F.col("record_id"))
    line = lambda n, value: F.concat(F.lit(f"{n}: "), value)
    rows = found.withColumn("digest", _digest(F.col("payload"))).withColumn("bare", F.regexp_replace("payload", COMMENT, ""))
    rows = with_text(rows, "bare", "text", bare=True)
    rows = rows.withColumn("title", _replaced(F.regexp_extract("bare", TITLE, 1), STEPS[-3:]))
    rows = with_decoded(rows, "title").withColumn("title", _replaced(F.col("title"), [(SPACE, " "), (HEAD, ""), (TAIL, "")]))
    # addresses are decoded together: a line end parts them and is in none of them
    links = F.transform(F.regexp_extract_all("bare", F.lit(LINK), F.lit(1)), lambda u: F.regexp_replace(u, r"[\r\n]+", ""))
    rows = with_decoded(rows.withColumn("links", F.array_join(links, "\n")).withColumn("any", F.size(links) > 0), "links")
    fields = F.concat(F.array(line("title", F.col("title")), line("source-status", F.get("http", F.lit(0)))),
                      F.transform(F.slice("http", 2, F.greatest(F.size("http") - 1, F.lit(0))), lambda h: F.concat(F.lit("source-header: "), h)),
                      F.array(line("source-payload-digest", F.col("digest")), line("conversion", text)),
                      F.when(F.col("any"), F.transform(F.split("links", "\n", -1), lambda u: line("outlink", u))).otherwise(F.array().cast("array<string>")))
    rows = rows.withColumn("fields", F.concat(F.array_join(fields, CRLF), F.lit(CRLF)))
    both = F.array(_record("metadata", meta, source, "application/warc-fields", F.col("fields")), _record("conversion", text, source, "text/plain", F.col("text")))
    return rows.select("source_id", "target_uri", "date", F.col("digest").alias("source_digest"), F.explode(both).alias("r")).select("source_id", "target_uri", "date", "source_digest", "r.*")


def response_records(found: DataFrame) -> DataFrame:
    """The responses themselves in the columns of ``derive``."""
    block = F.concat(F.array_join("http", CRLF), F.lit(CRLF + CRLF), F.col("payload"))
    made = _record("response", F.col("record_id"), F.lit(None).cast("string"), "application/http; msgtype=response", block)
    return found.select("source_id", "target_uri", "date", _digest(F.col("payload")).alias("source_digest"), made.alias("r")).select("source_id", "target_uri", "date", "source_digest", "r.*")


def record_text(records: DataFrame) -> DataFrame:
    """One column ``value``: each record as it stands in a file, without the two line ends that follow it."""
    fields = [("WARC-Type", "warc_type"), ("WARC-Record-ID", "record_id"), ("WARC-Refers-To", "refers_to"), ("WARC-Target-URI", "target_uri"),
              ("WARC-Date", "date"), ("WARC-Block-Digest", "block_digest"), ("Content-Type", "content_type"), ("Content-Length", "content_length")]
    payload = F.when(F.col("warc_type") == "response", F.concat(F.lit("WARC-Payload-Digest: "), F.col("source_digest")))
    lines = [F.concat(F.lit(f"{n}: "), F.col(c).cast("string")) for n, c in fields]
    head = F.concat_ws(CRLF, F.lit("WARC/1.1"), *lines[:-2], payload, *lines[-2:])
    return records.select(F.concat(head, F.lit(CRLF + CRLF), F.col("block")).alias("value"))


def write(records: DataFrame, path: str, compression: str = "gzip") -> None:
    """Write records as files of the format, below ``path``."""
    record_text(records).write.option("lineSep", CRLF * 2).option("compression", compression).text(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """warc_type, record_id, refers_to, target_uri, date, source_digest, block_digest, content_type, content_length, block and whole.

    Records are told apart by the line ends and version between them. ``whole`` is false where the block is not as
    long as its header says, as when a payload holds just those characters; such rows are kept for the caller to judge."""
    between = CRLF * 2 + "WARC/1."
    raw = spark.read.option("lineSep", between).text(path).where("value <> ''")
    head = F.substring_index("value", CRLF * 2, 1)
    rest = F.substring("value", F.length(head) + 5, F.length("value"))
    block = F.regexp_replace(rest, r"\r\n\r\n\z", "")
    rows = raw.select(head.alias("head"), rest.alias("rest"), block.alias("cut"))
    field = lambda name: F.nullif(F.regexp_extract("head", rf"(?im)^{name}:[ \t]*([^\r\n]*)", 1), F.lit(""))
    names = [("warc_type", "WARC-Type"), ("record_id", "WARC-Record-ID"), ("refers_to", "WARC-Refers-To"), ("target_uri", "WARC-Target-URI"), ("date", "WARC-Date"),
             ("source_digest", "WARC-Payload-Digest"), ("block_digest", "WARC-Block-Digest"), ("content_type", "Content-Type")]
    size = field("Content-Length").cast("long")
    # the last record of a file still has the line ends that follow it
    rows = rows.select(*[field(n).alias(c) for c, n in names], size.alias("content_length"),
                       F.when(F.octet_length("rest") == size, F.col("rest")).otherwise(F.col("cut")).alias("block"))
    return rows.withColumn("whole", F.coalesce(F.octet_length("block") == F.col("content_length"), F.lit(False)))


def as_responses(records: DataFrame) -> DataFrame:
    """Response rows from the response records of ``read``: the block cut into header lines and payload."""
    head = F.substring_index("block", CRLF * 2, 1)
    return records.where("warc_type = 'response'").select(F.col("record_id").alias("source_id"), "record_id", "target_uri", "date",
        F.split(head, CRLF).alias("http"), F.substring("block", F.length(head) + 5, F.length("block")).alias("payload"))


def _sql() -> str:
    quoted = lambda s: "'" + s.replace("'", "''") + "'"

    def replaced(text, steps):
        for pattern, by in steps:
            by = "chr(10)" if by == "\n" else quoted(by)
            text = f"regexp_replace({text}, {quoted(pattern)}, {by}, 'g')"
        return text

    def named(text):
        for name, char in NAMED.items():
            text = f"replace({text}, {quoted(f'&{name};')}, {quoted(char)})"
        return f"replace({text}, '&amp;', '&')"

    title = replaced(named(replaced(f"regexp_extract(bare, {quoted(TITLE)}, 1)", STEPS[-3:])), [(SPACE, " "), (HEAD, ""), (TAIL, "")])
    link = named("regexp_replace(u, '[\\r\\n]+', '', 'g')")
    eol = "chr(13) || chr(10)"
    uuid = "'<urn:uuid:' || h[1:8] || '-' || h[9:12] || '-' || h[13:16] || '-' || h[17:20] || '-' || h[21:32] || '>'"
    return f"""
WITH p AS (SELECT page_id, url, coalesce(html, '') AS html, sha256(coalesce(html, '')) AS digest, strlen(coalesce(html, '')) AS size FROM pages),
a AS (SELECT *, regexp_replace(html, {quoted(COMMENT)}, '', 'g') AS bare, sha256(concat_ws('|', 'response', CAST(page_id AS VARCHAR), coalesce(url, ''), digest)) AS h FROM p),
b AS (SELECT *, {uuid} AS source FROM a),
c AS (SELECT * EXCLUDE (h), sha256('conversion|' || source) AS h FROM b),
d AS (SELECT *, {uuid} AS text_id FROM c),
e AS (SELECT * EXCLUDE (h), sha256('metadata|' || source) AS h FROM d),
f AS (SELECT *, {uuid} AS meta_id, {replaced(named(replaced('html', STEPS)), TIDY)} AS text, {title} AS title,
      list_transform(regexp_extract_all(bare, {quoted(LINK)}, 1), lambda u: 'outlink: ' || {link} || {eol}) AS links FROM e),
g AS (SELECT *, 'title: ' || title || {eol} || 'source-status: {STATUS}' || {eol} || 'source-header: Content-Type: {MIME}' || {eol} ||
      'source-header: Content-Length: ' || size || {eol} || 'source-payload-digest: sha256:' || digest || {eol} || 'conversion: ' || text_id || {eol} ||
      array_to_string(links, '') AS fields FROM f)
SELECT page_id, 'metadata' AS warc_type, meta_id AS record_id, source AS refers_to, url AS target_uri, 'sha256:' || digest AS source_digest,
       'application/warc-fields' AS content_type, CAST(strlen(fields) AS BIGINT) AS content_length, 'sha256:' || sha256(fields) AS block_digest FROM g
UNION ALL SELECT page_id, 'conversion', text_id, source, url, 'sha256:' || digest, 'text/plain', CAST(strlen(text) AS BIGINT), 'sha256:' || sha256(text) FROM g"""


@query("op4_warc_derivatives", _sql())
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Headers and digests of the records derived from every page."""
    done = derive(responses(table(spark, sf_dir, "pages")))
    return done.select(F.col("source_id").alias("page_id"), "warc_type", "record_id", "refers_to", "target_uri", "source_digest", "content_type", "content_length", "block_digest")
