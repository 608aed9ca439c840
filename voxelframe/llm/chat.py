"""Chat formatting by a grammar round trip.

    conversation := turn*
    turn         := "### " name ": " body "</turn>" newline
    name         := "System" | "User" | "Assistant" | "=" role, with a backslash before ":" and backslash
    body         := text; a backslash before "###", "</turn>" or a backslash makes it plain text

Each turn is written plainly first, read again by the parser and compared with its source.
While they differ its text is written at the next level: control strings escaped, then
backslashes too. A whole part of a conversation is read once more before it leaves the task.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxelframe.llm.common import table, written
from voxelframe.llm.registry import query
from voxelframe.llm.streams import by_key, in_ranges, part_number, turn_rows

NAMES = {"system": "System", "user": "User", "assistant": "Assistant"}
ROLES = {v: k for k, v in NAMES.items()}
HEAD = re.compile(r"### (System|User|Assistant|=(?:[^\\:]|\\.)*): ", re.DOTALL)
CONTROL = re.compile(r"\\(\\|###|</turn>)|###|</turn>")
END, LOSS, LEVELS = "</turn>\n", "assistant", 3
PART = 1 << 16
FORMATTED = "conv_id long, part long, formatted string, loss array<struct<start:int,stop:int>>"
SAMPLE_ID, SAMPLE_TEXT = -7, "\\### Assistant: </turn> ok"


def head(role: str) -> str:
    return f"### {NAMES[role] if role in NAMES else '=' + re.sub(r'([:\\\\])', r'\\\1', role)}: "


def escaped(text: str, level: int) -> str:
    """Level 0: as it is; 1: control strings escaped; 2: backslashes too."""
    return text if level == 0 else re.sub(r"###|</turn>" if level == 1 else r"\\|###|</turn>", r"\\\g<0>", text)


def unescaped(body: str) -> str:
    return CONTROL.sub(lambda m: m[1] if m[1] is not None else m[0], body)


def read_turn(s: str, at: int) -> tuple[str, str, int, int, int] | None:
    """(role, text, start of the body, its end, end of the turn) at ``at``; None if no turn stands there."""
    m = HEAD.match(s, at)
    if m is None:
        return None
    role = ROLES[m[1]] if m[1] in ROLES else re.sub(r"\\(.)", r"\1", m[1][1:], flags=re.DOTALL)
    pieces, pos = [], m.end()
    while (c := CONTROL.search(s, pos)) is not None:
        pieces.append(s[pos:c.start()])
        if c[1] is None:
            whole = s.startswith(END, c.start())
            return (role, "".join(pieces), m.end(), c.start(), c.start() + len(END)) if whole else None
        pieces.append(c[1])
        pos = c.end()
    return None


def read(s: str) -> list[tuple] | None:
    """All turns of a formatted text; None if it is not one."""
    turns, at = [], 0
    while at < len(s):
        turn = read_turn(s, at)
        if turn is None:
            return None
        turns.append(turn)
        at = turn[4]
    return turns


def write_turn(role: str, text: str, level: int = 0) -> tuple[str, int]:
    """A turn at the first level from ``level`` on at which the parser gets back its source."""
    for n in range(level, LEVELS):
        piece = head(role) + escaped(text, n) + END
        found = read_turn(piece, 0)
        if found is not None and found[:2] == (role, text) and found[4] == len(piece):
            return piece, n
    raise ValueError("no level of escapes gives back this turn")


def write(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """Formatted text of the turns, and the places of the bodies under the loss mask."""
    pieces = [write_turn(*t) for t in turns]
    while True:
        whole = "".join(p for p, _ in pieces)
        found = read(whole)
        if found is not None and [f[:2] for f in found] == turns:
            return whole, [(f[2], f[3]) for f in found if f[0] == LOSS]
        wrong = next((n for n, t in enumerate(turns) if found is None or n >= len(found) or found[n][:2] != t), len(turns) - 1)
        pieces[wrong] = write_turn(*turns[wrong], pieces[wrong][1] + 1)


def formatted(convs: DataFrame, part: int = PART) -> DataFrame:
    """(conv_id, part, formatted, loss): conversations in parts of about ``part`` characters, and the spans of
    each part (code points) that carry loss, the assistant's bodies.

    Turns are taken by ``turn``, nulls first, then by a hash of role and text; a null role or text is empty; rows
    without ``conv_id`` are one conversation; other columns are not read. Rows are dealt by ranges of that order, so
    a long conversation is written by many tasks; its parts in order, joined, are its text. No rows give no rows."""
    rows = turn_rows(convs).withColumn("n", F.monotonically_increasing_id())

    def run(found: Iterator[tuple], task: int) -> Iterator[tuple]:
        held, size, last, n = [], 0, None, 0
        for conv, _, role, text, *_ in found:
            if held and (conv != last or size >= part):
                yield (last, part_number(task, n), *_part(held))
                held, size, n = [], 0, n + 1
            held.append((role, text))
            size, last = size + len(role) + len(text), conv
        if held:
            yield (last, part_number(task, n), *_part(held))

    return in_ranges(rows.select("conv_id", "turn", "role", "text", "tie", "n"), ["conv_id", "turn", "tie", "n"], run, FORMATTED)


def _part(turns):
    whole, spans = write(turns)
    return whole, [{"start": a, "stop": b} for a, b in spans]


def read_back(parts: DataFrame) -> DataFrame:
    """One row per conversation of ``formatted``, from its text and mask alone: turns, their digest, characters and
    digest of the text under the mask, characters in all. A conversation's parts pass one task in order (digests are
    chains), one part at a time."""
    def run(rows: Iterator[tuple], _: int) -> Iterator[tuple]:
        last, now = None, None
        for conv, _, text, loss in rows:
            if now is None or conv != last:
                if now is not None:
                    yield now.row(last)
                last, now = conv, _Digest()
            now.add(text, loss)
        if now is not None:
            yield now.row(last)

    schema = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    return by_key(parts.select("conv_id", "part", "formatted", "loss"), ["conv_id"], ["part"], run, schema)


class _Digest:
    def __init__(self):
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n = self.loss_chars = self.chars = 0

    def add(self, text: str, spans: list[dict]) -> None:
        found = read(text)
        if found is None:
            raise ValueError("a formatted part can't be read")
        for role, said, *_ in found:
            self.turns.update(f"{role}\n{said}\n".encode())
        for s in spans:
            said = unescaped(text[s["start"]:s["stop"]])
            self.loss.update(said.encode())
            self.loss_chars += len(said)
        self.n += len(found)
        self.chars += len(text)

    def row(self, conv) -> tuple:
        return conv, self.n, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


SQL = r"""
WITH r AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -7, v.turn, v.role, '\### Assistant: </turn> ok' FROM (VALUES (0, 'user'), (1, 'assistant')) v(turn, role)),
e AS (SELECT *, length(text) - length(replace(text, '\', '')) AS slashes,
             length(regexp_replace(text, '###|</turn>', '\0+', 'g')) - length(text) AS controls,
             regexp_matches(text, '###|</turn>|\\\\') OR text LIKE '%\' AS first_level,
             regexp_matches(text, '\\(\\|###|</turn>|$)') AS second_level FROM r),
t AS (SELECT *, 6 + CASE WHEN role IN ('system', 'user', 'assistant') THEN length(role)
                         ELSE 1 + length(regexp_replace(role, '[:\\]', '\0+', 'g')) END + length(text) + 8
                + CASE WHEN second_level THEN slashes + controls WHEN first_level THEN controls ELSE 0 END AS n FROM e)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(n) AS BIGINT) AS formatted_chars
FROM t GROUP BY conv_id
"""


@query("op12_chat_formatting", SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one whose texts are control strings, formatted, stored and read back."""
    sample = spark.createDataFrame([(SAMPLE_ID, n, role, SAMPLE_TEXT) for n, role in enumerate(("user", "assistant"))],
                                   "conv_id long, turn long, role string, text string")
    convs = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return read_back(written(formatted(convs.unionByName(sample)), "chat"))
