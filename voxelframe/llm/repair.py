"""Conversation structure repair at least cost, by depth-first branch and bound.

A row is kept (0), rerolled to user or assistant (3), deleted (4; blank and repeated rows must be) and an empty
turn can be inserted before any row or at the end (3); a truncated row that stays adds 3. The roles that are left
read ``(s?(ua)+)?``. Among the cheapest edits the least string of their initials (D, I, K, R) is taken.

States are what has been read: 0 nothing, 1 a system turn, 2 up to a user turn, 3 up to an assistant turn; a node is
(row, state). The search takes edits in the order of their initials from an explicit stack, so of two prefixes that
reach a node at one cost the first is the lesser string, and a node's table needs its least cost only: a later prefix
that is not cheaper is dropped. With bounds from the rows that follow, a node is left at most once for each unit by
which the first incumbent exceeds the bound.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxelframe.llm.common import table, written
from voxelframe.llm.registry import query
from voxelframe.llm.streams import by_key, digests, in_ranges, part_number, turn_rows

SPACE = " \t\n\v\f\r"
REROLE, DELETE, INSERT, CUT = 3, 4, 3, 3
LONG, SEGMENT = 4096, 512
STEP = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
NEXT = "uuau"  # the role that a rerolled or inserted turn takes in each state
NAME = {"u": "user", "a": "assistant"}
END = (0, 2, 1, 0)  # inserted turns that end a conversation in each state
GO = {2: (1, 1, 0, 1), 3: (2, 2, 1, 0)}  # inserted turns that lead from each state to these


def fault_of(text: str, repeated: bool) -> str:
    """First fault of a row: b(lank), d(uplicate), t(runcated) or none."""
    bare = text.rstrip(SPACE)
    return "b" if not bare else "d" if repeated else "" if bare[-1] in ".!?" else "t"


class _Rows:
    """Rows as (initial, fault), with costs and bounds of what follows each row."""

    def __init__(self, rows: list[tuple[str, str]], goal: int | None):
        self.rows, self.goal, n = rows, goal, len(rows)
        self.kept = [None if f in ("b", "d") else (CUT if f == "t" else 0) for _, f in rows]
        after = [n] * (n + 1)  # next row that may stay
        for i in range(n - 1, -1, -1):
            after[i] = i if self.kept[i] is not None else after[i + 1]
        gone = [0] * (n + 1)  # deletions that rows from here on need
        for i in range(n - 1, -1, -1):
            gone[i] = gone[i + 1] + (DELETE if self.kept[i] is None else 0)
        self.rest = [0] * (n + 1)
        for i in range(n - 1, -1, -1):
            if self.kept[i] is None:
                self.rest[i] = DELETE + self.rest[i + 1]
                continue
            j = after[i + 1]
            lone = self._alone(i, last=j == n)
            self.rest[i] = lone + self.rest[i + 1]
            if j < n:
                self.rest[i] = max(self.rest[i], self._pair(i, j) + gone[i + 1] - gone[j] + self.rest[j + 1])
        self.bound = [[0] * 4 for _ in range(n + 1)]
        for s in range(4):
            self.bound[n][s] = INSERT * END[s] if goal is None else 0 if s == goal else math.inf
        for i in range(n):
            j = after[i]
            for s in range(4):
                least = self.rest[i]
                if j < n:
                    keep = self.kept[j] + (0 if self.rows[j][0] in STEP[s] else INSERT)
                    least = max(least, gone[i] - gone[j] + min(keep, REROLE + self.kept[j], DELETE) + self.rest[j + 1])
                self.bound[i][s] = least

    def _alone(self, i: int, last: bool) -> int:
        """Least cost of a row whatever its neighbours; of the last one with the turns that must follow it."""
        r, keep = self.rows[i][0], math.inf
        if r in ("s", "u", "a"):
            keep = self.kept[i] + (INSERT * END["?sua".index(r)] if last and self.goal is None else 0)
        return min(keep, REROLE + self.kept[i], DELETE)

    def _pair(self, i: int, j: int) -> int:
        """Least cost of two rows with nothing kept between them."""
        a, b = self.rows[i][0], self.rows[j][0]
        keep_a, keep_b = [self.kept[x] if self.rows[x][0] in ("s", "u", "a") else math.inf for x in (i, j)]
        move_a, move_b = min(REROLE + self.kept[i], DELETE), min(REROLE + self.kept[j], DELETE)
        return min(keep_a + keep_b + (0 if a + b in ("su", "ua", "au") else INSERT), keep_a + move_b, move_a + keep_b, move_a + move_b)

    def edits(self, i: int, s: int) -> list[tuple[str, int, int, int]]:
        """(initial, cost, row, state) of the edits at a node, by initial."""
        out = [("D", DELETE, i + 1, s), ("I", INSERT, i, STEP[s][NEXT[s]])]
        if self.kept[i] is not None:
            if self.rows[i][0] in STEP[s]:
                out.append(("K", self.kept[i], i + 1, STEP[s][self.rows[i][0]]))
            out.append(("R", REROLE + self.kept[i], i + 1, STEP[s][NEXT[s]]))
        return out

    def first(self, start: int) -> tuple[float, str]:
        """An incumbent: at every node the edit of least bound; towards a state, the last row makes room for inserts."""
        i, s, cost, audit, n = 0, start, 0, "", len(self.rows)
        while i < n - (self.goal is not None):
            ways = [(c + self.bound[k][t], k == i, e, c, k, t) for e, c, k, t in self.edits(i, s) if e != "I" or audit[-2:] != "II"]
            _, _, e, c, i, s = min(ways)
            cost, audit = cost + c, audit + e
        if self.goal is None:
            return cost + INSERT * END[s], audit + "I" * END[s]
        return cost + INSERT * GO[self.goal][s] + DELETE, audit + "I" * GO[self.goal][s] + "D"


def search(rows: list[tuple[str, str]], start: int = 0, goal: int | None = None) -> tuple[float, str]:
    """(cost, audit) of the cheapest edits from state ``start`` to ``goal`` (None: a whole conversation); the least
    audit among equals. Infinite cost if there are none. Edits to a state end with one of a row."""
    if goal in (0, 1):
        return _kept_out(rows, start, goal)
    told = _Rows(rows, goal)
    best, n = told.first(start), len(rows)
    seen: dict[tuple[int, int], float] = {}
    stack = [(0, start, 0, "")]
    while stack:
        i, s, cost, audit = stack.pop()
        least = cost + told.bound[i][s]
        if least > best[0] or least == best[0] and audit > best[1][:len(audit)] or cost >= seen.get((i, s), math.inf):
            continue
        seen[i, s] = cost
        if i == n:
            if goal is None:
                best = min(best, (cost + INSERT * END[s], audit + "I" * END[s]))
            else:  # inserts at a goal state are left to what follows; the bound keeps other states out
                best = min(best, (cost, audit))
            continue
        for e, c, k, t in reversed(told.edits(i, s)):
            stack.append((k, t, cost + c, audit + e))
    return best


def _kept_out(rows: list[tuple[str, str]], start: int, goal: int) -> tuple[float, str]:
    """All rows deleted, or all but one system turn."""
    n = len(rows)
    if start == goal:
        return DELETE * n, "D" * n
    if (start, goal) != (0, 1):
        return math.inf, ""
    ways = [(DELETE * (n - 1) + (CUT if f == "t" else 0), "D" * i + "K" + "D" * (n - 1 - i)) for i, (r, f) in enumerate(rows) if r == "s" and f in ("", "t")]
    return min(ways, default=(math.inf, ""))


def applied(rows: list[tuple[str, str]], audit: str, state: int = 0) -> tuple[list[tuple[str, str]], int]:
    """Turns that the edits leave of rows (role, text), and the state after them."""
    out, i = [], 0
    for e in audit:
        role, text = ("", "") if e == "I" else rows[i]
        i += e != "I"
        if e != "D":
            role = role if e == "K" else NAME[NEXT[state]]
            state = STEP[state][role[:1]]
            out.append((role, text))
    return out, state


def illegal_pairs(initials: list[str]) -> int:
    return sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))


REPAIRED = ("conv_id long, part long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
            "turns array<struct<role:string,text:string>>")


def repaired(rows: DataFrame, long: int = LONG, segment: int = SEGMENT) -> DataFrame:
    """Repaired conversations of ``rows`` (conv_id, turn, role, text, tie, copies), in parts: counts, cost, audit and the
    turns that are left. Rows are taken by turn (nulls first), then ``tie``; a row stands ``copies`` times in a row; one
    with none only names its conversation. A null conv_id is a conversation like any other. No rows give no rows.

    Up to ``long`` rows a conversation is one part, repaired in one piece. Longer ones are dealt by ranges of their
    order: each segment of ``segment`` rows is searched from every state to every state, the cheapest chain of
    segments is chosen from these tables, and each segment writes a part. Counts that need all rows (``gaps``) stand
    in the first part; the counts, costs and audits of a conversation's parts add up."""
    sizes = rows.groupBy("conv_id").agg(F.sum("copies").alias("size")).where(F.col("size") > long).select(F.col("conv_id").alias("_id"))
    large = written(sizes, "long-conversations")
    if large.isEmpty():
        return _short(rows)
    same = rows["conv_id"].eqNullSafe(large["_id"])
    return _short(rows.join(large, same, "left_anti")).unionByName(_long(rows.join(large, same, "left_semi").where("copies > 0"), segment))


def _short(rows: DataFrame) -> DataFrame:
    def run(found: Iterator[tuple], _: int) -> Iterator[tuple]:
        held, last = [], None
        for conv, turn, role, text, _tie, copies in found:
            if last is not None and conv != last[0]:
                yield _whole(last[0], held)
                held = []
            last = (conv,)
            held += [(turn, role, text)] * copies
        if last is not None:
            yield _whole(last[0], held)

    return by_key(rows.select("conv_id", "turn", "role", "text", "tie", "copies"), ["conv_id"], ["turn", "tie"], run, REPAIRED)


def _whole(conv, rows: list[tuple]) -> tuple:
    seen, faults = set(), []
    for _, role, text in rows:
        faults.append(fault_of(text, (role, text) in seen))
        seen.add((role, text))
    initials = [role[:1] for _, role, _ in rows]
    cost, audit = search(list(zip(initials, faults))) if rows else (0, "")
    turns, _ = applied([r[1:] for r in rows], audit)
    known = {t for t, _, _ in rows if t is not None}
    gaps = max(known) - min(known) + 1 - len(known) if known else 0
    return (conv, 0, gaps, faults.count("b"), faults.count("d"), faults.count("t"), illegal_pairs(initials), cost, audit,
            [{"role": r, "text": t} for r, t in turns])


def _long(rows: DataFrame, segment: int) -> DataFrame:
    """Long conversations. Equal rows of a turn are one row with their number until the order is dealt; the first row of
    each role and text is found by an aggregation that combines on the map side."""
    rows = rows.groupBy("conv_id", "turn", "role", "text", "tie").agg(F.sum("copies").alias("copies"))
    rows = written(rows.withColumn("same", F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)), "long-rows")
    place = F.struct(F.col("turn").isNotNull().alias("known"), "turn", "tie")
    first = rows.groupBy("conv_id", "same").agg(F.min(place).alias("place")).select(F.col("conv_id").alias("_id"), F.col("same").alias("_same"), "place")
    marked = rows.join(first, rows["conv_id"].eqNullSafe(first["_id"]) & (rows["same"] == first["_same"]))
    marked = marked.withColumn("new", place == F.col("place")).select("conv_id", "turn", "role", "text", "tie", "copies", "new")

    def cut(found: Iterator[tuple], task: int) -> Iterator[tuple]:
        held, last, n = [], None, 0
        for conv, _, role, text, _tie, copies, new in found:
            for copy in range(copies):
                if held and (conv != last or len(held) >= segment):
                    yield _segment(last, part_number(task, n) + 1, held)
                    held, n = [], n + 1
                held.append((role, text, fault_of(text, not new or copy > 0)))
                last = conv
        if held:
            yield _segment(last, part_number(task, n) + 1, held)

    ways = "array<struct<start:int,goal:int,cost:long,audit:string>>"
    pieces = written(in_ranges(marked, ["conv_id", "turn", "tie"], cut, "conv_id long, part long, rows array<struct<role:string,text:string,fault:string>>, "
                               f"first string, last string, illegal long, ways {ways}"), "long-segments")
    chosen = by_key(pieces.select("conv_id", "part", "first", "last", "ways"), ["conv_id"], ["part"], _chosen, "conv_id long, part long, start int, cost long, audit string, joint long, head boolean")
    spread = rows.groupBy("conv_id").agg(F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).alias("gaps"))
    chosen = chosen.withColumnsRenamed({"conv_id": "_id", "part": "_part"}).join(spread, F.col("_id").eqNullSafe(F.col("conv_id"))).drop("conv_id")
    both = pieces.join(chosen, (pieces["part"] == chosen["_part"]) & pieces["conv_id"].eqNullSafe(chosen["_id"]))
    both = both.withColumn("gaps", F.when(F.col("head"), F.col("gaps")).otherwise(0)).withColumn("illegal", F.col("illegal") + F.col("joint"))

    def write(found: Iterator[tuple], _: int) -> Iterator[tuple]:
        for conv, part, held, start, cost, audit, illegal, gaps in found:
            faults = [r["fault"] for r in held]
            turns, _state = applied([(r["role"], r["text"]) for r in held], audit, start)
            yield (conv, part, gaps, faults.count("b"), faults.count("d"), faults.count("t"), illegal, cost, audit, [{"role": r, "text": t} for r, t in turns])

    return by_key(both.select("conv_id", "part", "rows", "start", "cost", "audit", "illegal", "gaps"), ["conv_id", "part"], [], write, REPAIRED)


def _segment(conv, part: int, rows: list[tuple]) -> tuple:
    short = [(role[:1], fault) for role, _, fault in rows]
    ways = [(s, g, *search(short, s, g)) for s in range(4) for g in range(4)]
    return (conv, part, [{"role": r, "text": t, "fault": f} for r, t, f in rows], short[0][0], short[-1][0], illegal_pairs([r for r, _ in short]),
            [{"start": s, "goal": g, "cost": c, "audit": a} for s, g, c, a in ways if c < math.inf])


def _chosen(found: Iterator[tuple], _: int) -> Iterator[tuple]:
    """The cheapest chain of segments of each conversation. It holds sixteen audits a segment, so a small multiple of the
    audit itself, which is one value of the result."""
    held, last = [], None
    for conv, *row in found:
        if last is not None and conv != last[0]:
            yield from _chain(last[0], held)
            held = []
        last = (conv,)
        held.append(row)
    if last is not None:
        yield from _chain(last[0], held)


def _chain(conv, parts: list) -> Iterator[tuple]:
    parts = [(p, f, l, {(w["start"], w["goal"]): (w["cost"], w["audit"]) for w in ways}) for p, f, l, ways in parts]
    # from the end: cheapest cost and least audit from each state before a segment, with the state after it. All
    # audits of a segment end with an edit of its last row, so none is the start of another.
    plans, rest = [], [INSERT * k for k in END]
    for n, (_, _, _, ways) in enumerate(reversed(parts)):
        plan = []
        for s in range(4):
            options = [(c + rest[g], a + ("I" * END[g] if n == 0 else ""), g, c + (INSERT * END[g] if n == 0 else 0)) for (f, g), (c, a) in ways.items() if f == s]
            plan.append(min(options, default=(math.inf, "", s, 0)))
        plans.append(plan)
        rest = [p[0] for p in plan]
    s, before = 0, None
    for (part, first, end, _), plan in zip(parts, reversed(plans)):
        _, audit, after, cost = plan[s]
        yield conv, part, s, int(cost), audit, int(before is not None and before + first not in ("su", "ua", "au")), before is None
        s, before = after, end


def damaged(convs: DataFrame) -> DataFrame:
    """Rows of a conversations table after damage, as ``repaired`` takes them; dropped rows stay with no copies."""
    rows = turn_rows(convs, " ")
    key = F.concat(*[F.coalesce(F.col(c).cast("string"), F.lit(" ")) if c != ":" else F.lit(":") for c in ("conv_id", ":", "turn")])
    rows = rows.withColumn("harm", F.crc32(key.cast("binary")) % 20)
    text = F.when(F.col("harm").isin(0, 1), "").when(F.col("harm") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    rows = rows.withColumn("text", text).withColumn("role", F.when(F.col("harm") == 4, "user").otherwise(F.col("role")))
    copies = F.when(F.col("harm") == 0, 0).when(F.col("harm") == 3, 2).otherwise(1)
    return rows.withColumn("copies", copies).withColumn("tie", F.xxhash64("role", "text")).select("conv_id", "turn", "role", "text", "tie", "copies")


def told(parts: DataFrame) -> DataFrame:
    """One row per conversation of ``repaired``, with a digest of the turns that are left."""
    sums, empty = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"], hashlib.sha256(b"").hexdigest()
    body = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit(":"), t["text"])), "\n")
    whole = parts.where("part = 0").select("conv_id", *sums, "audit", F.sha2(body, 256).alias("repaired_sha256"))
    cut = parts.where("part > 0")
    audit = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("part", "audit"))), lambda p: p["audit"]), "")
    added = cut.groupBy("conv_id").agg(*[F.sum(c).alias(c) for c in sums], audit.alias("audit"))
    ends = digests(cut.where(F.size("turns") > 0).select("conv_id", "part", body.alias("body")), ["conv_id"], "\n").withColumnRenamed("conv_id", "_id")
    added = added.join(ends, added["conv_id"].eqNullSafe(ends["_id"]), "left")
    return whole.unionByName(added.select("conv_id", *sums, "audit", F.coalesce("sha256", F.lit(empty)).alias("repaired_sha256")))


SQL = """
WITH RECURSIVE b AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
           xor(list_reduce(list_prepend(4294967295::UBIGINT, flatten(list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''),
               lambda b: [ord(b)::UBIGINT, 256, 256, 256, 256, 256, 256, 256, 256]))),
               lambda a, x: CASE WHEN x < 256 THEN xor(a, x) WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384::UBIGINT) ELSE a >> 1 END), 4294967295::UBIGINT) % 20 AS harm
    FROM conversations),
d AS (SELECT conv_id, turn, CASE WHEN harm = 4 THEN 'user' ELSE role END AS role,
             CASE WHEN harm = 1 THEN '' WHEN harm = 2 THEN translate(text, '.!?', '') ELSE text END AS text,
             unnest(range(CASE harm WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM b),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, copy) AS i, rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare FROM d),
r AS (SELECT conv_id, turn, i, role, text, left(role, 1) AS r,
             CASE WHEN bare = '' THEN 'b' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'd'
                  WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 't' ELSE '' END AS f,
             lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) || left(role, 1) AS pair FROM o),
moves(s, m, ins) AS (VALUES (0, 0, ''), (0, 2, 'I'), (0, 3, 'II'), (1, 1, ''), (1, 2, 'I'), (1, 3, 'II'), (2, 2, ''), (2, 3, 'I'), (3, 3, ''), (3, 2, 'I')),
steps(m, r, e, t) AS (VALUES (0, '', 'D', 0), (1, '', 'D', 1), (2, '', 'D', 2), (3, '', 'D', 3), (0, '', 'R', 2), (1, '', 'R', 2), (2, '', 'R', 3), (3, '', 'R', 2),
                             (0, 's', 'K', 1), (0, 'u', 'K', 2), (1, 'u', 'K', 2), (3, 'u', 'K', 2), (2, 'a', 'K', 3)),
p(conv_id, i, s, w) AS (
    SELECT DISTINCT conv_id, 0::BIGINT, 0, '00000000' FROM r
    UNION ALL
    SELECT r.conv_id, r.i, steps.t, min(lpad((left(p.w, 8)::INT + 3 * length(ins) + CASE e WHEN 'D' THEN 4 WHEN 'R' THEN 3 ELSE 0 END
                                              + CASE WHEN r.f = 't' AND e <> 'D' THEN 3 ELSE 0 END)::VARCHAR, 8, '0') || substr(p.w, 9) || ins || e)
    FROM p JOIN r ON r.conv_id IS NOT DISTINCT FROM p.conv_id AND r.i = p.i + 1 JOIN moves USING (s)
         JOIN steps ON steps.m = moves.m AND (e <> 'K' OR steps.r = r.r) AND (e = 'D' OR r.f IN ('', 't'))
    GROUP BY r.conv_id, r.i, steps.t),
n AS (SELECT conv_id, max(i) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (f = 'b') AS blank,
             count(*) FILTER (f = 'd') AS duplicate, count(*) FILTER (f = 't') AS truncated, count(*) FILTER (i > 1 AND pair NOT IN ('su', 'ua', 'au')) AS illegal FROM r GROUP BY conv_id),
best AS (SELECT p.conv_id, min(CASE s WHEN 1 THEN lpad((left(w, 8)::INT + 6)::VARCHAR, 8, '0') || substr(w, 9) || 'II'
                                      WHEN 2 THEN lpad((left(w, 8)::INT + 3)::VARCHAR, 8, '0') || substr(w, 9) || 'I' ELSE w END) AS w
         FROM p JOIN n ON n.conv_id IS NOT DISTINCT FROM p.conv_id AND n.n = p.i GROUP BY p.conv_id),
edits AS (SELECT conv_id, w, unnest(range(9, length(w) + 1)) AS j FROM best),
kept AS (SELECT e.conv_id, j, substr(w, j, 1) AS e, length(replace(substr(w, 9, j - 8), 'I', '')) AS i, row_number() OVER (PARTITION BY e.conv_id ORDER BY j) AS k
         FROM edits e WHERE substr(w, j, 1) <> 'D'),
left_over AS (SELECT kept.*, r.role, r.text, max(CASE WHEN k = 1 AND e = 'K' AND r.r = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY kept.conv_id) AS system
              FROM kept LEFT JOIN r ON r.conv_id IS NOT DISTINCT FROM kept.conv_id AND r.i = kept.i AND kept.e <> 'I'),
said AS (SELECT conv_id, string_agg(CASE WHEN e = 'K' THEN role WHEN (k - system) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || coalesce(text, ''), chr(10) ORDER BY k) AS said
         FROM left_over GROUP BY conv_id)
SELECT c.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, CAST(coalesce(left(w, 8), '0') AS BIGINT) AS cost, coalesce(substr(w, 9), '') AS audit, sha256(coalesce(said, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN n ON n.conv_id IS NOT DISTINCT FROM c.conv_id
     LEFT JOIN best ON best.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN said ON said.conv_id IS NOT DISTINCT FROM c.conv_id
"""


@query("op11_conversation_repair", SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Damaged conversations, repaired: counts, cost, edits and a digest of what is left."""
    return told(written(repaired(damaged(table(spark, sf_dir, "conversations"))), "repaired"))
