"""Operators on conversations against plain Python: repair, formatting, prefix trie."""

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import xxhash
from pyspark.sql import functions as F

from tests.llm.conftest import TALKS
from voxelframe.llm import chat, repair, streams, trie
from voxelframe.llm.common import table, written

SF = "/root/testdata/sf0.001"


def _sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def _talks(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


def _order(turn, role, text):
    """Turn (null first), then Spark's hash of role and text."""
    h = xxhash.xxh64_intdigest(text.encode(), xxhash.xxh64_intdigest(role.encode(), 42))
    return (turn is not None, turn or 0, h - (1 << 64) if h >> 63 else h)


def _random_talks(seed, convs=60):
    rng, rows = random.Random(seed), []
    for c in range(convs):
        for t in range(rng.randint(1, 30)):
            text = rng.choice(["", " ", "a.", "b", "c?", "same.", f"own {rng.randint(0, 9)}!", None])
            rows.append((c if c else None, rng.choice([t, t, t, None, t - 1]), rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None]), text))
    return rows


# repair

def _cheapest(rows, start=0, goal=None):
    """(cost, audit) by all states over all rows, (role initial, fault) each."""
    ways = {start: (0, "")}
    for r, f in rows:
        wide = dict(ways)
        for _ in range(3):
            for s, (c, a) in list(wide.items()):
                t = {0: 2, 1: 2, 2: 3, 3: 2}[s]
                wide[t] = min(wide.get(t, (math.inf, "")), (c + 3, a + "I"))
        ways = {}
        for s, (c, a) in wide.items():
            edits = [(s, 4, "D")]
            if f not in ("b", "d"):
                edits += [({0: 2, 1: 2, 2: 3, 3: 2}[s], 6 if f else 3, "R")]
                if (s, r) in {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}:
                    edits += [({"s": 1, "u": 2, "a": 3}[r], 3 if f else 0, "K")]
            for t, x, e in edits:
                ways[t] = min(ways.get(t, (math.inf, "")), (c + x, a + e))
    if goal is not None:
        return ways.get(goal, (math.inf, ""))
    return min((c + 3 * n, a + "I" * n) for s, (c, a) in ways.items() for n in [{0: 0, 1: 2, 2: 1, 3: 0}[s]])


def test_search_is_the_cheapest_and_least():
    rng = random.Random(1)
    for _ in range(1500):
        rows = [(rng.choice("ssuuuaaat"), rng.choice(["", "", "", "t", "b", "d"])) for _ in range(rng.randint(1, 12))]
        for start in range(4):
            for goal in (None, 0, 1, 2, 3):
                assert repair.search(rows, start, goal) == _cheapest(rows, start, goal)
    rows = [(rng.choice("suuuuuaaaaa"), rng.choice(["", "", "", "t", "b", "d"])) for _ in range(600)]
    assert repair.search(rows) == _cheapest(rows)


def _repaired(talks):
    by = defaultdict(list)
    for c, t, role, text in talks:
        by[c].append((t, role if role is not None else " ", text if text is not None else " "))
    out = {}
    for c, found in by.items():
        rows = []
        for t, role, text in found:
            harm = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
            if harm == 0:
                continue
            text = "" if harm == 1 else "".join(x for x in text if x not in ".!?") if harm == 2 else text
            rows += [(t, "user" if harm == 4 else role, text)] * (2 if harm == 3 else 1)
        rows.sort(key=lambda r: _order(*r))
        faults = []
        for n, (_, role, text) in enumerate(rows):
            bare = text.strip(" \t\n\v\f\r")
            faults.append("b" if not bare else "d" if (role, text) in [r[1:] for r in rows[:n]] else "" if bare[-1] in ".!?" else "t")
        cost, audit = _cheapest([(r[1][:1], f) for r, f in zip(rows, faults)])
        said, left = [], iter(rows)
        for e in audit:
            _, role, text = (None, "", "") if e == "I" else next(left)
            if e in "RI":
                role = "assistant" if said and said[-1][0] == "u" else "user"
            if e != "D":
                said.append(f"{role}:{text}")
        turns = {r[0] for r in rows} - {None}
        out[c] = (max(turns) - min(turns) + 1 - len(turns) if turns else 0, faults.count("b"), faults.count("d"), faults.count("t"),
                  sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:])), cost, audit, _sha("\n".join(said)))
    return out


def test_repair_of_odd_rows_in_pieces(spark):
    """Conversations in one piece, and the same ones cut into segments as long ones are."""
    for talks in (TALKS, _random_talks(3)):
        want = _repaired(talks)
        rows = repair.damaged(_talks(spark, talks))
        for long, segment in ((4096, 512), (6, 3)):
            got = repair.told(written(repair.repaired(rows, long, segment), "test")).collect()
            assert {r["conv_id"]: tuple(r)[1:] for r in got} == want and len(got) == len(want)


# formatting

def test_texts_of_control_strings_round_trip():
    rng = random.Random(4)
    pieces = ["\\", "\\\\", "###", "#", "</turn>", "</turn>\n", "<", "### User: ", "### =x: ", "\n", ":", "word", "\\### Assistant: </turn> ok", "é😀"]
    levels = Counter()
    for _ in range(4000):
        turns = [(rng.choice(["user", "assistant", "system", "", "a:b", "x\\", "User", "=", "</turn>"]), "".join(rng.choices(pieces, k=rng.randint(0, 6)))) for _ in range(rng.randint(1, 4))]
        text, spans = chat.write(turns)
        assert [t[:2] for t in chat.read(text)] == turns
        assert [chat.unescaped(text[a:b]) for a, b in spans] == [t for r, t in turns if r == "assistant"]
        levels.update(chat.write_turn(*t)[1] for t in turns)
    assert set(levels) == {0, 1, 2}
    assert chat.read("### User: no end") is None and chat.read("plain") is None and chat.read("") == []


def test_formatted_parts_read_back(spark):
    for talks in (TALKS, _random_talks(5)):
        by = defaultdict(list)
        for c, t, role, text in talks:
            by[c].append((t, role or "", text or ""))
        for part in (1 << 16, 10):
            parts = written(chat.formatted(_talks(spark, talks), part), "test")
            got = {r["conv_id"]: r for r in chat.read_back(parts).collect()}
            assert set(got) == set(by)
            for c, rows in by.items():
                turns = [r[1:] for r in sorted(rows, key=lambda r: _order(*r))]
                said = "".join(t for r, t in turns if r == "assistant")
                assert (got[c]["n_turns"], got[c]["turns_sha256"]) == (len(turns), _sha("".join(f"{r}\n{t}\n" for r, t in turns)))
                assert (got[c]["loss_chars"], got[c]["loss_sha256"], got[c]["formatted_chars"]) == (len(said), _sha(said), len(chat.write(turns)[0]))


# trie

def _nodes(talks, family=100, heads=6):
    own, members = defaultdict(list), defaultdict(list)
    for c, t, role, text in talks:
        if c is not None:
            own[c].append((t, role or "", text or ""))
    turns = {c: [r[1:] for r in sorted(rows, key=lambda r: _order(*r))] for c, rows in own.items()}
    whole = {}
    for c in turns:
        h = zlib.crc32(str(c).encode()) % heads
        whole[c] = tuple(turns.get(c - int(math.fmod(c, family)), [])[:h] + turns[c][h:])
    for c, path in whole.items():
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
    out = []
    for path, ids in members.items():
        below = [p for p in members if p[:len(path)] == path]
        leaves = [p for p in below if not any(q != p and q[:len(p)] == p for q in below)]
        saved = sum((len(members[p]) - 1) * len(p[-1][1]) for p in below if p)
        ends = _sha(",".join(str(c) for c in sorted(ids) if whole[c] == path))
        out.append((min(ids), len(path), min(members[path[:-1]]) if path else None, len(ids), sum(len(p) == len(path) + 1 for p in below), len(leaves), saved, ends))
    return Counter(out)


def test_trie_matches_brute_force_at_any_size_of_subtrees(spark):
    rng = random.Random(6)
    shared = [(c, t, "ua"[t % 2], f"{t}" if t < 4 else f"{t}-{rng.randint(0, 1)}") for c in range(100, 140) for t in range(rng.randint(1, 8))]
    copies = [(c, t, "u", f"copy {t}") for c in range(300, 330) for t in range(5)]
    for talks in (TALKS, shared + copies):
        want = _nodes(talks)
        found = trie.grafted(trie.turn_marks(_talks(spark, talks)))
        for limit in (1 << 15, 12):
            assert Counter(tuple(r) for r in trie.trie(found, limit).collect()) == want


def test_paths_of_whole_conversations(spark):
    """Without grafting, the trie of the table itself."""
    talks = [tuple(r) for r in table(spark, SF, "conversations").select("conv_id", "turn", "role", "text").collect()]
    got = trie.trie(trie.paths(trie.turn_marks(_talks(spark, talks)))).collect()
    by = defaultdict(list)
    for c, t, role, text in talks:
        by[c].append((t, role, text))
    prefixes = {tuple(r[1:] for r in sorted(rows))[:d] for rows in by.values() for d in range(len(rows) + 1)}
    assert len(got) == len(prefixes) and {r["depth"] for r in got if r["parent_conv_id"] is None} == {0}


def test_digests_join_parts_in_order(spark):
    parts = spark.createDataFrame([(k, n, f"{k}{n}") for k in ("a", None) for n in range(50)], "k string, part long, body string").orderBy(F.rand(1))
    got = {r["k"]: r["sha256"] for r in streams.digests(parts, ["k"], "|").collect()}
    assert got == {k: _sha("|".join(f"{k}{n}" for n in range(50))) for k in ("a", None)}
