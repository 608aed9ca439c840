"""Each operator against a brute-force version, a round trip, or held-out accuracy."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.plain import component, fingerprint_of, hits, words_of
from voxelframe.llm import decontaminate, langid, maxent, neighbours, packing, quality, secrets, sharding, simhash, warc
from voxelframe.llm.common import table, written

SF = "/root/testdata/sf0.001"
MID = "/root/testdata/sf0.01"


# near duplicates

def test_simhash_matches_brute_force(spark, texts):
    got = {r["doc_id"]: r for r in simhash.op1(spark, SF).collect()}
    prints = {i: fingerprint_of(t) for i, t in texts.items()}
    comp = component(prints)
    assert {i: r["fingerprint"] for i, r in got.items()} == {i: f"{p:016x}" for i, p in prints.items()}
    assert {i: r["component_id"] for i, r in got.items()} == comp


def test_close_pairs_lose_nothing_in_large_blocks(spark):
    """A dense cluster goes through all three levels of blocks; far fingerprints stay alone."""
    rng = random.Random(5)
    centre = rng.getrandbits(64)
    prints = {0, centre, (1 << 64) - 1} | {rng.getrandbits(64) for _ in range(200)}
    prints |= {centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 4))) for _ in range(700)}
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    nodes = written(spark.createDataFrame([(p,) for p in signed], "fp long"), "test")
    got = {(r["u"], r["v"]) for r in simhash.close_pairs(nodes, block=8).collect()}
    want = {(min(a, b), max(a, b)) for n, a in enumerate(signed) for b in signed[:n] if ((a ^ b) & (1 << 64) - 1).bit_count() <= 2}
    assert got == want and len(want) > 500


def test_chain_is_one_component(spark):
    """A long chain of two-bit steps is one component; its rounds settle."""
    prints = [sum(1 << b for b in range(0, n)) for n in range(0, 60, 2)]
    nodes = spark.createDataFrame([(p, 100 - n) for n, p in enumerate(prints)], "fp long, doc_id long")
    got = simhash.linked(written(nodes, "test")).collect()
    assert {r["component_id"] for r in got} == {min(100 - n for n in range(len(prints)))} and len(got) == len(prints)


# language

def test_language_held_out_accuracy(spark):
    got = langid.op2(spark, MID).join(table(spark, MID, "documents").select("doc_id", "lang"), "doc_id").where("held_out")
    n, right = got.count(), got.where("lang = lang_pred").count()
    assert n > 200 and right >= 0.98 * n


def test_language_scores_match_plain_counts(spark, docs, monkeypatch):
    """Matrix and scores from one dictionary of cell counts; long texts cut into slices."""
    whole = {i: np.concatenate(list(langid.cells(t))) for i, t in ((r["doc_id"], r["text"]) for r in docs.collect())}
    model = langid.learnt(docs)
    n, rows = defaultdict(Counter), Counter()
    for r in docs.collect():
        if zlib.crc32(str(r["doc_id"]).encode()) % 4 != 2 and r["lang"]:
            n[r["lang"]].update(whole[r["doc_id"]].tolist())
            rows[r["lang"]] += 1
    assert model.langs == sorted(n)
    some = docs.limit(20).collect()
    monkeypatch.setattr(langid, "SLICE", 100)
    for r, lang, score in zip(some, *model.score([r["text"] for r in some])):
        cells = Counter(whole[r["doc_id"]].tolist())
        assert Counter(np.concatenate(list(langid.cells(r["text"]))).tolist()) == cells
        logs = {k: math.log((rows[k] + 1) / (sum(rows.values()) + len(n))) + sum(
            c * math.log((n[k][cell] + 0.1) / (sum(n[k].values()) + 0.1 * 2 ** 15)) for cell, c in cells.items()) for k in n}
        best = max(logs, key=logs.get)
        assert best == lang and score == pytest.approx(1 / sum(math.exp(v - logs[best]) for v in logs.values()), abs=1e-3)
    assert model.score([None, "", "123 ..."])[0] == ["und"] * 3


# shards

def _shard(spark, rows, **kw):
    return sharding.shard(spark.createDataFrame(rows, "doc_id long, text string"), **kw).select("__row.*", "size", "shard", "slot").toPandas()


def test_shards_are_whole_even_and_gapless(spark):
    rng = random.Random(1)
    rows = [(i, "x" * rng.randint(0, 300)) for i in range(3000)] + [(i, "same text " * 5) for i in range(3000, 4500)] + [(7, None)] * 20
    got = _shard(spark, rows, shards=8, range_rows=50)
    assert Counter(zip(got.doc_id, got["size"])) == Counter((i, len(t or "") + 1) for i, t in rows)
    sums = got.groupby("shard")["size"].sum()
    assert len(sums) == 8 and sums.max() - sums.min() <= 0.03 * sums.mean() + 2 * got["size"].max()
    assert all(sorted(g.slot) == list(range(len(g))) for _, g in got.groupby("shard"))


def test_shards_keep_small_groups_and_split_large_ones(spark):
    rows = [(i, f"text {i // 3} " * 9) for i in range(6000)]
    got = _shard(spark, rows, shards=4)
    assert got.groupby("text").shard.nunique().max() == 1
    got = _shard(spark, [(i, "one text") for i in range(1000)], shards=4)
    assert sorted(got.groupby("shard").size()) == [250] * 4
    got = _shard(spark, [(1, "twice")] * 400, shards=4)
    assert sorted(got.groupby("shard").size()) == [100] * 4
    assert len(_shard(spark, [(1, "a"), (2, "b")], shards=16)) == 2


def test_bytes_below_are_exact(spark):
    rng = np.random.default_rng(2)
    keys = rng.integers(-3, 4, size=(500, 3))
    sizes = rng.integers(1, 100, size=500)
    rows = spark.createDataFrame([(*map(int, k), int(s)) for k, s in zip(keys, sizes)], "__h long, __d long, __u long, size long")
    probes = sorted({tuple(map(int, k)) for k in rng.integers(-4, 5, size=(40, 3))})
    want = [(sum(int(s) for k, s in zip(keys, sizes) if tuple(k) < p), sum(tuple(k) < p for k in keys)) for p in probes]
    assert sharding.below(rows, probes) == want


# derived records

def test_warc_files_give_the_records_back(spark, tmp_path):
    pages = table(spark, SF, "pages").limit(40)
    found = warc.responses(pages)
    derived = warc.derive(found)
    both = warc.response_records(found).unionByName(derived)
    for kind in ("none", "gzip"):
        warc.write(both, str(tmp_path / kind), kind)
        back = warc.read(spark, str(tmp_path / kind))
        assert back.where("NOT whole").count() == 0 and back.count() == both.count()
        columns = ["warc_type", "record_id", "refers_to", "target_uri", "date", "block_digest", "content_type", "content_length", "block"]
        assert back.select(columns).exceptAll(both.select(columns)).count() == 0
        assert warc.derive(warc.as_responses(back)).drop("source_id").exceptAll(derived.drop("source_id")).count() == 0
    ids = {r["record_id"] for r in found.collect()}
    assert {r["refers_to"] for r in derived.collect()} == ids
    for r in derived.collect():
        assert r["block_digest"] == "sha256:" + hashlib.sha256(r["block"].encode()).hexdigest() and r["content_length"] == len(r["block"].encode())


def test_plain_text_of_pages(spark):
    html = ['<p>x &#233;&#x1F600; &#55296; &lt;b&gt;&amp;lt;</p><!-- c --><script>a<b</script>y<br>z  <b>q</b><a href="u&amp;v">k</a><p unclosed',
            "<title>T &amp; t</title><ul><li>a</li>\n <li> b </li></ul><!-- open", "", "a < b", "<style>p{}</style>"]
    rows = spark.createDataFrame([(i, h) for i, h in enumerate(html)], "i int, h string")
    got = [r["t"] for r in rows.transform(lambda d: warc.with_text(d, "h", "t")).orderBy("i").collect()]
    assert got == ["x é😀 &#55296; <b>&lt;\ny\nz qk", "a\nb", "", "a < b", ""]


# language model

def test_lm_matches_brute_force(spark, docs, texts):
    """Counts and base exactly; the model token by token from its weights; probabilities that add up."""
    learnt = docs.where("doc_id % 3 > 0")
    words, vocab, weights = maxent.fit(learnt)
    got = {r["doc_id"]: r for r in maxent.score(docs, words, vocab, weights, ["doc_id"]).collect()}
    split = {i: [*re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t)), ""] for i, t in texts.items()}
    c = Counter(w for i, ws in split.items() if i % 3 for w in ws)
    n, v = sum(c.values()), len(c)
    assert (vocab.tokens, vocab.distinct) == (n, v)
    klass = {w: vocab.class_of(w.encode()) for ws in split.values() for w in ws}
    by, kinds = Counter(), Counter()
    for w, k in c.items():
        by[klass[w]] += k
        kinds[klass[w]] += 1
    better = 0
    for i in sorted(split)[:40]:
        ws = split[i]
        base = sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws)
        h = np.array([0, 0, 0] + [zlib.crc32(w.encode()) for w in ws], dtype=np.uint32)
        cells = maxent.features(h[2:-1], h[1:-2], h[:-3])
        model = 0.0
        for w, cell in zip(ws, cells.T):
            group, place = divmod(klass[w], maxent.GROUP)
            one, two = np.exp(sum(weights[0][f].astype(float) for f in cell)), np.exp(sum(weights[1][f * maxent.GROUP + group].astype(float) for f in cell))
            model += math.log10(one[group] / one.sum() * two[place] / two.sum()) + math.log10((c[w] + 0.1) / (by[klass[w]] + 0.1 * (kinds[klass[w]] + 1)))
        r = got[i]
        assert (r["n_tokens"], r["n_known"]) == (len(ws), sum(c[w] > 0 for w in ws))
        assert r["base_score"] == pytest.approx(base, rel=1e-9) and r["score"] == pytest.approx(model, rel=1e-5)
        better += r["score"] > r["base_score"]
    assert better >= 32
    rest = vocab.class_rest()
    for k in range(maxent.CLASSES):  # words of a class and its unknown token add up to one
        total = sum((n_ + 0.1) / 10 ** rest[k] for w, n_ in c.items() if klass[w] == k) + 0.1 / 10 ** rest[k]
        assert total == pytest.approx(1.0)


def test_lm_rare_words_meet_their_counts(spark, docs):
    """The same base score whether words are looked up locally or in the shuffle."""
    words, vocab, weights = maxent.fit(docs)
    one = {r["doc_id"]: r for r in maxent.score(docs, words, vocab, weights, ["doc_id"]).collect()}
    vocab.frequent = dict(list(vocab.frequent.items())[:40]) | {b"": vocab.frequent[b""]}
    two = {r["doc_id"]: r for r in maxent.score(docs, words, vocab, weights, ["doc_id"]).collect()}
    for i, r in one.items():
        assert two[i]["n_known"] == r["n_known"] and two[i]["base_score"] == pytest.approx(r["base_score"], rel=1e-9)


def test_lm_held_out(spark):
    got = maxent.op5(spark, MID).toPandas()
    held = got[got.held_out]
    assert held.score.sum() > held.base_score.sum() and (held.score > held.base_score).mean() > 0.9


# quality

def test_quality_against_labels(spark):
    got = quality.op6(spark, MID).join(table(spark, MID, "labels"), "doc_id").toPandas()
    good, bad = got[got.quality == 1], got[got.quality == 0]
    assert good.keep.mean() >= 0.98 and bad.keep.mean() <= 0.4
    order = np.argsort(got.score.to_numpy())
    rank = np.empty(len(got))
    rank[order] = np.arange(len(got))
    auc = (rank[(got.quality == 1).to_numpy()].mean() - (len(good) - 1) / 2) / len(bad)
    assert auc > 0.97


def test_em_finds_planted_accuracies():
    rng = np.random.default_rng(3)
    true, n = [0.9, 0.8, 0.7, 0.6, 0.95, 0.85, 0.75, 0.65, 0.9], 60_000
    y = rng.random(n) < 0.7
    counts = Counter()
    votes = np.stack([np.where(rng.random(n) < 0.3, 0, np.where((rng.random(n) < a) == y, quality.GOOD, quality.BAD)) for a in true], axis=1)
    for v in votes:
        counts[int(sum(x * 3 ** i for i, x in enumerate(v)))] += 1
    share, said, post = quality.expectation(counts)
    assert share == pytest.approx(0.7, abs=0.02)
    assert np.allclose(said[:, 1, quality.GOOD], true, atol=0.02) and np.allclose(said[:, 0, quality.BAD], true, atol=0.02)
    assert post[sum(quality.GOOD * 3 ** i for i in range(9))] > 0.99 and post[sum(quality.BAD * 3 ** i for i in range(9))] < 0.01


def test_many_languages_share_cells(spark, monkeypatch):
    """A dirty language column makes the matrix coarser, not the job fail; each language is still found by its letters."""
    monkeypatch.setattr(langid, "MATRIX_MB", 1)
    rows = [(f"l{i:03}", (chr(0x4E00 + 7 * i) + chr(0x3041 + i % 80)) * 30) for i in range(300)]
    docs = spark.createDataFrame(rows, "lang string, text string")
    model = langid.train(docs)
    assert model.logp.shape == (512, 300) and len(model.langs) == 300
    whole = langid.counts(docs).where("cell >= 0").groupBy("lang").agg(F.sum("n").alias("n")).collect()
    folded = np.zeros((300, 512))
    for r in langid.counts(docs).where("cell >= 0").collect():
        folded[model.langs.index(r["lang"]), r["cell"] >> (langid.BITS - 9)] += r["n"]
    assert folded.sum() == sum(r["n"] for r in whole)
    want = np.log((folded + langid.SMOOTH) / (folded.sum(axis=1, keepdims=True) + langid.SMOOTH * 512))
    assert np.allclose(model.logp, want.T, atol=1e-5)
    told = docs.select("lang", langid.predict(docs, model).alias("p")).collect()
    assert sum(r["lang"] == r["p"]["lang"] for r in told) > 150


# secrets

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def _base(text):
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    return sorted(found + [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24])


def _random(run, model):
    p, total = 0, 0.0
    for ch in run:
        c = secrets.ALPHABET.index(ch) + 1
        total, p = total + model[p * 67 + c], c
    return total >= secrets.TOTAL and total >= secrets.MEAN * len(run)


def _stretches(run, model):
    ratios, p = [], 0
    for ch in run:
        c = secrets.ALPHABET.index(ch) + 1
        ratios.append(model[p * (len(secrets.ALPHABET) + 1) + c])
        p = c
    out, start = [], 0
    while start < len(run):
        s, best, end, stop = 0.0, 0.0, start, len(run)
        for i in range(start, len(run)):
            s += ratios[i] - secrets.FLOOR
            if s <= 0 or s < best - secrets.DROP:
                stop = i + 1
                break
            if s > best:
                best, end = s, i + 1
        total = sum(ratios[start:end])
        if end - start >= secrets.LEAST and total >= secrets.TOTAL and total >= secrets.MEAN * (end - start):
            out.append((start, end))
        start = stop
    return out or ([(0, len(run))] if _random(run, model) else [])


def test_keys_in_paths_and_after_names(spark, docs):
    """A key is reported without the path or name that it hangs on, and the rest of the text stays."""
    key, other = "q7Zx0Kd93VbTj2LmWp8RyE5uHc1NgS4f", "Xk29sLq0Vd7RmTz4Jw8BnY1pGf6Hc3Ue"
    texts = {f"open /home/some/long/ordinary/path/of/the/project/{key} now": [key], f"name_of_the_old_internal_service_and_its_account_{key}": [key],
             f"{key}/documents/and/settings/of/an/ordinary/person/in/the/office/{other}": [key, other], "some/long/ordinary/path/of/the/project": []}
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    model = secrets.train(docs)
    clean = {r["doc_id"]: r["text"] for r in secrets.redact(rows, model).collect()}
    for r in secrets.spans(rows, model, ["doc_id", "text"]).collect():
        found, want = [r["text"][s["start"]:s["end"]] for s in r["spans"]], texts[r["text"]]
        assert len(found) == len(want)
        for f, w in zip(found, want):  # where path and key meet, rare letters of one path word may go along
            at, end = r["text"].index(f) - r["text"].index(w), r["text"].index(f) + len(f) - r["text"].index(w) - len(w)
            assert -8 <= at <= 2 and -2 <= end <= 8
        left = r["text"]
        for f in found:
            left = left.replace(f, "[SECRET]")
        assert clean[r["doc_id"]] == left


def test_secrets_match_brute_force(spark, docs):
    rng = random.Random(4)
    key = "".join(rng.choice(secrets.ALPHABET) for _ in range(40))
    odd = [f"use {key} here", f"x {key}", "secret=token:abcdefgh", "TOKEN = 'abc'; Api_Key:\"zzzzzz\"", "AKIA" + "A" * 15 + " AKIA" + "B" * 16, "é😀 " + "0a" * 12 + " é " + "f" * 23,
           "password=" + "0123456789abcdef" * 2, "internationalization-and-localisation", "", None, "deadbeef" * 4 + key, "apikey=short token=longenough"]
    rows = docs.select("doc_id", "text").unionByName(spark.createDataFrame([(10_000 + i, t) for i, t in enumerate(odd)], "doc_id long, text string"))
    model = secrets.train(docs)
    got = {r["doc_id"]: r for r in secrets.spans(rows, model, ["doc_id"]).collect()}
    for r in rows.collect():
        text, base = r["text"] or "", _base(r["text"] or "")
        more = []
        for m in re.finditer(r"[A-Za-z0-9+/_-]{16,}", text):
            left = max([b for a, _, b in base if a <= m.start()], default=0)
            right = min([a for a, _, b in base if a > m.start()], default=len(text))
            more += [(m.start() + a, 3, m.start() + b) for a, b in _stretches(m[0], model) if left <= m.start() + a and m.start() + b <= right]
        assert [tuple(s) for s in got[r["doc_id"]]["base"]] == base
        assert [tuple(s) for s in got[r["doc_id"]]["spans"]] == sorted(base + more)
    assert [s["rank"] for s in got[10_000]["spans"]] == [3] and not got[10_007]["spans"]


def test_redacted_texts_hold_no_secret(spark, docs):
    model = secrets.train(docs)
    before = {r["doc_id"]: r for r in secrets.spans(docs, model, ["doc_id", "text"]).collect()}
    clean = secrets.redact(docs, model)
    assert clean.columns == docs.columns
    assert sum(len(r["spans"]) for r in secrets.spans(clean, model, ["doc_id"]).collect()) == 0
    changed = {r["doc_id"] for r in clean.collect() if r["text"] != before[r["doc_id"]]["text"]}
    assert changed == {i for i, r in before.items() if r["spans"]}


# neighbours

def test_neighbours_recall_and_scores(spark):
    got = neighbours.op8(spark, SF).toPandas()
    rows = table(spark, SF, "embeddings").toPandas()
    ids, x = rows.vec_id.to_numpy(), np.stack(rows.embedding.to_numpy()).astype(float)
    seen = total = 0
    for q in ids[ids % 20 == 0]:
        s = x @ x[ids == q][0]
        best = [i for i in ids[np.lexsort((ids, -s))] if i != q][:20]
        mine = got[got.query_id == q].sort_values("rank")
        assert list(mine["rank"]) == list(range(1, 21))
        assert np.allclose(mine.score, [s[ids == i][0] for i in mine.vec_id], rtol=1e-12)
        seen, total = seen + len(set(best) & set(mine.vec_id)), total + len(best)
    assert seen >= 0.9 * total


def test_neighbours_over_many_blocks(spark, monkeypatch):
    """Clusters of different norms and one very common vector, in many small blocks; ties by id."""
    monkeypatch.setattr(neighbours, "BLOCK", 100)
    monkeypatch.setattr(neighbours, "LEAF", 16)
    rng = np.random.default_rng(6)
    x = np.concatenate([rng.normal(size=(30, 12)).repeat(40, axis=0) * 3 + rng.normal(size=(1200, 12)), np.ones((300, 12))]) * rng.choice([0.5, 1.0], size=(1500, 1))
    x[1200:] = 1.0
    rows = spark.createDataFrame([(int(i), [float(v) for v in r]) for i, r in enumerate(x)], "vec_id long, embedding array<double>")
    got = neighbours.neighbours(rows, F.col("vec_id") % 50 == 0).toPandas()
    seen = total = 0
    for q in range(0, 1500, 50):
        s = np.einsum("d,nd->n", x[q], x)
        best = [i for i in np.lexsort((np.arange(1500), -s)) if i != q][:20]
        mine = got[got.query_id == q].sort_values("rank")
        assert len(mine) == 20
        seen, total = seen + len(set(best) & set(mine.vec_id)), total + 20
        order = list(zip(-mine.score, mine.vec_id))
        assert order == sorted(order)
    assert seen >= 0.9 * total


def test_chi_square_quantile():
    assert neighbours.chi_square(2, 0.95) == pytest.approx(5.991, abs=1e-3) and neighbours.chi_square(8, 0.95) == pytest.approx(15.507, abs=1e-3)


# packing

def _greedy(sizes, lengths, price):
    bins = []
    for s in sorted(sizes, reverse=True):
        fit = [b for b in bins if b[0] - b[1] >= s]
        if fit:
            min(fit, key=lambda b: b[0] - b[1])[1] += s
        else:
            bins.append([min((n for n in lengths if n >= s), key=lambda n: (price(n) / n, n)), s])
    return bins


def test_plan_is_best_fit_decreasing():
    for seed in range(200):
        rng = random.Random(seed)
        prices = {16: 20 + 9 * rng.random(), 32: 30 + 20 * rng.random(), 64: 50 + 60 * rng.random()}
        sizes = [min(64, 1 + int(rng.expovariate(1 / rng.choice([5, 12, 30])))) for _ in range(rng.randint(0, 200))]
        steps = packing.plan(Counter(sizes), packing.by_piece((16, 32, 64), prices.get))
        content = defaultdict(list)
        for s in steps:
            for j in range(s.count * s.each):
                content[s.first + j // s.each].append((s.offset + j % s.each * s.size, s.size, s.length))
        assert sorted(z for c in content.values() for _, z, _ in c) == sorted(sizes)
        greedy = _greedy(sizes, (16, 32, 64), prices.get)
        assert Counter(c[0][2] for c in content.values()) == Counter(b[0] for b in greedy)
        ends = packing.filled(steps, (16, 32, 64))
        for at, used, length in ends:
            c = sorted(content[at])
            assert [a for a, _, _ in c] == list(np.cumsum([0] + [z for _, z, _ in c[:-1]])) and used == sum(z for _, z, _ in c)
            assert length == min(n for n in (16, 32, 64) if n >= used)


def _least_price(sizes, lengths, price):
    """Exhaustive: the pieces in all ways into sequences."""
    best = [float("inf")]

    def place(i, bins):
        if i == len(sizes):
            best[0] = min(best[0], sum(price(min(n for n in lengths if n >= b)) for b in bins))
            return
        for j in range(len(bins)):
            if bins[j] + sizes[i] <= max(lengths):
                place(i + 1, bins[:j] + [bins[j] + sizes[i]] + bins[j + 1:])
        place(i + 1, [*bins, sizes[i]])

    place(0, [])
    return best[0]


def test_lengths_are_chosen_jointly():
    lengths, joint, exact = (16, 32, 64), 0, 0
    for seed in range(150):
        rng = random.Random(1000 + seed)
        prices = {16: 20 + 9 * rng.random(), 32: 30 + 20 * rng.random(), 64: 50 + 60 * rng.random()}
        sizes = [min(64, 1 + int(rng.expovariate(1 / rng.choice([5, 12, 30])))) for _ in range(rng.randint(1, 7))]
        histogram = Counter(sizes)
        price = lambda steps: packing.total(steps, lengths, prices.get)
        got = price(packing.cheapest(histogram, lengths, prices.get))
        alone = price(packing.plan(histogram, packing.by_piece(lengths, prices.get)))
        used = [b[1] for b in _greedy(sizes, lengths, prices.get)]
        assert alone == pytest.approx(sum(prices[min(n for n in lengths if n >= u)] for u in used))
        least = _least_price(sizes, lengths, prices.get)
        assert least - 1e-9 <= got <= alone + 1e-9 and got < 1.35 * least
        joint, exact = joint + (got < alone - 1e-9), exact + (got < least + 1e-9)
    assert joint >= 5 and exact >= 140
    assert packing.cheapest({}) == []


def test_a_joint_choice_spares_a_long_sequence():
    """A long sequence is cheapest per token, but nothing is left to fill it with."""
    prices = {10: 10.5, 100: 90.0}
    steps = packing.plan({6: 3}, packing.jointly({6: 3}, (10, 100), prices.get))
    assert [(s.length, s.count, s.each) for s in steps] == [(10, 3, 1)]
    assert [(s.length, s.count) for s in packing.plan({6: 3}, packing.by_piece((10, 100), prices.get))] == [(100, 1)]
    many = packing.plan({6: 10 ** 9}, packing.jointly({6: 10 ** 9}, (10, 100), prices.get))
    assert {s.length for s in many} == {100} and len(many) <= 3 and sum(s.count * s.each for s in many) == 10 ** 9


def test_sequences_hold_every_token_once(spark, docs, texts):
    lengths = (64, 256, 1024)
    rows = packing.sequences(docs, lengths=lengths).collect()
    back = defaultdict(list)
    for r in rows:
        assert r["length"] == min(n for n in lengths if n >= r["used"]) and r["used"] == sum(p["size"] for p in r["pieces"])
        assert [p["offset"] for p in r["pieces"]] == list(np.cumsum([0] + [p["size"] for p in r["pieces"][:-1]]))
        for p, t in zip(r["pieces"], r["texts"]):
            back[p["id"]].append((p["start"], t))
    assert {i: "".join(t for _, t in sorted(v)) for i, v in back.items()} == texts
    items = written(packing.pieces(docs, ["doc_id"], longest=1024), "test")
    sizes = [r["size"] for r in items.collect()]
    greedy = _greedy(sizes, lengths, packing.cost)
    used = [min(n for n in lengths if n >= b[1]) for b in greedy]
    assert sum(packing.cost(r["length"]) for r in rows) <= sum(map(packing.cost, used)) and sum(sizes) == sum(r["used"] for r in rows)


# contamination

def test_decontamination_matches_brute_force(spark, docs, texts):
    bench = table(spark, SF, "benchmark").select("item_id", "text").unionByName(spark.createDataFrame(
        [(900, "the the"), (901, "THE of"), (902, None), (903, " .. "), (904, "no such words xyzzy"), (905, "the of")], "item_id long, text string"))
    items = [(r["item_id"], r["text"]) for r in bench.collect()]
    got = {r["id"]: r for r in decontaminate.contamination(docs, bench).collect()}
    for i, t in texts.items():
        words, places, found = hits(t, [x for _, x in items])
        assert (got[i]["n_words"], got[i]["n_hit"]) == (len(words), len(places))
        assert got[i]["items"] == sorted(str(items[n][0]) for n in found)


def _near(text, item, slack=4, size=13):
    """Whether four in five of some window's words stand within an offset range of the text."""
    words, spoken = words_of(text), words_of(item)
    size = min(size, len(spoken))
    need = -(-4 * size // 5)
    places = defaultdict(list)
    for pos, w in enumerate(words):
        places[w].append(pos)
    deltas = [{p - i for p in places[w]} for i, w in enumerate(spoken)]
    return need > 1 and any(sum(any(low <= d <= low + slack for d in deltas[i]) for i in range(s, s + size)) >= need
                            for s in range(len(spoken) - size + 1) for low in {d - k for ds in deltas for d in ds for k in range(slack + 1)})


def test_proximity(spark):
    """Against all windows and offsets: words lost, moved, replaced by unknown ones, repeated; short items."""
    rng = random.Random(9)
    item = [f"w{i}" for i in range(20)]
    items = [" ".join(item), "w1 w2 w3 w4 w5", "alone", "a a a b a a c", " ".join(f"z{i}" for i in range(40)) + " w0 w1"]
    texts = {1: items[0], 2: items[0].replace("w5", "w5 a b c"), 3: " ".join(reversed(item)), 4: "w0 " + "x " * 40 + "w1", 5: items[0].replace("w3", "n1").replace("w9", "n2"),
             6: "alone", 7: "a b a a c a", 8: None, 9: ""}
    for n in range(120):
        w = [x if rng.random() > 0.15 else rng.choice(["new", "w7", x + " more", ""]) for x in rng.choice([item, item[4:], [f"z{i}" for i in range(12, 40)], ["w1", "w2", "w3", "w4", "w5"]])]
        texts[100 + n] = " ".join(rng.choice([["pad"], ["w2", "a"], []]) + w + ["tail"])
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    rows = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r["id"]: r for r in decontaminate.contamination(rows, bench, near=True).collect()}
    assert set(got) == set(texts) and "1" not in got[3]["near_items"]
    assert {"0"} <= set(got[5]["near_items"]) and got[5]["items"] == [] and got[6]["near_items"] == []
    want = {i: [str(n) for n, x in enumerate(items) if _near(t, x)] for i, t in texts.items()}
    assert {i: r["near_items"] for i, r in got.items()} == want and sum(map(bool, want.values())) > 60
    assert all(set(r["items"]) - {"2"} <= set(r["near_items"]) for r in got.values())


def test_words():
    assert words_of("A-b_ß 東京9.") == ["a", "b", "ß", "東京9"]
