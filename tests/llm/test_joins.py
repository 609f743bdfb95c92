"""Jaccard join, suffix-array dedup, decontamination and vector dedup against brute force."""
import hashlib
import random
import re
import time
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest

from meterflow.llm import decontaminate, ngram_join, pq_dedup, suffix_dedup


def shingles(text, k):
    w = (text or "").encode().lower().split()
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def components(ids, linked):
    up = {i: i for i in ids}

    def top(i):
        while up[i] != i:
            i = up[i]
        return i
    for a in ids:
        for b in ids:
            if a < b and linked(a, b):
                x, y = sorted((top(a), top(b)))
                up[y] = x
    return {i: top(i) for i in ids}


@pytest.mark.parametrize("width,percent", [(3, 90), (5, 80), (2, 50)])
def test_jaccard_components_match_brute_force(spark, prose, width, percent):
    r = random.Random(width)
    texts = {}
    for g in range(8):  # groups of near copies, with chains
        w = prose(r.randint(5, 120), 100 + g).split()
        for i in range(9):
            w = list(w)
            for _ in range(r.randint(0, 2)):
                w[r.randrange(len(w))] = f"new{r.randrange(10**6)}"
            texts[g * 10 + i] = " ".join(w)
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {x.doc_id: (x.n_shingles, x.component_id) for x in ngram_join.jaccard_components(df, width, percent).collect()}
    s = {i: shingles(t, width) for i, t in texts.items()}
    want = components(sorted(s), lambda a, b: s[a] and s[b] and 100 * len(s[a] & s[b]) >= percent * len(s[a] | s[b]))
    assert got == {i: (len(s[i]), want[i]) for i in s}


def test_jaccard_links_match_brute_force(spark, prose):
    r = random.Random(9)
    texts, at = {}, 0
    for g in range(4):
        base = prose(80, 300 + g).split()
        for i in range(12):  # near copies of one text: nearly all pairs of a group link
            w = list(base)
            if i > 1:  # the first two are equal
                w[r.randrange(80)] = f"new{i}"
            texts[at] = " ".join(w)
            at += 1
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    s = {i: shingles(t, 3) for i, t in texts.items()}
    linked = lambda a, b: 100 * len(s[a] & s[b]) >= 85 * len(s[a] | s[b])
    want = components(sorted(s), linked)
    got = {x.doc_id: (x.n_links, x.component_id) for x in ngram_join.jaccard_components(df, 3, 85, count_links=True).collect()}
    assert got == {a: (sum(linked(a, b) for b in s if a != b), want[a]) for a in s} and sum(n for n, _ in got.values()) > 300


def test_jaccard_pairs_are_verified_once(spark, prose, monkeypatch):
    r = random.Random(4)
    rows = []
    for g in range(6):
        w = prose(60, 700 + g).split()
        for i in range(10):
            w = list(w)
            w[r.randrange(60)] = f"new{r.randrange(10**6)}"
            rows.append((g * 10 + i, " ".join(w)))
    compared, real = [], ngram_join.settle

    def settle(df, name):
        out = real(df, name)
        if name == "pairs":
            compared.append({(x.a, x.b) for x in out.collect()})
        return out
    monkeypatch.setattr(ngram_join, "settle", settle)
    got = ngram_join.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"), 3, 80).count()
    assert got == 60 and len(compared) == 2 and compared[0] and not compared[0] & compared[1]
    assert all(a < b for a, b in compared[0] | compared[1])


def test_jaccard_odd_rows(odd_docs, no_docs):
    rows = ngram_join.jaccard_components(odd_docs, 3, 90).collect()
    assert len(rows) == odd_docs.count()
    by = {}
    for x in rows:
        by.setdefault(x.doc_id, []).append((x.n_shingles, x.component_id))
    assert by[2] == by[2][:1] * 2 and by[1][0][1] == by[2][0][1] == by[3][0][1] == by[9][0][1] == 1
    assert by[4] == [(0, 4)] and by[5] == [(0, 5)] and by[6] == [(0, 6)] and by[7] == [(1, 7)] and by[8] == [(1, 8)]
    assert all(c is None for _, c in by[None])
    assert ngram_join.jaccard_components(no_docs, 3, 90).count() == 0
    kept = ngram_join.stage_jaccard(None, odd_docs, "")
    assert kept.columns == odd_docs.columns
    assert {x.doc_id for x in kept.collect()} == {1, 4, 5, 6, 7, 8, 10, 11, 12, 13, None}


def brute_repeats(texts, length):
    seen, cover = {}, {i: set() for i in texts}
    for i in sorted(texts):
        t = (texts[i] or "").encode()
        for s in range(len(t) - length + 1):
            w = t[s:s + length]
            if w in seen:
                cover[i].update(range(s, s + length))
            else:
                seen[w] = (i, s)
    out = {}
    for i, c in cover.items():
        t = (texts[i] or "").encode()
        out[i] = (len(t), len(c), sum(x - 1 not in c for x in c), hashlib.sha256(bytes(b for k, b in enumerate(t) if k not in c)).hexdigest())
    return out


@pytest.mark.parametrize("hot", [20_000, 2])
def test_repeats_match_brute_force(spark, prose, hot):
    r = random.Random(4)
    parts = [prose(r.randint(10, 60), s) for s in range(12)] + ["ab" * 90, "é" * 70]
    texts = {i: " ".join(r.choice(parts) if r.random() < .6 else prose(r.randint(1, 20), 1000 + 31 * i + k) for k in range(r.randint(0, 7))) for i in range(80)}
    texts[80] = None
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(4)
    rep = suffix_dedup.repeats
    try:
        rep.__defaults__ = (100, hot)
        got = {x[0]: tuple(x[1:]) for x in suffix_dedup.repeated_bytes(df).collect()}
    finally:
        rep.__defaults__ = (100, suffix_dedup.HOT_CONTEXTS)
    assert got == brute_repeats(texts, 100)


def test_repeat_groups_name_their_first_occurrence(spark, prose):
    shared = prose(80, 7)
    texts = {1: prose(30, 1) + " " + shared, 2: shared + " " + prose(30, 2), 5: "x " + shared}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    raw = {i: t.encode() for i, t in texts.items()}
    rows = suffix_dedup.repeats(df).collect()
    assert {x.doc for x in rows} == {2, 5}
    for x in rows:
        assert raw[x.doc][x.start:x.start + x.size] == raw[x.first_doc][x.first_start:x.first_start + x.size] and x.size >= 100
        assert (x.first_doc, x.first_start) < (x.doc, x.start)


@pytest.mark.parametrize("hot", [20_000, 2])
def test_repeat_groups_are_whole_and_name_all_occurrences(spark, hot, monkeypatch):
    r = random.Random(12)
    noise = lambda n: "".join(r.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(n))
    long, part = noise(5599), noise(300)
    half = long[2000:4500]
    texts = {1: noise(50) + "1" + long + "2" + noise(70), 2: noise(90) + "3" + long + "4", 3: "5" + long + "6" + noise(10),
             4: noise(33) + "7" + half + "8" + noise(5), 5: half + "9" + part + "0" + noise(40), 6: "-" + part + "+" + part, 7: noise(500), 8: ""}
    real = suffix_dedup.repeats
    monkeypatch.setattr(suffix_dedup, "repeats", lambda docs, length: real(docs, length, hot))
    rows = suffix_dedup.repeat_groups(spark.createDataFrame(list(texts.items()), "doc_id long, text string"), 100).collect()
    got = {}
    for x in rows:
        got.setdefault(texts[x.first_doc][x.first_start: x.first_start + x["size"]], set()).add((x.doc, x.start))
    want = {w: {(d, i) for d, t in texts.items() for i in range(len(t)) if t.startswith(w, i)} for w in (long, half, part)}
    assert got == want and [len(want[w]) for w in (long, half, part)] == [3, 5, 3]
    assert all((x.first_doc, x.first_start) == min(want[texts[x.first_doc][x.first_start: x.first_start + x["size"]]]) for x in rows)


def test_repeat_groups_of_near_copies_match_brute_force(spark, prose, no_docs):
    r = random.Random(8)
    base, texts = prose(120, 40), {}
    for i in range(9):
        at, n = r.randrange(200), r.randint(120, 400)
        texts[i] = prose(10, 500 + i) + base[at: at + n] + prose(10, 600 + i)
    texts[9] = texts[3]
    raw = {i: t.encode() for i, t in texts.items()}
    rows = suffix_dedup.repeat_groups(spark.createDataFrame(list(texts.items()), "doc_id long, text string"), 60).collect()
    assert len({(x.first_doc, x.first_start, x["size"], x.doc, x.start) for x in rows}) == len(rows)
    groups, covered = {}, {i: set() for i in raw}
    for x in rows:
        w = raw[x.first_doc][x.first_start: x.first_start + x["size"]]
        assert len(w) >= 60 and raw[x.doc][x.start: x.start + x["size"]] == w
        groups.setdefault(w, set()).add((x.doc, x.start))
        covered[x.doc] |= set(range(x.start, x.start + x["size"]))
    assert all(len(g) > 1 for g in groups.values())
    at = {}
    for i, t in raw.items():
        for j in range(len(t) - 59):
            at.setdefault(t[j:j + 60], []).append((i, j))
    want = {i: set() for i in raw}
    for places in at.values():
        if len(places) > 1:
            for i, j in places:
                want[i] |= set(range(j, j + 60))
    assert covered == want
    assert suffix_dedup.repeat_groups(no_docs.select("doc_id", "text"), 60).count() == 0


def test_repeats_odd_rows(odd_docs, no_docs):
    rows = suffix_dedup.repeated_bytes(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    by = {}
    for x in rows:
        by.setdefault(x.doc_id, []).append(x)
    assert [x.n_removed for x in by[1]] == [0] and all(x.n_removed == x.n_bytes for x in by[2]) and len(by[2]) == 2
    assert all(x.n_removed == 0 for x in by[None]) and by[4][0].n_bytes == 0 and by[3][0].n_removed == 0
    assert by[4][0].kept_sha256 == hashlib.sha256(b"").hexdigest() and by[11][0].n_removed > 0
    assert suffix_dedup.repeated_bytes(no_docs).count() == 0
    kept = {x.doc_id: x for x in suffix_dedup.stage_suffix_dedup(None, odd_docs, "").collect()}
    assert 2 not in kept and kept[1].n_chars == len(kept[1].text) and 4 in kept and 13 in kept and len(kept[13].text) < 3000
    assert len(kept[11].text) > 0 and kept[11].text.endswith("x")


def hits(text, items):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    low = lambda t: word.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
    w, cover, found = low(text), set(), set()
    for item, t in items:
        q = low(t)
        n = min(10, len(q))
        wins = {tuple(q[i:i + n]) for i in range(len(q) - n + 1)} if q else set()
        for i in range(len(w) - n + 1 if n else 0):
            if tuple(w[i:i + n]) in wins:
                cover.update(range(i, i + n))
                found.add(str(item))
    return len(w), len(cover), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(cover)


def test_contamination_matches_brute_force(spark, prose, odd_docs, no_docs):
    bench = [(1, prose(40, 50)), (2, "Two words"), (3, None), (4, ""), (5, prose(10, 51)), (6, prose(40, 50)), (None, prose(12, 52)), (70, "É x É")]
    items = [b for b in bench if b[0] is not None]
    r = random.Random(2)
    texts = {}
    for i in range(60):
        t = prose(r.randint(0, 60), 200 + i).split()
        if i % 3 == 0:
            q = (bench[r.choice([0, 4])][1]).split()
            a = r.randrange(0, len(q) - 5)
            t[len(t) // 2:len(t) // 2] = [x.upper() if x.isascii() else x for x in q[a:a + r.randint(5, 40)]]
        if i % 7 == 0:
            t += ["TWO,", "words!"]
        if i % 11 == 0:
            t += ["é", "x", "é", "É", "X", "É"]
        texts[i] = " ".join(t)
    b = spark.createDataFrame(bench, "item_id long, text string").selectExpr("item_id", "text", "item_id AS k", "text AS ids")
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {x[0]: tuple(x[1:6]) for x in decontaminate.contamination(df, b).collect()}
    assert got == {i: hits(t, items) for i, t in texts.items()}
    odd = decontaminate.contamination(odd_docs, b).collect()
    assert len(odd) == odd_docs.count() and {x.n_words for x in odd if x.doc_id in (4, 5, 6)} == {0}
    assert decontaminate.contamination(no_docs, b).count() == 0
    clean = decontaminate.contamination(df, b.limit(0)).where("contaminated OR n_items > 0").count()
    assert clean == 0


def test_decontamination_stage_keeps_exactly_the_clean_rows(spark, prose, odd_docs, no_docs, monkeypatch):
    bench = [(1, prose(40, 50)), (2, "Two words"), (3, None)]
    passage = " ".join(bench[0][1].split()[5:25])
    rows = [(1, "clean " + prose(30, 60)), (1, prose(9, 61) + " " + passage.upper().replace("É", "é")), (2, passage), (2, passage), (None, "two words"),
            (None, None), (None, "other"), (3, ""), (4, "two  WORDS!"), (5, "two"), (6, prose(200, 62))]
    rows = [(i, t, "x", n) for n, (i, t) in enumerate(rows)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, h string, rid int").repartition(3)
    b = spark.createDataFrame(bench, "item_id long, text string")
    want = sorted((r for r in rows if not hits(r[1], bench)[4]), key=str)
    assert sorted(map(tuple, decontaminate.clean_documents(docs, b).collect()), key=str) == want and 0 < len(want) < len(rows)
    monkeypatch.setattr(decontaminate, "BROADCAST_TERMS", 0)
    monkeypatch.setattr(decontaminate, "BROADCAST_ENTRIES", 0)
    out = decontaminate.clean_documents(docs, b)
    assert sorted(map(tuple, out.collect()), key=str) == want and out.columns == docs.columns
    assert sorted(map(tuple, decontaminate.clean_documents(odd_docs, b).collect()), key=str) == sorted((tuple(r) for r in odd_docs.collect() if not hits(r.text, bench)[4]), key=str)
    assert decontaminate.clean_documents(no_docs, b).count() == 0
    assert decontaminate.clean_documents(docs, b.limit(0)).count() == len(rows)


def test_proximity_matches(spark, prose):
    q = [f"rare{i}" for i in range(10)]
    docs = [(1, "a b " + " x ".join(reversed(q))), (2, " ".join(q[:5]) + " y" * 200 + " " + " ".join(q[5:])), (3, "z")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame([(9, " ".join(q))], "item_id long, text string")
    got = {tuple(x) for x in decontaminate.proximity_matches(df, b, span=30, rarest=10).collect()}
    assert got == {(1, "9")}


def test_proximity_matches_need_all_words(spark):
    q = [f"rare{i}" for i in range(10)]
    docs = [(1, "a b " + " x ".join(reversed(q))), (2, " ".join(q[:3]) + " y z"), (3, " ".join(q[3:] * 5)), (4, "Rare9 " + " ".join(q[:9]).upper())]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame([(9, " ".join(q))], "item_id long, text string")
    assert {tuple(x) for x in decontaminate.proximity_matches(df, b).collect()} == {(1, "9"), (4, "9")}


def test_vectors_match_brute_force(spark):
    rng = np.random.default_rng(1)
    base = rng.normal(size=(40, 16))
    rows = [(i, (base[rng.integers(40)] + rng.normal(size=16) * .25).tolist(), i) for i in range(400)]
    rows += [(600, None, 1), (601, [0.0] * 16, 1), (602, [float("nan")] * 16, 1), (603, [None] * 16, 1), (604, rows[3][1], 1),
             (605, [2 * x for x in rows[3][1]], 1), (None, rows[3][1], 1), (606, [], 1), (607, [1.0, 2.0], 1), (608, [float("inf")] + [1.0] * 15, 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, n int")
    got = {x.vec_id: (x.n_links, x.component_id, x.kept) for x in pq_dedup.near_duplicates(df).collect()}
    ids = [x[0] for x in rows[:400] + rows[404:406]]
    x = np.array([x[1] for x in rows[:400] + rows[404:406]])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    link = x @ x.T >= 0.9
    np.fill_diagonal(link, False)
    at = {v: k for k, v in enumerate(ids)}
    comp = components(ids, lambda a, b: link[at[a], at[b]])
    recall = sum(got[i][0] for i in ids) / link.sum()
    assert recall >= 0.99 and all(got[i][0] <= link[at[i]].sum() for i in ids)
    assert sum(got[i][1] == comp[i] for i in ids) >= 0.99 * len(ids)
    assert all(got[i] == (0, i, True) for i in (600, 601, 602, 603, 606, 607, 608)) and got[None] == (0, None, False)
    assert pq_dedup.near_duplicates(df.limit(0)).count() == 0


def test_vectors_of_few_directions_match_brute_force(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(5000, 6)) @ rng.normal(size=(6, 64)) + rng.normal(size=(5000, 64)) * .02  # 19 lists near a subspace of 6 dimensions
    short = rng.normal(size=(60, 3))  # another length is a group of its own
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(10_000 + i, v.tolist()) for i, v in enumerate(short)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    got = {r.vec_id: r.n_links for r in pq_dedup.near_duplicates(df).collect()}
    for first, m in ((0, x), (10_000, short)):
        u = m / np.linalg.norm(m, axis=1, keepdims=True)
        link = u @ u.T >= 0.9
        np.fill_diagonal(link, False)
        assert link.sum() > 100 and [got[first + i] for i in range(len(m))] == link.sum(1).tolist()


def links(x, cosine=0.9):
    link = x @ x.T >= cosine
    np.fill_diagonal(link, False)
    return link


def test_vectors_of_float_type_in_many_blocks_match_brute_force(spark, monkeypatch):
    monkeypatch.setattr(pq_dedup, "LEAST_BLOCK", 300)
    rng = np.random.default_rng(7)
    x = (rng.normal(size=(80, 32))[rng.integers(80, size=3000)] + rng.normal(size=(3000, 32)) * .4).astype(np.float32)
    x[2900:] = rng.normal(size=32) + rng.normal(size=(100, 32)) * .05  # a large group of near copies
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    got = {r.vec_id: (r.n_links, r.component_id) for r in pq_dedup.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)).collect()}
    u = x.astype(np.float64)
    link = links(u / np.linalg.norm(u, axis=1, keepdims=True))
    comp = components(range(len(x)), lambda a, b: link[a, b])
    assert [got[i] for i in range(len(x))] == [(n, comp[i]) for i, n in enumerate(link.sum(1).tolist())]


def test_vector_lists_probed():
    rng = np.random.default_rng(8)
    x = rng.normal(size=(100, 64))[rng.integers(100, size=8000)] + rng.normal(size=(8000, 64)) * .5
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    z = pq_dedup.Quantiser(x, 60)
    own = z.encode(x)[0]
    lists, least = np.arange(60), np.full(60, np.inf)
    np.minimum.at(least, own, (x * z.coarse[own]).sum(1))
    p = z.probes(x, own, lists, least, 0.9)
    a, b = np.nonzero(links(x))
    assert len(a) > 1000 and p[a, own[b]].all() and p[np.arange(len(x)), own].all()
    border = np.sqrt(np.maximum((z.coarse[:, None] - z.coarse) ** 2, 0).sum(2))  # lists within the threshold's distance of the border, as probed before
    d = 1 - 2 * x @ z.coarse.T + (z.coarse ** 2).sum(1)
    before = d - d[np.arange(len(x)), own][:, None] <= 2 * border[own] * np.sqrt(.2)
    assert p.sum() < 0.75 * before.sum()


def test_vector_search_costs_no_more_than_a_product():
    rng = np.random.default_rng(9)
    x = rng.normal(size=(6000, 64))  # spread over all dimensions, so that every list is probed
    x[:50] = x[50:100] + rng.normal(size=(50, 64)) * .1
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    z = pq_dedup.Quantiser(x, 24)
    own, code, err = z.encode(x)
    least = np.full(24, -1.0)
    ids = pa.array(np.arange(6000))
    t = pa.table({"cid": ids, "m": pa.array(np.ones(6000, np.int64)), "v": pq_dedup._bytes(x), "list": pa.array(own), "code": pq_dedup._bytes(code), "err": pa.array(err)})
    search = pq_dedup._search(SimpleNamespace(value=z), least, "<f8", 0.9)

    def least_cpu(f):
        times = []
        for _ in range(3):
            begun = time.process_time()
            out = f()
            times.append(time.process_time() - begun)
        return out, min(times)
    found, cost = least_cpu(lambda: search(t, t).to_pandas().groupby("cid")["n"].sum())
    link, plain = least_cpu(lambda: links(x))
    assert link.sum() >= 100 and found.reindex(range(6000), fill_value=0).tolist() == link.sum(1).tolist()
    assert cost < 1.3 * plain


def test_vector_copies_do_not_grow_until_blocks_are_full():
    assert [-(-n // pq_dedup._block(n, 64)) for n in (10_000, 50_000, 500_000)] == [5, 8, 8]
    assert pq_dedup._block(10 ** 9, 64) * 64 * 8 == pq_dedup.BLOCK_BYTES
