"""Pipeline stages against plain versions of their rules, on the same rows."""
import hashlib
import random
from collections import defaultdict

from test_joins import components, shingles
from testdata_paths import SF_MID

from meterflow.llm import language_id, mixing, ngram_join, suffix_dedup


def plain_dedup(texts, length=100):
    """Texts without the characters whose bytes all lie in a string of ``length`` bytes that starts earlier too."""
    seen, out = set(), {}
    for i in sorted(texts):
        t = texts[i].encode()
        gone = [False] * len(t)
        for s in range(len(t) - length + 1):
            w = t[s:s + length]
            if w in seen:
                gone[s:s + length] = [True] * length
            seen.add(w)
        kept, at = "", 0
        for c in texts[i]:
            n = len(c.encode())
            kept += "" if all(gone[at:at + n]) else c
            at += n
        if kept == texts[i] or kept.strip(" "):
            out[i] = kept
    return out


def near_copies(prose):
    r = random.Random(9)
    texts = {}
    for g in range(7):
        w = prose(r.randint(30, 90), 300 + g).split()
        for i in range(7):
            w = list(w)
            for _ in range(r.randint(0, 3)):
                w[r.randrange(len(w))] = f"néw{r.randrange(10**6)}"
            texts[g * 10 + i] = " ".join(w)
    texts[6] = texts[0]  # an exact copy
    return texts


def frame(spark, texts):
    rows = [(i, t, "en", f"s{i % 3}", len(t)) for i, t in texts.items()]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(4)


def test_jaccard_stage_keeps_the_smallest_of_each_component(spark, prose):
    texts = near_copies(prose)
    s = {i: shingles(t, 5) for i, t in texts.items()}
    top = components(sorted(s), lambda a, b: 100 * len(s[a] & s[b]) >= 80 * len(s[a] | s[b]))
    got = ngram_join.stage_jaccard(spark, frame(spark, texts), "").collect()
    assert {x.doc_id: x.text for x in got} == {i: t for i, t in texts.items() if top[i] == i}
    assert len(got) == len(set(top.values())) < len(texts)


def test_suffix_stage_takes_out_exactly_the_repeated_characters(spark, prose):
    texts = near_copies(prose)
    out = suffix_dedup.stage_suffix_dedup(spark, frame(spark, texts), "")
    got = out.collect()
    want = plain_dedup(texts)
    assert {x.doc_id: x.text for x in got} == want and len(want) < len(texts) and any(want[i] != texts[i] for i in want)
    assert all(x.n_chars == len(x.text) for x in got) and out.columns == ["doc_id", "text", "lang", "source", "n_chars"]


def test_steps_leave_only_tables_that_the_result_reads(spark, prose, monkeypatch):
    from meterflow.llm import components as steps
    made, gone = [], []
    for module in (ngram_join, suffix_dedup):
        monkeypatch.setattr(module, "settle", lambda df, name: (made.append(name), steps.settle(df, name))[1])
    monkeypatch.setattr(steps, "remove", lambda spark, path, real=steps.remove: (gone.append(path.rsplit("/", 1)[1].rsplit("-", 1)[0]), real(spark, path)))
    df = frame(spark, near_copies(prose))
    assert ngram_join.jaccard_components(df).count() == suffix_dedup.repeated_bytes(df).count() == 49
    assert sorted(set(made) - set(gone)) == ["sets", "spans"] and len(gone) == len(made) - 2


def test_language_stage_drops_exactly_the_undetermined(spark, odd_docs):
    rows = [x.asDict() for x in odd_docs.collect()]
    want = [x for x in rows if any(c.isalpha() for c in x["text"] or "")]
    got = [x.asDict() for x in language_id.stage_language_id(spark, odd_docs, "").collect()]
    assert sorted(got, key=str) == sorted(want, key=str) and 0 < len(want) < len(rows)


def plain_probabilities(docs):
    """Raking over a dictionary of cells, each capped at its tokens."""
    def form(t):
        return "table" if "|" in t else "shout" if "!!" in t else "figures" if any(c in "0123456789" for c in t) else "prose"
    own = {x.doc_id: ((x.source or "", x.lang or "", form(x.text or "")), len((x.text or "").encode().split())) for x in docs}
    tokens = defaultdict(float)
    for cell, n in own.values():
        tokens[cell] += n
    tokens = {c: n for c, n in tokens.items() if n}
    reach = mixing.BUDGET * sum(tokens.values())
    goals = []
    for side, power in enumerate(mixing.TEMPER.values()):
        have = defaultdict(float)
        for c, n in tokens.items():
            have[c[side]] += n
        low, high = 0.0, 1e12
        for _ in range(200):
            mid = (low + high) / 2
            low, high = (mid, high) if sum(min(n, mid * n ** power) for n in have.values()) < reach else (low, mid)
        goals.append({v: min(n, low * n ** power) for v, n in have.items()})
    w = {c: n * mixing.BUDGET for c, n in tokens.items()}
    for _ in range(1500):
        for side, goal in enumerate(goals):
            now = defaultdict(float)
            for c, x in w.items():
                now[c[side]] += x
            w = {c: min(tokens[c], x * goal[c[side]] / now[c[side]]) if now[c[side]] else 0.0 for c, x in w.items()}
    return {i: w[cell] / tokens[cell] if n else 0.0 for i, (cell, n) in own.items()}


def test_mix_stage_draws_by_the_raked_probabilities(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    p = plain_probabilities(docs.collect())
    u = {i: int(hashlib.md5(f"{i}:mix".encode()).hexdigest()[:13], 16) / 16 ** 13 for i in p}
    got = {x.doc_id: x.mix_probability for x in mixing.stage_mix(spark, docs, SF_MID).collect()}
    assert all(abs(q - p[i]) < 1e-3 for i, q in got.items())
    sure = {i for i in p if abs(u[i] - p[i]) > 1e-3}
    assert {i for i in sure if u[i] < p[i]} == sure & set(got) and len(sure) > 0.98 * len(p)
