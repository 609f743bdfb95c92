"""Language ID, scores, mixing, WARC and main text: brute force, round trips and held-out accuracy."""
import base64
import gzip
import hashlib
import random
import zlib
from collections import Counter

import duckdb
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from meterflow.llm import html_text, kernel, language_id, mixing, quality, registry, toxicity, warc
from meterflow.session import scratch_path

SF_MID = "/root/testdata/sf0.01"


def test_word_hashes_split_like_bytes_split():
    r = random.Random(1)
    texts = [None, "", "a", "  x\ty\n", "Hello wORLD é\x0b", "z" * 300] + [" ".join(r.choice(["ab", "c", "deé", "F"]) for _ in range(r.randint(0, 30))) for _ in range(100)]
    data, off = kernel.text_buffers(pa.array(texts))
    old, seen = kernel.BLOCK, {}
    try:
        for block in (7, 64, old):
            kernel.BLOCK = block
            h, w = kernel.word_hashes(data, off)
            for t, a, b in zip(texts, w[:-1], w[1:]):
                words = (t or "").encode().lower().split()
                assert b - a == len(words)
                assert all(seen.setdefault(x, v) == v for x, v in zip(words, h[a:b].tolist()))
    finally:
        kernel.BLOCK = old
    assert len(set(seen.values())) == len(seen)


def grams(text):
    out = Counter()
    word = ""
    for ch in (text or "") + " ":
        if ch.isalpha():
            word += ch.lower()[0]
        elif word:
            p = f"_{word}_"
            out.update(word)
            out.update(p[i:i + 2] for i in range(len(p) - 1))
            out.update(p[i:i + 3] for i in range(len(p) - 2))
            word = ""
    return out


def test_document_grams_match_brute_force():
    texts = ["Ab a, é1É!", "", None, "x", " lead", "tail ", "ß ñandú 日本"]
    got = [sorted(Counter(k.tolist()).values()) for k in language_id.document_grams(*kernel.text_buffers(pa.array(texts)))]
    assert got == [sorted(grams(t).values()) for t in texts]


def test_language_held_out_accuracy_and_odd_rows(spark, odd_docs, no_docs):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    rows = language_id.language_predictions(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(rows) == docs.count()
    assert all(x.held_out == (zlib.crc32(str(x.doc_id).encode()) % 4 == 2) for x in rows)
    held = [x.lang_pred == x.lang for x in rows if x.held_out]
    assert sum(held) >= 0.97 * len(held) and all(0 <= x.score <= 1 for x in rows)
    odd = {x.doc_id: x for x in language_id.language_predictions(odd_docs).collect()}
    assert all(odd[i].lang_pred == "und" and odd[i].score == 0 for i in (4, 5, 6, 12)) and odd[None].held_out is False
    assert odd[10].lang_pred == "en" and language_id.language_predictions(no_docs).count() == 0
    kept = language_id.stage_language_id(None, odd_docs, "")
    assert kept.columns == odd_docs.columns and not {4, 5, 6, 12} & {x.doc_id for x in kept.collect()}


def accuracy(rows, labels, parts, rest):
    held = [(x.predicted, labels[x.doc_id]) for x in rows if x.doc_id in labels and zlib.crc32(str(x.doc_id).encode()) % parts == rest]
    assert all(x.held_out == (zlib.crc32(str(x.doc_id).encode()) % parts == rest) for x in rows if x.doc_id is not None)
    assert all(0 <= x.score <= 1 and x.predicted == int(x.score >= 0.5) for x in rows)
    return sum(a == b for a, b in held) / len(held)


def test_quality_rules(spark, odd_docs, no_docs):
    docs, labels = spark.read.parquet(f"{SF_MID}/documents.parquet"), spark.read.parquet(f"{SF_MID}/labels.parquet")
    marks = {x.doc_id: x.quality for x in labels.collect()}
    assert accuracy(quality.quality_scores(docs, labels).collect(), marks, 3, 1) >= 0.97
    assert quality.quality_scores(odd_docs, labels).count() == odd_docs.count()
    assert quality.quality_scores(no_docs, labels).count() == 0
    nothing = quality.quality_scores(odd_docs, labels.limit(0)).collect()
    assert {x.score for x in nothing} == {0.5}
    odd_labels = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (None, 1, 1), (2, None, None), (3, 1, 0)], "doc_id long, quality int, toxic int")
    assert all(x.score > 0.9 for x in quality.quality_scores(odd_docs, odd_labels).collect())


def test_rule_paths_and_column(spark):
    tree = "m\n  If (feature 0 <= 1.5)\n   If (feature 1 <= 2.0)\n    Predict: 0.0\n   Else (feature 1 > 2.0)\n    Predict: 1.0\n  Else (feature 0 > 1.5)\n   Predict: 1.0\n"
    rules = quality._paths(tree, ["a", "b"])
    assert rules == {(("a", "<=", 1.5),), (("a", "<=", 1.5), ("b", "<=", 2.0)), (("a", "<=", 1.5), ("b", ">", 2.0)), (("a", ">", 1.5),)}
    df = spark.createDataFrame([(1.0, 3.0), (2.0, 3.0)], "a double, b double")
    assert [x[0] for x in df.select(quality.rule_column((("a", "<=", 1.5), ("b", ">", 2.0)))).collect()] == [1.0, 0.0]


def test_toxicity_planted_words(spark, prose, odd_docs, no_docs):
    r = random.Random(5)
    rows = []
    for i in range(1500):
        w = prose(r.randint(5, 80), i).split()
        bad = i % 5 == 1
        if bad:
            for _ in range(r.randint(1, 3)):
                w.insert(r.randrange(len(w)), r.choice(["Vexoling", "vexolar", "grumbat", "GRUMBAT!", "gru­mbat".replace("­", "")]))
        rows.append((i, " ".join(w), int(bad)))
    docs = spark.createDataFrame([x[:2] for x in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(x[0], x[2]) for x in rows], "doc_id long, toxic int")
    assert accuracy(toxicity.toxicity_scores(docs, labels).collect(), {x[0]: x[2] for x in rows}, 5, 0) >= 0.97
    assert toxicity.toxicity_scores(odd_docs, labels).count() == odd_docs.count()
    assert toxicity.toxicity_scores(no_docs, labels).count() == 0
    assert {x.score for x in toxicity.toxicity_scores(odd_docs, labels.limit(0)).collect()} == {0.0}


def test_toxicity_parts_hold_both_labels(spark):
    rows = [(i, float(i < 5)) for i in range(400)]
    dealt, n, ones = toxicity._in_parts(spark.createDataFrame(rows, "doc_id long, label double"))
    parts = {}
    for x in dealt.collect():
        parts.setdefault(x.part, []).append(x.label)
    assert (n, ones) == (400, 5) and sorted(parts) == [0, 1, 2, 3] and all(0 < sum(v) < len(v) for v in parts.values())
    few, n, ones = toxicity._in_parts(spark.createDataFrame(rows[3:], "doc_id long, label double"))
    assert (n, ones) == (397, 2) and few.where("part IS NULL").count() == 397


def test_raking_that_does_not_settle_raises(spark, monkeypatch):
    monkeypatch.setattr(mixing, "MOST_BLOCKS", 1)
    with pytest.raises(Exception, match="has not settled"):
        mixing.sampling(spark.read.parquet("/root/testdata/sf0.001/documents.parquet")).count()


@pytest.mark.parametrize("name", sorted(registry.ORACLE))
def test_queries_match_their_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "embeddings", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('/root/testdata/sf0.001/{t}.parquet')")
    df = registry.QUERIES[name](spark, "/root/testdata/sf0.001")
    cur = con.execute(registry.ORACLE[name])
    at = [[d[0] for d in cur.description].index(c) for c in df.columns]
    assert sorted(map(str, (tuple(x) for x in df.collect()))) == sorted(str(tuple(x[i] for i in at)) for x in cur.fetchall())


def test_mixing_meets_marginals_and_odd_rows(spark, odd_docs, no_docs):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    goal = spark.createDataFrame([("en", 1.0), ("de", 1.0), ("fr", 1.0), ("es", 1.0)], "lang string, share double")
    out = mixing.sampling(docs, budget=0.1, targets={"lang": goal})
    m = {x.lang: x.t for x in out.groupBy("lang").agg(F.sum(F.col("n_tokens") * F.col("probability")).alias("t")).collect()}
    total = sum(m.values())
    assert all(abs(v / total - 0.25) < 0.01 for v in m.values())
    assert abs(total - 0.1 * out.agg(F.sum("n_tokens")).first()[0]) < 1e-6 * total
    odd = mixing.sampling(odd_docs).collect()
    assert len(odd) == odd_docs.count() and not any(x.sampled for x in odd if not x.n_tokens)
    assert {x.n_tokens for x in odd if x.doc_id in (4, 5, 6)} == {0} and all(0 <= x.probability <= 1 for x in odd)
    assert mixing.sampling(no_docs).count() == 0
    stage = mixing.stage_mix(None, odd_docs, "")
    assert stage.columns == [*odd_docs.columns, "mix_topic", "mix_tokens", "mix_probability"] and stage.count() <= len(odd)


def test_word_counts_and_forms():
    texts = ["a b  c", None, "", " \n", "x|y", "hi!! 1", "hi! !", "no 7", "é", "!", "!"]
    data, off = kernel.text_buffers(pa.array(texts))
    old = kernel.BLOCK
    try:
        for block in (2, 5, old):
            kernel.BLOCK = block
            assert kernel.word_counts(data, off).tolist() == [len((t or "").split()) for t in texts]
    finally:
        kernel.BLOCK = old
    assert mixing._forms(data, off) == ["prose"] * 4 + ["table", "shout", "prose", "figures"] + ["prose"] * 3


def test_warc_round_trip(spark):
    r = random.Random(3)
    rows = [(i if i % 37 else None, r.choice([None, "http://www.a.de/x?y=1", "https://b.org/é z\r\n", "bad[://", ""]),
             r.choice([None, "", "<p>é\r\n\r\nx</p>", "a" * 1000, str(i)]), "clash") for i in range(1, 200)]
    rows += [rows[5], rows[6]]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, sha string").repartition(4)
    path = scratch_path(spark, "warc-test")
    warc.write_archives(pages, path)
    caps = warc.merged_index(warc.read_archives(spark, path)).collect()
    lead = {}
    for i, _, h, _ in rows:
        if i is not None:
            lead[h or ""] = min(i, lead.get(h or "", i))
    want = []
    for i, _, h, _ in rows:
        b = (h or "").encode()
        other = i is not None and lead[h or ""] != i
        want.append((i, len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(), "revisit" if other else "response", lead[h or ""] if other else None))
    assert sorted(map(str, want)) == sorted(str((x.page_id, x.payload_bytes, x.payload_digest, x.record_type, x.refers_to)) for x in caps)
    key = [(x.url_key, x.captured_at, x.page_id is not None, x.page_id or 0) for x in caps]
    assert key == sorted(key)
    files = {x.file: x.content for x in spark.read.format("binaryFile").load(path).select(F.element_at(F.split("path", "/"), -1).alias("file"), "content").collect()}
    for x in caps[:20]:  # offsets are good for random access
        fields, _, _ = warc.parse_record(gzip.decompress(bytes(files[x.archive][x.offset:x.offset + x.size])))
        assert fields["WARC-Type"] == x.record_type and int(fields.get("X-Page-ID", -1)) == (-1 if x.page_id is None else x.page_id)
    assert b"WARC/1.1" in gzip.decompress(bytes(next(iter(files.values()))))  # the whole file is a valid gzip stream
    empty = scratch_path(spark, "warc-empty")
    warc.write_archives(pages.limit(0), empty)
    assert warc.merged_index(warc.read_archives(spark, empty)).count() == 0


def test_loser_tree():
    r = random.Random(1)
    for k in (0, 1, 2, 3, 7, 16):
        runs = [sorted(r.randrange(50) for _ in range(r.randrange(12))) for _ in range(k)]
        assert list(warc.LoserTree(runs)) == sorted(sum(runs, []))


PAGE = """<!DOCTYPE html><html><head><title>t</title><script>var t="</p>"</script></head><body><header><h1>Site</h1></header>
<nav><ul><li><a href="/a">Menu, one</a><li><a href="/b">Menu, two</a></ul></nav><div class="cookie-notice">We use cookies, many, of them.</div>
{main}<aside>Side, bar text, with commas, and more.</aside><div id="comments"><p>First, I think, this is, a long comment by a reader.</p></div>
<form><p>Mail, please: <input></p></form><footer>&copy; 2024</footer></body></html>"""
BODY = "<h1>Head &amp; line</h1><p>First para, with&nbsp;some   commas, here<br>and more.<p><b>Second</b> para, <a href=x>linked</a> bit, long enough.</p><ul><li>Item, one</li><li>two</ul>"
TEXT = "Head & line\n\nFirst para, with some commas, here and more.\n\nSecond para, linked bit, long enough.\n\nItem, one\n\ntwo"


@pytest.mark.parametrize("main", [f"<article>{BODY}<div class='ad'>Buy, now</div></article>", f"<main><div>{BODY}</div></main>",
                                  f"<div class='story'><div class='x'>{BODY}</div></div>", f"<div>{BODY}"])
def test_main_text(main):
    assert html_text.main_text(PAGE.format(main=main)) == TEXT


@pytest.mark.parametrize("name", ["layout with-sidebar", "no-sidebar", "has-banner", "content-with-nav", "page sidebar", "widget"])
def test_main_text_inside_marked_layouts(name):
    assert html_text.main_text(PAGE.format(main=f"<div class='{name}'><article>{BODY}</article></div>")) == TEXT
    assert html_text.main_text(PAGE.format(main=f"<div class='{name}'><div>{BODY}</div></div>")) == TEXT


def test_main_text_keeps_content_named_like_boilerplate():
    long = "Earlier authors, as we have seen, had measured the same meters, over two years, and found the same drift."
    page = f"<article><h1>T</h1><p>{long}</p><section class='related-work'><p>{long}</p></section><p id='search-results'>{long}</p><div class='related'>More: {long}</div></article>"
    assert html_text.main_text(PAGE.format(main=page)) == "\n\n".join(["T", long, long, long])


def test_main_text_keeps_short_sections_beside_a_long_one():
    long = "A long, plain paragraph, with commas, of the main story, that goes on and on, for a while. " * 4
    page = f"<div><section><p>{long}</p><p>{long}</p><p>{long}</p></section><section><p>This short section, too, is text.</p></section><p>And a short last line.</p></div><div>Home | News | Sport | Weather | More</div>"
    got = html_text.main_text(f"<html><body>{page}</body></html>")
    assert "This short section, too, is text." in got and "Home" not in got


def test_main_text_odd_pages(spark):
    odd = [None, "", "<p>hi", "just text", "<article><h1>T</h1><p>x</p></article>", "<div>" * 4000 + "deep, text", "<p a='unclosed>x</p>", "<!-- open", "<script>x", "</p></div>"]
    want = ["", "", "hi", "just text", "T\n\nx", "deep, text"]
    assert [html_text.main_text(h) for h in odd][:6] == want
    pages = spark.createDataFrame([(i if i else None, None, h, "clash") for i, h in enumerate(odd)], "page_id long, url string, html string, text string")
    rows = html_text.extract_text(pages).collect()
    assert len(rows) == len(odd) and all(x.n_chars == len(x.text) for x in rows)
    assert html_text.extract_text(pages.limit(0)).count() == 0


def test_mixing_meets_all_marginals_at_the_budget(spark):
    out = mixing.sampling(spark.read.parquet(f"{SF_MID}/documents.parquet")).withColumn("t", F.col("n_tokens") * F.col("probability")).persist()
    all_tokens, drawn = out.agg(F.sum("n_tokens"), F.sum("t")).first()
    assert abs(drawn - mixing.BUDGET * all_tokens) < 1e-6 * drawn and out.where("probability > 1").count() == 0
    for c, power in mixing.TEMPER.items():
        rows = out.groupBy(c).agg(F.sum("n_tokens").alias("n"), F.sum("t").alias("t")).where("n > 0").collect()
        norm = sum(r.n ** power for r in rows)
        assert all(abs(r.t / drawn - r.n ** power / norm) < 2e-4 for r in rows), c
    out.unpersist()


def test_pipeline_keeps_clean_documents_and_columns(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    at = docs
    sizes = []
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, at, SF_MID)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == docs.columns
        out.write.parquet(str(tmp_path / name))
        at = spark.read.parquet(str(tmp_path / name))
        sizes.append(at.count())
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "ngram_jaccard_join", "suffix_array_dedup", "benchmark_decontamination", "source_mixing"]
    assert 1000 >= sizes[0] >= sizes[1] >= sizes[2] >= sizes[3] >= sizes[4] > 200 and sizes[0] >= 990
    again = {x.doc_id for x in corpus_pipeline.run(spark, SF_MID).select("doc_id").collect()}
    assert again == {x.doc_id for x in at.select("doc_id").collect()}


def test_html_time_grows_with_the_page_only():
    from time import perf_counter

    from meterflow.llm.html_text import main_text
    pages = ["<a " * 350_000, "<a \"" * 250_001 + ">", "<a '\" " * 150_001, "<noscript>" * 100_000, "<div>" * 100_000 + "x, y. " * 50,
             "<div>" * 100_000 + "</span>" * 100_000, "<b>" * 50_000 + "<h1>x</h1>" * 50_000, "<!-- " * 200_000, "</a " * 200_000, "<! " * 200_000]
    for page in pages:
        start = perf_counter()
        main_text(page)
        assert perf_counter() - start < 5, page[:20]


def test_html_text_of_sibling_articles_is_kept_whole():
    from meterflow.llm.html_text import main_text
    first, second, third = (f"{w} part, of the text. " * 20 for w in ("First", "Second", "Third"))
    page = (f"<body><nav>menu</nav><article><p>{first}</p></article><article><p>{second}</p></article><article class='comment'><p>{third}</p></article>"
            "<article><a href='x'>Another page, of this site, to read next</a></article></body>")
    text = main_text(page)
    assert text.startswith(f"{first.strip()}\n\n{second.strip()}") and "Third" not in text


def test_language_profiles_limit_their_ranking_before_the_shuffle(spark, prose):
    from meterflow.llm.language_id import learn_profiles
    df = spark.createDataFrame([(1, prose(300, 1), "en"), (2, prose(300, 2), "fr")], "doc_id long, text string, lang string")
    p = learn_profiles(df, 20)
    assert "WindowGroupLimit" in p._jdf.queryExecution().executedPlan().toString()
    ranks = {}
    for r in p.collect():
        ranks.setdefault(r.lang, []).append(r["rank"])
    assert {k: sorted(v) for k, v in ranks.items()} == {"en": list(range(20)), "fr": list(range(20))}
