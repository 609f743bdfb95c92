"""Whitening, alignment and packing against brute force on whole tables and on odd rows."""
import random
import zlib
from collections import Counter
from hashlib import sha256

import numpy as np
import pytest

from meterflow.llm import alignment, packing, whitening
from meterflow.llm.vocab import Memo, byte_level, vocabulary

SF = "/root/testdata/sf0.001"


def integers(v):
    return [int(np.floor(1024 * float(c))) + 100000 for c in v]


def whitened_by_hand(vectors):
    x = np.array([integers(v) for v in vectors], dtype=object)
    n, s = len(x), x.sum(0)
    d = n * x - s
    cov = np.array([[sum(a * b for a, b in zip(d[:, i], d[:, j])) / n**3 for j in range(x.shape[1])] for i in range(x.shape[1])])
    e, w = np.linalg.eigh(cov)
    order = np.argsort(-e)[:8]
    return n, [int(sum(a * a for a in row)) for row in d], (d / n).astype(float) @ w[:, order] / np.sqrt(e[order]), e[order] / np.trace(cov)


def check_whitened(rows, vectors):
    n, deviation, z, explained = whitened_by_hand([v for _, v in vectors])
    got = {(r.vec_id, r.component): r for r in rows}
    assert len(got) == len(rows) == len(vectors) * z.shape[1]
    for k in range(z.shape[1]):
        mine = np.array([got[i, k + 1].whitened for i, _ in vectors])
        sign = np.sign((mine * z[:, k]).sum())
        assert np.abs(sign * mine - z[:, k]).max() < 1e-6
        assert all(got[i, k + 1].deviation == deviation[j] and got[i, k + 1].n == n for j, (i, _) in enumerate(vectors))
        assert abs(got[vectors[0][0], k + 1].explained / explained[k] - 1) < 1e-9
    assert {r.identity_error for r in rows}.pop() < 1e-8


def test_whitening_query_matches_exact_arithmetic(spark):
    rows = whitening.op11_embedding_whitening(spark, SF).collect()
    table = spark.read.parquet(f"{SF}/embeddings.parquet").orderBy("vec_id").collect()
    check_whitened(rows, [(r.vec_id, list(r.embedding)) for r in table])


def test_whitening_of_odd_rows(spark, tmp_path):
    r = random.Random(5)
    nan, inf = float("nan"), float("inf")
    good = [(i, [r.gauss(0, 1 + k) * (300 if k == 1 else 1) for k in range(9)]) for i in range(150)]
    rows = good + [(200, None), (201, []), (202, [None] + [0.0] * 8), (203, [nan] * 9), (204, [inf] + [0.0] * 8)]
    path = str(tmp_path / "e")
    spark.createDataFrame([(i, v, "x", i) for i, v in rows], "vec_id long, embedding array<double>, z string, dim long").repartition(4).write.parquet(f"{path}/embeddings.parquet")
    check_whitened(whitening.op11_embedding_whitening(spark, path).collect(), good)


def test_whitening_of_repeated_constant_and_huge_rows(spark, tmp_path):
    rows = [(1, [1.0, 2.0]), (1, [1.0, 2.0]), (None, [3.0, 2.0]), (2, [0.5] * 3), (3, [1e300, 0.0, 0.0, 1.0]), (4, [-1e300, 0.0, 0.0, 2.0])]
    path = str(tmp_path / "e")
    spark.createDataFrame(rows, "vec_id long, embedding array<double>").write.parquet(f"{path}/embeddings.parquet")
    got = whitening.op11_embedding_whitening(spark, path).collect()
    assert Counter((r.vec_id, r.n) for r in got) == {(1, 3): 4, (None, 3): 2, (2, 1): 3, (3, 2): 4, (4, 2): 4}
    flat = [r for r in got if r.vec_id in (1, None) and r.component == 2]
    assert all(r.whitened is None and r.explained == 0 for r in flat) and len(flat) == 3  # a constant entry has no variance
    first = [r.whitened for r in got if r.vec_id in (1, None) and r.component == 1]
    assert sorted(abs(x) for x in first) == pytest.approx([0.5**0.5, 0.5**0.5, 2**0.5])
    assert all(r.whitened is None and r.explained is None and r.identity_error is None and r.deviation == 0 for r in got if r.vec_id == 2)
    assert all(r.deviation is None for r in got if r.vec_id in (3, 4))  # does not fit a long
    spark.createDataFrame([], "vec_id long, embedding array<float>").write.parquet(f"{path}0/embeddings.parquet")
    assert whitening.op11_embedding_whitening(spark, f"{path}0").collect() == []


def test_bit_sliced_scatter_is_exact():
    rng = np.random.default_rng(3)
    for rows, low, high in ((1, -5, 6), (63, 0, 1), (64, 0, 2), (1000, 98_000, 102_000), (130, -2**62, 2**62), (2, -2**63, 2**63 - 1)):
        x = rng.integers(low, high, (rows, 5), dtype=np.int64)
        s, p = whitening.scatter(x)
        o = x.astype(object)
        assert (s == o.sum(0)).all() and (p == o.T @ o).all()


# ---- alignment

def tokenizers():
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer
    a = Tokenizer.from_file(vocabulary("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    return a, SentencePieceProcessor(model_file=vocabulary("piece_bpe_32k.model"))


def aligned_by_hand(rows):
    a, b = tokenizers()
    level = byte_level()
    assert sorted(level.values()) == list(range(256))
    a_bytes = {i: bytes(level[c] for c in t) if t != "<|endoftext|>" else t.encode() for t, i in a.get_vocab().items()}
    b_bytes = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i, p in ((i, b.id_to_piece(i)) for i in range(b.get_piece_size()))]
    out, counts = [], Counter()
    for doc_id, text in rows:
        ia, ib = (a.encode(" " + text, add_special_tokens=False).ids, b.encode(text, num_threads=1)) if text else ([], [])
        whole = (" " + (text or "")).encode()
        if b"".join(a_bytes[i] for i in ia) != whole or b"".join(b_bytes[i] for i in ib) != whole:
            ia, ib = [], []
        ea, eb = np.cumsum([len(a_bytes[i]) for i in ia]).tolist(), np.cumsum([len(b_bytes[i]) for i in ib]).tolist()
        at_a, at_b = ({e: k for k, e in enumerate(x)} for x in (ea, eb))
        links = [(x, ib[at_b[e]]) for x, e in zip(ia, ea) if e in at_b]
        groups, la, lb = [], 0, 0
        for e in sorted(at_a.keys() & at_b.keys()):
            na, nb = at_a[e] + 1, at_b[e] + 1
            groups.append(",".join(map(str, ia[la:na])) + "|" + ",".join(map(str, ib[lb:nb])))
            la, lb = na, nb
        counts.update(links)
        out.append((doc_id, len(ia), len(ib), len(groups), links, ";".join(groups)))
    best = {}
    for (x, y), c in counts.items():
        best[y] = max(best.get(y, 0), c)
    return sorted(((d, na, nb, ng, len(links), sum(counts[p] == best[p[1]] for p in links), sum(counts[p] for p in links),
                    sha256(g.encode()).hexdigest() if g else "") for d, na, nb, ng, links, g in out), key=str)


def run_alignment(spark, docs, path):
    docs.write.parquet(f"{path}/documents.parquet")
    return sorted(map(tuple, alignment.op12_tokenizer_alignment(spark, path).collect()), key=str)


ODD_TEXTS = [None, "", " ", "  ", "\n", "a", " a", "  a b", "a ", "a  ", "a  b   c    d", "tab\tand\nline\r\n  break \n \n x", "non break   space　wide  x",
             "don't we'll I'M it's 'tis", "<s>text</s> <unk> <0x0A> <|endoftext|> <|ENDOFTEXT|> X<|endoftext|>y", "A.B,c;;d's! O'Neil'S ''re (x)[2]3.4 a-b_c e\u0323\u0301, É, 5,é x\u0301.y", "low▁line", "a▁ b", "ﬁ ① ² Å Å é é", "😀😀 👩‍👩‍👧 x", "Ünï cödé ÉCOLE ça ß÷ÿ ×à naïve. straße, İstanbul ΣΑΣ ǅ",
             "\x00 \x01 a\x01 \x1c x \x1f", "a" * 3000, "!" * 500 + " ?", " ".join(["word"] * 2000), "x\u0085y \u0085z", "مرحبا بالعالم", "日本語のテキスト 中文", "a ́b ́"]


def test_alignment_query_matches_brute_force(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = sorted(map(tuple, alignment.op12_tokenizer_alignment(spark, SF).collect()), key=str)
    assert got == aligned_by_hand([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])


def test_alignment_of_odd_texts(spark, tmp_path, odd_docs, no_docs, monkeypatch):
    rows = list(enumerate(ODD_TEXTS)) + [(5, "a"), (None, "a b"), (None, None)]
    docs = spark.createDataFrame([(i, t, "r", 1) for i, t in rows], "doc_id long, text string, rid string, pairs int").repartition(3)
    assert run_alignment(spark, docs, str(tmp_path / "a")) == aligned_by_hand(rows)
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    assert run_alignment(spark, odd_docs, str(tmp_path / "b")) == aligned_by_hand(rows)
    assert run_alignment(spark, no_docs, str(tmp_path / "c")) == []


def test_alignment_groups_hold_all_tokens_and_both_joins_agree(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(40)
    both = alignment.align(docs)
    for r in both.collect():
        assert sum(r.a_sizes) == len(r.a_ids) == r.n_a and sum(r.b_sizes) == len(r.b_ids) == r.n_b and len(r.a_sizes) == r.n_groups
    counts = alignment.pair_counts(both, 32000)
    one = sorted(map(tuple, alignment.score(both, counts).select("rid", "n_best", "count_sum").collect()))
    monkeypatch.setattr(alignment, "BROADCAST_PAIRS", 10)
    assert sorted(map(tuple, alignment.score(both, counts).select("rid", "n_best", "count_sum").collect())) == one


def test_long_texts_and_a_small_memory_change_nothing(monkeypatch):
    text = (" ".join(ODD_TEXTS[3:]).replace("▁", "") + " plain words with no odd spaces " * 30).encode()
    two = alignment.TwoEncodings(alignment.BYTE_VOCABULARY, alignment.PIECE_VOCABULARY)
    want, words = two.texts([text, b"a b", None]), packing.WordIds(packing.VOCABULARY)
    ids = words.texts([text, b"a b"])
    monkeypatch.setattr(alignment, "SLICE", 700)
    monkeypatch.setattr(packing, "SLICE", 700)
    monkeypatch.setattr(alignment.slices, "__defaults__", (700,))
    two.a_memo.limit, two.b_memo.limit, words.memo.limit = 20, 30, 15
    assert two.texts([text, b"a b", None]) == want and want[0][0]
    assert words.texts([text, b"a b"]) == ids


def test_gallop_finds_common_entries():
    r = random.Random(2)
    for _ in range(200):
        a_lists = [[] if r.random() < 0.2 else sorted(r.sample(range(1, 400), r.randint(1, 120))) for _ in range(r.randint(1, 6))]
        b_lists = [sorted(r.sample(range(1, 400), r.randint(1, 120))) if a else [] for a in a_lists]
        for a, b in zip(a_lists, b_lists):
            if a:
                a.append(400), b.append(400)
        base = [400 * k for k in range(len(a_lists))]
        flat = [np.array([x + o for v, o in zip(lists, base) for x in v], np.int64) for lists in (a_lists, b_lists)]
        sizes = [np.array([len(v) for v in lists]) for lists in (a_lists, b_lists)]
        ca, cb = alignment.common_ends(*flat, *sizes)
        assert flat[0][ca].tolist() == flat[1][cb].tolist() == sorted(set(flat[0].tolist()) & set(flat[1].tolist()))


def test_memo_forgets_but_keeps_what_it_was_just_asked_for():
    asked = []
    m = Memo(lambda parts: (asked.extend(parts), [p * 2 for p in parts])[1], limit=3)
    m.learn({b"a", b"b"})
    m.learn({b"b", b"c", b"d"})
    assert m.known == {b"b": b"bb", b"c": b"cc", b"d": b"dd"}
    m.learn({b"b", b"c", b"d"})
    cut = Memo(lambda parts: [p.upper() for p in parts], split=lambda p: p.split(b","))
    cut.learn({b"x,y", b"y", b"z"})
    assert cut.known[b"x,y"] == b"XY" and cut.known[b"z"] == b"Z"
    assert Counter(asked) == {b"a": 1, b"b": 2, b"c": 1, b"d": 1}


# ---- packing

def check_packed(rows, docs, capacity=4096, ratio=1.01):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(vocabulary("word_bpe_49k.json"))
    want = Counter()
    for doc_id, text in docs:
        ids = t.encode(text or "", add_special_tokens=False).ids + [1]
        for piece, lo in enumerate(range(0, len(ids), capacity)):
            part = ids[lo: lo + capacity]
            want[doc_id, piece, lo, len(part), zlib.crc32(np.array(part, "<u4").tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    held = {}
    for r in rows:
        held.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in held.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    total = sum(r.length for r in rows)
    assert len(held) <= ratio * total / capacity + 1
    return held


def test_packing_query_matches_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    check_packed(packing.op13_best_fit_packing(spark, SF).collect(), [(r.doc_id, r.text) for r in docs])


def test_packing_of_odd_texts(spark, odd_docs, no_docs):
    rows = list(enumerate(ODD_TEXTS)) + [(5, "a"), (None, "a b"), (None, None), (90, " ".join(["word"] * 4095)), (91, " ".join(["word"] * 4096))]
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, offset int, task string").repartition(5)
    check_packed(packing.pack_documents(docs, ids=False).collect(), rows)
    check_packed(packing.pack_documents(odd_docs, ids=False).collect(), [(r.doc_id, r.text) for r in odd_docs.collect()])
    assert packing.pack_documents(no_docs).collect() == []


def test_packing_over_many_tasks_and_rounds(spark, prose, monkeypatch):
    r = random.Random(4)
    rows = [(i, prose(int(2 ** r.uniform(0, 8)), i)) for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(12)
    monkeypatch.setattr(packing, "GATHER", 3)
    packed = packing.pack_documents(docs, capacity=128, places=16)
    held = check_packed(packed.collect(), rows, 128, 1.1)
    seqs = {s.sequence_id: s for s in packing.sequences(packed).collect()}
    assert seqs.keys() == held.keys()
    for r in packed.collect():
        s = seqs[r.sequence_id]
        assert np.array(s.ids[r.offset: r.offset + r.length], "<u4").tobytes() == bytes(r.ids) and r.doc_id in s.doc_ids


def test_open_bins_take_the_fullest_that_fits_and_close_the_fullest():
    bins = packing.OpenBins(10, 3, 0)
    assert [bins.add(n, n) for n in (7, 5, 9, 2, 4)] == [None] * 5  # 2 goes to the bin with 3 free, 4 to that with 5
    assert bins.add(1, 1) == [1, (5, 0), (4, 5), (1, 9)]  # of three bins with 1 free, the one filled last
    assert bins.add(6, 6) is None and bins.count == 3
    assert bins.add(8, 8) == [0, (7, 0), (2, 7)]  # nothing fits and no place is free: a fullest bin closes
    assert bins.add(10, 10)[1:] == [(10, 0)] and bins.count == 3
    assert sorted(box[1:] for box in bins.rest()) == [[(6, 0)], [(8, 0)], [(9, 0)]]
