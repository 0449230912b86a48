"""Operators 11, 12 and 13 against plain restatements, and their defined results."""

from __future__ import annotations

import hashlib
import random
import struct
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from llm import op11_packing as op11
from llm import op12_whitening as op12
from llm import op13_merkle_manifest as op13

DOC = "doc_id long, text string, lang string, source string, n_chars long"

# -- 11 -------------------------------------------------------------------------------------------


def _plain_best_fit(sizes, capacity, most):
    """Bins by trying every open one."""
    open_, made, out = [], 0, []  # (free, number), the latest of equal ones last
    for size in sizes:
        fit = [b for b in open_ if b[0] >= size]
        if fit:
            best = min(b[0] for b in fit)
            bin_ = [b for b in fit if b[0] == best][-1]
            open_.remove(bin_)
        else:
            bin_, made = (capacity, made), made + 1
        out.append((bin_[1], capacity - bin_[0]))
        if bin_[0] > size:
            open_.append((bin_[0] - size, bin_[1]))
        if len(open_) > most:
            least = min(b[0] for b in open_)
            open_.remove([b for b in open_ if b[0] == least][-1])
    return out


@pytest.mark.parametrize("most", [1, 3, 50])
def test_best_fit(most):
    rng = random.Random(most)
    sizes = [rng.choice([rng.randint(1, 100), rng.randint(1, 12), 100]) for _ in range(3000)]
    fit = op11.BestFit(100, most)
    got = [fit.add(s) for s in sizes]
    assert [g[:2] for g in got] == _plain_best_fit(sizes, 100, most)
    assert fit.open <= most and len([g for g in got if g[2] is not None]) + fit.open == fit.made


TEXTS = ["Hello, World! it's 2024-05-17, (90's) don't 'save ,'s -'s x'1 l'll", "", "   \n\t ", None, "a<|endoftext|>b <|ENDOFTEXT|> <|startoftext|>,x|y",
         "naıve İstanbul Straße ΑΣ é 1̸ ,̸ a ́b ÉTÉ", "你好世界。123१२ 한국어",
         "a b c\x1cd\x85e", "x" * 5000 + "é" * 300 + "9" * 200, "one two three four " * 40, "\U0001f600\U0001f468‍\U0001f469 ok", "Fuss̈e,züge.b"]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path(op11.TOKENIZER))


def _ids(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("block", [7, 64, 1 << 20])
def test_words_give_the_tokenizers_ids(tokenizer, block):
    texts = TEXTS + ["".join(random.Random(i).choices("aB'9,|<> \n-é́ß你x", k=60)) for i in range(300)]
    words, got = op11.Words(op11.TOKENIZER), defaultdict(list)
    ends = []
    for row, ids, end in op11.fragments(pa.array(texts), words, block):
        got[row] += ids.tolist()
        ends += [row] * end
    assert ends == list(range(len(texts)))
    for row, text in enumerate(texts):
        assert got[row] == _ids(tokenizer, text), text


def test_forgotten_words_are_encoded_again(tokenizer, monkeypatch):
    monkeypatch.setattr(op11, "KEPT_WORDS", 3)
    words = op11.Words(op11.TOKENIZER)
    for text in ("a b c d e f g", "h a b", "c d x"):
        assert [i for _, ids, _ in op11.fragments(pa.array([text]), words) for i in ids.tolist()] == _ids(tokenizer, text)
    words._forget(words.kept)


def test_other_tokenizers_encode_whole_texts():
    name = "byte_bpe_50k.json"
    whole, words = Tokenizer.from_file(public_tokenizers.path(name)), op11.Words(name)
    assert not words.by_word
    texts = [t for t in TEXTS if t != ""] + [""]
    got = defaultdict(list)
    for row, ids, _ in op11.fragments(pa.array(texts), words):
        got[row] += ids.tolist()
    assert [got[i] for i in range(len(texts))] == [_ids(whole, t) for t in texts]


def _check_packing(rows, docs, tokenizer, capacity):
    want = sorted((doc_id is not None, doc_id or 0, i, s, len(ids[s:s + capacity]), zlib.crc32(struct.pack(f"<{len(ids[s:s + capacity])}I", *ids[s:s + capacity])))
                  for doc_id, text in docs for ids in [_ids(tokenizer, text) + [1]] for i, s in enumerate(range(0, len(ids), capacity)))
    assert sorted((r.doc_id is not None, r.doc_id or 0, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    held = defaultdict(list)
    for r in rows:
        held[r.sequence_id].append((r.offset, r.length))
    for parts in held.values():
        parts.sort()
        assert [o for o, _ in parts] == [sum(n for _, n in parts[:i]) for i in range(len(parts))] and sum(n for _, n in parts) <= capacity
    return len(held)


def test_packing_of_odd_rows(spark, tokenizer):
    long_text = "alpha beta, gamma 12. " * 4000
    docs = [*enumerate(TEXTS), (100, long_text), (100, long_text), (100, "again"), (None, "no id"), (None, None)]
    # a text whose tokens and end id are exactly two sequences
    docs.append((101, "the " * 63))
    df = spark.createDataFrame([(d, t, "x", 5, "s") for d, t in docs], "doc_id long, text string, ids string, length int, sequence_id string")
    got = op11.pack(df, capacity=32, open_bins=4).collect()
    _check_packing(got, docs, tokenizer, 32)
    assert op11.pack(df.where("false")).count() == 0
    assert op11.pack(df.where("doc_id = 1")).collect()[0].length == 1


def test_packing_rounds_fill_sequences(spark, tokenizer):
    rng = random.Random(3)
    docs = [(i, " ".join(rng.choices(["the", "a", "cat", "of", "and"], k=rng.randint(0, 90)))) for i in range(3000)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(40)
    least = -(-sum(len(_ids(tokenizer, t)) + 1 for _, t in docs) // 64)
    for open_bins, most in ((2, 1.1), (64, 1.02)):  # 40 tasks with 2 open sequences each: more than one round
        got = op11.pack(df, capacity=64, open_bins=open_bins)
        assert _check_packing(got.collect(), docs, tokenizer, 64) <= most * least + 1


def test_whole_sequences(spark, tokenizer):
    docs = [(i, "the cat " * (i % 7) + "x" * (i % 3)) for i in range(60)]
    packed = op11.pack(spark.createDataFrame(docs, "doc_id long, text string"), capacity=16, keep_ids=True)
    whole = op11.sequences(packed).collect()
    assert all(len(s.ids) == s.length <= 16 for s in whole)
    ends = sorted(i for s in whole for i in s.ids)
    assert ends == sorted(i for _, t in docs for i in [*_ids(tokenizer, t), 1])
    starts = {(r.sequence_id, r.offset): r for r in packed.collect()}
    for s in whole:
        at = 0
        for d in s.doc_ids:
            r = starts[s.sequence_id, at]
            assert r.doc_id == d and s.ids[at:at + r.length] == r.ids
            at += r.length


# -- 12 -------------------------------------------------------------------------------------------

SPECTRA = {"spread": np.linspace(1, 2, 30), "clustered": np.concatenate([3 + 1e-9 * np.arange(8), np.linspace(1, 2, 20)]),
           "two scales": np.concatenate([1 + 1e-12 * np.arange(4), 5 + 1e-8 * np.arange(3), np.linspace(6, 7, 9)]),
           "equal": np.concatenate([np.ones(5), np.full(3, 4.0), [9, 8]]), "flat": np.concatenate([np.zeros(6), [2, 1]])}


@pytest.mark.parametrize("name", SPECTRA)
def test_refined_eigenvectors(name):
    values = SPECTRA[name]
    q = np.linalg.qr(np.random.default_rng(1).standard_normal((len(values),) * 2))[0].astype(np.longdouble)
    for _ in range(2):
        q = q + q @ (np.eye(len(values)) - q.T @ q) / 2
    a = (q * values) @ q.T
    a = (a + a.T) / 2
    e, x = op12.eigen(a)
    wide = x.astype(np.longdouble)
    assert (np.diff(e) <= 0).all() and np.abs(e - np.sort(values)[::-1]).max() < 1e-14 * values.max()
    assert np.abs(a @ wide - wide * e).max() < 1e-14 * values.max() and np.abs(wide.T @ wide - np.eye(len(values))).max() < 1e-15
    if name in ("spread", "clustered"):  # float64 alone has the cluster's vectors to 1e-7
        best = q[:, np.argsort(-values)].astype(np.float64)
        assert np.minimum(np.abs(x - best).max(axis=0), np.abs(x + best).max(axis=0)).max() < 1e-9


def test_one_iteration_is_not_enough_from_single_precision():
    a = np.diag(np.linspace(1, 2, 10)).astype(np.longdouble) + np.longdouble(0.1)
    x = np.linalg.eigh(a.astype(np.float32))[1].astype(np.longdouble)
    first, _, moved = op12.refine(a, x)
    assert 1e-9 < moved < 1e-4 and op12.refine(a, first)[2] < 1e-9


def _whitened_plainly(vectors):
    x = np.floor(256 * np.array(vectors, float)).astype(np.int64)
    fit = np.unique(x, axis=0)
    n, s = len(fit), fit.sum(axis=0)
    w, v = np.linalg.eigh(np.cov(fit.T.astype(float), bias=True))
    w, v = w[::-1], v[:, ::-1]
    return n, ((n * x - s) ** 2).sum(axis=1), (x - s / n) @ v[:, :4] / np.sqrt(w[:4]), w[:4] / w.sum()


def test_whitening_of_odd_rows(spark):
    rng = np.random.default_rng(2)
    eight = (rng.standard_normal((300, 8)) * np.arange(1, 9)).astype(np.float32).tolist()
    two = rng.standard_normal((40, 2)).astype(np.float32).tolist()
    rows = [(i, v) for i, v in enumerate(eight)] + [(1000 + i, v) for i, v in enumerate(eight[:150])] + [(2000 + i, v) for i, v in enumerate(two)]
    odd = [(-1, None), (-2, [1.0, None]), (-3, [float("nan")] * 8), (-4, [float("inf")] * 2), (-5, [])]
    df = spark.createDataFrame([(i, v, "n", 1.0) for i, v in rows + odd + [(None, eight[0])]],
                               "vec_id long, embedding array<float>, x string, n double").repartition(5)
    got = op12.whiten(df).collect()
    assert {r.vec_id for r in got} == {i for i, _ in rows} | {None}
    assert {r.component for r in got if r.vec_id == 2000} == {1, 2} and len([r for r in got if r.vec_id == 3]) == 4
    by = {(r.vec_id, r.component): r for r in got}
    for ids, vectors in (([i for i, v in rows if len(v) == 8], eight + eight[:150]), ([i for i, v in rows if len(v) == 2], two)):
        n, deviation, w, explained = _whitened_plainly(vectors)
        for k in range(w.shape[1]):
            mine = np.array([by[i, k + 1].whitened for i in ids])
            assert min(np.abs(mine - w[:, k]).max(), np.abs(mine + w[:, k]).max()) < 1e-9
            assert {by[i, k + 1].n for i in ids} == {n} and abs(by[ids[0], k + 1].explained - explained[k]) < 1e-12
            assert by[ids[0], k + 1].identity_error < 1e-12
        assert [int(by[i, 1].deviation) for i in ids] == deviation.tolist()
    assert op12.whiten(df.where("false")).count() == 0


def test_whitening_without_variance(spark):
    one = spark.createDataFrame([(1, [0.5, 0.25, -1.0]), (2, [0.5, 0.25, -1.0])], "vec_id long, embedding array<double>")
    got = op12.whiten(one).collect()
    assert len(got) == 6 and {(r.n, int(r.deviation), r.whitened, r.explained, r.identity_error) for r in got} == {(1, 0, None, None, None)}
    line = spark.createDataFrame([(i, [float(i), float(i)]) for i in range(5)], "vec_id long, embedding array<double>")
    got = op12.whiten(line).collect()
    assert all((r.whitened is None) == (r.component == 2) and abs(r.explained - (r.component == 1)) < 1e-12 for r in got)
    assert abs([r.whitened for r in got if (r.vec_id, r.component) == (0, 1)][0]) == pytest.approx(2 ** 0.5)


def test_whitening_of_huge_entries(spark):
    rows = [(0, [1e300, 1.0]), (1, [-1e300, 2.0]), (2, [2.0 ** 54, 3.0]), (3, [-0.0, 1e-9]), (4, [0.0, 4.0])]
    got = {(r.vec_id, r.component): r for r in op12.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    x = np.array([[2 ** 63 - 1, 256], [-2 ** 63, 512], [2 ** 62, 768], [0, 0], [0, 1024]], object)
    s = x.sum(axis=0)
    exact = [int(((5 * row - s) ** 2).sum()) for row in x]
    assert [got[i, 1].deviation for i in range(5)] == [None if d >= 10 ** 38 else d for d in exact]
    assert all(np.isfinite(got[i, 1].whitened) for i in range(5))


def test_deviations_are_exact_for_many_rows():
    rng = np.random.default_rng(4)
    x = rng.integers(-300, 300, (50, 16))
    for n in (10, 10 ** 6, 10 ** 9, 10 ** 11):
        sums = [int(v) for v in rng.integers(-200 * n, 200 * n, 16)]
        centre = np.array([(2 * s + n) // (2 * n) for s in sums], np.int64)
        m = op12.Model(n, sums, centre, np.eye(16), np.ones(16), 1.0)
        want = [sum((n * int(a) - s) ** 2 for a, s in zip(row, sums)) for row in x]
        assert [int(d) for d in op12.deviations(x, m).to_pylist()] == want


# -- 13 -------------------------------------------------------------------------------------------


def _hash(text):
    return hashlib.sha256(text.encode()).hexdigest()


def _leaf(r, text):
    return _hash("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (r[0], r[3], r[2], r[4], text)))


def _tree(nodes):
    paths, groups = [[] for _ in nodes], [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        for at in range(0, len(nodes), 8):
            run = nodes[at:at + 8]
            for j, below in enumerate(groups[at:at + 8]):
                for i in below:
                    paths[i].append(("".join(run[:j]), "".join(run[j + 1:])))
        groups = [sum(groups[at:at + 8], []) for at in range(0, len(nodes), 8)]
        nodes = [_hash("".join(nodes[at:at + 8])) for at in range(0, len(nodes), 8)]
    return nodes[0], paths


def _manifest(rows):
    own = []
    for lang in sorted({r[2] for r in rows}, key=lambda v: (v is not None, (v or "").encode())):
        part = sorted((r for r in rows if r[2] == lang), key=lambda r: (r[0] is not None, r[0] or 0, _leaf(r, r[1])))
        leaves = [_leaf(r, r[1]) for r in part]
        own.append((part, leaves, *_tree(leaves)))
    root, tops = _tree([o[2] for o in own])
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    out = []
    for (part, leaves, subroot, paths), top in zip(own, tops):
        for r, leaf, path in zip(part, leaves, paths):
            node = leaf
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0 and r[1] is not None:
                node = _leaf(r, r[1].translate(lower))
            for a, b in path + top:
                node = _hash(a + node + b)
            out.append((r[0], leaf, subroot, root, _hash("".join(a + b for a, b in path + top)), node, node == root))
    return out


def _odd_documents(seed=1):
    rng = random.Random(seed)
    rows = [(i, f"Text {i} Ä你" if i % 5 else "", "en", f"s{i % 3}", i) for i in range(700)]  # more than one block
    rows += [(rng.randrange(50), rng.choice([None, "", "ABC", "abc"]), rng.choice([None, "", "de", "\U0001f600", "￿"]), None, None) for _ in range(150)]
    rows += [(None, "same", "fr", "s", 1)] * 9 + [(7, None, "fr", "s", 1)] * 3 + [(8, "X" * 100_000, "lone", None, 2)]
    return rows + [(i, "Part", f"lang{i}", "s", 0) for i in range(70)]  # more langs than a run of runs


def _run(df):
    lowered = {"text": F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")}
    third = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0, F.lit(False))
    return op13.verified(op13.manifest(df, altered=lowered, where=third))


def _sorted(rows):
    return sorted(map(tuple, rows), key=lambda r: (r[0] is not None, r[0] or 0, *r[1:]))


def test_manifest_of_odd_rows(spark):
    rows = _odd_documents()
    df = spark.createDataFrame([(*r, "p", 1, "h") for r in rows], f"{DOC}, part string, rank int, hash string").repartition(7)
    got = _run(df)
    assert _sorted(got.collect()) == _sorted(_manifest(rows))


@pytest.mark.parametrize("n", [1, 2, 8, 9, 512, 513])
def test_manifest_heights(spark, n):
    rows = [(i, f"T{i}", "en", "s", i) for i in range(n)]
    assert _sorted(_run(spark.createDataFrame(rows, DOC)).collect()) == _sorted(_manifest(rows))


def test_manifest_of_nothing(spark):
    assert _run(spark.createDataFrame([], DOC)).count() == 0


def test_proofs_hold_for_the_rows_alone(spark):
    rows = [(i, f"T{i}", "en" if i % 3 else "de", "s", i) for i in range(40)]
    proofs = op13.manifest(spark.createDataFrame(rows, DOC))
    kept = op13.verified(proofs).collect()
    assert all(r.verified for r in kept)
    wrong = op13.verified(proofs.withColumn("path", F.reverse("path"))).collect()
    assert not any(r.verified for r in wrong)
    plan = proofs._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan  # paths come from nested rows, not from joins
