"""Operators on whole texts against plain restatements, and their defined edge cases."""

from __future__ import annotations

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import llm.exchange as exchange
from llm.op1_substring_dedup import WINDOW, remove_repeats
from llm.op4_decontamination import contamination, proximity_matches
from llm.op6_quality import CHUNK, accepted, chunk_starts, fit, held_out, learn
from llm.op7_ngram_join import MARKS, keep_one, parities, similar_sets
from llm.op10_lm_scoring import K, MU, _sum as add_counts, cross_entropy_difference, pack_counts, unpack_counts
from llm.textnp import pack_sorted, pack_values, unpack_sorted, unpack_values

DOCS = "doc_id long, text string"
SPACE = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(autouse=True)
def small_chunks(monkeypatch):
    """Many chunks and buckets even for a handful of texts."""
    monkeypatch.setattr(exchange, "CHUNK_BYTES", 2000)


def make_docs(seed: int = 1, n: int = 60) -> list[tuple]:
    """Texts over a small vocabulary with copies, near copies, shared passages, runs and odd white space."""
    rng = random.Random(seed)
    vocab = ["the", "of", "and", "É", "été", "Großes", "a", "b"] + [f"w{i}" for i in range(40)]
    passage = [rng.choice(vocab) for _ in range(30)]
    base = [rng.choice(vocab) for _ in range(80)]
    out: list[tuple] = []
    for i in range(n):
        words = [rng.choice(vocab) for _ in range(rng.choice([0, 1, 5, 13, 14, 60, 120]))]
        kind = i % 6
        if kind == 1:
            at = rng.randrange(len(words) + 1)
            words[at:at] = passage[rng.randrange(8):]
        elif kind == 2:
            words = list(base)
            for _ in range(rng.randrange(4)):
                words[rng.randrange(len(words))] = rng.choice(vocab)
        elif kind == 3:
            words = ["x"] * rng.randrange(40) + words + ["x"] * 20
        elif kind == 4 and out:
            words = SPACE.findall(out[rng.randrange(len(out))][1] or "")
        sep = rng.choice([" ", "  ", "\n", "\t ", "  "])
        out.append((rng.randrange(10_000) if i % 7 else i, sep.join(words)))
    ids = {}
    return [(ids.setdefault(d, d), t) for d, t in out] + [(None, "null id text"), (5, None), (6, ""), (7, " \n "), (5, "again 5")]


def removed(docs: list[tuple]) -> collections.Counter:
    inf = 1 << 63
    least: dict = {}
    split = [(inf if d is None else d, SPACE.findall(t or "")) for d, t in docs]
    for d, w in split:
        for i in range(len(w) - WINDOW + 1):
            k = tuple(w[i:i + WINDOW])
            least[k] = min(least.get(k, inf), d)
    out = collections.Counter()
    for (d, w), (raw, _) in zip(split, docs):
        gone = set()
        for i in range(len(w) - WINDOW + 1):
            if least[tuple(w[i:i + WINDOW])] < d:
                gone |= set(range(i, i + WINDOW))
        kept = " ".join(x for j, x in enumerate(w) if j not in gone)
        out[raw, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest(), kept] += 1
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_substring_dedup(spark, seed):
    docs = make_docs(seed)
    got = remove_repeats(spark.createDataFrame(docs, DOCS).withColumn("kept", F.lit(1)).repartition(3)).collect()
    assert collections.Counter(tuple(r) for r in got) == removed(docs)


def test_substring_dedup_runs_and_empty(spark):
    run = [(3, "z " * 50), (1, "z " * 20 + "end"), (2, "q " + "z " * 13)]
    got = {r["doc_id"]: r["n_removed"] for r in remove_repeats(spark.createDataFrame(run, DOCS)).collect()}
    assert got == {1: 0, 2: 13, 3: 50}
    assert remove_repeats(spark.createDataFrame([], DOCS)).count() == 0


def sets_of(docs: list[tuple], n: int) -> list[frozenset]:
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    out = []
    for _, t in docs:
        w = SPACE.findall((t or "").translate(lower))
        out.append(frozenset(tuple(w[i:i + n]) for i in range(max(1, len(w) - n + 1))) if w else frozenset())
    return out


def components(docs: list[tuple], n: int, percent: int) -> collections.Counter:
    sets, root = sets_of(docs, n), {d: d for d, _ in docs if d is not None}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    known = [(d, s) for (d, _), s in zip(docs, sets) if d is not None and s]
    for i, (a, s) in enumerate(known):
        for b, t in known[:i]:
            if 100 * len(s & t) >= percent * len(s | t):
                a2, b2 = find(a), find(b)
                root[max(a2, b2)] = min(a2, b2)
    return collections.Counter((d, len(s), None if d is None else find(d)) for (d, _), s in zip(docs, sets))


@pytest.mark.parametrize("seed,n,percent", [(1, 4, 85), (2, 5, 80), (3, 2, 50)])
def test_ngram_join(spark, seed, n, percent):
    docs = make_docs(seed)
    got = similar_sets(spark.createDataFrame(docs, DOCS).repartition(3), n, percent).collect()
    assert collections.Counter(tuple(r) for r in got) == components(docs, n, percent)


def test_ngram_join_keeps_one_row_of_each_group(spark):
    docs = [(i, "one two three four five six seven eight") for i in range(9, 3, -1)] + [(1, "else"), (None, "else"), (2, None)]
    df = spark.createDataFrame(docs, DOCS).withColumn("component_id", F.lit("own"))
    got = keep_one(df)
    assert got.columns == ["doc_id", "text", "component_id"]
    assert sorted((r[0] or 0) for r in got.collect()) == [0, 1, 2, 4]
    assert similar_sets(spark.createDataFrame([], DOCS)).count() == 0


ITEM_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def test_decontamination(spark):
    rng = random.Random(4)
    vocab = ["the", "of", "É", "é", "İstanbul", "x1"] + [f"v{i}" for i in range(30)]
    items = [(i, ",".join(rng.choice(vocab) for _ in range(rng.choice([1, 3, 10, 11, 25])))) for i in range(12)]
    items += [(3, items[3][1]), (3, "Another text of item three , with ten words or more in it"), (90, None), (91, "--"), (None, "lost item words")]
    docs = []
    for i in range(50):
        words = [rng.choice(vocab) for _ in range(rng.choice([0, 4, 30, 80]))]
        if i % 3 == 0:
            part = (rng.choice(items)[1] or "").split(",")
            words[3:3] = part[rng.randrange(3):]
        docs.append((i, rng.choice([" ", ". ", "\n-"]).join(words).upper() if i % 5 == 0 else " ".join(words)))
    docs += [(None, items[4][1]), (7, items[5][1]), (8, None), (9, ""), (10, "É " * 5), (11, "lost item words")]

    def words_of(t):
        return ITEM_WORD.findall((t or "").translate(LOWER))

    want = collections.Counter()
    for d, t in docs:
        w, hit, ids = words_of(t), set(), set()
        for item, text in items:
            iw = words_of(text)
            span = min(10, len(iw))
            for j in range(len(iw) - span + 1 if iw else 0):
                for i in range(len(w) - span + 1):
                    if w[i:i + span] == iw[j:j + span]:
                        hit |= set(range(i, i + span))
                        ids.add(None if item is None else str(item))
        names = sorted(x for x in ids if x is not None)
        want[d, len(w), len(hit), len(names), hashlib.sha256(",".join(names).encode()).hexdigest(), bool(hit)] += 1
    df = spark.createDataFrame(docs, DOCS).withColumn("hits", F.lit("own"))
    got = contamination(df, spark.createDataFrame(items, "item_id long, text string"))
    cols = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    assert collections.Counter(tuple(r) for r in got.select(*cols).collect()) == want
    none = contamination(df, spark.createDataFrame([], "item_id long, text string"))
    assert none.where("contaminated").count() == 0 and none.count() == len(docs)
    assert contamination(df.limit(0), spark.createDataFrame(items, "item_id long, text string")).count() == 0


def test_decontamination_finds_words_whose_lower_case_depends_on_their_neighbours(spark):
    docs = [(1, "ΑΒ Α.Σ. ΓΔ"), (2, "ΑΒ ΟΔΟΣ.Α ΓΔ"), (3, "none")]
    items = [(1, "Α.Σ."), (2, "ΟΔΟΣ Α")]
    got = contamination(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert sorted((r["doc_id"], r["n_words"], r["n_hit"], r["item_ids"]) for r in got) == [(1, 4, 2, ["1"]), (2, 4, 2, ["2"]), (3, 1, 0, [])]


def test_decontamination_proximity(spark):
    docs = [(1, "alpha x x beta x gamma"), (2, "alpha " + "x " * 40 + "beta gamma"), (3, "beta alpha gamma"), (4, None)]
    items = [(9, "alpha beta gamma")]
    got = proximity_matches(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, "item_id long, text string"), within=10)
    assert sorted((r[0], r[1], r[2], r[3]) for r in got.collect()) == [(1, "9", 0, 5), (3, "9", 0, 2)]


def test_chunks_cover_the_text():
    for size in (0, 1, CHUNK - 1, CHUNK, CHUNK + 1, 5 * CHUNK + 7):
        seen = np.zeros(size, bool)
        for s in chunk_starts(size):
            seen[s:s + CHUNK] = True
        assert seen.all()


def test_quality_learns_and_passes_columns_through(spark):
    rng = random.Random(5)
    docs = []
    for i in range(240):
        words = [rng.choice(["stone", "river", "a", "of", "light", "walks"]) for _ in range(rng.choice([3, 60, 400]))]
        docs.append((i, " ".join(words) + "." if i % 3 else "!! ".join(w.upper() for w in words), i))
    docs += [(1000, None, 0), (1001, "", 0), (None, "light walks a river.", 0)]
    df = spark.createDataFrame(docs, DOCS + ", score int")
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(240)] + [(3, None), (None, 1)], "doc_id long, quality int")
    w = learn(df, labels, max_rows=150)
    kept = accepted(df, w)
    assert kept.columns == ["doc_id", "text", "score"]
    got = {r[0] for r in kept.where("doc_id < 1000").collect()}
    out = [i for i in range(240) if zlib.crc32(str(i).encode()) % 4 == 2]
    assert sum((i in got) == (i % 3 > 0) for i in out) >= 0.95 * len(out)
    assert {r[0] for r in df.where(held_out(F.col("doc_id"))).collect()} == {d for d, _, _ in docs if d is not None and zlib.crc32(str(d).encode()) % 4 == 2}
    # no labels: neutral, nothing fails
    blank = learn(df, labels.limit(0))
    assert accepted(df, blank, 0.5).count() == len(docs)
    assert accepted(df.limit(0), blank).count() == 0


def test_quality_fit_is_deterministic():
    rng = np.random.default_rng(0)
    x = rng.integers(97, 123, (40, CHUNK), dtype=np.uint8)
    x[::2, ::3] = 33
    y = np.arange(40) % 2
    a, b = (fit(x, y.astype(np.float32), np.ones(40), steps=60) for _ in range(2))
    assert all((a[k] == b[k]).all() for k in a)


def lm_scores(docs: list[tuple], target: set) -> list[tuple]:
    import math

    split = [(d, SPACE.findall(t or "")) for d, t in docs]

    def counts(rows):
        uni, bi = collections.Counter(), collections.Counter()
        for _, w in rows:
            uni.update(w)
            bi.update(zip(w, w[1:]))
        return uni, bi, sum(uni.values())

    out = []
    for i, (d, w) in enumerate(split):
        rest = split[:i] + split[i + 1:]
        u_b, b_b, n_b = counts(rest)
        u_t, b_t, n_t = counts([r for r in rest if r[0] in target])
        any_target = any(r[0] in target and r[1] for r in split)
        loss, scored = [0.0, 0.0], 0
        for j, x in enumerate(w):
            if not u_b[x]:
                continue
            scored += 1

            def p_all(y):
                return (u_b[y] or 1) / max(n_b, 1)

            def p_target(y):
                return (u_t[y] + MU * p_all(y)) / (n_t + MU)
            pa, pt = p_all(x), p_target(x)
            if j:
                v = w[j - 1]
                pa, pt = (b_b[v, x] + K * pa) / (u_b[v] + K), (b_t[v, x] + K * pt) / (u_t[v] + K)
            loss[1] -= math.log(pa)
            loss[0] -= math.log(pt)
        score = (loss[0] - loss[1]) / max(scored, 1) if any_target else 0.0
        out.append((-1 if d is None else d, len(w), scored, round(score, 9) + 0.0))
    return sorted(out)


def test_lm_scores(spark):
    docs = make_docs(6, 40)
    ids = spark.createDataFrame([(d,) for d, _ in docs[::3] if d is not None] + [(None,), (123456,)], "id long")
    target = {d for d, _ in docs[::3] if d is not None}
    got = cross_entropy_difference(spark.createDataFrame(docs, DOCS).withColumn("score", F.lit(0)), ids).collect()
    have = sorted((-1 if r["doc_id"] is None else r["doc_id"], r["n_words"], r["n_scored"], round(r["score"], 9) + 0.0) for r in got)
    for a, b in zip(have, lm_scores(docs, target), strict=True):
        assert a[:3] == b[:3] and a[3] == pytest.approx(b[3], abs=1e-7)
    none = cross_entropy_difference(spark.createDataFrame(docs, DOCS), ids.limit(0)).collect()
    assert {r["score"] for r in none} == {0.0}
    assert cross_entropy_difference(spark.createDataFrame([], DOCS), ids).count() == 0


def test_packed_numbers_round_trip():
    rng = np.random.default_rng(1)
    for n in (0, 1, 7, 1000):
        x = np.sort(rng.integers(0, 2 ** 64, n, dtype=np.uint64))
        assert (unpack_sorted(pack_sorted(x)) == x).all()
        v = rng.integers(-2 ** 63, 2 ** 63 - 1, n, dtype=np.int64)
        assert (unpack_values(pack_values(v)) == v).all()
        assert (unpack_values(pack_values(v % 1000)) == v % 1000).all()


def test_ngram_join_of_one_large_group_of_near_copies(spark):
    rng = random.Random(11)
    base = [f"w{i}" for i in range(90)]
    docs = []
    for i in range(260):
        words = base[:]
        for _ in range(rng.randrange(9)):
            words[rng.randrange(len(words))] = f"x{rng.randrange(400)}"
        docs.append((i, " ".join(words)))
    got = similar_sets(spark.createDataFrame(docs, DOCS).repartition(5), 5, 80).collect()
    want = components(docs, 5, 80)
    assert len({c for _, _, c in want}) > 3 and collections.Counter(tuple(r) for r in got) == want


def test_parities_never_exceed_the_difference():
    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(0, 2 ** 63, rng.integers(1, n)).astype(np.uint64)) for n in (2, 5, 60, 400, 3000)]
    sets += [np.unique(np.concatenate([s[: len(s) // 2], rng.integers(0, 2 ** 63, 7).astype(np.uint64)])) for s in sets]
    marks = parities(np.repeat(np.arange(len(sets)), [len(s) for s in sets]), np.concatenate(sets), len(sets))
    assert marks.shape == (10, MARKS // 64)
    for a, x in zip(sets, marks):
        for b, y in zip(sets, marks):
            bits = sum(bin(int(v) & (1 << 64) - 1).count("1") for v in x ^ y)
            differ = len(np.setxor1d(a, b))
            assert bits <= differ and (bits - differ) % 2 == 0


def test_counts_above_four_thousand_million():
    counts = np.array([[3 * 10 ** 9, 10], [1, 0]], np.int64)
    group = pa.table({"bucket": [0, 0], "chunk": [0, 1], "round": [1, 1], "keys": [pack_sorted(np.array([5, 9], np.uint64))] * 2,
                      "vals": [pack_counts(counts)] * 2})
    for answer in add_counts(group)["vals"].to_pylist():
        assert unpack_counts(answer).tolist() == [[6 * 10 ** 9, 20], [2, 0]]
