"""Hard negatives and clusters against brute force in whole numbers, and repetition against plain Python."""

import hashlib
import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from wattframe.llm import clusters, negatives, repetition, vectors
from wattframe.llm.common import text_steps

ODD = [None, [], [None, 1.0], [float("nan"), 1.0], [float("inf"), 0.0], [1e300, 1.0]]


def table(spark, rows):
    """rows: (id, vector, label); extra columns clash with names of the operators' own."""
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    return df.withColumns({c: F.lit(1) for c in ("id", "vector", "shard", "codes", "windows", "cluster", "distance", "rank", "asks")})


# 11


def mined(rows, is_anchor, positives=5, negs=10, share=(30, 90), scale=256):
    held = {}
    for i, v, label in rows:
        if i is None or label is None or not v or any(x is None or not math.isfinite(x) for x in v):
            continue
        whole = [math.floor(scale * x) for x in v]
        if sum(x * x for x in whole) < 2**60:
            held[i] = min(held.get(i, (label, whole)), (label, whole))
    out = []
    for a in sorted(i for i in held if is_anchor(i)):
        label, q = held[a]
        scores = [(-sum(x * y for x, y in zip(q, v, strict=True)), i, other == label) for i, (other, v) in held.items() if i != a and len(v) == len(q)]
        scores.sort()
        for s, p, _ in [x for x in scores if x[2]][:positives]:
            inside = [(n, i) for n, i, same in scores if not same and share[0] * -s <= 100 * -n <= share[1] * -s][:negs]
            out += [(a, p, rank, i, -s, -n) for rank, (n, i) in enumerate(inside, 1)]
    return out


def test_hard_negatives_by_brute_force(spark, monkeypatch):
    rng = np.random.default_rng(11)
    x = rng.normal(size=(900, 12)) / 3
    x[100:400] = x[7]  # a vector that a third of all rows share
    x[400:450] = x[7] + rng.normal(size=(50, 12)) * 0.01
    rows = [(i, v.tolist(), int(rng.integers(0, 4))) for i, v in enumerate(x)]
    rows += [(2000 + i, rng.normal(size=5).tolist(), i % 2) for i in range(60)]  # another dimension, odd
    rows += [(3000 + 10 * k, v, 1) for k, v in enumerate(ODD)] + [(None, x[0].tolist(), 1), (40, x[1].tolist(), None), (50, x[3].tolist(), 0), (50, x[3].tolist(), 0), (60, x[8].tolist(), 9), (4000, [0.0] * 12, 1), (4010, [1.0], 1)]
    want = mined(rows, lambda i: i % 10 == 0)
    for shard_rows, step in ((100, 1 << 20), (negatives.SHARD_ROWS, 300)):
        monkeypatch.setattr(negatives, "SHARD_ROWS", shard_rows)
        monkeypatch.setattr(negatives, "STEP", step)
        got = negatives.mine(table(spark, rows), F.col("vec_id") % 10 == 0)
        assert sorted(map(tuple, got.collect())) == sorted(want) and len(want) > 1000
    assert negatives.mine(table(spark, rows).limit(0), F.col("vec_id") % 10 == 0).count() == 0


def test_codes_bound_every_score_and_leave_few_rows():
    rng = np.random.default_rng(12)
    x = np.floor(256 * rng.normal(size=(3000, 64)) / 8).astype(np.int64)
    labels, ids = rng.integers(0, 10, 3000), np.arange(3000)
    for books in (negatives.fit_codebooks(x[:2000]), negatives.Books({}).of_size(64)):
        codes, residuals = negatives.encode(x, books)
        shard = negatives.Shard(books, ids, labels, x, codes, residuals)
        for n, low, high in shard.bounds(x[:40], slice(0, 3000)):
            true = shard.vectors @ x[n]
            assert (low <= true).all() and (true <= high).all()
        list(shard.positives(ids[:40], labels[:40], x[:40], 5))
        if books.any():
            assert shard.scored < 0.4 * 40 * 300, shard.scored  # of 300 rows of an anchor's label


def test_large_numbers_stay_exact(spark):
    """Products beyond 2^53 and tables beyond 2^31."""
    rng = np.random.default_rng(13)
    x = rng.integers(-(2**25), 2**25, size=(120, 6)).astype(float)
    rows = [(i, v.tolist(), i % 3) for i, v in enumerate(x)]
    got = negatives.mine(table(spark, rows), F.col("vec_id") % 4 == 0, scale=2)
    assert sorted(map(tuple, got.collect())) == sorted(mined(rows, lambda i: i % 4 == 0, scale=2)) and got.count()


# 12


def lloyd(rows, k=16, rounds=3, scale=64, size=64, seed=1):
    held = [(i, [math.floor(scale * x) for x in v]) for i, v in rows if v is not None and len(v) == size and all(x is not None and math.isfinite(x) for x in v)]
    held = [(i, v) for i, v in held if sum(x * x for x in v) < 2**60]
    start = sorted(held, key=lambda r: (hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest() if r[0] is not None else "~", r[1]))
    c = [v for _, v in start[:k]]

    def near(v):
        d = [sum((a - b) ** 2 for a, b in zip(v, m, strict=True)) for m in c]
        return d.index(min(d)), min(d)

    for _ in range(rounds):
        groups = {}
        for _, v in held:
            groups.setdefault(near(v)[0], []).append(v)
        c = [[sum(col) // len(groups[j]) for col in zip(*groups[j], strict=True)] if j in groups else m for j, m in enumerate(c)]
    found = [(i, *near(v)) for i, v in held]
    inertia = Counter()
    for _, j, d in found:
        inertia[j] += d
    return [(i, j, d, inertia[j], sum(inertia.values()), hashlib.sha256(",".join(map(str, c[j])).encode()).hexdigest()) for i, j, d in found]


@pytest.mark.parametrize("case", ["clustered", "random", "large", "few"])
def test_clusters_by_brute_force(spark, case):
    rng = np.random.default_rng(14)
    if case == "clustered":
        x = rng.normal(size=(20, 64))[rng.integers(0, 20, 500)] * 2 + rng.normal(size=(500, 64)) * 0.05
        x[:170] = x[0]  # one vector for a third of the rows: equal centroids, ties and empty clusters
    elif case == "large":
        x = rng.integers(-(2**20), 2**20, size=(100, 64)).astype(float)
    else:
        x = np.round(rng.normal(size=(300 if case == "random" else 9, 64)) / 8, 1)
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(3, x[4].tolist()), (3, x[3].tolist()), (None, x[1].tolist()), (901, [1.0] * 63), (902, [None] * 64), (903, [float("nan")] * 64), (904, None), (905, [1e300] * 64)]
    got = clusters.digests(clusters.cluster(table(spark, [(i, v, 0) for i, v in rows])))
    order = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    assert sorted(map(tuple, got.collect()), key=order) == sorted(lloyd(rows), key=order)
    assert clusters.digests(clusters.cluster(table(spark, [(1, None, 0)]))).count() == 0


def test_exponion_looks_at_few_centroids():
    rng = np.random.default_rng(15)
    middle = rng.integers(-4000, 4000, size=(50, 8))
    x = middle[rng.integers(0, 50, 5000)] + rng.integers(-50, 50, size=(5000, 8))
    first = clusters.Exponion(middle + 3)
    state = first.assign(x, np.zeros(5000, np.int32), np.full(5000, np.inf), np.zeros(5000))
    moved = clusters.Exponion(middle, middle + 3)
    cluster, upper, lower = moved.assign(x, *state)
    every = vectors.squares(x, middle)
    assert (cluster == every.argmin(axis=1)).all() and moved.scanned < 0.1 * every.size
    assert (upper >= np.sqrt(every.min(axis=1))).all() and (lower <= np.sqrt(np.sort(every, axis=1)[:, 1])).all()


# 13


def measured(text):
    words = re.findall("[^\x20\x09-\x0d]+", text or "")
    grams = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    hit = {k for i in range(len(words) - 7) if grams[tuple(words[i : i + 8])] > 1 for k in range(i, i + 8)}
    lines = [x for x in (text or "").split("\n") if re.search("[^\x20\x09-\x0d]", x)]
    longest = 0
    for n in range(8, len(words)):
        grams = [tuple(words[i : i + n]) for i in range(len(words) - n + 1)]
        if len(set(grams)) == len(grams):
            break
        longest = n
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(hit), longest), hit


def texts():
    rng = np.random.default_rng(16)
    out = [None, "", " \n", "a b\na b\n\n \n \né # <é> ü 　x", "x " * 300, "".join(f"p{i} " for i in range(120)) * 2, "".join(f"q{i} " for i in range(100)) * 2, "longtext " + "".join(f"r{i}\n" for i in range(9000))]
    for _ in range(150):
        n = int(rng.integers(0, 120))
        words = [f"w{x}" for x in rng.integers(0, int(rng.integers(1, 60)), n)]
        if n > 30 and rng.random() < 0.7:
            at = int(rng.integers(0, n - 12))
            words[at:at] = words[5 : 5 + int(rng.integers(8, 25))] * int(rng.integers(1, 4))
        out.append("".join(x + str(rng.choice(list(" \n\t "))) for x in words))
    return out


def test_repetition_by_brute_force(spark):
    rows = list(enumerate(texts()))
    rows += [rows[4], (4, "again"), (None, "no id " * 10)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit(1) for c in ("n_words", "spans", "kept", "longest_repeat")})
    got = repetition.judge(df).collect()
    key = lambda r: tuple((x is None, x) for x in r)
    want = []
    for i, t in rows:
        base, _ = measured(t)
        failed = base[0] < 20 or 100 * base[4] > 30 * base[0]
        want.append((i, *base, failed, not failed and base[5] <= repetition.MOST_LONGEST))
    assert sorted(((r.doc_id, *r[1:7], r.base_failed, r.kept) for r in got), key=key) == sorted(want, key=key)
    assert not {r.doc_id: r.kept for r in got}[4] and sum(r.kept for r in got) > 20
    assert repetition.digests(repetition.judge(df)).columns == ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    assert repetition.judge(df.limit(0)).count() == 0


def test_repeated_spans_and_maximal_repeats():
    every = texts()
    for first, data, offsets in text_steps(pa.array(every), 1 << 12):
        columns = repetition.measures(data, offsets)
        for r in range(len(offsets) - 1):
            text = every[first + r]
            words = re.findall("[^\x20\x09-\x0d]+", text or "")
            spans = columns[7][r].as_py()
            assert {k for s in spans for k in range(s["first_word"], s["end_word"])} == measured(text)[1]
            assert all(re.findall("[^\x20\x09-\x0d]+", text[s["start"] : s["end"]]) == words[s["first_word"] : s["end_word"]] for s in spans)


def test_maximal_repeats_by_definition():
    rng = np.random.default_rng(17)
    for size in (2, 3, 6):
        words = rng.integers(1, size, 90).astype(np.uint64) if size > 2 else np.tile(rng.integers(1, 9, 12), 6).astype(np.uint64)
        text = words.tolist()
        want = set()
        for n in range(8, len(text)):
            places = {}
            for i in range(len(text) - n + 1):
                places.setdefault(tuple(text[i : i + n]), []).append(i)
            for gram, at in places.items():
                left = {text[i - 1] if i else None for i in at}
                right = {text[i + n] if i + n < len(text) else None for i in at}
                if len(at) > 1 and (len(left) > 1 or None in left) and (len(right) > 1 or None in right):
                    want.add(gram)
        found = repetition.repeats(words)
        grams = [tuple(text[i : i + n]) for n, i in found.maximal]
        assert len(grams) == len(set(grams)) and set(grams) == want
        assert max(map(len, want), default=0) == found.longest.max(initial=0)
