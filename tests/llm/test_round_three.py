"""Centroid clustering, filter audit and language-model scoring against brute force."""

import collections
import hashlib
import math
import zlib
from itertools import permutations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from stratalake.llm import centroids, filter_audit, lm_score, queries

SMALL = "/root/testdata/sf0.001"

# 11 centroid clustering


def brute_clusters(rows, k, rounds, scale, components):
    """The same clustering with Python integers and without a tree."""
    kept = [(i, [math.floor(x * scale) if abs(x) < 2.0 ** 900 else int(x) * scale for x in v]) for i, v in rows
            if v is not None and len(v) == components and all(x is not None and math.isfinite(x) for x in v)]
    key = lambda i: hashlib.sha256(f"1:{'null' if i is None else i}".encode()).hexdigest()
    found = [list(v) for _, v in sorted(kept, key=lambda r: (key(r[0]), r[1]))[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(found))

    for _ in range(rounds):
        own = collections.defaultdict(list)
        for _, v in kept:
            own[nearest(v)[1]].append(v)
        found = [[sum(x) // len(x) for x in zip(*own[n])] if own[n] else c for n, c in enumerate(found)]
    each = [(i, *nearest(v)[::-1]) for i, v in kept]
    inertia = collections.Counter()
    for _, c, d in each:
        inertia[c] += d
    total = sum(inertia.values())
    fits = lambda d: d if d < 1 << 63 else None
    # an inertia is unknown where one of its distances is
    holes = {c for _, c, d in each if d >= 1 << 63}
    return sorted(((i, c, fits(d), None if c in holes else fits(inertia[c]), None if holes else fits(total),
                    hashlib.sha256(",".join(map(str, found[c])).encode()).hexdigest()) for i, c, d in each),
                  key=lambda r: (r[0] is None, *map(str, r)))


def clustered(spark, rows, k=5, rounds=3, scale=64, components=4):
    df = spark.createDataFrame(rows, "vec_id long, vector array<double>").withColumn("cluster", F.lit("x")) \
        .withColumn("place.value", F.lit(1))
    got = [tuple(r) for r in centroids.cluster(df, k, rounds, scale, components).collect()]
    return sorted(got, key=lambda r: (r[0] is None, *map(str, r)))


@pytest.mark.parametrize("seed,size", [(1, 1.0), (2, 40.0), (3, 0.02)])
def test_clusters_equal_brute_force(spark, seed, size):
    """Small scales give many equal distances, which the smaller centroid wins."""
    rng = np.random.default_rng(seed)
    rows = [(i, [float(x) for x in rng.normal(0, size, 4)]) for i in range(150)]
    rows += [(7, rows[7][1]), (None, [0.0] * 4), (None, [1.0, 0.0, 0.0, 0.0]), (900, None), (901, [1.0]), (902, [None, 1.0, 1.0, 1.0]),
             (903, [float("nan"), 0.0, 0.0, 0.0]), (904, [float("inf"), 0.0, 0.0, 0.0]), (905, [])]
    assert clustered(spark, rows) == brute_clusters(rows, 5, 3, 64, 4)


def test_clusters_of_huge_components_are_exact(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in rng.normal(0, 10.0 ** rng.integers(0, 300), 4)]) for i in range(60)]
    rows += [(100, [1.7e308, -1.7e308, 0.0, 1.0])]
    assert clustered(spark, rows, k=6) == brute_clusters(rows, 6, 3, 64, 4)


def test_few_or_no_vectors(spark):
    rows = [(3, [1.0, 2.0, 3.0, 4.0]), (4, [1.0, 2.0, 3.0, 4.0])]
    assert clustered(spark, rows) == brute_clusters(rows, 5, 3, 64, 4)
    assert clustered(spark, []) == [] and clustered(spark, [(1, None)]) == []


def test_the_tree_is_exact_and_prunes():
    rng = np.random.default_rng(8)
    middle = rng.integers(-4000, 4000, (16, 8))
    points = np.repeat(middle, 4, axis=0) + rng.integers(-9, 9, (64, 8))
    rows = points[rng.integers(0, 64, 500)] + rng.integers(-9, 9, (500, 8))
    tree = centroids.Tree(points.tolist())
    cluster, distance, work = tree.nearest(rows.astype(np.int64))
    full = ((rows[:, None, :] - points[None]) ** 2).sum(axis=2)
    assert (cluster == full.argmin(axis=1)).all() and (distance == full.min(axis=1)).all()
    assert work < 500 * 64 / 3
    # equal centroids on the pruning radius: the smaller number wins
    line = centroids.Tree([[x] for x in (0, 10, 20, 30, 10, 40, 0, 50)])
    cluster, _, _ = line.nearest(np.array([[5], [10], [15], [25], [45], [-3]]))
    assert cluster.tolist() == [0, 1, 1, 2, 5, 0]


@pytest.mark.parametrize("value", [0, 1, -1, (1 << 40) - 1, 1 << 40, -(1 << 41) - 5, 3 ** 500])
def test_digits_add_up(value):
    assert sum(d << centroids.DIGIT_BITS * p for p, d in centroids.digits(value)) == value


# 12 filter audit


def brute_audit(docs, labels):
    """Every order run filter by filter."""
    good, toxic = collections.defaultdict(int), collections.defaultdict(int)
    for i, q, t in labels:
        good[i] |= q == 1
        toxic[i] |= t == 1
    least = {}
    for i, text, _ in docs:
        if i is not None:
            least[text or ""] = min(i, least.get(text or "", i))
    parts = collections.defaultdict(list)
    for i, text, source in docs:
        text = text or ""
        words = text.encode().split()
        fails = "".join(f for f, bad in zip("ABCDE", (
            len(words) < 200, 100 * len(set(words)) < 50 * len(words),
            100 * sum("A" <= c <= "Z" for c in text) > 2 * len(text), any(c in "#$%&*|" for c in text),
            i is not None and i > least[text])) if bad)
        parts[source or ""].append((fails, i is not None and good[i], i is not None and toxic[i]))
    out = []
    for part, rows in parts.items():
        gone = collections.Counter()
        own = []
        for order in permutations("ABCDE"):
            left = rows
            for step, f in enumerate(order, 1):
                here = [r for r in left if f in r[0]]
                left = [r for r in left if f not in r[0]]
                gone[f] += len(here)
                own.append((part, "".join(order), step, len(left), len(here), sum(f in r[0] for r in rows) - len(here),
                            sum(r[0] == f for r in rows), sum(r[1] for r in here), sum(r[2] for r in here), f))
        out += [(*r[:-1], gone[r[-1]]) for r in own]
    return sorted(out)


def test_audit_equals_all_orders_run(spark):
    rng = np.random.default_rng(3)
    texts = [None, "", "a b c", "A B # c", " ".join(f"w{i}" for i in range(250)), "x " * 300, "x\x0by\x1cz ", "É" * 9 + "AB",
             " ".join(f"W{i}" for i in range(220)), " ".join(f"w{i}" for i in range(40_000)), "50 % off & more"]
    docs = [(int(rng.integers(0, 60)) if rng.random() < 0.9 else None, texts[rng.integers(0, len(texts))],
             (None, "", "a", "b")[rng.integers(0, 4)]) for _ in range(160)]
    docs += [(3, "A # c", "b")] * 3 + [(None, "A # c", "c")]
    labels = [(int(i), int(rng.integers(0, 2)), int(rng.integers(0, 2))) for i in rng.integers(0, 60, 50)]
    labels += [(None, 1, 1), (5, None, None), (6, 1, None)]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string")
    df = df.withColumn("mask", F.lit("x")).withColumn("n.good", F.lit(1)).withColumn("digest", F.lit(None).cast("int"))
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumn("part", F.lit("x"))
    got = sorted(tuple(r) for r in filter_audit.audit(df, marks).collect())
    assert got == brute_audit(docs, labels)


def test_audit_of_nothing(spark, no_docs):
    marks = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.audit(no_docs, marks).count() == 0


def test_shapley_by_least_squares_equals_mean_over_orders():
    rng = np.random.default_rng(4)
    removed = filter_audit.coalition_table({m: int(rng.integers(0, 50)) for m in range(32)}, 5)
    want = [0] * 5
    for order in permutations(range(5)):
        before = 0
        for f in order:
            want[f] += removed[before | 1 << f] - removed[before]
            before |= 1 << f
    assert [v * 120 for v in filter_audit.shapley(removed, 5)] == want


# 13 language-model scoring


def brute_scores(docs, train, order):
    """Counts in dictionaries, quantised alike, and the same smoothing."""
    def split(text):
        return (text or "").encode().lower().split()

    counts = collections.Counter()
    for i, text in docs:
        if train(i):
            seq = [lm_score.START] * order + split(text) + [lm_score.END]
            for j in range(order - 1, len(seq)):
                for k in range(1, order + 1):
                    counts[tuple(seq[j - k + 1:j + 1])] += 1
    unigrams = {g[0]: n for g, n in counts.items() if len(g) == 1 and g[0] != lm_score.START}
    total, types = sum(unigrams.values()), len(unigrams)
    c = lambda g: 1.5 * 2 ** (counts[g].bit_length() - 1) - 0.5 if counts[g] else 0.0
    out = []
    for i, text in docs:
        words = split(text) + [lm_score.END]
        seq = [lm_score.START] * (order - 1) + words
        base = sum(math.log10((unigrams.get(w, 0) + 1) / (total + types + 1)) for w in words)
        logs = 0.0
        for j in range(order - 1, len(seq)):
            p = min(1.0, (c((seq[j],)) + 1) / (total + types + 1))
            for k in range(2, order + 1):
                gram = tuple(seq[j - k + 1:j + 1])
                p = (c(gram) + lm_score.MU * p) / (max(c(gram[:-1]), c(gram)) + lm_score.MU)
            logs += math.log10(p)
        out.append((i, len(words), sum(w in unigrams for w in words), total, base, logs))
    return sorted(out, key=lambda r: (r[0] is None, *map(str, r)))


def held_in(i):
    return (0 if i is None else zlib.crc32(str(i).encode()) % 7) != 2


def scored(spark, docs, order=lm_score.ORDER, key_bits=lm_score.BITS):
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("words", F.lit("x")) \
        .withColumn("levels.digest", F.lit(1)).withColumn("train", F.lit(False))
    got = [tuple(r) for r in lm_score.score(df, lm_score.fit(df, queries.fold(7) != 2, order, key_bits)).collect()]
    return sorted(got, key=lambda r: (r[0] is None, *map(str, r)))


def close(got, want):
    assert [r[:4] for r in got] == [r[:4] for r in want]
    for a, b in zip(got, want):
        assert a[4:] == pytest.approx(b[4:], rel=1e-9, abs=1e-9)


ODD = [None, "", " \t\x0b", "a", "A b\x1cc  a", "É é", "the cat sat on the mat", "the cat sat on the dog", "the dog"]


@pytest.mark.parametrize("order", [1, 2, 3])
def test_scores_equal_dictionaries(spark, order):
    """With many bits a key the filter errs on none of these n-grams."""
    rng = np.random.default_rng(order)
    docs = [(int(i), ODD[rng.integers(0, len(ODD))]) for i in rng.integers(0, 200, 150)]
    docs += [(None, "the cat"), (None, "the cat"), (None, None), (5, "x " * 30_000), (2, "the end")]
    close(scored(spark, docs, order, 300), brute_scores(docs, held_in, order))


def test_scores_do_not_depend_on_rounds_slices_or_head(spark, monkeypatch):
    rng = np.random.default_rng(9)
    docs = [(i, " ".join(f"w{int(x)}" for x in rng.zipf(1.4, 60) % 400)) for i in range(120)]
    monkeypatch.setattr(lm_score, "HEAD_WORDS", 16)
    monkeypatch.setattr(lm_score, "SLICE_GRAMS", 500)
    want = brute_scores(docs, held_in, lm_score.ORDER)
    real = lm_score.rounds
    monkeypatch.setattr(lm_score, "rounds", lambda model: max(3, real(model, 4000)))
    close(scored(spark, docs, key_bits=300), want)


def test_nothing_to_learn_or_score(spark, no_docs):
    assert lm_score.score(no_docs, lm_score.fit(no_docs, queries.fold(7) != 2)).count() == 0
    df = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    r = lm_score.score(df, lm_score.fit(df, F.lit(False))).first()
    assert tuple(r) == (1, 3, 0, 0, 0.0, 0.0)


def test_filter_answers_are_never_too_low_and_rarely_too_high():
    rng = np.random.default_rng(1)
    known = rng.integers(0, 1 << 63, 20_000).astype(np.uint64)
    counts = rng.geometric(0.4, len(known))
    data = np.frombuffer(lm_score.build(known, lm_score.level(counts)), np.uint8)
    held = lm_score.Filters(1, 0, np.array([len(data) * 8], np.uint64), np.array([0]), data)
    found = held.levels(known)
    assert (found >= lm_score.level(counts)).all() and (found > lm_score.level(counts)).mean() < 0.02
    assert (held.levels(rng.integers(0, 1 << 63, 20_000).astype(np.uint64)) > 0).mean() < 0.02


def test_model_beats_base_on_held_out_documents(spark):
    """Documents of at least 50 tokens that the model has not seen."""
    rows = queries.op13_lm_scoring(spark, "/root/testdata/sf0.01").where("held_out AND n_tokens >= 50").collect()
    assert len(rows) > 60 and np.mean([r["score"] > r["base_score"] for r in rows]) > 0.9


def test_words_are_split_at_ascii_white_space():
    t = lm_score.tokens(pa.array(["a  B\x0bc\x0c\x1cd e", None, "", "\n"]))
    assert [t.words[c] for c in t.codes] == [b"a", b"b", b"c", "\x1cd e".encode()]
    assert t.begin.tolist() == [0, 4, 4, 4, 4]
