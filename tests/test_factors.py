"""Vectors, factors, stitched walks, moves that never lower the objective, exact best products: against brute force and stated laws."""

from __future__ import annotations

import os
import random
import subprocess
import sys
from collections import Counter

import numpy as np
import pytest
from pyspark.ml.recommendation import ALS
from pyspark.sql import functions as F

from tallybook.operators import community as CM
from tallybook.operators import factor as FA
from tallybook.operators import fusion as FU
from tallybook.operators import inner_product as IP
from tallybook.operators import recommend as REC
from tallybook.operators import skipgram as SG
from tallybook.operators import textclass as TC
from tallybook.operators import walks as W
from tallybook.session import Rolling


@pytest.fixture(scope="module")
def topics(spark):
    """Documents of six topics of twelve words each; one word in ten comes from another topic."""
    rng = random.Random(1)
    words = [[f"t{k}w{i}" for i in range(12)] for k in range(6)]
    docs = [(d, [rng.choice(words[d % 6 if rng.random() < 0.9 else rng.randrange(6)]) for _ in range(30)]) for d in range(240)]
    return docs, spark.createDataFrame(docs, "doc_id long, tokens array<string>")


def neighbours(vectors, k=5):
    rows = sorted(vectors.select("word", "vector").collect())
    x = np.array([r["vector"] for r in rows])
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = x @ x.T
    np.fill_diagonal(near, -9)
    words = [r["word"] for r in rows]
    return {words[i]: {words[j] for j in np.argsort(-near[i])[:k]} for i in range(len(words))}


def purity(found):
    return np.mean([w[:2] == x[:2] for w, near in found.items() for x in near])


# ---- word vectors


def test_block_skip_gram_agrees_with_one_block(spark, topics):
    _, df = topics
    one, three = (neighbours(SG.skip_gram(df, 16, 5, 5, sample=None, seed=3, blocks=b), 11) for b in (1, 3))
    assert len(one) == len(three) == 72
    assert purity(one) > 0.97 and purity(three) > 0.95
    assert np.mean([len(one[w] & three[w]) / 11 for w in one]) > 0.9


def test_document_vectors(spark, topics):
    _, df = topics
    rows = df.limit(30).unionByName(spark.createDataFrame([(900, []), (901, None), (902, ["alone"])], df.schema))
    got = {r["doc_id"]: r["vector"].toArray() for r in TC.doc_vectors(rows, size=6, window=3, iters=1, sample=0.01).collect()}
    assert len(got) == 33 and all(len(v) == 6 for v in got.values())
    assert not got[900].any() and not got[901].any() and got[902].any()


def test_co_occurrences_and_shares(spark, topics):
    docs, df = topics
    want = Counter((t[i], t[j]) for _, t in docs for i in range(len(t)) for j in range(max(0, i - 3), min(len(t), i + 4)) if i != j)
    key = {r["word"]: r["id"] for r in SG.vocabulary(df).collect()}
    got = {(r["c"], r["x"]): r["n"] for r in SG.co_occurrences(df, "tokens", 3).collect()}
    assert got == {(key[a], key[b]): n for (a, b), n in want.items()}
    words = SG.vocabulary(df)
    total, n = sum(len(t) for _, t in docs), Counter(w for _, t in docs for w in t)
    shares = SG.kept_shares(words, 0.01)
    assert shares == {key[w]: pytest.approx(np.sqrt(0.01 * total / c)) for w, c in n.items() if c > 0.01 * total}
    less = SG.co_occurrences(df, "tokens", 3, shares, seed=1).agg(F.sum("n")).first()[0]
    assert less < sum(want.values())


def test_a_long_text_is_windowed_in_stretches(spark):
    rng = random.Random(3)
    t = [f"w{rng.randrange(50)}" for _ in range(50_300)]
    df = spark.createDataFrame([(t,)], "tokens array<string>")
    got = {(r["c"], r["x"]): r["n"] for r in SG.co_occurrences(df, "tokens", 2).collect()}
    key = {r["word"]: r["id"] for r in SG.vocabulary(df).collect()}
    want = Counter((t[i], t[j]) for i in range(len(t)) for j in range(max(0, i - 2), min(len(t), i + 3)) if i != j)
    assert got == {(key[a], key[b]): n for (a, b), n in want.items()}


# ---- factors


def dense(rows, ids, size):
    out = np.zeros((len(ids), size))
    for r in rows.collect():
        out[ids[r["id"]]] = np.frombuffer(r["vec"])
    return out


@pytest.mark.parametrize("blocks", [1, 3])
def test_factors_of_a_sparse_matrix(spark, blocks):
    rng = np.random.default_rng(5)
    a = (rng.normal(size=(40, 6)) * [9, 7, 5, 4, 3, 2]) @ rng.normal(size=(6, 25))
    a[rng.random(a.shape) < 0.4] = 0
    entries = spark.createDataFrame([(int(i), 1000 + int(j), float(a[i, j])) for i, j in zip(*np.nonzero(a), strict=True)], "i long, j long, v double")
    exact, ids = np.linalg.svd(a), {i: i for i in range(40)}
    rows, values = FA.randomized_svd(entries, 5, spare=8, power=3, blocks=blocks)
    assert values == pytest.approx(exact[1][:5], rel=1e-3)
    q = dense(rows, ids, 5)
    assert np.linalg.svd(exact[0][:, :3].T @ q)[1] == pytest.approx([1, 1, 1], abs=1e-3)
    rows, inner = FA.alternating_factors(entries, 5, 12, blocks=blocks)
    u = dense(rows, ids, 5)
    left = a - u @ np.linalg.pinv(u) @ a
    assert np.linalg.norm(left) < 1.02 * np.sqrt((exact[1][5:] ** 2).sum())
    assert inner.shape == (5, 5)


def test_word_and_node_vectors_find_the_topics(spark, topics):
    docs, df = topics
    words = FU.word_vectors(df, 12, 2)
    assert purity(neighbours(words)) > 0.97
    nodes = W.node_vectors(df.select(F.col("tokens").alias("path")), 12, 3)
    assert purity(neighbours(nodes.withColumnRenamed("key", "word"))) > 0.97
    wide = FU.word_vectors(df, 100, 2)  # more than there are words
    assert wide.count() == 72 and all(len(r["vector"]) == 100 for r in wide.collect())


# ---- walks


def law(edges, n, length, alpha):
    """Chance of each vertex after each step of a walk that starts anywhere, by start."""
    p = np.zeros((n, n))
    for a, b in edges:
        p[a, b] = 1
    p /= p.sum(axis=1, keepdims=True)
    at, out = np.eye(n), [np.eye(n)]
    for _ in range(length - 1):
        at = (1 - alpha) * at @ p + alpha * np.eye(n)
        out.append(at)
    return out


@pytest.mark.parametrize("alpha", [0.0, 0.2])
def test_stitched_walks_keep_the_law(spark, alpha):
    pairs = [(0, k) for k in range(1, 7)] + [(1, 2), (3, 4), (4, 5)]
    edges = sorted({*pairs, *((b, a) for a, b in pairs)})
    n, length, paths = 7, 13, 3000
    df = spark.createDataFrame(edges, "src long, dst long")
    walks = W.stitched_walks(df, paths, length, alpha, 5).collect()
    assert len(walks) == n * paths
    seen = np.zeros((length, n, n))
    for r in walks:
        assert len(r["path"]) == length and r["path"][0] == r["start"]
        for k, (a, b) in enumerate(zip(r["path"], r["path"][1:], strict=False), 1):
            assert (a, b) in edges or (alpha and b == r["start"])
            seen[k, r["start"], b] += 1
    want = law(edges, n, length, alpha)
    for k in range(1, length):
        assert np.abs(seen[k] / paths - want[k]).max() < 0.06  # some six standard deviations; walks may share segments
    assert [tuple(r) for r in W.stitched_walks(df, 3, length, alpha, 5).orderBy("start", "rep").collect()] == [
        tuple(r) for r in W.stitched_walks(df.repartition(3), 3, length, alpha, 5).orderBy("start", "rep").collect()]


def test_stitched_walks_end_where_there_is_no_way(spark):
    chain = spark.createDataFrame([(k, k + 1) for k in range(5)], "src long, dst long")
    got = {(r["start"], r["rep"]): r["path"] for r in W.stitched_walks(chain, 2, 4, 0.0, 1).collect()}
    assert got == {(s, r): list(range(s, min(s + 3, 5) + 1)) for s in range(6) for r in (1, 2)}
    assert all(len(r["path"]) == 1 for r in W.stitched_walks(chain, 1, 1).collect())
    back = W.stitched_walks(chain, 40, 9, 0.5, 2).collect()
    for r in back:  # a walk that has come to vertex 5 stays there
        assert all(b in (a + 1, r["start"]) and a != 5 for a, b in zip(r["path"], r["path"][1:], strict=False))
        assert len(r["path"]) == 9 or r["path"][-1] == 5
    assert W.stitched_walks(chain.limit(0), 2, 5).count() == 0


# ---- communities


@pytest.mark.parametrize("alpha", [0.0, 0.5, 1.0])
def test_rounds_of_moves_never_lower_the_objective(spark, alpha):
    rng = random.Random(4)
    group = [k // 8 for k in range(24)]
    edges = [(a, b, float(rng.randint(1, 3))) for a in range(24) for b in range(a + 1, 24) if rng.random() < (0.7 if group[a] == group[b] else 0.12)]
    e = spark.createDataFrame(edges, "src long, dst long, weight double")
    v = CM.vertices(spark.createDataFrame([(k, [1.0 + group[k], rng.random(), 2.0 - group[k]]) for k in range(24)], "id long, attrs array<double>"))
    start = v.select("id", F.col("id").alias("comm"))
    trace = []
    comm = CM.local_move(e, v, start, alpha, 4, trace)
    assert all(b >= a - 1e-9 for a, b in zip(trace, trace[1:], strict=False))
    if alpha == 1:
        assert trace[-1] == pytest.approx(CM.modularity(e, comm).first()[0])
        got = dict(map(tuple, comm.collect()))
        best = CM.modularity(e, spark.createDataFrame([(k, group[k]) for k in range(24)], "id long, comm long")).first()[0]
        assert trace[-1] > 0.7 * best and len(set(got.values())) < 12


def test_moves_of_a_round_gain_together(spark):
    """Whatever subset of harmless moves is made, modularity rises by at least the gains less the costs."""
    rng = random.Random(9)
    edges = [(a, b, 1.0) for a in range(30) for b in range(a + 1, 30) if rng.random() < (0.6 if a // 5 == b // 5 else 0.05)]
    e = spark.createDataFrame(edges, "src long, dst long, weight double")
    v = CM.vertices(spark.createDataFrame([(k, [1.0, float(k)]) for k in range(30)], "id long, attrs array<double>"))
    comm = spark.createDataFrame([(k, k // 5 if rng.random() < 0.6 else rng.randrange(6)) for k in range(30)], "id long, comm long")
    level = CM.Level(e, v)
    ties = level.ties(comm)
    stats = level.stats(comm, ties)
    best = CM.best_moves(level.gains(comm, ties, stats, 6, 1.0)).join(comm.withColumnRenamed("comm", "cur"), "id").select("id", "cur", "comm", "gain")
    good = CM.harmless(level, best, 1.0).collect()
    assert len(good) > 2
    before = CM.modularity(e, comm).first()[0]
    for _ in range(3):
        some = [r for r in good if rng.random() < 0.7] or good
        moved = CM.apply_moves(comm, spark.createDataFrame(some, "id long, comm long, gain double"))
        assert CM.modularity(e, moved).first()[0] > before


def test_ties_are_made_once_a_round_under_similarity_alone(spark, monkeypatch):
    rng = random.Random(5)
    edges = [(a, b, 1.0) for a in range(24) for b in range(a + 1, 24) if rng.random() < 0.4]
    e = spark.createDataFrame([*edges, (3, 99, 1.0), (98, 99, 1.0)], "src long, dst long, weight double")
    v = CM.vertices(spark.createDataFrame([(k, [rng.random() - 0.5 for _ in range(3)]) for k in range(24)], "id long, attrs array<double>"))
    made, ties = [], CM.Level.ties
    monkeypatch.setattr(CM.Level, "ties", lambda level, comm: made.append(level) or ties(level, comm))
    trace = []
    comm = CM.local_move(e, v, v.select("id", F.col("id").alias("comm")), 0.0, 6, trace)
    assert len(trace) > 2 and len(made) <= len(trace)
    assert made[0].both.select("id").distinct().count() == 24  # of edges between others none is kept
    parts = CM.community_similarity(v, comm).agg(F.avg("similarity"), F.count("*")).first()
    assert trace[-1] == pytest.approx(parts[0] / parts[1])


def test_move_gain_reads_its_edges_once(spark):
    read = spark.sparkContext.accumulator(0)

    def seen(x):
        read.add(1)
        return x

    e = spark.createDataFrame([(0, 1, 1.0), (1, 2, 2.0), (2, 3, 1.0), (3, 9, 5.0)], "src long, dst long, weight double")
    e = e.withColumn("weight", F.udf(seen, "double")("weight"))
    v = CM.vertices(spark.createDataFrame([(k, [1.0, float(k)]) for k in range(4)], "id long, attrs array<double>"))
    comm = spark.createDataFrame([(0, 0), (1, 0), (2, 1), (3, 1), (9, 2)], "id long, comm long")
    got = {(r["id"], r["comm"]): r["dq"] for r in CM.move_gain(e, v, comm, 0.5).collect()}
    assert read.value == 4 and set(got) == {(1, 1), (2, 0)}  # vertex 9 has no attributes
    assert got[1, 1] == pytest.approx((2 - 1) / 9 - 3 * (9 - 4 + 3) / (2 * 81))  # degrees 1, 3, 3, 6 of the four, m = 9


def test_of_two_vertices_that_would_swap_one_moves(spark):
    pairs = [(0, 1), (2, 3), (4, 5)]
    e = spark.createDataFrame([(a, b, 1.0) for a, b in pairs], "src long, dst long, weight double")
    v = CM.vertices(spark.createDataFrame([(k, [1.0, float(k)]) for k in range(6)], "id long, attrs array<double>"))
    start = v.select("id", F.col("id").alias("comm"))
    trace = []
    comm = dict(map(tuple, CM.local_move(e, v, start, 1.0, 1, trace).collect()))
    assert len(trace) == 2 and all(comm[a] == comm[b] for a, b in pairs)


# ---- best products


def test_best_products_are_exact_and_fewer(spark):
    rng = np.random.default_rng(7)
    u, v = rng.normal(size=(60, 5)), rng.normal(size=(300, 5)) * (1 / (1 + np.arange(300)))[:, None] ** 0.7
    v[10] = v[11]  # a tie
    need = [int(x) for x in rng.integers(1, 12, 60)]
    need[0], need[1] = 400, 0
    users = spark.createDataFrame([(k, u[k].tolist(), need[k]) for k in range(60)], "user_id long, vec array<double>, need int")
    items = spark.createDataFrame([(1 << 40 | k, v[k].tolist()) for k in range(300)], "item_id long, vec array<double>")
    got = {r["user_id"]: r for r in IP.best_products(users, items, 7, 16).collect()}
    assert set(got) == set(range(60)) - {1}
    for k, r in got.items():
        s = u[k] @ v.T
        order = np.lexsort((np.arange(300), -s))[: need[k]]
        assert [i & 0xFFFF for i in r["items"]] == order.tolist()
        assert r["scores"] == pytest.approx(s[order].tolist())
    assert got[0]["scored"] == 300
    assert sum(r["scored"] for k, r in got.items() if k) < 0.5 * 58 * 300
    assert IP.best_products(users, items.limit(0)).where("size(items) > 0").count() == 0


def test_recommendations_equal_those_of_the_model(spark):
    rng = random.Random(3)
    rows = [(u, i, rng.randint(1, 5)) for u in range(20) for i in rng.sample(range(40), 8)]
    plays = spark.createDataFrame(rows, "user_id long, item_id long, plays long")
    far = plays.withColumn("user_id", F.col("user_id") + (1 << 40)).withColumn("item_id", F.col("item_id") + (1 << 41))
    mine = REC.train_implicit(far, 4, 7, blocks=2)
    als = ALS(rank=4, maxIter=5, regParam=0.01, alpha=0.01, implicitPrefs=True, seed=7, numUserBlocks=2, numItemBlocks=2, userCol="user_id", itemCol="item_id", ratingCol="plays")
    seen = sorted({i for _, i, _ in rows})
    number = {i: k for k, i in enumerate(seen)}
    model = als.fit(spark.createDataFrame([(u, number[i], float(p)) for u, i, p in rows], "user_id int, item_id int, plays float"))
    want = {r["user_id"]: r["recommendations"] for r in model.recommendForAllUsers(6).collect()}
    got = {}
    for r in REC.recommend(mine, far, 6).collect():
        got.setdefault(r["user_id"] - (1 << 40), {})[r["place"]] = (number[r["item_id"] - (1 << 41)], r["score"])
    for u, recs in want.items():
        assert [got[u][k + 1][1] for k in range(6)] == pytest.approx([x["rating"] for x in recs], abs=1e-4)
    agree = np.mean([got[u][k + 1][0] == x["item_id"] for u, recs in want.items() for k, x in enumerate(recs)])
    assert agree > 0.9  # float ties aside
    pairs = spark.createDataFrame([((1 << 40) + 1, (1 << 41) + seen[0]), (5, 5)], "user_id long, item_id long")
    assert REC.score(mine, pairs).count() == 1


# ---- session


def test_rolling_tables_delete_the_one_before(spark):
    roll = Rolling()
    a = roll.cut(spark.range(3))
    b = roll.cut(a.select((F.col("id") + 1).alias("id")))
    folder = lambda df: df.inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0]
    assert sorted(r[0] for r in b.collect()) == [1, 2, 3] and os.path.isdir(folder(b))
    with pytest.raises(Exception, match="exist"):
        a.count()


def test_a_local_session_without_a_shared_folder_cuts(folder):
    code = ("from tallybook.session import cut, get_spark, release\n"
            "s = get_spark('plain', master='local[1]', shuffle_partitions=1)\n"
            "assert s.conf.get('spark.checkpoint.dir', None) is None\n"
            "print('rows', cut(cut(s.range(5)).where('id > 1')).count())\nrelease(s)\n")
    env = {k: v for k, v in os.environ.items() if k != "PYSPARK_SUBMIT_ARGS"} | {"SPARK_CONF_DIR": folder, "PYTHONPATH": os.getcwd()}
    done = subprocess.run([sys.executable, "-c", code], env=env, capture_output=True, text=True, timeout=180)
    assert "rows 3" in done.stdout, done.stderr[-1500:]


def test_a_product_moves_rare_rows_once(spark, monkeypatch):
    monkeypatch.setattr(FA, "FREQUENT", 5)
    rng = np.random.default_rng(8)
    a = np.where(rng.random((30, 40)) < np.linspace(0.9, 0.05, 40), rng.normal(size=(30, 40)), 0)
    entries = spark.createDataFrame([(int(i), int(j), float(a[i, j])) for i, j in zip(*np.nonzero(a), strict=True)], "i long, j long, v double")
    x = rng.normal(size=(40, 3))
    rows = spark.createDataFrame([(k, bytearray(x[k].tobytes())) for k in range(40)], "id long, vec binary")
    for flipped in (False, True):
        m, y = (a.T, x[:30]) if flipped else (a, x)
        matrix = FA.dealt(entries, 4, flipped)
        held = rows.where(F.col("id") < len(y))
        assert matrix.placed(held).count() == 4 * 5 + len(y) - 5
        assert dense(FA.multiply(matrix, held), {i: i for i in range(len(m))}, 3) == pytest.approx(m @ y)


def test_link_model_by_groups_of_a_word(spark, monkeypatch):
    rng = random.Random(9)
    images = spark.createDataFrame([(f"i{k}", [rng.uniform(-1, 1) for _ in range(3)]) for k in range(12)], "name string, vector array<float>")
    words = spark.createDataFrame([(f"w{k}", [rng.uniform(-1, 1) for _ in range(5)]) for k in range(4)], "word string, vector array<double>")
    pairs = spark.createDataFrame([(f"i{i}", f"w{w}", 1.0 if (i + w) % 3 else -1.0) for i in range(12) for w in range(4)], "name string, word string, e double")
    many = FU._by_word(pairs, images, words)
    assert many.count() == 4  # a word's vector is held once for all its pairs
    one = FU.fit_link(pairs, images, words, k=8, iters=5, seed=2)
    monkeypatch.setattr(FU, "GROUP", 3)
    assert FU._by_word(pairs, images, words).count() > 4
    two = FU.fit_link(pairs, images, words, k=8, iters=5, seed=2)
    assert two.image == pytest.approx(one.image) and two.word == pytest.approx(one.word)
    iv, wv = ({r[0]: np.array(r[1]) for r in d.collect()} for d in (images, words))
    for model in (one, FU.LinkModel(one.image[:, :2], one.word[:, :2])):  # a common space that is wider, and one that is narrower than images
        for r in FU.score_link(model, pairs, images, words).collect():
            assert r["score"] == pytest.approx((iv[r["name"]] @ model.image) @ (wv[r["word"]] @ model.word))
