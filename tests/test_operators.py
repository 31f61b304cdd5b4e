import hashlib
import itertools
import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tallybook.functions.policy import local_score
from tallybook.operators import allocation as A
from tallybook.operators import causality as C
from tallybook.operators import community as CM
from tallybook.operators import facts as O
from tallybook.operators import fusion as FU
from tallybook.operators import graph as G
from tallybook.operators import metrics as M
from tallybook.operators import ordering as R
from tallybook.operators import recommend as REC
from tallybook.operators import regression as REG
from tallybook.operators import series as S
from tallybook.operators import snapshots as SN
from tallybook.operators import walks as W

# ---- ordering -------------------------------------------------------------------------------------


def test_rank_within_a_hot_key(spark):
    """One key holds most rows and spreads over several ranges."""
    df = spark.range(5000).select(
        F.when(F.col("id") % 10 < 7, 0).otherwise(F.col("id") % 10).alias("k"), ((F.col("id") * 7919) % 5003).alias("v")
    ).repartition(8)
    got = R.rank_within(df, ["k"], [F.col("v").asc()]).toPandas()
    want = got.groupby("k")["v"].rank(method="first").astype(int)
    assert (got["rank"] == want).all() and len(got) == 5000


def test_quantiles(spark):
    rng = np.random.default_rng(1)
    x = np.round(rng.normal(size=501), 2)
    df = spark.createDataFrame(pd.DataFrame({"g": np.arange(501) % 2, "v": x}))
    got = R.quantiles(df, "v", {"a": 0.25, "b": 0.5, "c": 0.9}, by=["g"]).toPandas().set_index("g")
    for g in (0, 1):
        assert np.allclose(got.loc[g, ["a", "b", "c"]], np.quantile(x[np.arange(501) % 2 == g], [0.25, 0.5, 0.9]))
    assert np.isclose(R.quantiles(df, "v", {"m": 0.5}).first()["m"], np.median(x))


def test_dense_index(spark):
    df = spark.createDataFrame([(w,) for w in "b a c a d".split()], "w string")
    assert sorted(map(tuple, R.dense_index(df, "w").collect())) == [("a", 0), ("b", 1), ("c", 2), ("d", 3)]


# ---- facts ----------------------------------------------------------------------------------------


def test_expand_in_blocks(spark):
    df = spark.createDataFrame([("a", 25), ("b", 0), ("c", 10)], "k string, n long")
    got = O.expand(df, "n", "i", step=10).groupBy("k").agg(F.count("*"), F.min("i"), F.max("i")).collect()
    assert sorted(map(tuple, got)) == [("a", 25, 1, 25), ("c", 10, 1, 10)]


def test_items_by_user_in_chunks(spark):
    df = spark.range(100).select(F.lit(1).alias("user_id"), F.col("id").alias("item_id"))
    rows = O.items_by_user(df, chunk=30).collect()
    assert {r["chunk"]: r["items"] for r in rows} == {k: list(range(30 * k, min(100, 30 * k + 30))) for k in range(4)}
    long = O.items_by_user(spark.range(25_000).select(F.lit(1).alias("user_id"), F.col("id").alias("item_id"))).collect()
    assert sorted((r["chunk"], len(r["items"])) for r in long) == [(0, 10_000), (1, 10_000), (2, 5_000)]


def test_split_covers_all(spark):
    df = spark.range(4000).withColumnRenamed("id", "user_id")
    got = dict(map(tuple, O.split_label(df, {"a": 0.4, "b": 0.4, "c": 0.2}, 13, ["user_id"]).groupBy("split").count().collect()))
    assert sum(got.values()) == 4000 and abs(got["a"] - 1600) < 150 and abs(got["c"] - 800) < 120


def test_permute_is_a_permutation(spark):
    df = spark.range(50).withColumnRenamed("id", "seq")
    got = O.permute(df, "seq", 3, 1).toPandas()
    for _, g in got.groupby("trial"):
        assert sorted(g["pos"]) == list(range(1, 51))
    orders = {tuple(g.sort_values("pos")["seq"]) for _, g in got.groupby("trial")}
    assert len(orders) == 3


def brute_overlap(scores, truth, train):
    by = {}
    for u, i, s in scores:
        if (u, i) not in train:
            by.setdefault(u, []).append((-s, i))
    t = {}
    for u, i in truth:
        t.setdefault(u, set()).add(i)
    out = []
    for u, want in t.items():
        top = [i for _, i in sorted(by.get(u, []))[: len(want)]]
        out.append(len(want & set(top)) / len(want))
    return sum(out) / len(out)


def test_overlap_against_brute_force(spark):
    rng = random.Random(2)
    pairs = [(u, i) for u in range(12) for i in range(30)]
    train = set(rng.sample(pairs, 90))
    truth = set(rng.sample(pairs, 70))
    scores = [(u, i, rng.randint(0, 9) / 2) for u, i in pairs]
    df = lambda rows: spark.createDataFrame(list(rows), "user_id long, item_id long")
    got = REC.overlap_at_x(spark.createDataFrame(scores, "user_id long, item_id long, score double"), df(truth), df(train)).first()
    assert got["overlap"] == pytest.approx(brute_overlap(scores, truth, train))


def test_model_scores_are_deep_enough(spark):
    """Scores cut at truth + train give the same overlap as scores of all pairs."""
    rng = random.Random(3)
    rows = [(u, i, rng.randint(1, 5)) for u in range(15) for i in rng.sample(range(40), 4 + 2 * (u % 5))]
    plays = spark.createDataFrame(rows, "user_id long, item_id long, plays long")
    p = O.split_label(plays, {"train": 0.6, "val": 0.4}, 1, ["user_id", "item_id"])
    train, val = p.where("split = 'train'"), p.where("split = 'val'")
    model = REC.train_implicit(train, 4, blocks=2)
    short = REC.overlap_at_x(REC.model_scores(model, val, train), val, train).first()["hits"]
    users, items = plays.select("user_id").distinct().collect(), plays.select("item_id").distinct().collect()
    every = spark.createDataFrame([(u[0], i[0]) for u in users for i in items], "user_id long, item_id long")
    full = REC.overlap_at_x(REC.score(model, every).select("user_id", "item_id", "score"), val, train).first()["hits"]
    assert abs(short - full) <= 1  # float ties aside


# ---- series ---------------------------------------------------------------------------------------


def series(spark, cols):
    n = len(next(iter(cols.values())))
    return spark.createDataFrame(pd.DataFrame({"t": np.arange(n), **cols}))


def test_control_limits(spark):
    lim = S.control_limits(series(spark, {"sim": np.array([2, 3, 4, 5, 6, 7, 5, 4, 3, 2, 1.0])})).first()
    assert lim["moving_range"] == pytest.approx(1.1)
    assert (lim["low"], lim["high"]) == (pytest.approx(0.7), pytest.approx(7.3))


def test_windows(spark):
    got = S.windows(series(spark, {"v": np.arange(8.0) ** 2}), "v", 3).orderBy("t").collect()
    assert [r["t"] for r in got] == [2, 3, 4, 5, 6]
    assert got[0]["x"] == [0.0, 1.0, 4.0] and got[0]["y"] == 5.0


def test_var_against_numpy(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(120, 2)).cumsum(axis=0) * 0.1 + rng.normal(size=(120, 2))
    s = series(spark, {"a": x[:, 0] * 1000, "b": x[:, 1]})
    x = x * np.array([1000, 1])
    for p, trend in ((1, False), (3, True)):
        m = C.var_fit(s, ["a", "b"], p, trend)
        design = np.hstack([*[x[p - k : 120 - k] for k in range(1, p + 1)], *([np.arange(p, 120)[:, None]] if trend else []), np.ones((120 - p, 1))])
        beta, *_ = np.linalg.lstsq(design, x[p:], rcond=None)
        got = m.residuals().orderBy("t").toPandas()[["a", "b"]].to_numpy()
        assert np.allclose(got, x[p:] - design @ beta, atol=1e-7)


def test_ols_standard_errors(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(80, 2))
    y = 3 + x @ [1.5, -2] + rng.normal(size=80)
    f = REG.ols(spark.createDataFrame(pd.DataFrame({"p": x[:, 0], "q": x[:, 1], "y": y})), "y", ["p", "q"])
    d = np.hstack([x, np.ones((80, 1))])
    beta, rss, *_ = np.linalg.lstsq(d, y, rcond=None)
    assert np.allclose(f.coef, beta) and np.allclose(f.se, np.sqrt(np.diag(np.linalg.inv(d.T @ d)) * rss[0] / 77))


def test_kernel_regression_on_a_grid(spark):
    rng = np.random.default_rng(6)
    x, y, q = rng.normal(size=(40, 5)), rng.normal(size=40), rng.normal(size=(25, 5))
    mk = lambda v, y: spark.createDataFrame([(i, [float(a) for a in r], float(b)) for i, (r, b) in enumerate(zip(v, y))], "t long, x array<double>, y double")
    z = lambda m: (m - m.mean(1, keepdims=True)) / np.linalg.norm(m - m.mean(1, keepdims=True), axis=1, keepdims=True)
    w = np.exp(2 * z(q) @ z(x).T)
    for cell in (7, 4096):
        got = REG.kernel_predict(mk(q, np.zeros(25)), mk(x, y), 2.0, cell=cell).orderBy("t").toPandas()["yhat"]
        assert np.allclose(got, w @ y / w.sum(1))


def test_ks(spark):
    rng = np.random.default_rng(7)
    a, b = np.round(rng.normal(size=200), 1), np.round(rng.normal(0.3, 1, size=150), 1)
    grid = np.unique(np.concatenate([a, b]))
    want = max(abs((a <= v).mean() - (b <= v).mean()) for v in grid)
    mk = lambda v: spark.createDataFrame([(float(x),) for x in v], "value double")
    got = C.ks_two_sample(mk(a), mk(b)).first()
    assert got["d"] == pytest.approx(want) and 0 <= got["p_value"] <= 1


def test_ci_tests_and_skeleton(spark):
    """Published residual correlations: with n=1000 all edges stay, with n=249 one goes."""
    corr = spark.createDataFrame(
        [("MPRICE", "Move", -0.545273), ("MPRICE", "RPRICE", 0.397995), ("Move", "RPRICE", -0.600993)], "a string, b string, r double"
    )
    for n, z, edges in ((1000, 3.323, 3), (249, 1.648, 2)):
        ci = C.ci_tests(corr, n)
        row = ci.where("a = 'MPRICE' AND b = 'RPRICE' AND size(cond) = 1").first()
        assert row["z"] == pytest.approx(z, abs=1e-3) and row["r"] == pytest.approx(0.104914, abs=1e-5)
        pc = C.pc_graph(ci)
        assert pc.count() == edges and {r["kind"] for r in pc.collect()} == {"undirected"}


def test_v_structure(spark):
    rng = np.random.default_rng(8)
    a, b = rng.normal(size=2000), rng.normal(size=2000)
    df = spark.createDataFrame(pd.DataFrame({"a": a, "b": b, "c": a + b + 0.3 * rng.normal(size=2000)}))
    got = {(r["a"], r["b"], r["kind"]) for r in C.pc_graph(C.ci_tests(C.corr_matrix(df, ["a", "b", "c"]), 2000, alpha=0.01)).collect()}
    assert got == {("a", "c", "a->b"), ("b", "c", "a->b")}


def test_lingam_order(spark):
    rng = np.random.default_rng(9)
    x = rng.uniform(-1, 1, 4000)
    y = 2 * x + rng.uniform(-1, 1, 4000)
    z = y - x + rng.uniform(-1, 1, 4000)
    order, effects = C.lingam(spark.createDataFrame(pd.DataFrame({"z": z, "y": y, "x": x})), ["z", "y", "x"])
    assert order == ["x", "y", "z"]
    w = {(r["cause"], r["effect"]): r["weight"] for r in effects.collect()}
    assert w["x", "y"] == pytest.approx(2, abs=0.1) and w["y", "z"] == pytest.approx(1, abs=0.1)


# ---- graphs ---------------------------------------------------------------------------------------


def edges(spark, rows):
    return spark.createDataFrame(rows, "src long, dst long")


def test_components_against_union_find(spark):
    rng = random.Random(10)
    rows = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)] + [(100 + i, 101 + i) for i in range(40)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in rows:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    got = dict(map(tuple, G.components(edges(spark, rows)).collect()))
    assert got == {x: find(x) for x in list(parent)}


def test_pagerank_sums_to_one(spark):
    rng = random.Random(11)
    rows = [(s, rng.randrange(20), rng.randrange(20)) for s in range(3) for _ in range(40)]
    pr = G.pagerank(spark.createDataFrame(rows, "snap long, src long, dst long"), "snap", 25)
    for r in pr.groupBy("snap").agg(F.sum("rank").alias("s")).collect():
        assert r["s"] == pytest.approx(1.0)


def test_graph_basics(spark):
    e = edges(spark, [(1, 2), (2, 1), (2, 3), (3, 3)])
    assert G.has_self_loops(e).first()[0] is True
    u = G.undirected(e)
    assert sorted(map(tuple, u.collect())) == [(1, 2), (2, 1), (2, 3), (3, 2)]
    assert tuple(G.graph_size(u).first()) == (3, 2)
    assert G.clique(spark, 4).count() == 12
    assert sorted(map(tuple, G.subgraph(u, spark.createDataFrame([(1,), (2,)], "id long")).collect())) == [(1, 2), (2, 1)]


def test_walks_follow_edges(spark):
    rng = random.Random(12)
    rows = [(i, rng.randrange(30)) for i in range(30) for _ in range(2)] + [(5, 99)]  # 99 is a dead end
    e = G.consistent(edges(spark, rows))
    have = set(map(tuple, e.collect()))
    walks = W.random_walks(e, 3, 12, alpha=0.2, seed=4, cut_every=5).collect()
    nodes = {x for r in have for x in r}
    assert len(walks) == 3 * len(nodes)
    out = {a for a, _ in have}
    for w in walks:
        p = w["path"]
        assert p[0] == w["start"]
        assert all((a, b) in have or b == p[0] for a, b in zip(p, p[1:]))
        assert len(p) == 12 or p[-1] not in out


def test_sampled_walks(spark):
    e = G.undirected(edges(spark, [(i, i + 1) for i in range(10)]))
    got = W.sampled_walks(e, 25, 4, seed=1).collect()
    assert len(got) == 25 and all(len(r["path"]) == 4 for r in got)


def test_simhash_similarity_range(spark):
    rows = [(s, a, b) for s in range(4) for a, b in itertools.combinations(range(5 + s), 2)]
    e = spark.createDataFrame(rows, "snap long, src long, dst long")
    prints = SN.simhash(SN.shingle(e))
    assert all(len(r["bits"]) == 64 for r in prints.collect())
    sims = [r["sim"] for r in SN.snapshot_similarity(prints).collect()]
    assert len(sims) == 3 and all(0 <= s <= 1 for s in sims)


@pytest.mark.parametrize("bits", [64, 128, 160, 300])
def test_simhash_at_any_width(spark, bits):
    """Bits of md5(token), then of md5(token|1) and so on; the similarity counts all of them."""
    tokens = [(s, i, 1 + (i * 7 + s) % 5) for s in (0, 1) for i in range(s * 30, s * 30 + 60)]
    prints = SN.simhash(spark.createDataFrame(tokens, "snap long, token long, weight long"), bits=bits)
    want = {}
    for s in (0, 1):
        sums = [0] * bits
        for snap, tok, w in tokens:
            if snap == s:
                text = "".join(hashlib.md5((str(tok) if k == 0 else f"{tok}|{k}").encode()).hexdigest() for k in range(-(-bits // 128)))
                for i, b in enumerate(bin(int(text, 16))[2:].zfill(4 * len(text))[:bits]):
                    sums[i] += w * (2 * int(b) - 1)
        want[s] = [int(x >= 0) for x in sums]
    assert {r["snap"]: r["bits"] for r in prints.collect()} == want
    same = sum(a == b for a, b in zip(want[0], want[1], strict=True)) / bits
    assert abs(SN.snapshot_similarity(prints).first()["sim"] - same) < 1e-12


def test_same_snapshot_is_identical(spark):
    rows = [(s, 1, b) for s in (0, 1) for b in range(2, 9)]
    e = spark.createDataFrame(rows, "snap long, src long, dst long")
    assert SN.snapshot_similarity(SN.simhash(SN.shingle(e))).first()["sim"] == 1.0


# ---- communities ----------------------------------------------------------------------------------


def two_cliques(spark):
    rows = [(a + o, b + o, 1.0) for o in (0, 10) for a, b in itertools.combinations(range(6), 2)] + [(5, 10, 1.0)]
    e = spark.createDataFrame(rows, "src long, dst long, weight double")
    attrs = spark.createDataFrame(
        [(i + o, [1.0, 0.1 * i] if o == 0 else [0.1 * i, 1.0]) for o in (0, 10) for i in range(6)], "id long, attrs array<double>"
    )
    return e, CM.vertices(attrs)


def test_sac_finds_the_cliques(spark):
    e, v = two_cliques(spark)
    for alpha in (1.0, 0.5):
        got = dict(map(tuple, CM.sac(e, v, alpha, levels=4, passes=4).collect()))
        assert len(got) == 12
        assert len({got[i] for i in range(6)}) == 1 and len({got[i] for i in range(10, 16)}) == 1 and got[0] != got[10]


def test_gains_match_recomputed_objectives(spark):
    e, v = two_cliques(spark)
    comm = spark.createDataFrame([(i + o, i % 3) for o in (0, 10) for i in range(6)], "id long, comm long")
    q0 = CM.modularity(e, comm).first()[0]
    sim = lambda c: {r["comm"]: r["similarity"] for r in CM.community_similarity(v, c).collect()}
    s0 = sim(comm)
    for g in CM.move_gain(e, v, comm, 0.5).orderBy("id", "comm").limit(4).collect():
        moved = comm.withColumn("comm", F.when(F.col("id") == g["id"], g["comm"]).otherwise(F.col("comm")))
        assert g["dq"] == pytest.approx(CM.modularity(e, moved).first()[0] - q0)
        assert g["ds"] == pytest.approx(sim(moved)[g["comm"]] - s0[g["comm"]])
        assert g["gain"] == pytest.approx(0.5 * g["dq"] + 0.5 * g["ds"] / 9)


def test_contraction_keeps_modularity(spark):
    e, v = two_cliques(spark)
    comm = spark.createDataFrame([(i + o, i % 3) for o in (0, 10) for i in range(6)], "id long, comm long")
    ce, cv = CM.contract(e, v, comm)
    same = cv.select("id", F.col("id").alias("comm"))
    assert CM.modularity(ce, same).first()[0] == pytest.approx(CM.modularity(e, comm).first()[0])
    s = {r["comm"]: r["similarity"] for r in CM.community_similarity(cv, same).collect()}
    for r in CM.community_similarity(v, comm).collect():
        assert s[r["comm"]] == pytest.approx(r["similarity"])


def test_cascade_grows(spark):
    e, v = two_cliques(spark)
    comm = spark.createDataFrame([(i + o, o // 10) for o in (0, 10) for i in range(6)], "id long, comm long")
    seeds = CM.seeds_per_community(comm, 3, trials=2)
    for retry in (True, False):
        got = CM.cascade(e, comm, seeds, steps=5, retry=retry).orderBy("trial", "step").toPandas()
        for _, g in got.groupby("trial"):
            assert list(g["step"]) == list(range(1, 7)) and g["covered"].iloc[0] == 2
            assert g["covered"].is_monotonic_increasing and g["ratio"].max() <= 1


# ---- allocation -----------------------------------------------------------------------------------


def small_market(seed=13, n=400):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(12)]
    bids = {(a, w): rng.randint(1, 9) / 10 for a in range(8) for w in rng.sample(words, 6)}
    budgets = {a: round(rng.uniform(5, 30), 2) for a in range(8)}
    log = [(i, rng.choice(words)) for i in range(1, n + 1)]
    return log, bids, budgets


def by_hand(log, bids, budgets, policy):
    left, out = {a: round(b * 10000) for a, b in budgets.items()}, []
    for seq, word in log:
        cand = [
            (-local_score(policy, b, left[a] / 10000, budgets[a]), a, b)
            for (a, w), b in bids.items() if w == word and left[a] >= round(b * 10000)
        ]
        if cand:
            _, a, b = min(cand)
            left[a] -= round(b * 10000)
            out.append((seq, a, b))
    return out


def market_frames(spark, log, bids, budgets):
    return (
        spark.createDataFrame(log, "seq long, keyword string"),
        spark.createDataFrame([(a, w, b) for (a, w), b in bids.items()], "adv_id long, keyword string, bid double"),
        spark.createDataFrame(list(budgets.items()), "adv_id long, budget double"),
    )


@pytest.mark.parametrize("policy", ["greedy", "msvv", "balance"])
def test_allocation_against_the_ordered_log(spark, policy):
    market = small_market()
    q, b, u = market_frames(spark, *market)
    q = q.withColumn("trial", F.lit(0).cast("bigint"))
    run = A.allocate_greedy(q, b, u) if policy == "greedy" else A.allocate(q, b, u, policy)
    assert [tuple(r) for r in run.orderBy("seq").select("seq", "adv_id", "bid").collect()] == by_hand(*market, policy)


def test_greedy_stream_and_rounds_agree(spark):
    q, b, u = market_frames(spark, *small_market(14, 250))
    shuffled = O.permute(q, "seq", 3, 5).select("trial", F.col("pos").alias("seq"), "keyword")
    key = ["trial", "seq", "adv_id"]
    x = sorted(map(tuple, A.allocate_greedy(shuffled, b, u).select(*key).collect()))
    y = sorted(map(tuple, A.allocate(shuffled, b, u, "greedy").select(*key).collect()))
    assert x == y and len(x) > 300


def test_spend_stays_in_budget(spark):
    q, b, u = market_frames(spark, *small_market(15))
    runs = A.experiment(q, b, u, "msvv", trials=3)
    spent = runs.groupBy("trial", "adv_id").agg(F.sum("bid").alias("s")).join(u, "adv_id")
    assert spent.where("s > budget + 1e-6").count() == 0
    r = M.competitive_ratio(A.revenue(runs), u).first()
    assert r["trials"] == 3 and 0 < r["ratio"] <= 1


# ---- fusion ---------------------------------------------------------------------------------------


def test_negative_pairs(spark):
    im = spark.createDataFrame([(c,) for c in "abc"], "name string")
    wo = spark.createDataFrame([(c,) for c in "xyz"], "word string")
    e = spark.createDataFrame([("a", "x"), ("a", "y"), ("b", "z")], "name string, word string")
    got = sorted(map(tuple, FU.negative_pairs(im, wo, e, 4).collect()))
    assert len(set(got)) == 4 and set(got) < {(a, b) for a in "abc" for b in "xyz"} - {("a", "x"), ("a", "y"), ("b", "z")}
    assert FU.negative_pairs(im, wo, e, 100).count() == 6
    many = FU.negative_pairs(spark.range(300).select(F.col("id").cast("string").alias("name")), wo, e, 60).collect()
    assert len(set(many)) == 60 and len({r["name"] for r in many}) > 30


def test_valid_patches(spark):
    rows = [("a", 0, 127), ("a", 1, 100), ("a", 2, 127), ("b", 0, 127), ("b", 1, 127)]
    got = FU.valid_patches(spark.createDataFrame(rows, "name string, pos int, rows int"))
    assert sorted(map(tuple, got.select("name", "pos").collect())) == [("a", 0), ("b", 0), ("b", 1)]


def test_link_model_learns(spark):
    rng = np.random.default_rng(16)
    iv, wv = rng.normal(size=(20, 4)), rng.normal(size=(20, 4))
    pairs = [(f"i{a}", f"w{b}", 1.0 if iv[a] @ wv[b] > 0 else -1.0) for a in range(20) for b in range(20)]
    vec = lambda m, p, k: spark.createDataFrame([(f"{p}{i}", [float(x) for x in r]) for i, r in enumerate(m)], f"{k} string, vector array<double>")
    df = spark.createDataFrame(pairs, "name string, word string, e double")
    images, words = vec(iv, "i", "name"), vec(wv, "w", "word")
    model = FU.fit_link(df, images, words, k=8, iters=200, seed=1)
    hit = FU.score_link(model, df, images, words).select(F.avg(((F.col("score") > 0) == (F.col("e") > 0)).cast("double"))).first()[0]
    assert hit > 0.6
    assert math.isfinite(hit)
