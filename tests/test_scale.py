"""What must not grow with the input: broadcasts, exploded shuffles, rounds without effect, rows of a task."""

import re
import time
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallybook.operators import community as CM
from tallybook.operators import fusion as FU
from tallybook.operators import graph as GR
from tallybook.operators import ordering as R
from tallybook.operators import series as S
from tallybook.operators import skipgram as SG
from tallybook.operators import walks as W
from tallybook.session import cut
from tallybook.sources import readers as RD
from tallybook.sources import sinks as SK


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def plans(monkeypatch):
    """(columns, plan) of the tables that walks cut."""
    seen = []

    def noted(df):
        seen.append((df.columns, plan(df)))
        return cut(df)

    monkeypatch.setattr(W, "cut", noted)
    return seen


def test_walk_segments_are_never_broadcast(spark, plans):
    ring = [(i, (i + d) % 12) for i in range(12) for d in (1, 11, 5, 7)]
    e = spark.createDataFrame(ring, "src long, dst long")
    for walk in (W.stitched_walks, W.random_walks):
        plans.clear()
        got = walk(e, 3, 12, 0.2, 4).collect()
        assert len(got) == 36
        for r in got:
            assert len(r["path"]) == 12 and all(b == r["start"] or (a, b) in set(ring) for a, b in zip(r["path"], r["path"][1:]))
        carried = [p for columns, p in plans if {"moves", "path"} & set(columns)]
        assert carried and "SortMergeJoin" in "".join(carried) and not any(re.search(r"BroadcastHashJoin \[[^\]]*(cur|_c|_pos)#", p) for p in carried)


def test_walks_write_no_segment_that_no_piece_walks(spark, monkeypatch):
    rows = []

    def noted(df):
        out = cut(df)
        rows.append((out.columns, out.count()))
        return out

    monkeypatch.setattr(W, "cut", noted)
    ring = [(i, (i + d) % 12) for i in range(12) for d in (1, 11, 5, 7)]
    e = spark.createDataFrame(ring, "src long, dst long")
    got = W.stitched_walks(e, 3, 12, 0.2, 4).collect()
    pieces = next(n for columns, n in rows if "len" in columns and "path" not in columns)
    assert len(got) == 36 and max(n for columns, n in rows if {"moves", "path"} & set(columns)) <= pieces


def test_a_training_step_sums_equal_rows_without_scattered_adds():
    rng = np.random.default_rng(0)
    at, g = rng.integers(0, 40, 576), rng.normal(size=(576, 100)).astype(np.float32)
    rows = rng.random((40, 101)).astype(np.float32)
    side = lambda: SG._Side(list(range(40)), [1] * 40, [r.tobytes() for r in rows])
    a, b = side(), side()

    def scattered(s):
        which, back = np.unique(at, return_inverse=True)
        total = np.zeros((len(which), 100), np.float32)
        np.add.at(total, back, g)
        s.sums[which] += (total * total).mean(axis=1)
        s.vec[which] += SG.RATE * total / np.sqrt(s.sums[which] + 1e-10)[:, None]

    def least(f):
        took = []
        for _ in range(40):
            t = time.perf_counter()
            f()
            took.append(time.perf_counter() - t)
        return min(took)

    a.step(at, g)
    scattered(b)
    assert np.allclose(a.vec, b.vec, atol=1e-6) and np.allclose(a.sums, b.sums, rtol=1e-5)
    assert least(lambda: a.step(at, g)) < 0.85 * least(lambda: scattered(b))


def test_predicted_ratings_keep_a_pair_in_one_row(spark):
    rng = np.random.default_rng(3)
    vecs = [(f"u{u}", rng.normal(size=4).tolist()) for u in range(6)] + [("u1", rng.normal(size=4).tolist())]  # u1 twice
    vecs += [(f"m{m}_{r}", [0.0] * 4 if (m, r) == (2, 1) else rng.normal(size=4).tolist()) for m in range(4) for r in range(1, 6) if (m, r) != (3, 5)]
    vecs += [("m0_4", dict(vecs)["m0_2"]), (None, [1.0] * 4)]  # equal vectors: the lower rating wins
    pairs = [(str(u), str(m)) for u in range(6) for m in range(4)] + [("1", "2"), (None, "2"), ("9", "0")]
    df = W.predict_rating(spark.createDataFrame(vecs, "key string, vector array<double>"), spark.createDataFrame(pairs, "user string, movie string"))
    want = {}
    for u, m in {p for p in pairs if p[0] and p[0] != "9"}:
        found = []
        for key, v in vecs:
            for star, x in vecs:
                if key == f"u{u}" and star and star.startswith(f"m{m}_"):
                    n = np.linalg.norm(v) * np.linalg.norm(x)
                    found.append((round(np.dot(v, x) / n, 12) if n else -9.0, -int(star[-1])))
        want[u, m] = -max(found)[1]
    got = [tuple(r) for r in df.collect()]
    assert len(got) == len(want) and {r[:2]: r[2] for r in got} == want
    assert "SortAggregate" not in plan(df)


def test_text_windows_look_each_token_up_once(spark):
    docs = [(1, "a b c d e f".split()), (1, "f e d c b a g h".split()), (2, "b b b b b".split()), (3, "a b".split()), (2, "b b b b b".split())]
    df = FU.text_examples(spark.createDataFrame(docs, "doc_id long, tokens array<string>"))
    idx = {w: i for i, w in enumerate(sorted({w for _, x in docs for w in x}))}
    want = {}
    for d, x in docs:
        for p in range(len(x) - 4):
            w = [idx[x[p + i]] for i in (2, 0, 1, 3, 4)]
            want[d, p + 1] = [max(z) for z in zip(w, want.get((d, p + 1), w))]
    got = {(r["doc_id"], r["pos"]): [r["center"], r["ctx_1"], r["ctx_2"], r["ctx_3"], r["ctx_4"]] for r in df.collect()}
    assert got == want and df.columns == ["doc_id", "pos", "center", "ctx_1", "ctx_2", "ctx_3", "ctx_4"]
    assert "posexplode(concat" not in plan(df)


def test_tags_in_order_need_no_shuffle_of_the_candidates(spark):
    images = spark.createDataFrame([(f"n{i}",) for i in range(40)], "name string")
    words = spark.createDataFrame([(f"w{i}",) for i in range(9)], "word string")
    scored = FU.with_frequent_words(images, words).withColumn("score", (F.xxhash64("name", "word") % 100) / 100.0)
    df = FU.tags_for(scored)
    got = [tuple(r) for r in df.collect()]
    rows = [tuple(r) for r in scored.collect()]
    assert len(rows) == 360 and got == sorted((r for r in rows if r[2] > 0), key=lambda r: (r[0], -r[2], r[1]))
    assert plan(df).split("Initial Plan")[0].count("rangepartitioning") == 1


def test_a_spread_ends_when_all_is_reached(spark, monkeypatch):
    edges = spark.createDataFrame([(a, b) for a in range(8) for b in range(a)] + [(20, 21)], "src long, dst long")
    comm = spark.createDataFrame([(i, i // 20) for i in [*range(8), 20, 21]], "id long, comm long")
    seeds = CM.seeds_per_community(comm, 3, trials=2)
    cuts = Counter()

    def counted(df):
        cuts["n"] += 1
        return cut(df)

    monkeypatch.setattr(CM, "cut", counted)
    got = {(r["trial"], r["step"]): r["covered"] for r in CM.cascade(edges, comm, seeds, alpha=1.0, beta=1.0, steps=12).collect()}
    assert got == {(t, s): 2 if s == 1 else 10 for t in (0, 1) for s in range(1, 14)}
    assert cuts["n"] < 8


def test_ranges_grow_in_number(spark, monkeypatch):
    pids = []

    def noted(df):
        out = cut(df)
        pids.append(out.groupBy("_pid").count().agg(F.count("*"), F.max("count")).first())
        return out

    monkeypatch.setattr(R, "cut", noted)
    monkeypatch.setattr(R, "RANGE_ROWS", 100)
    df = spark.range(5000).select(((F.col("id") * 7919) % 5003).alias("v"))
    ranked = R.rank_within(df, [], [F.col("v").asc()], "i", 5000)
    got = ranked.toPandas().sort_values("v")
    assert (got["i"].to_numpy() == np.arange(1, 5001)).all()
    assert pids[0][0] > 40 and pids[0][1] < 300
    pairs = S.pair_consecutive(ranked, "i", 50)
    assert pairs.count() == 4999 and "hashpartitioning(i" in plan(pairs)


def test_names_of_files_are_taken_without_a_pattern_over_the_path(spark, folder):
    SK.write_csv(spark.createDataFrame([(1, 0.5, 0.25, 2.0)], "row_id long, a double, b double, Yi double"), f"{folder}/train1_90.csv")
    got = RD.read_features(spark, folder, 2)
    assert [(r["split"], r["horizon"], r["y"]) for r in got.collect()] == [("train1", 90, 2.0)]
    assert not re.search(r"regexp_extract\([^()]*file_path", got._jdf.queryExecution().optimizedPlan().toString())


def test_ranks_need_no_window_over_the_rows(spark):
    rows = [(k % 3 if k % 7 else None, (k * 37) % 101) for k in range(101)]
    df = spark.createDataFrame(rows, "k long, v long").repartition(5)
    ranked = R.rank_within(df, ["k"], [F.col("v").asc()])
    want = {(k, v): 1 + sum(a == k and b < v for a, b in rows) for k, v in rows if k is not None}
    assert {(r["k"], r["v"]): r["rank"] for r in ranked.collect()} == want
    assert "Window" not in plan(ranked) and "Window" not in plan(R.rank_within(df, [], [F.col("v").asc()]))


def test_both_directions_come_from_pairs_in_one_order(spark):
    e = spark.createDataFrame([("a", "b"), ("b", "a"), ("a", "b"), ("c", "c"), ("c", None), (None, None), ("d", "a")], "src string, dst string")
    both = GR.undirected(e)
    assert sorted(map(tuple, both.collect())) == [("a", "b"), ("a", "d"), ("b", "a"), ("d", "a")]
    assert "Union" not in plan(both)


def parts_of(df):
    return df.select(F.spark_partition_id().alias("p")).distinct().count()


def test_parts_of_tags_and_lines_grow_with_the_rows(spark, monkeypatch):
    monkeypatch.setattr(R, "RANGE_ROWS", 10)
    tags = spark.createDataFrame([(f"i{k}", [f"w{j}" for j in range(k, k + 9)]) for k in range(40)], "name string, tags array<string>")
    hot = FU.multi_hot(tags)
    words = sorted({f"w{j}" for k in range(40) for j in range(k, k + 9)})
    assert {r["name"]: r["features"] for r in hot.collect()} == {f"i{k}": sorted(words.index(f"w{j}") for j in range(k, k + 9)) for k in range(40)}
    assert parts_of(FU.tag_rows(tags)) > 12 and parts_of(hot) > 12
    lines = spark.createDataFrame([(f"u{k}", f"m{k % 7}", float(k % 5), i) for k in range(200) for i in (1, 2)], "user string, movie string, rating double, line_no int")
    last = GR.last_ratings(lines, 400)
    assert last.count() == 200 and parts_of(last) > 12


def test_components_of_texts_move_numbers(spark, monkeypatch):
    from tallybook.operators import graph as G

    written, real = [], G.cut
    monkeypatch.setattr(G, "cut", lambda df: written.append(dict(df.dtypes)) or real(df))
    rows = [("k:b", "a:2"), ("k:a", "a:2"), ("k:a", "a:10"), ("k:c", "a:3"), ("x", "x"), ("y", None), ("z", "k:c"), ("k:b", "a:2")]
    got = G.components(spark.createDataFrame(rows, "src string, dst string"))
    near = {"a:10": ["k:b", "k:a", "a:2", "a:10"], "a:3": ["k:c", "a:3", "z"], "x": ["x"], "y": ["y"], None: [None]}
    assert sorted(map(tuple, got.collect()), key=str) == sorted(((v, c) for c, vs in near.items() for v in vs), key=str)
    assert all(kinds["src"] == "bigint" for kinds in written[2:])
    numbers = G.components(spark.createDataFrame([(3, 1), (5, 3), (8, 9), (4, 4)], "src long, dst long"))
    assert sorted(map(tuple, numbers.collect())) == [(1, 1), (3, 1), (4, 4), (5, 1), (8, 8), (9, 8)]
