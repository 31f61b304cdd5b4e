"""Spelling variants, grouped prefix join and ball-tree search against brute force, with small ranges, blocks and trees."""

from __future__ import annotations

import math
import random
import re
import string
from collections import Counter
from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallybook.llm import ball_tree, prefix_join, spelling

DOCS = "doc_id bigint, text string, lang string"


def docs_of(spark, rows):
    """Documents with further columns whose names clash with internal ones."""
    return spark.createDataFrame([(i, t, "en") for i, t in rows], DOCS).withColumns(
        {c: F.lit(1) for c in ("word", "n", "key", "node", "group", "comp", "term", "score", "rank", "part", "place", "bits", "item")})


def lower(text):
    return text.translate(str.maketrans(string.ascii_uppercase, string.ascii_lowercase))


# ---- op11


def brute_variants(rows, every):
    n = Counter()
    for i, t in rows:
        for w in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = lower(w)
            h = crc32(f"{'' if i is None else i}:{w}".encode())
            n[w[: h % len(w)] + w[h % len(w) + 1 :] if h % every == 0 else w] += 1
    n = {w: c for w, c in n.items() if len(w) >= 5 and c >= 3}

    def near(a, b):
        if abs(len(a) - len(b)) > 1 or a == b:
            return False
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b, strict=True)) == 1
        s, l = sorted((a, b), key=len)
        return any(l[:k] + l[k + 1 :] == s for k in range(len(l)))

    form, count = {}, {}
    for w in n:
        found = sorted((-n[x], x) for x in n if near(w, x))
        count[w] = len(found)
        form[w] = found[0][1] if found and -found[0][0] >= 2 * n[w] else None
    out = {}
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out[w] = (n[w], count[w], form[w], n[form[w]] if form[w] else None, root)
    return out


@pytest.fixture
def misspelt_rows():
    rng = random.Random(8)
    base = ["banana", "bandana", "aaaaaa", "aaaaaaa", "ÀÉîöü", "zebra", "stone", "stones", "notes", "abcde" * 40]
    vocabulary = []
    for w in base:
        variants = {w}
        for _ in range(12):
            k, c = rng.randrange(len(w) + 1), rng.choice("abnsé")
            variants |= {w[:k] + c + w[k:], w[:k] + w[k + 1 :], w[:k] + c + w[k + 1 :]}
        vocabulary += [(v, 20 if v == w else rng.choice((1, 1, 2, 5))) for v in sorted(variants)]
    texts = [" ".join(rng.choices([v for v, _ in vocabulary], [c for _, c in vocabulary], k=150)).title() + " 12ab-€xyzzy ĀstoneĀ’notes" for _ in range(40)]
    rows = [(i, t) for i, t in enumerate(texts)]
    return [*rows, rows[0], (None, texts[1]), (100, None), (101, ""), (102, " \n "), (103, "x" * 70_000 + " " + "stone " * 5000)]


@pytest.mark.parametrize("ranges", [5, 100_000])
def test_spelling_variants(spark, misspelt_rows, monkeypatch, ranges):
    monkeypatch.setattr(spelling, "RANGE_WORDS", ranges)
    monkeypatch.setattr(spelling, "TYPO_EVERY", 7)
    want = brute_variants(misspelt_rows, 7)
    got = spelling.spelling_variants(docs_of(spark, misspelt_rows)).collect()
    assert len(got) == len(want)
    assert {r["word"]: (r["n"], r["n_near"], r["form"], r["form_n"], r["root"]) for r in got} == want
    assert sum(1 for v in want.values() if v[2]) > 20 and max(v[1] for v in want.values()) > 5


def test_spelling_variants_of_nothing(spark):
    assert spelling.spelling_variants(docs_of(spark, [])).count() == 0
    assert [tuple(r) for r in spelling.spelling_variants(docs_of(spark, [(1, "single single single")])).collect()] == [("single", 3, 0, None, None, "single")]


def test_trie_nodes_are_the_shared_prefixes():
    words = sorted(w.encode() for w in ("a", "ab", "abc", "abd", "b", "ba", "bab", "c"))
    for cuts in ([8], [1, 7], [3, 3, 2], [1] * 8):
        at, parts = 0, []
        for k, size in enumerate(cuts):
            some = words[at : at + size]
            parts.append((k, some[0], some[-1], sum(len(w) + 1 for w in some)))
            at += size
        borders, nodes, at = spelling.Borders(parts).of, [], 0
        for k, size in enumerate(cuts):
            nodes += spelling.nodes_of(words[at : at + size], *borders[k])
            at += size
        name = {}
        for w, own in zip(words, nodes, strict=True):
            for i, node in enumerate(own):
                assert name.setdefault(w[:i], node) == node
        assert len(set(name.values())) == len(name)
        shared = {p for p in (w[:i] for w in words for i in range(len(w) + 1)) if sum(x.startswith(p) for x in words) > 1}
        assert set(name) >= shared


# ---- op12


def brute_components(rows, width, num, den):
    sets = {}
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", lower(t or ""))
        sets[i] = {tuple(w[k : k + width]) for k in range(max(1, len(w) - width + 1))} if w else set()
    comp = {i: i for i in sets}

    def root(i):
        while comp[i] != i:
            i = comp[i]
        return i

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            common = len(sets[a] & sets[b])
            if common and den * common >= num * (len(sets[a]) + len(sets[b]) - common):
                x, y = sorted((root(a), root(b)))
                comp[y] = x
    return {i: (len(sets[i]), root(i)) for i in ids}


def near_copies(seed, changes, copies=30):
    """Texts that share a long passage, families of near copies and exact copies."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdefg", k=rng.randint(2, 5)))
    passage = [word() for _ in range(60)]
    rows = [" ".join(word() for _ in range(rng.randint(1, 80))) for _ in range(20)]
    rows += [" ".join([*passage, *(word() for _ in range(rng.randint(0, 12)))]) for _ in range(30)]
    base = [word() for _ in range(120)]
    for _ in range(copies):
        t = list(base)
        for _ in range(rng.randint(0, changes)):
            t[rng.randrange(len(t))] = word()
        rows.append(" ".join(t))
    rows += [rows[0], rows[-1].upper(), rows[55] + "\n", None, "", " \t", "one", "One", "one two", "x " * 400]
    rng.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize(("seed", "changes", "small", "block"), [(1, 2, 16, 1024), (2, 3, 2, 4), (3, 6, 1, 7)])
def test_prefix_join(spark, monkeypatch, seed, changes, small, block):
    monkeypatch.setattr(prefix_join, "BLOCK", block)
    rows = near_copies(seed, changes)
    got = prefix_join.similar_documents(docs_of(spark, rows), small=small).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == brute_components(rows, 3, 90, 100)


def test_prefix_join_of_odd_rows(spark):
    assert prefix_join.similar_documents(docs_of(spark, [])).count() == 0
    rows = [(5, "a b c d"), (5, "a b c d"), (None, "a b c d"), (7, "A b c d"), (8, "e"), (None, None)]
    got = sorted((r["doc_id"] or 0, r["n_shingles"], r["component_id"]) for r in prefix_join.similar_documents(docs_of(spark, rows)).collect() if r["doc_id"] is not None or r["n_shingles"])
    assert got == [(0, 2, 5), (5, 2, 5), (5, 2, 5), (7, 2, 5), (8, 1, 8)]


def test_prefixes_hold_the_first_common_shingle():
    rule, rng = prefix_join.Rule(90, 100), np.random.default_rng(4)
    for _ in range(300):
        n = int(rng.integers(1, 60))
        a = set(rng.choice(200, n, replace=False).tolist())
        b = set(list(a)[int(rng.integers(0, 4)) :]) | set(rng.choice(200, int(rng.integers(0, 4))).tolist())
        if rule.holds(a, b):
            x, y = sorted(a), sorted(b)
            common = min(a & b)
            assert x.index(common) < rule.prefix(len(x)) and y.index(common) < rule.prefix(len(y))


# ---- op13


def brute_search(rows, items, top):
    term = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lower(t or ""))
    docs = [(i, Counter(term(t))) for i, t in rows if term(t)]
    big, total = len(docs), sum(sum(c.values()) for _, c in docs)
    df = Counter(t for _, c in docs for t in c)
    out = {}
    for name, text in set(items):
        scored = []
        for i, c in docs:
            n = sum(c.values())
            m = 100 - 50 + (50 * n * big) // total
            s = sum(math.floor(1000 * math.log((2 * big + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * c[t]) // (1000 * c[t] + 20 * m)) for t in set(term(text)) if t in c)
            if s > 0:
                scored.append((-s, math.inf if i is None else i))
        for k, (s, i) in enumerate(sorted(scored)[:top], 1):
            out[name, text, k] = (None if i == math.inf else i, -s)
    return out


@pytest.fixture
def searched():
    rng = random.Random(6)
    vocabulary = ["".join(rng.choices("abcdéü9", k=rng.randint(1, 4))) for _ in range(120)]
    weight = [1 / (k + 1) for k in range(len(vocabulary))]
    text = lambda n: " ".join(rng.choices(vocabulary, weight, k=n))
    rows = [(i, text(rng.randint(1, 60))) for i in range(150)]
    rows += [(200, rows[3][1]), (201, rows[3][1]), (3, rows[3][1]), (None, rows[3][1].upper()), (202, None), (203, ""), (204, "--- !"), (205, text(4000))]
    items = [(f"i{k}", text(rng.randint(1, 25))) for k in range(12)] + [("long", text(300)), ("none", ""), ("null", None), ("absent", "zzzzzz"), ("i0", "another ab é"), ("copy", rows[3][1])]
    return rows, [*items, items[2]]


@pytest.mark.parametrize(("chunk", "fan", "block", "top"), [(8192, 16, 100_000, 50), (5, 2, 250, 7)])
def test_ranked_search(spark, monkeypatch, searched, chunk, fan, block, top):
    for name, value in (("CHUNK", chunk), ("FAN", fan), ("BLOCK_TERMS", block)):
        monkeypatch.setattr(ball_tree, name, value)
    rows, items = searched
    frame = spark.createDataFrame(items, "item_id string, text string").withColumns({"score": F.lit(1), "words": F.lit("x"), "block": F.lit(2)})
    got = ball_tree.ranked_search(docs_of(spark, rows), frame, top).collect()
    want = brute_search(rows, items, top)
    assert {(r["item_id"], r["item_text"], r["rank"]): (r["doc_id"], r["score"]) for r in got} == want
    assert len(got) == len(want)


def test_ranked_search_of_nothing(spark):
    items = spark.createDataFrame([("a", "b")], "item_id string, text string")
    assert ball_tree.ranked_search(docs_of(spark, []), items).count() == 0
    assert ball_tree.ranked_search(docs_of(spark, [(1, "b")]), items.limit(0)).count() == 0


def test_tree_prunes_and_bounds_hold():
    rng = np.random.default_rng(2)
    terms_, adds = [], []
    for k in range(4000):
        t = np.unique(np.concatenate(([k // 40], rng.integers(100, 130, 6)))).astype(np.uint32)
        terms_.append(t)
        adds.append(np.where(t < 100, rng.integers(10**9, 10**10, len(t)), rng.integers(1, 10**8, len(t))))
    tree, flag = ball_tree.BallTree(terms_, adds), np.zeros(200, bool)
    for item in (np.array([5, 105, 110]), np.array([99]), np.array([100, 101]), np.array([199])):
        flag[:] = False
        flag[item] = True
        exact = np.array([int(a[flag[t]].sum()) for t, a in zip(terms_, adds, strict=True)])
        for level, bound in enumerate(tree.bounds(item)):
            wide = ball_tree.FAN ** (level + 1)
            assert all(bound[k] >= exact[k * wide : (k + 1) * wide].max() for k in range(len(bound)))
        best = ball_tree.Best(10)
        seen = tree.search(item, flag, best.least, lambda first, score: best.offer(score, np.arange(first, first + len(score))))
        order = np.lexsort((np.arange(4000), -exact))[:10]
        assert best.score.tolist() == [x for x in exact[order].tolist() if x > 0]
        if item[0] < 100:
            assert seen < len(tree.levels[0]) / 4
