"""Toxicity scores over noisy-channel deobfuscation.

1. Character trigrams of all documents are counted over a fixed alphabet of 64 symbols (so the model has 64^3 cells at any size)
   and smoothed into a language model.
2. A token of any length with leetspeak, separators or repeated letters spans a lattice: each run of a character may stand for the letters
   it imitates, once or twice, and a separator for nothing or a space. Viterbi decoding under the language model picks the reading. Tokens
   without such signs have one path and stay as they are. Runs of tokens of up to three characters ("a i d i o t", "id io t") span one
   lattice, in which each space stays or goes; a word over several tokens counts as itself or as what is left of it from any of them on.
3. Restored words and their prefixes of 4 to 6 letters, which stand for word families, are counted by class over labelled
   rows; those that are significant for the toxic class make the lexicon.
4. A logistic model of (hits, hits per word) turns lexicon hits into a score.

The classifier is fitted on at most about ``MAX_LABELLED`` labelled rows, drawn by a hash of doc_id; their ids are small enough
to be sent to all tasks, so that texts are not shuffled. The language model and the scores cover all rows whole.

Defined results: null and empty texts get the score of no hits; null labels and labels without a document are not used; with
no rows of one of the classes all scores are the share of the other (0 without labels); repeated rows are scored each.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate, groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import map_stream, table
from .registry import query

MAX_LABELLED = 50_000
#: Least documents, G2 statistic and ratio of class shares of a lexicon entry; most entries of the lexicon.
MIN_DOCS, MIN_G2, MIN_RATIO, MAX_LEXICON = 4, 30.0, 8.0, 50_000
PREFIXES = (4, 5, 6)
PREDICT_AT = 0.3

# fixed values: characters that imitate letters
LEET = {
    "0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "li", "+": "t", "(": "c", "{": "c", "<": "c", "€": "e", "£": "l", "¥": "y", "%": "o", "#": "h", "&": "a",
}
SEPARATORS = ".-_*~'`^,:;/\\"
_ALPHABET = "abcdefghijklmnopqrstuvwxyzßàáâãäåæçèéêëìíîïðñòóôõöøùúûüýþÿœ"
_CODE = {c: i + 1 for i, c in enumerate(_ALPHABET)}
_LATIN = np.zeros(256, np.int32)
for _c, _i in _CODE.items():
    if ord(_c) < 256:
        _LATIN[ord(_c)] = _i
N = 64
_EDGE = ".,;:!?\"'()[]{}<>|*#%&$~^_-=+/\\`@"
_SPOTS = re.compile(r"([^\W\d_])\1\1|([^\W\d_])\2.*([^\W\d_])\3|[^\W\d_][^\w\s]+\w|\d[^\W\d_]|[^\W\d_]\d|[^\w\s][^\W\d_]|_")


def trigram_counts(docs: DataFrame, text: str = "text") -> np.ndarray:
    """64 x 64 x 64 counts of lower-case letter trigrams; symbol 0 is any other character."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(N**3, np.int64)
        for b in batches:
            whole = " ".join(t.lower() for t in b.column(0).to_pylist() if t)
            codes = _LATIN[np.frombuffer(f" {whole} ".encode("latin-1", "replace"), np.uint8)]
            for i in range(0, len(codes) - 2, 1 << 20):
                c = codes[i : i + (1 << 20) + 2]
                total += np.bincount((c[:-2] * N + c[1:-1]) * N + c[2:], minlength=N**3)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], ["cell", "n"])

    rows = map_stream(docs.select(F.col(text).cast("string")), count, "cell bigint, n bigint").groupBy("cell").agg(F.sum("n").alias("n"))
    total = np.zeros(N**3, np.float64)
    for r in rows.collect():  # at most 64^3 rows
        total[r["cell"]] = r["n"]
    return total.reshape(N, N, N)


def smoothed(counts: np.ndarray) -> np.ndarray:
    """log P(c | a, b): interpolation of tri-, bi- and unigram estimates with Witten-Bell weights."""
    uni = (counts.sum((0, 1)) + 1) / (counts.sum() + N)
    two = counts.sum(0)
    kinds = (two > 0).sum(1, keepdims=True)
    bi = (two + np.maximum(kinds, 1) * uni) / (two.sum(1, keepdims=True) + np.maximum(kinds, 1))
    kinds = (counts > 0).sum(2, keepdims=True)
    tri = (counts + np.maximum(kinds, 1) * bi) / (counts.sum(2, keepdims=True) + np.maximum(kinds, 1))
    return np.log(tri).astype(np.float32)


_TWICE = re.compile(r"(.)\1")
_SHORT = 3
#: Tokens over this are not remembered, and tails are cut here, well over any prefix.
_LONG, _TAIL = 60, 24
#: In readings: a space that was dropped.
_JOINT = "\x1f"


def _readings(c: str, run: int) -> list[tuple[str, float]]:
    """What ``run`` times the character ``c`` may stand for, with log channel probabilities."""
    if c == " ":
        return [(_JOINT, -0.7), (" ", -0.7)]
    letters = LEET.get(c, "") if not c.isalpha() else c
    out = []
    for x in letters:
        if run == 1:
            out.append((x, -0.1 if c.isalpha() else -0.7))
        elif run == 2:
            out += [(x + x, -0.2), (x, -2.5)]
        else:
            out += [(x, -0.7), (x + x, -1.2)]
    if not c.isalnum():
        out.append(("", -1.0 if c in SEPARATORS else -4.0))
        if c in SEPARATORS:
            out.append((" ", -1.0))
    elif not letters:
        out.append((c * min(run, 2), -1.0))
    return out


def decode(token: str, logp: np.ndarray) -> str:
    """The most probable reading of a token's lattice."""
    best: dict[tuple[int, int], tuple[float, tuple | None]] = {(0, 0): (0.0, None)}
    i = 0
    while i < len(token):
        j = i
        while j < len(token) and token[j] == token[i]:
            j += 1
        step: dict[tuple[int, int], tuple[float, tuple | None]] = {}
        for out, cost in _readings(token[i], j - i):
            for (a, b), (s, done) in best.items():
                x, y, z = a, b, s + cost
                for ch in out if out != _JOINT else "":
                    k = _CODE.get(ch, 0)
                    z += float(logp[x, y, k])
                    x, y = y, k
                if (x, y) not in step or z > step[x, y][0]:
                    step[x, y] = (z, (done, out))
        best, i = step, j
    back = max(((s + float(logp[a, b, 0]), n) for n, ((a, b), (s, _)) in enumerate(best.items())))[1]
    parts, at = [], list(best.values())[back][1]
    while at:
        at, out = at
        parts.append(out)
    return "".join(reversed(parts))


def is_plain(token: str, core: str) -> bool:
    """Letters without a doubled one, and no more than one mark behind them: such a token has no spots."""
    return core.isalpha() and (len(core) == len(token) or len(core) + 1 == len(token) and token[-1] in ".,;:!?") and not _TWICE.search(core)


class Restorer(dict):
    """Raw lower-case token -> restored words, remembered up to a bound."""

    def __init__(self, logp: np.ndarray):
        super().__init__()
        self.logp, self.runs = logp, {}

    def __missing__(self, token: str) -> str:
        if len(self) > 300_000:
            self.clear()
        core = token.strip(_EDGE)
        if not is_plain(token, core) and _SPOTS.search(token):
            hidden = token.strip(".,;:?\"'")
            whole = decode(hidden, self.logp) if hidden != core and any(c in LEET for c in hidden) else core
            inner = decode(core, self.logp) if _SPOTS.search(core) else core
            word = inner if not any(c in LEET for c in hidden[:1] + hidden[-1:]) else f"{inner} {whole}"
        else:
            word = core
        if len(token) <= _LONG:
            self[token] = word
        return word

    def joined(self, run: tuple[str, ...]) -> tuple[list[list[str]], list[str]]:
        """For each word that the reading of a run of short tokens joins: itself and its tails. Then, of single letters, those of the whole run."""
        if run in self.runs:
            return self.runs[run]
        if len(self.runs) > 100_000:
            self.runs.clear()
        single, pieces = all(len(t) == 1 for t in run), []
        for t in run:
            if single and pieces and pieces[-1][0] == t:
                pieces[-1] += t  # one run of the character
            else:
                pieces.append(t)
        reading = decode(" ".join(pieces), self.logp)
        words = [w for w in (_tails(x) for x in reading.split(" ")) if len(w) > 1]
        whole = [decode("".join(run), self.logp), *_tails(reading.replace(" ", _JOINT))] if single and len(run) >= 3 else []
        if sum(map(len, run)) <= _LONG:
            self.runs[run] = words, whole
        return words, whole


def _tails(joined: str) -> list[str]:
    """A word with marks of its joints, without them, then what is left of it from each joint on."""
    parts = joined.split(_JOINT)
    word, at, out = "".join(parts), 0, []
    for x in parts:
        if x:
            out.append(word[at : at + _TAIL] if at else word)
        at += len(x)
    return out


class Cores(dict):
    """Token -> a short token without the punctuation around it, nothing for lone punctuation, None for any other; remembered up to a bound."""

    def __missing__(self, t: str) -> str | None:
        if len(self) > 300_000:
            self.clear()
        core = t if len(t) == 1 else t.strip(".,;:!?\"'") if len(t) <= _SHORT + 2 else t
        got = core if 0 < len(core) <= _SHORT else None if core or len(t) > _SHORT else ""
        if len(t) <= _LONG:
            self[t] = got
        return got


def short_runs(tokens: list[str], cores: Cores | None = None) -> list[tuple[str, ...]]:
    """Runs of two or more tokens of up to three characters, without the punctuation around them."""
    out, run = [], []
    for core in map((Cores() if cores is None else cores).__getitem__, tokens):
        if core is None:
            if run:
                if len(run) >= 2:
                    out.append(tuple(run))
                run = []
        elif core:
            run.append(core)
    if len(run) >= 2:
        out.append(tuple(run))
    return out


def single_runs(run: tuple[str, ...]) -> list[tuple[str, ...]]:
    """The parts of ``run`` that are three or more single characters in a row."""
    return [p for p in (tuple(g) for one, g in groupby(run, lambda t: len(t) == 1) if one) if len(p) >= 3]


def spelled(runs: list[tuple[str, ...]], restore: Restorer) -> list[str]:
    """Words in runs of three or more single characters."""
    out = []
    for run in runs:
        for part in single_runs(run):
            words, whole = restore.joined(part)
            out += [whole[0], *[w[0] for w in words]]
    return out


def features(word: str) -> list[str]:
    return ["=" + word, *[word[:k] for k in PREFIXES if len(word) >= k]] if len(word) >= 3 else []


class Lexicon(dict):
    """Restored word -> its entry, if it or a prefix of it is one; remembered up to a bound."""

    def __init__(self, entries: set[str]):
        super().__init__()
        self.entries, self.runs = entries, {}

    def __missing__(self, word: str) -> str | None:
        if len(self) > 300_000:
            self.clear()
        self[word] = got = next((f for f in features(word) if f in self.entries), None)
        return got

    def holds(self, word: str) -> bool:
        """Whether the word has an entry, without remembering it."""
        known = self.entries
        return len(word) >= 3 and ("=" + word in known or any(word[:k] in known for k in PREFIXES if len(word) >= k))

    def hits_of(self, run: tuple[str, ...], restore: Restorer) -> int:
        """Hits in words over several tokens of ``run``."""
        if run not in self.runs:
            if len(self.runs) > 100_000:
                self.runs.clear()
            got = self._hits_of(run, restore)
            if sum(map(len, run)) > _LONG:
                return got
            self.runs[run] = got
        return self.runs[run]

    def _hits_of(self, run: tuple[str, ...], restore: Restorer) -> int:
        parts = single_runs(run)
        if parts == [run]:
            words, whole = restore.joined(run)
            return max(sum(any(self[x] for x in w) for w in words), int(any(self[x] for x in whole)))
        inner, text = sum(self.hits_of(p, restore) for p in parts), "".join(run)
        if text.isalpha() and not _TWICE.search(" ".join(run)):
            # letters stand for themselves; most runs hold no entry at all, however they are joined
            at = list(accumulate(map(len, run), initial=0))
            if not any(text[i : i + k] in self.entries for i in at for k in PREFIXES) and not any(
                f"={text[i:j]}" in self.entries for n, i in enumerate(at) for j in at[n + 2 : n + 2 + _TAIL]):
                return inner
        elif not any(c.isalpha() for c in text):
            return inner
        return max(inner, sum(any(self[x] for x in w) for w in restore.joined(run)[0]))


class TokenHits(dict):
    """Raw token -> hits among its restored words, remembered up to a bound."""

    def __init__(self, restore: Restorer, lexicon: Lexicon):
        super().__init__()
        self.restore, self.lexicon = restore, lexicon

    def __missing__(self, token: str) -> int:
        if len(self) > 300_000:
            self.clear()
        core = token.strip(_EDGE)
        got = int(self.lexicon.holds(core)) if is_plain(token, core) else sum(self.lexicon[w] is not None for w in self.restore[token].split())
        if len(token) <= _LONG:
            self[token] = got
        return got


def learn_lexicon(labelled: DataFrame, shared_lm, toxic: int, clean: int) -> set[str]:
    """Entries significant for the toxic class among ``labelled(text, y)``."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restore, cores, known = Restorer(shared_lm.value), Cores(), {}
        for b in batches:
            by: tuple[Counter, Counter] = (Counter(), Counter())
            for t, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                tokens, found = (t or "").lower().split(), set()
                for x in set(tokens):
                    if x not in known:
                        if len(known) > 200_000:
                            known.clear()
                        known[x] = tuple(f for w in restore[x].split() for f in features(w))
                    found.update(known[x])
                found.update(f for w in spelled(short_runs(tokens, cores), restore) for f in features(w))
                by[y].update(found)
            names = list(by[0].keys() | by[1].keys())
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.string()), pa.array([by[1][f] for f in names], pa.int64()), pa.array([by[0][f] for f in names], pa.int64())],
                ["f", "a", "b"])

    n = float(toxic + clean)
    a, b = F.col("a"), F.col("b")

    def term(x: Column, m: float) -> Column:
        return F.when(x > 0, x * F.log(x * n / ((a + b) * m))).otherwise(0.0)

    out_a, out_b = F.lit(float(toxic)) - a, F.lit(float(clean)) - b
    rest = F.lit(n) - a - b

    def other(x: Column, m: float) -> Column:
        return F.when(x > 0, x * F.log(x * n / (rest * m))).otherwise(0.0)

    g2 = 2 * (term(a, float(toxic)) + term(b, float(clean)) + other(out_a, float(toxic)) + other(out_b, float(clean)))
    rows = (
        map_stream(labelled, count, "f string, a bigint, b bigint").groupBy("f").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
        .where((a >= MIN_DOCS) & (a / toxic >= MIN_RATIO * b / clean)).withColumn("g2", g2).where(F.col("g2") >= MIN_G2)
        .orderBy(F.desc("g2"), "f").limit(MAX_LEXICON).collect()
    )
    return {r["f"] for r in rows}


def hits(docs: DataFrame, shared, carry: list[str], text: str = "text") -> DataFrame:
    """``carry`` columns with ``n_words`` and ``n_hits``, the number of restored words that are lexicon entries."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        logp, entries = shared.value
        restore, lexicon, cores = Restorer(logp), Lexicon(entries), Cores()
        token_hits = TokenHits(restore, lexicon)
        for b in batches:
            n, h = [], []
            for t in b.column("_t").to_pylist():
                tokens = (t or "").lower().split()
                n.append(len(tokens))
                h.append(sum(map(token_hits.__getitem__, tokens)) + sum(lexicon.hits_of(r, restore) for r in short_runs(tokens, cores)))
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in carry], pa.array(n, pa.int64()), pa.array(h, pa.int64())], [*carry, "n_words", "n_hits"])

    rows = docs.select(*[F.col(f"`{c}`") for c in carry], F.col(text).cast("string").alias("_t"))
    schema = rows.drop("_t").withColumns({"n_words": F.lit(None).cast("bigint"), "n_hits": F.lit(None).cast("bigint")}).schema
    return map_stream(rows, count, schema)


def _inputs(h, n):
    """Model inputs of hit and word counts; works on arrays and on columns."""
    log = F.log1p if isinstance(h, Column) else np.log1p
    return log(h), log(100.0 * h / (n + 1.0))


def fit(rows: list[tuple[int, int, int, int]]) -> np.ndarray:
    """Ridge logistic regression on (hits, words, label, count) rows by Newton steps."""
    h, n, y, c = (np.array(x, float) for x in zip(*rows, strict=True))
    x = np.stack([np.ones_like(h), *_inputs(h, n)], 1)
    w = np.zeros(3)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (c * (p - y)) + np.array([0, 1, 1]) * w
        step = np.linalg.solve((x * (c * p * (1 - p))[:, None]).T @ x + np.diag([1e-6, 1, 1]), grad)
        w -= step
        if abs(step).max() < 1e-9:
            break
    return w


def toxicity_scores(
    docs: DataFrame, labels: DataFrame, carry: list[str] | None = None, doc_id: str = "doc_id", text: str = "text",
    train: Column | None = None, reference: DataFrame | None = None,
) -> DataFrame:
    """``docs`` (or its ``carry`` columns) with ``n_words``, ``n_hits``, ``score`` and ``predicted``; such columns are replaced.

    ``train``: which labelled rows may be learned from, by default all. ``reference``: the table that labels refer to, if
    ``docs`` is only a part of it.
    """
    spark, carry = docs.sparkSession, [c for c in (docs.columns if carry is None else carry) if c not in ("score", "predicted", "n_words", "n_hits", "_t")]
    reference = docs if reference is None else reference
    known = labels.select(F.col("doc_id").cast("bigint").alias("_id"), F.col("toxic").cast("int").alias("_y")).where("_y in (0, 1)")
    known = known.where(train if train is not None else F.lit(True))
    total = known.count()
    cell = 1_000_000
    drawn = known.where(F.pmod(F.xxhash64("_id"), F.lit(cell)) < int(cell * min(1.0, MAX_LABELLED / max(1, total))))
    labelled = reference.join(F.broadcast(drawn), F.col(doc_id).cast("bigint") == F.col("_id")).select(F.col(text).cast("string").alias("_t"), "_y")
    size = {r["_y"]: r["n"] for r in labelled.groupBy("_y").agg(F.count("*").alias("n")).collect()}
    logp = smoothed(trigram_counts(docs, text))
    if len(size) < 2:
        weights, entries = None, set()
    else:
        lm = spark.sparkContext.broadcast(logp)
        entries = learn_lexicon(labelled, lm, size[1], size[0])
        shared = spark.sparkContext.broadcast((logp, entries))
        seen = hits(labelled, shared, ["_y"], "_t")
        near = F.when(F.col("n_words") < 32, F.col("n_words")).otherwise(F.floor(F.pow(F.lit(2.0), F.floor(F.log2("n_words") * 4) / 4)))
        bins = seen.groupBy(F.least("n_hits", F.lit(200)).alias("h"), near.cast("bigint").alias("n"), "_y").count().collect()
        weights = fit([(r["h"], r["n"], r["_y"], r["count"]) for r in bins])
    shared = spark.sparkContext.broadcast((logp, entries))
    found = hits(docs, shared, carry, text)
    if weights is None:
        score = F.lit(1.0 if 1 in size else 0.0)
    else:
        one, two = _inputs(F.col("n_hits"), F.col("n_words"))
        z = F.lit(float(weights[0])) + float(weights[1]) * one + float(weights[2]) * two
        score = 1 / (1 + F.exp(-z))
    return found.withColumn("score", score).withColumn("predicted", (F.col("score") >= PREDICT_AT).cast("int"))


def held_out(doc_id: str) -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


@query("op4_toxicity")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    return toxicity_scores(docs, labels, carry=["doc_id"], train=~held_out("_id")).select(
        "doc_id", held_out("doc_id").alias("held_out"), "score", "predicted", "n_hits", "n_words")
