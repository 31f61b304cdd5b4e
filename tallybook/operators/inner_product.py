"""Exact best inner products of users and items, without scoring all pairs.

Items lie in blocks by falling norm. No product with an item of a block exceeds |user| times the block's largest norm, so a user is done
as soon as that falls below the last score of a full list. Blocks come in rounds of one, two, four and so on; a round deals the users that are
still open anew into blocks, each of which meets the round's item blocks in one task, in order, and leaves out the users that are done by then.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.arrow import map_stream
from ..session import Rolling, cut
from .facts import expand
from .ordering import rank_within

#: Users and items of a block.
USERS, ITEMS = 4096, 2048
#: Bounds are raised by this share: far more than the rounding of products in doubles.
SLACK = 1e-9
_STATE = "user_id bigint, vec array<double>, need bigint, items array<bigint>, scores array<double>, scored bigint"


def _norm(c: str):
    return F.sqrt(F.aggregate(c, F.lit(0.0), lambda a, x: a + x * x))


def item_blocks(items: DataFrame, size: int) -> DataFrame:
    """(block, norm, ids, vecs): items by falling norm, ``size`` a block, with the largest norm of each."""
    placed = rank_within(items.withColumn("norm", _norm("vec")), [], [F.desc("norm"), F.asc("item_id")], "place").withColumn("block", F.floor((F.col("place") - 1) / size))
    listed = F.array_sort(F.collect_list(F.struct("place", "item_id", "vec"))).alias("m")
    return placed.groupBy("block").agg(F.max("norm").alias("norm"), listed).select(
        "block", "norm", F.transform("m", lambda x: x["item_id"]).alias("ids"), F.flatten(F.transform("m", lambda x: x["vec"])).alias("vecs"))


class _Users:
    """Users of one block with their lists so far."""

    def __init__(self, t: pa.Table):
        self.id, self.need = t.column("user_id").to_pylist(), t.column("need").to_pylist()
        self.vec = np.array(t.column("vec").to_pylist(), np.float64)
        self.items = [np.array(x, np.int64) for x in t.column("items").to_pylist()]
        self.scores = [np.array(x, np.float64) for x in t.column("scores").to_pylist()]
        self.scored = np.array(t.column("scored").to_pylist(), np.int64)
        self.norm = np.sqrt((self.vec * self.vec).sum(axis=1))
        self.least = np.array([s[-1] if len(s) >= n else -np.inf for s, n in zip(self.scores, self.need, strict=True)])

    def meet(self, norm: float, ids: np.ndarray, vecs: np.ndarray) -> None:
        open_ = np.flatnonzero(self.norm * norm * (1 + SLACK) + SLACK >= self.least)
        if not len(open_):
            return
        self.scored[open_] += len(ids)
        for u, row in zip(open_.tolist(), self.vec[open_] @ vecs.T, strict=True):
            good = row >= self.least[u]
            if good.any():
                items, scores = np.concatenate((self.items[u], ids[good])), np.concatenate((self.scores[u], row[good]))
                order = np.lexsort((items, -scores))[: self.need[u]]
                self.items[u], self.scores[u] = items[order], scores[order]
                if len(order) == self.need[u]:
                    self.least[u] = self.scores[u][-1]

    def rows(self) -> pa.RecordBatch:
        n, size = self.vec.shape
        vec = pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * size, pa.int32()), pa.array(self.vec.ravel()))
        return pa.RecordBatch.from_arrays(
            [pa.array(self.id, pa.int64()), vec, pa.array(self.need, pa.int64()), pa.array(self.items, pa.list_(pa.int64())), pa.array(self.scores, pa.list_(pa.float64())), pa.array(self.scored)],
            ["user_id", "vec", "need", "items", "scores", "scored"])


def _round(open_: DataFrame, blocks: DataFrame, slots: int) -> DataFrame:
    """The state of ``open_`` users after they met ``blocks``."""
    none = F.lit(None)
    state = ["user_id", "vec", "need", "items", "scores", "scored"]
    users = open_.select(F.pmod(F.xxhash64("user_id"), F.lit(slots)).cast("int").alias("slot"), none.cast("bigint").alias("block"), none.cast("double").alias("norm"),
                         none.cast("array<bigint>").alias("ids"), none.cast("array<double>").alias("vecs"), *state)
    kinds = dict(open_.dtypes)
    items = expand(blocks, F.lit(slots), "_s").select((F.col("_s") - 1).cast("int").alias("slot"), "block", "norm", "ids", "vecs", *[none.cast(kinds[c]).alias(c) for c in state])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slot, held, users_ = None, [], None
        for b in batches:
            slots_ = b.column("slot").to_numpy()
            new = np.flatnonzero(slots_[1:] != slots_[:-1]) + 1
            for s, e in zip([0, *new.tolist()], [*new.tolist(), b.num_rows], strict=True):
                if slots_[s] != slot:
                    if users_ is None and held:
                        users_ = _Users(pa.Table.from_batches(held))
                    if users_ is not None:
                        yield users_.rows()
                    slot, held, users_ = slots_[s], [], None
                part = b.slice(s, e - s)
                n = part.column("block").null_count  # users come first
                if n:
                    held.append(part.slice(0, n))
                if n < part.num_rows and held:
                    if users_ is None:
                        users_ = _Users(pa.Table.from_batches(held))
                    for k in range(n, part.num_rows):
                        ids = np.asarray(part.column("ids")[k].values, np.int64)
                        users_.meet(part.column("norm")[k].as_py(), ids, np.asarray(part.column("vecs")[k].values).reshape(len(ids), -1))
        if users_ is None and held:
            users_ = _Users(pa.Table.from_batches(held))
        if users_ is not None:
            yield users_.rows()

    placed = users.unionByName(items).repartitionById(slots, F.col("slot")).sortWithinPartitions("slot", F.col("block").asc_nulls_first())
    return map_stream(placed, run, _STATE)


def best_products(users: DataFrame, items: DataFrame, users_size: int = USERS, items_size: int = ITEMS) -> DataFrame:
    """(user_id, items, scores, scored) for ``users(user_id, vec, need)`` and ``items(item_id, vec)``.

    ``items`` are the ``need`` best (all, if there are fewer), by falling score, ties by item id; ``scored`` is the number of products computed for the user.
    """
    blocks = cut(item_blocks(items.select("item_id", F.col("vec").cast("array<double>").alias("vec")), items_size))
    norms = dict(map(tuple, blocks.select("block", "norm").collect()))  # one number a block
    roll = Rolling()
    state = roll.cut(users.select(
        "user_id", F.col("vec").cast("array<double>").alias("vec"), F.col("need").cast("bigint").alias("need"), F.array().cast("array<bigint>").alias("items"),
        F.array().cast("array<double>").alias("scores"), F.lit(0).cast("bigint").alias("scored")).where("need > 0"))
    first = 0
    while first < len(norms):
        bound = _norm("vec") * F.lit(norms[first] * (1 + SLACK)) + SLACK
        open_ = (F.size("scores") < F.col("need")) | (bound >= F.get("scores", F.size("scores") - 1))
        left = state.where(open_).count()
        if not left:
            break
        last = 2 * first + 1
        met = _round(state.where(open_), blocks.where((F.col("block") >= first) & (F.col("block") < last)), -(-left // users_size))
        state = roll.cut(state.where(~open_).unionByName(met))
        first = last
    return state.select("user_id", "items", "scores", "scored")
