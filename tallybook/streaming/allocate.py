"""Keyword allocation of a query stream: remaining budgets are kept as state per component."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from ..operators.allocation import UNIT, pick
from ..session import use_rocksdb_state

OUTPUT = StructType([
    StructField("comp", LongType()), StructField("seq", LongType()), StructField("adv_id", LongType()), StructField("bid", DoubleType()),
])


class BudgetKeeper(StatefulProcessor):
    """State per component: advertiser -> units spent so far."""

    def __init__(self, policy: str):
        self.policy = policy

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.spent = handle.getMapState(
            "spent", StructType([StructField("adv_id", LongType())]), StructType([StructField("units", LongType())])
        )

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timers) -> Iterator[pd.DataFrame]:
        """Rows are (seq, offers): a batch's queries of the component, put in order before they are served."""
        pdf = pd.concat(list(rows)).sort_values("seq")
        left, changed, out = {}, set(), []
        for seq, offers in zip(pdf["seq"], pdf["offers"]):
            cand = []
            for o in offers:
                adv = int(o["adv_id"])
                if adv not in left:
                    used = self.spent.getValue((adv,))[0] if self.spent.containsKey((adv,)) else 0
                    left[adv] = round(o["budget"] * UNIT) - used
                cand.append((adv, float(o["bid"]), float(o["budget"])))
            win = pick(self.policy, cand, left)
            if win is not None:
                left[win[0]] -= round(win[1] * UNIT)
                changed.add((win[0], round(next(o["budget"] for o in offers if o["adv_id"] == win[0]) * UNIT)))
                out.append((key[0], seq, *win))
        for adv, budget in changed:
            self.spent.updateValue((adv,), (budget - left[adv],))
        yield pd.DataFrame(out, columns=["comp", "seq", "adv_id", "bid"])

    def close(self) -> None:
        pass


def allocate_stream(queries: DataFrame, bids: DataFrame, budgets: DataFrame, policy: str, comp: DataFrame) -> DataFrame:
    """Streaming ``(seq, keyword)`` -> (comp, seq, adv_id, bid).

    ``comp(keyword, comp)`` numbers the components of the bid graph; queries of one component share
    budgets and are served in ``seq`` order within a batch, batches in order of arrival.
    """
    use_rocksdb_state(queries.sparkSession)
    book = bids.join(budgets, "adv_id").groupBy("keyword").agg(F.collect_list(F.struct("adv_id", "bid", "budget")).alias("offers"))
    rows = queries.join(book, "keyword").join(comp, "keyword").select("comp", "seq", "offers")
    return rows.groupBy("comp").transformWithStateInPandas(
        statefulProcessor=BudgetKeeper(policy), outputStructType=OUTPUT, outputMode="Append", timeMode="None"
    )
