"""Scores that decide which advertiser gets a query."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from .hashing import col

POLICIES = ("greedy", "msvv", "balance")


def psi(spent) -> Column:
    """Discount of a bid by the fraction of the budget already spent."""
    return F.lit(1.0) - F.exp(col(spent) - F.lit(1.0))


def bid_score(policy: str, bid, remaining, budget) -> Column:
    if policy == "greedy":
        return col(bid)
    if policy == "msvv":
        return col(bid) * psi(F.lit(1.0) - col(remaining) / col(budget))
    if policy == "balance":
        return col(remaining)
    raise ValueError(f"unknown policy {policy}")


def local_score(policy: str, bid: float, remaining: float, budget: float) -> float:
    """The same score for one bid inside a task."""
    if policy == "greedy":
        return bid
    if policy == "msvv":
        return bid * (1.0 - math.exp(-remaining / budget))
    if policy == "balance":
        return remaining
    raise ValueError(f"unknown policy {policy}")
