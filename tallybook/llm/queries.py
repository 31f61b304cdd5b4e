"""All queries of this subpackage."""

from . import ball_tree, chat, decontaminate, fingerprints, lm_score, near_dedup, packing, pii, prefix_join, sharding, spelling, toxicity, url_filter  # noqa: F401
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
