"""The named queries; importing a module registers its queries."""

from roadpulse.plans import (  # noqa: F401
    load_queries,
    analysis_queries,
    feature_queries,
    mining_queries,
    model_queries,
    stream_queries,
    replay_queries,
)
from roadpulse.plans.registry import ORACLES, QUERIES  # noqa: F401
