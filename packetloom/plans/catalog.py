"""All registered queries."""

from packetloom.plans import (  # noqa: F401
    detect_queries,
    feature_queries,
    graph_queries,
    model_queries,
    source_queries,
    stream_queries,
    traffic_queries,
)
from packetloom.plans.registry import ORACLES, QUERIES  # noqa: F401
