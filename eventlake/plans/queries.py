"""All registered queries of the event-log operators."""

from eventlake.plans import canonical_queries, hybrid_queries, routing_queries, state_queries, stream_queries  # noqa: F401
from eventlake.plans.registry import ORACLE_SQL, QUERIES
from eventlake.plans.routing_queries import normalized as flagship

__all__ = ["ORACLE_SQL", "QUERIES", "flagship"]
