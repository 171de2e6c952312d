"""All registered queries."""

from cardlake.plans import report_queries, graph_queries, stream_queries, text_queries  # noqa: F401
from cardlake.plans.registry import ORACLES, QUERIES  # noqa: F401
