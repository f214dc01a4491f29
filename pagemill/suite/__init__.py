"""Every operator as a query over the given tables, with its SQL oracle where there is one."""

from pagemill.suite import aggregates, batches, files, graph, html, records, relevance, streams, urls  # noqa: F401
from pagemill.suite.registry import ORACLES, QUERIES  # noqa: F401
