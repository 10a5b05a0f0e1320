"""Named queries over the given tables, with the SQL each must agree with."""

from . import clusters, flows, items, neighbors, texts

_PARTS = (items, texts, neighbors, clusters, flows)
QUERIES = {name: query for part in _PARTS for name, query in part.QUERIES.items()}
ORACLES = {name: sql for part in _PARTS for name, sql in part.ORACLES.items()}
