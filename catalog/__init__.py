"""Queries on the test tables, one per operator, with the SQL that checks them."""

from . import certs, dns, edges, files, graph, names

MODULES = (names, edges, dns, files, certs, graph)

QUERIES = {name: query for m in MODULES for name, (query, _) in m.CATALOG.items()}
ORACLES = {name: sql for m in MODULES for name, (_, sql) in m.CATALOG.items() if sql}
