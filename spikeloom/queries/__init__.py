"""Registered queries of the burst-analytics operators and their SQL."""

from . import browse, flows, reports, scores, signals, states, units

PARTS = (signals, reports, flows, browse, scores, states, units)
QUERIES: dict = {name: f for part in PARTS for name, f in part.QUERIES.items()}
ORACLES: dict = {name: sql for part in PARTS for name, sql in part.ORACLES.items()}
