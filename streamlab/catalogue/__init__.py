"""Registered queries over the driver tables, each with its SQL counterpart where one exists."""

from streamlab.catalogue import flights, patients, posts, quotes, votes

_PARTS = (flights, quotes, votes, patients, posts)


def all_queries() -> dict:
    return {name: fn for part in _PARTS for name, fn in part.QUERIES.items()}


def all_oracles() -> dict:
    return {name: sql for part in _PARTS for name, sql in part.ORACLES.items()}
