"""Registered queries and their oracle SQL, by name."""

from tripleweft.queries import graph, rules, sinks, sources, streams, terms

_MODULES = (sources, terms, rules, graph, sinks, streams)


def all_queries():
    return {name: fn for m in _MODULES for name, fn in m.registry.queries.items()}


def all_oracles():
    return {name: sql for m in _MODULES for name, sql in m.registry.oracles.items()}
