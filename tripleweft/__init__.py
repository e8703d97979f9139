"""Declarative mapping of tables, CSV, JSON and XML to RDF triples as Spark plans."""

from tripleweft.mapping import Mapping, ObjectMap, TriplesMap, constant, ref, template
from tripleweft.plans.compile import materialise, triples_of

__all__ = [
    "Mapping",
    "ObjectMap",
    "TriplesMap",
    "constant",
    "materialise",
    "ref",
    "template",
    "triples_of",
]
