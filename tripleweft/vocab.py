"""Vocabulary IRIs, the triples schema and the output format table."""

from pyspark.sql import types as T

# Public vocabulary IRIs.
RDF = "http://www.w3.org/1999/02/22-rdf-syntax-ns#"
RDF_TYPE = RDF + "type"
XSD = "http://www.w3.org/2001/XMLSchema#"
RR = "http://www.w3.org/ns/r2rml#"
RML = "http://semweb.mmlab.be/ns/rml#"
QL = "http://semweb.mmlab.be/ns/ql#"
SCHEMA = "https://schema.org/"

# A constant object that starts with one of these is an IRI.
IRI_STARTS = ("http://", "https://", "urn:")

# Accepted reference formulations, lower case to canonical.
FORMULATIONS = {"jsonpath": "JSONPath", "xpath": "XPath", "csv": "CSV"}

# Output formats as (name, file extension, mime type).
OUTPUT_FORMATS = (
    ("TURTLE", "ttl", "text/turtle"),
    ("NTRIPLES", "nt", "application/n-triples"),
    ("JSONLD", "jsonld", "application/ld+json"),
    ("RDFXML", "rdf", "application/rdf+xml"),
)

IRI = "iri"
LITERAL = "literal"
BNODE = "bnode"
# Fixed value: how a blank node starts, as subject or object.
BLANK = "_:"

TRIPLE_COLUMNS = ("s", "p", "o", "o_kind", "o_datatype", "o_lang")

TRIPLES_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in TRIPLE_COLUMNS])


def is_iri_constant(value):
    """True if a constant object is to be written as an IRI."""
    return value.startswith(IRI_STARTS)
