"""Triples as N-Triples lines."""

from pyspark.sql import functions as F

from tripleweft.functions.text import escape_literal
from tripleweft.vocab import BLANK, BNODE, IRI


def node_text(col):
    """A subject in N-Triples and Turtle syntax: an IRI in brackets, a blank node as it is."""
    return F.when(col.startswith(BLANK), col).otherwise(F.concat(F.lit("<"), col, F.lit(">")))


def object_column():
    """Object of a triples row in N-Triples and Turtle syntax."""
    tail = F.coalesce(
        F.concat(F.lit("^^<"), F.col("o_datatype"), F.lit(">")),
        F.concat(F.lit("@"), F.col("o_lang")),
        F.lit(""),
    )
    literal = F.concat(F.lit('"'), escape_literal(F.col("o")), F.lit('"'), tail)
    iri = F.concat(F.lit("<"), F.col("o"), F.lit(">"))
    return F.when(F.col("o_kind") == IRI, iri).when(F.col("o_kind") == BNODE, F.col("o")).otherwise(literal)


def ntriples_lines(triples, keep=()):
    """One `value` row per triple; no shuffle."""
    line = F.concat(node_text(F.col("s")), F.lit(" <"), F.col("p"), F.lit("> "), object_column(), F.lit(" ."))
    return triples.select(*keep, line.alias("value"))


def write_ntriples(triples, path, mode="overwrite", compression=None):
    writer = ntriples_lines(triples).write.mode(mode)
    if compression:
        writer = writer.option("compression", compression)
    writer.text(path)
