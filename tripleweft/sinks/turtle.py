"""Triples as Turtle, predicate-object lines by subject."""

from pyspark.sql import functions as F

from tripleweft.sinks.ntriples import node_text, object_column
from tripleweft.sinks.subjects import subject_lines
from tripleweft.vocab import RDF_TYPE

# Fixed value: what `turtle_lines` puts before a predicate-object pair.
_INDENT = "    "


def turtle_lines(triples, distinct=False, sample=None):
    """Rows (s, value): lines of Turtle, sorted by subject (with a `sample`, subject by subject); in this order they make up the file."""
    verb = F.when(F.col("p") == RDF_TYPE, F.lit("a")).otherwise(F.concat(F.lit("<"), F.col("p"), F.lit(">")))
    line = F.concat(verb, F.lit(" "), object_column())
    return subject_lines(triples, node_text(F.col("s")), line, distinct, "\n    ", "    ", " ;", " .\n", sample)


def predicate_object(value):
    """The predicate and object of a line of `turtle_lines`."""
    start = F.when(value.startswith(_INDENT), F.lit(1)).otherwise(F.instr(value, "\n" + _INDENT) + 1) + len(_INDENT)
    end = F.length(value) - F.when(value.endswith("\n"), F.lit(3)).otherwise(F.lit(2))
    return F.substr(value, start, end - start + 1)


def write_turtle(triples, path, mode="overwrite", distinct=False, sample=None):
    turtle_lines(triples, distinct, sample).select("value").write.mode(mode).text(path)
