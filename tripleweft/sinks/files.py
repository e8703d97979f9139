"""Output of triples and text to files."""

from tripleweft.operators.setops import graph_distinct
from tripleweft.sinks.jsonld import write_jsonld
from tripleweft.sinks.ntriples import ntriples_lines, write_ntriples
from tripleweft.sinks.rdfxml import write_rdfxml
from tripleweft.sinks.subjects import SAMPLE
from tripleweft.sinks.turtle import write_turtle
from tripleweft.sources.ntriples import ntriples_scan


def write_partitioned(df, path, columns, mode="overwrite", replace_only_written=True, fmt="parquet"):
    """One folder per value of the columns.

    With `replace_only_written`, overwriting touches only the folders that the
    new rows fall into. Rows are gathered by folder before they are written, and
    adaptive execution splits large folders over tasks and joins small ones, so
    neither tasks times folders make files nor one task writes a hot folder.
    """
    writer = df.hint("rebalance", *columns).write.mode(mode).partitionBy(*columns).format(fmt)
    if replace_only_written and mode == "overwrite":
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.save(path)


def write_ntriples_partitioned(triples, path, columns, mode="overwrite"):
    """N-Triples text with one folder per value of the columns (a tenant, a predicate)."""
    write_partitioned(ntriples_lines(triples, keep=columns), path, columns, mode, fmt="text")


def write_text(df, path, mode="overwrite"):
    """Rows of a `value` column as lines; missing folders are made, old output replaced."""
    df.select("value").write.mode(mode).text(path)


def format_name(text):
    """Output format name in its canonical spelling."""
    return text.strip().upper().replace("-", "").replace("/", "")


def write_rdf(triples, path, output_format, mode="overwrite", **options):
    """Triples in one of the formats NTRIPLES, TURTLE, JSONLD, RDFXML."""
    writers = {
        "NTRIPLES": write_ntriples,
        "TURTLE": write_turtle,
        "JSONLD": write_jsonld,
        "RDFXML": write_rdfxml,
    }
    key = format_name(output_format)
    if key not in writers:
        raise ValueError(f"unsupported output format: {output_format}")
    writers[key](triples, path, mode=mode, **options)


def convert_ntriples(spark, source, target, output_format):
    """Rewrite N-Triples files in another format, as a graph without repeats."""
    triples = ntriples_scan(spark, source)
    if format_name(output_format) == "NTRIPLES":
        write_ntriples(graph_distinct(triples), target)
        return
    options = {"distinct": True} if format_name(output_format) == "TURTLE" else {}
    write_rdf(triples, target, output_format, sample=ntriples_scan(spark, source, fraction=SAMPLE), **options)
