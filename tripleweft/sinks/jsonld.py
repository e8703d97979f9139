"""Triples as flattened JSON-LD, one node object per subject."""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F

from tripleweft.plans.once import evaluate_once
from tripleweft.sinks.subjects import choose, sorted_subjects, subject_runs, text_of
from tripleweft.vocab import BLANK, BNODE, IRI, LITERAL, RDF_TYPE

# The lines around the nodes of a document.
OPENING, CLOSING = '{"@graph":[', "]}"
#: Bytes of a node that are held before it is closed and its subject opened again.
NODE_BYTES = 1_000_000
# Fixed value: characters that JSON text must escape.
_ESCAPED = r'[\x00-\x1F"\\]'
_ESCAPES = {n: f"\\u{n:04X}" for n in range(32)} | {ord(c): "\\" + e for c, e in zip('"\\\b\t\n\f\r', '"\\btnfr', strict=True)}
_CELLS = "array<map<string,string>>"


def json_string(col):
    """A string as quoted JSON text."""
    escaped = F.to_json(F.array(col))
    plain = F.concat(F.lit('"'), col, F.lit('"'))
    return F.when(col.rlike(_ESCAPED), F.substr(escaped, F.lit(2), F.length(escaped) - 2)).otherwise(plain)


def _quoted(texts):
    """The same for strings in Arrow."""
    plain = pc.binary_join_element_wise('"', texts, '"', "")
    escaped = pc.match_substring_regex(texts, _ESCAPED)
    if not pc.any(escaped).as_py():
        return plain
    return pc.if_else(escaped, pa.array([f'"{t.translate(_ESCAPES)}"' for t in texts.to_pylist()], pa.string()), plain)


def _cell():
    """A value object; its parts in the order of their keys."""
    o = json_string(F.col("o"))
    typed = F.concat(F.lit('{"@type":'), json_string(F.col("o_datatype")), F.lit(',"@value":'), o, F.lit("}"))
    tagged = F.concat(F.lit('{"@language":'), json_string(F.col("o_lang")), F.lit(',"@value":'), o, F.lit("}"))
    plain = F.concat(F.lit('{"@value":'), o, F.lit("}"))
    node = F.concat(F.lit('{"@id":'), o, F.lit("}"))
    literal = F.when(F.col("o_datatype").isNotNull(), typed).when(F.col("o_lang").isNotNull(), tagged).otherwise(plain)
    return F.when(F.col("o_kind").isin(IRI, BNODE), node).otherwise(literal)


def _nodes(batches):
    """Node objects from sorted rows; what is not yet closed waits as pieces, up to `NODE_BYTES`."""
    held, size, fresh = [], 0, False
    for rows, opens, turns, ends in subject_runs(batches, True):
        if fresh:  # the node was closed early: its subject goes on in a new one
            opens, turns = opens.copy(), turns.copy()
            opens[0] = turns[0] = True
            fresh = False
        s, text = text_of(rows, "s"), text_of(rows, "text")
        key = pc.binary_join_element_wise(_quoted(text_of(rows, "key")), ":[", "")
        start = pc.binary_join_element_wise('{"@id":', _quoted(s), ",", key, "")
        start = choose(opens, start, choose(turns, pc.binary_join_element_wise("],", key, ""), ","))
        piece = pc.binary_join_element_wise(start, text, choose(ends, "]}", ""), "")
        stops = np.flatnonzero(ends) + 1
        done, names = [], []
        if len(stops):
            offsets = pa.array(np.append(0, stops).astype(np.int32))
            joined = pc.binary_join(pa.ListArray.from_arrays(offsets, piece.slice(0, int(stops[-1]))), "")
            done = joined.to_pylist()
            done[0] = "".join([*held, done[0]])
            names = s.take(pa.array(stops - 1)).to_pylist()
            held, size = [], 0
        rest = piece.slice(int(stops[-1]) if len(stops) else 0)
        held += rest.to_pylist()
        size += rest.nbytes
        if size > NODE_BYTES:
            done.append("".join([*held, "]}"]))
            names.append(s[len(s) - 1].as_py())
            held, size, fresh = [], 0, True
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(done, pa.string())], ["s", "value"])


def jsonld_nodes(triples, sample=None):
    """Rows (s, value) of the distinct graph, predicates and values sorted.

    There is one shuffle, by subject, in which repeated triples meet. A subject has one node, or one per task that it is
    spread over and per megabyte of its text, so that no group is ever held in memory.
    """
    is_type = (F.col("p") == RDF_TYPE) & F.col("o_kind").isin(IRI, BNODE)
    key = F.when(is_type, F.lit("@type")).otherwise(F.col("p"))
    rows = sorted_subjects(triples, key, F.when(is_type, json_string(F.col("o"))).otherwise(_cell()), sample)
    return rows.mapInArrow(_nodes, "s string, value string")


def _framed(batches):
    """One `@graph` document per partition: an opening line, nodes with commas between, a closing line."""

    def lines(texts):
        return pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], names=["value"])

    yield lines([OPENING])
    first = True
    for batch in batches:
        if batch.num_rows:
            values = pc.binary_join_element_wise(",", batch.column(0).cast(pa.string()), "")
            if first:
                values = pa.concat_arrays([batch.column(0).cast(pa.string()).slice(0, 1), values.slice(1)])
                first = False
            yield pa.RecordBatch.from_arrays([values], names=["value"])
    yield lines([CLOSING])


def write_nodes(nodes, path, mode="overwrite", documents=True):
    """Node objects (`value`): each file is a JSON-LD document, or, without `documents`, lines of nodes."""
    text = nodes.select("value")
    if documents:
        text = text.mapInArrow(_framed, "value string")
    text.write.mode(mode).text(path)


def write_jsonld(triples, path, mode="overwrite", documents=True, sample=None):
    write_nodes(jsonld_nodes(triples, sample), path, mode, documents)


def jsonld_scan(spark, path):
    """Triples of files with one node object per line, with or without the document around them.

    Other lines than the two of the document and nodes (which may follow a comma) are an error.
    """
    line = F.col("value")
    bare = F.when(line.startswith("{"), line).when(line.startswith(","), F.substr(line, F.lit(2)))
    bare = F.trim(bare.otherwise(F.regexp_replace(line, r"^\s*,", "")))
    lines = evaluate_once(spark.read.text(path), bare.alias("value"))
    return parse_jsonld(lines.where(~F.col("value").isin(OPENING, CLOSING, "")))


def _node_kind(col):
    return F.when(col.startswith(BLANK), BNODE).otherwise(IRI)


def parse_jsonld(nodes, column="value"):
    """Triples of flattened node objects, one per row; text that is none is an error. A node is read once."""
    text, node, data = F.col("_text"), F.col("_node"), F.col("data")
    read = evaluate_once(nodes, F.col(column).alias("_text"), F.try_parse_json(column).alias("_node"))
    wrong = F.raise_error(F.concat(F.lit("not a JSON-LD node: "), F.substring(text, 1, 200)))
    head = evaluate_once(
        read,
        F.coalesce(F.try_variant_get(node, "$['@id']", "string"), wrong.cast("string")).alias("s"),
        F.try_variant_get(node, "$['@type']", "array<string>").alias("types"),
        F.map_filter(F.from_json(text, "map<string,string>"), lambda p, _: ~p.startswith("@")).alias("data"),
    )
    # The values of all predicates are read at once; where one is no array, each by itself.
    joined = F.concat(F.lit("["), F.array_join(F.map_values(data), ","), F.lit("]"))
    read = evaluate_once(head, "s", "types", "data", F.from_json(joined, f"array<{_CELLS}>").alias("cells"))
    alone = F.transform(F.map_values(data), lambda v: F.from_json(v, _CELLS))
    cells = F.when(F.size("cells") == F.size(data), F.col("cells")).otherwise(alone)
    types = F.transform("types", lambda t: F.create_map(F.lit("@id"), t))
    entries = F.arrays_zip(F.concat(F.array(F.lit("@type")), F.map_keys(data)), F.concat(F.array(types), cells))
    cells = read.select("s", F.inline(entries).alias("p", "cells")).select("s", "p", F.explode("cells").alias("c"))
    is_type = F.col("p") == "@type"

    def part(key):
        return F.try_element_at("c", F.lit(key))

    return cells.select(
        "s",
        F.when(is_type, RDF_TYPE).otherwise(F.col("p")).alias("p"),
        F.coalesce(part("@id"), part("@value")).alias("o"),
        F.when(is_type | part("@id").isNotNull(), _node_kind(part("@id"))).otherwise(LITERAL).alias("o_kind"),
        F.when(~is_type, part("@type")).alias("o_datatype"),
        F.when(~is_type, part("@language")).alias("o_lang"),
    )
