"""Records straight to serialised text, one text row per record.

The streaming formats need no triples table: the lines of one record are
concatenated where its terms are evaluated (`concat_ws` leaves out the null
ones). The plan is a scan, a projection and a text write.
"""

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from tripleweft.functions.text import escape_literal, escape_literal_text
from tripleweft.plans.compile import term_table
from tripleweft.plans.once import evaluate_once
from tripleweft.vocab import IRI, RDF_TYPE


def object_text(term, value):
    """Object in N-Triples/Turtle syntax with all fixed parts folded."""
    if term.kind == IRI:
        if term.fixed is not None:
            return F.lit(f"<{term.fixed}>")
        return F.concat(F.lit("<"), value, F.lit(">"))
    tail = '"'
    if term.datatype is not None:
        tail += f"^^<{term.datatype}>"
    elif term.lang is not None:
        tail += f"@{term.lang}"
    if term.fixed is not None:
        return F.lit('"' + escape_literal_text(term.fixed) + tail)
    return F.concat(F.lit('"'), escape_literal(value), F.lit(tail))


def _as_list(maps):
    return list(maps) if isinstance(maps, (list, tuple)) else [maps]


def _any(conditions):
    return reduce(lambda a, b: a | b, conditions)


def _has_triples(s, pairs):
    """Whether a map yields anything for a record, from its null values alone."""
    subject = F.col(s).isNotNull()
    if not pairs or any(term.fixed is not None for term, _ in pairs):
        return subject
    return subject & _any([value.isNotNull() for _, value in pairs])


def _evaluated(records, maps, encode, attrs=None):
    """Terms of the records that yield any triple, each computed once."""
    table, plan = term_table(records, maps, encode, attrs=attrs)
    plan = [(s, pairs) for s, pairs in plan if pairs]
    if any(isinstance(term.lang, Column) for _, pairs in plan for term, _ in pairs):
        raise ValueError("language tags from a column need triples: use `triples_of`")
    table = evaluate_once(table, *table.columns)
    return table.filter(_any([_has_triples(s, pairs) for s, pairs in plan])), plan


def ntriples_text(records, maps, encode=False, attrs=None):
    """One `value` row per record: its N-Triples lines joined by line breaks."""
    table, plan = _evaluated(records, _as_list(maps), encode, attrs)
    lines = []
    for s, pairs in plan:
        for term, value in pairs:
            lines.append(
                F.concat(
                    F.lit("<"), F.col(s), F.lit(f"> <{term.predicate}> "), object_text(term, value), F.lit(" .")
                )
            )
    return table.select(F.concat_ws("\n", *lines).alias("value"))


def turtle_text(records, maps, encode=False, attrs=None):
    """One `value` row per record: a subject block for each map."""
    table, plan = _evaluated(records, _as_list(maps), encode, attrs)
    blocks = []
    for s, pairs in plan:
        parts = []
        for term, value in pairs:
            verb = "a " if term.predicate == RDF_TYPE else f"<{term.predicate}> "
            parts.append(F.concat(F.lit(verb), object_text(term, value)))
        block = F.concat(F.lit("<"), F.col(s), F.lit(">\n    "), F.concat_ws(" ;\n    ", *parts), F.lit(" .\n"))
        blocks.append(F.when(_has_triples(s, pairs), block))
    return table.select(F.concat_ws("\n", *blocks).alias("value"))


def jsonld_text(records, maps, encode=False, attrs=None):
    """One node object per record and map.

    Right as a set only where no two records share a subject, which the maps
    must declare; else build the triples and use `sinks.jsonld`.
    """
    maps = _as_list(maps)
    if not all(tm.unique_subject for tm in maps):
        raise ValueError("per-record JSON-LD needs maps with unique subjects")
    table, plan = _evaluated(records, maps, encode, attrs)
    nodes = []
    for s, pairs in plan:
        grouped = {}
        for term, value in pairs:
            grouped.setdefault(term.predicate, []).append((term, value))
        fields = [F.col(s).alias("@id")]
        kinds = [value for _, value in grouped.pop(RDF_TYPE, [])]
        if kinds:
            fields.append(F.array(*kinds).alias("@type"))
        for predicate in sorted(grouped):
            cells = [_jsonld_cell(term, value) for term, value in grouped[predicate]]
            if len(cells) == 1:
                column = F.when(cells[0].isNotNull(), F.array(cells[0]))
            else:
                kept = F.array_distinct(F.array_compact(F.array(*cells)))
                column = F.when(F.size(kept) > 0, kept)
            fields.append(column.alias(predicate))
        nodes.append(F.when(_has_triples(s, pairs), F.to_json(F.struct(*fields))))
    return table.select(F.concat_ws("\n", *nodes).alias("value"))


def _jsonld_cell(term, value):
    null = F.lit(None).cast("string")
    is_iri = term.kind == IRI
    cell = F.struct(
        (value if is_iri else null).alias("@id"),
        F.lit(term.datatype).cast("string").alias("@type"),
        F.lit(term.lang).cast("string").alias("@language"),
        (null if is_iri else value).alias("@value"),
    )
    return cell if term.fixed is not None else F.when(value.isNotNull(), cell)
