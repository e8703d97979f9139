"""Mapping compiler: triples maps to narrow DataFrame plans.

One pass per input: every map over the same scan contributes its terms to one
array per record, which `inline` turns into rows. Nothing here shuffles, apart
from the `distinct` that set semantics may ask for.
"""

from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from tripleweft.functions.paths import resolver
from tripleweft.functions.templates import expand, fill_attributes, has_attributes, template_pieces
from tripleweft.mapping import Mapping
from tripleweft.plans.meeting import distinct_rows
from tripleweft.vocab import IRI, LITERAL, RDF_TYPE, TRIPLE_COLUMNS, is_iri_constant


@dataclass(frozen=True)
class Term:
    """Predicate and object of one rule; `fixed` is the text of a constant object."""

    predicate: str
    value: Column
    kind: str
    datatype: str | None = None
    lang: str | Column | None = None
    fixed: str | None = None


def object_term(predicate, obj, resolve, encode=False, attrs=None):
    """Rule as a Term, or None if the object map names nothing."""
    if obj.reference is not None:
        value, kind, fixed = resolve(obj.reference), LITERAL, None
    elif obj.template is not None:
        value, kind, fixed = expand(obj.template, resolve, encode, attrs), IRI, None
    elif obj.constant is not None:
        kind = IRI if is_iri_constant(obj.constant) else LITERAL
        value, fixed = F.lit(obj.constant), obj.constant
        if has_attributes(obj.constant):
            # Its start, ahead of any attribute, tells whether it is an IRI.
            value, fixed = fill_attributes(obj.constant, attrs), None
    else:
        return None
    if kind == IRI:
        return Term(predicate, value, kind, fixed=fixed)
    lang = obj.lang if obj.datatype is None else None
    return Term(predicate, value, kind, obj.datatype, lang, fixed)


def map_terms(tm, resolve, encode=False, attrs=None):
    """Subject column and terms of a triples map."""
    subject = expand(tm.subject, resolve, encode, attrs)
    if tm.where is not None:
        subject = F.when(tm.where, subject)
    terms = [Term(RDF_TYPE, F.lit(c), IRI, fixed=c) for c in tm.classes]
    for predicate, obj in tm.objects:
        term = object_term(predicate, obj, resolve, encode, attrs)
        if term is not None:
            terms.append(term)
    return subject, terms


def term_table(records, maps, encode=False, keep=(), predicates=None, attrs=None):
    """Subjects and objects side by side, one row per record.

    `predicates` leaves out all rules with other predicates. `attrs` is a map
    column (or its name) that fills `${name}` and `${name:-default}`.

    Returns the projection and, per map, the name of its subject column with
    (term, value column) pairs that refer to it.
    """
    cols, plan = [], []
    attrs = F.col(attrs) if isinstance(attrs, str) else attrs
    for i, tm in enumerate(maps):
        subject, terms = map_terms(tm, resolver(records, tm.formulation), encode, attrs)
        terms = [t for t in terms if predicates is None or t.predicate in predicates]
        cols.append(subject.alias(f"_s{i}"))
        pairs = []
        for j, term in enumerate(terms):
            if isinstance(term.lang, Column):
                cols.append(term.lang.cast("string").alias(f"_l{i}_{j}"))
                term = replace(term, lang=F.col(f"_l{i}_{j}"))
            if term.fixed is not None:
                pairs.append((term, F.lit(term.fixed)))
            else:
                cols.append(term.value.alias(f"_o{i}_{j}"))
                pairs.append((term, F.col(f"_o{i}_{j}")))
        plan.append((f"_s{i}", pairs))
    return records.select(*keep, *cols), plan


def _cell(subject, term, value):
    return F.struct(
        subject.alias("s"),
        F.lit(term.predicate).alias("p"),
        value.alias("o"),
        F.lit(term.kind).alias("o_kind"),
        F.lit(term.datatype).cast("string").alias("o_datatype"),
        (term.lang if isinstance(term.lang, Column) else F.lit(term.lang).cast("string")).alias("o_lang"),
    )


def map_predicates(tm):
    """Predicates that a triples map can yield."""
    return {p for p, _ in tm.objects} | ({RDF_TYPE} if tm.classes else set())


def triples_of(records, maps, encode=False, keep=(), predicates=None, attrs=None):
    """Triples of all maps over one record DataFrame, in one narrow pass.

    `keep` names record columns to carry along (a tenant, a file name); `attrs`
    names the map column of input attributes that `${name}` stands for.
    `predicates` limits the triples to those that a graph pattern asks for,
    which also keeps the columns of all other rules from being read.
    """
    maps = [maps] if not isinstance(maps, (list, tuple)) else list(maps)
    if predicates is not None:
        maps = [tm for tm in maps if map_predicates(tm) & set(predicates)]
    if not maps:
        raise ValueError("the mapping yields no triples")
    table, plan = term_table(records, maps, encode, keep, predicates, attrs)
    cells = [_cell(F.col(s), term, value) for s, pairs in plan for term, value in pairs]
    if not cells:
        raise ValueError("the mapping yields no triples")
    rows = table.select(*keep, F.inline(F.array(*cells)))
    return rows.filter(F.col("s").isNotNull() & F.col("o").isNotNull())


def union_all(frames):
    return reduce(lambda a, b: a.unionByName(b), frames)


def _subject_start(tm):
    pieces = template_pieces(tm.subject)
    return pieces[0][1] if pieces and pieces[0][0] == "text" else ""


def is_set_already(maps):
    """True if declared keys show that no triple can occur twice.

    Each map must have unique subjects and no repeated predicate, and the
    fixed starts of the subject templates must tell the maps apart.
    """
    for tm in maps:
        predicates = [p for p, _ in tm.objects] + ([RDF_TYPE] if tm.classes else [])
        if not tm.unique_subject or len(set(predicates)) < len(predicates):
            return False
        if len(set(tm.classes)) < len(tm.classes):
            return False
    starts = [_subject_start(tm) for tm in maps]
    return not any(
        i != j and a.startswith(b) for i, a in enumerate(starts) for j, b in enumerate(starts)
    )


def repeated_subjects(records, tm, encode=False, attrs=None):
    """Subjects that several records give, with their number: empty if `unique_subject` may be declared.

    Worth one run before a mapping that relies on the declaration is used on new data.
    """
    subject, _ = map_terms(tm, resolver(records, tm.formulation), encode, F.col(attrs) if isinstance(attrs, str) else attrs)
    counts = records.select(subject.alias("s")).where("s IS NOT NULL").groupBy("s").agg(F.count(F.lit(1)).alias("records"))
    return counts.where("records > 1")


def _signature(term):
    return (term.predicate, term.kind, term.datatype, term.lang)


def _rule_rows(records, maps, signatures, encode, predicates):
    """Rows (rule, s, o), where rule numbers what is fixed about a triple."""
    table, plan = term_table(records, maps, encode, predicates=predicates)
    cells = []
    for s, pairs in plan:
        for term, value in pairs:
            if isinstance(term.lang, Column):
                raise ValueError("a set of triples needs fixed language tags: drop repeats from `triples_of` instead")
            rule = signatures.setdefault(_signature(term), len(signatures))
            cells.append(F.struct(F.lit(rule).alias("rule"), F.col(s).alias("s"), value.alias("o")))
    rows = table.select(F.inline(F.array(*cells)))
    return rows.filter(F.col("s").isNotNull() & F.col("o").isNotNull())


def _spell_out(rows, signatures):
    """Rows (rule, s, o) as triples."""
    def part(i):
        values = F.array(*[F.lit(sig[i]).cast("string") for sig in signatures])
        return F.get(values, F.col("rule"))

    return rows.select(
        "s",
        part(0).alias("p"),
        "o",
        part(1).alias("o_kind"),
        part(2).alias("o_datatype"),
        part(3).alias("o_lang"),
    )


def materialise(mapping, inputs, distinct=False, encode=False, predicates=None):
    """Triples of a whole mapping; `inputs` maps source names to DataFrames.

    With `predicates`, only rules with those predicates are applied, and
    sources that have none of them are not scanned.

    A bag by default. `distinct` gives a set: without a shuffle where the
    declared keys already make it one, else by a shuffle of rule number,
    subject and object only, since the rule fixes all other columns.
    """
    if predicates is not None:
        mapping = Mapping(tuple(tm for tm in mapping.maps if map_predicates(tm) & set(predicates)))
    scans = mapping.scans().items()
    if not distinct or is_set_already(mapping.maps):
        frames = [triples_of(inputs[key[0]], maps, encode, predicates=predicates) for key, maps in scans]
        return union_all(frames).select(*TRIPLE_COLUMNS)
    signatures = {}
    rows = union_all([_rule_rows(inputs[key[0]], maps, signatures, encode, predicates) for key, maps in scans])
    return _spell_out(distinct_rows(rows), signatures)


def with_triple_count(records, maps, keep=(), attrs=None):
    """The kept columns of every record and the number of its triples, which are not built."""
    maps = [maps] if not isinstance(maps, (list, tuple)) else list(maps)
    table, plan = term_table(records, maps, keep=keep, attrs=attrs)
    per_record = F.lit(0).cast("bigint")
    for s, pairs in plan:
        fixed = sum(1 for term, _ in pairs if term.fixed is not None)
        here = F.lit(fixed).cast("bigint")
        for term, value in pairs:
            if term.fixed is None:
                here = here + value.isNotNull().cast("bigint")
        per_record = per_record + F.when(F.col(s).isNotNull(), here).otherwise(F.lit(0).cast("bigint"))
    return table.select(*keep, per_record.alias("triples"))


def count_triples(records, maps, attrs=None):
    """Number of triples as one row, counted per record without building them."""
    return with_triple_count(records, maps, attrs=attrs).agg(F.coalesce(F.sum("triples"), F.lit(0).cast("bigint")).alias("triples"))
