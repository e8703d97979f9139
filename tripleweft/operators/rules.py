"""Mappings as data: one row per rule, for many tenants at once.

Columns of a rules table: tenant, triples_map, source, formulation, iterator,
subject_template, classes, predicate, obj_kind (`reference`, `template`,
`constant`), obj_value, datatype, lang.
"""

from functools import reduce

from pyspark.sql import functions as F

from tripleweft.functions.names import expand_curie, looks_like_iri
from tripleweft.plans.joins import BROADCAST_ROWS, checked_join
from tripleweft.scratch import write_and_read
from tripleweft.vocab import FORMULATIONS, IRI, LITERAL, QL, RDF_TYPE, RML, RR

RULE_COLUMNS = (
    "tenant",
    "triples_map",
    "source",
    "formulation",
    "iterator",
    "subject_template",
    "classes",
    "predicate",
    "obj_kind",
    "obj_value",
    "datatype",
    "lang",
)

# Fixed patterns: template pieces, `$(x)` references and unresolved attributes.
_PIECE = r"(\{[^}]+\}|[^{]+|\{)"
_DOLLAR_REF = r"\$\(([^)]+)\)"
_UNRESOLVED = r"\$\{[^}]*\}"


# --- rules from mapping documents held as triples ---------------------------

# Node property names by mapping vocabulary predicate.
_NODE_PROPERTIES = {
    "logical_source": RML + "logicalSource",
    "source": RML + "source",
    "formulation": RML + "referenceFormulation",
    "iterator": RML + "iterator",
    "subject_map": RR + "subjectMap",
    "template": RR + "template",
    "predicate": RR + "predicate",
    "predicate_map": RR + "predicateMap",
    "object_map": RR + "objectMap",
    "object": RR + "object",
    "constant": RR + "constant",
    "reference": RML + "reference",
    "datatype": RR + "datatype",
    "lang": RR + "language",
}


def mapping_nodes(triples):
    """One row per node of each mapping document: its properties side by side."""
    columns = [F.max(F.when(F.col("p") == p, F.col("o"))).alias(name) for name, p in _NODE_PROPERTIES.items()]
    classes = F.sort_array(F.collect_set(F.when(F.col("p") == RR + "class", F.col("o")))).alias("classes")
    known = list(_NODE_PROPERTIES.values()) + [RR + "class"]
    return triples.filter(F.col("p").isin(known)).groupBy("tenant", F.col("s").alias("node")).agg(*columns, classes)


def rules_from_mapping_triples(triples):
    """Rules of all mapping documents; `tenant` names the document of a triple.

    One grouped pass gives a node table, gathered into one map of nodes per document: a mapping document is small, as
    one engine run reads it whole. Pairs of maps and predicate-object maps meet the map of their document in one join,
    and all links between nodes (logical source, subject map, object map) are look-ups in it.
    """
    nodes = write_and_read(mapping_nodes(triples), "mapping-nodes")
    named = [c for c in nodes.columns if c not in ("tenant", "node")]
    entry = F.struct("node", F.struct(*named).alias("n"))
    documents = nodes.groupBy("tenant").agg(F.map_from_entries(F.collect_list(entry)).alias("nodes"))
    maps = nodes.filter(F.col("logical_source").isNotNull()).select("tenant", F.col("node").alias("triples_map"))
    pairs = triples.filter(F.col("p") == RR + "predicateObjectMap").select(
        "tenant", F.col("s").alias("triples_map"), F.col("o").alias("pom")
    )
    paired = maps.join(pairs, ["tenant", "triples_map"], "left")
    rows = checked_join(paired, documents, ["tenant"], write_right=True)

    def at(node, name):
        return F.try_element_at("nodes", node)[name]

    own = F.col("triples_map")
    rows = rows.select(
        "tenant",
        "triples_map",
        "nodes",
        *[at(at(own, "logical_source"), c).alias(c) for c in ("source", "formulation", "iterator")],
        at(at(own, "subject_map"), "template").alias("subject_template"),
        at(at(own, "subject_map"), "classes").alias("classes"),
        at(F.col("pom"), "predicate").alias("_predicate"),
        at(F.col("pom"), "predicate_map").alias("_predicate_map"),
        at(F.col("pom"), "object_map").alias("_object_map"),
        at(F.col("pom"), "object").alias("_object"),
    )
    target = F.col("_object_map")
    rules = rows.select(
        "*",
        at(F.col("_predicate_map"), "constant").alias("_constant_predicate"),
        *[at(target, c).alias("_" + c) for c in ("reference", "template", "constant")],
        *[at(target, c).alias(c) for c in ("datatype", "lang")],
    )
    fixed = F.coalesce("_constant", "_object")
    formulation = F.coalesce(F.replace("formulation", F.lit(QL), F.lit("")), F.lit("JSONPath"))
    return rules.select(
        "tenant",
        "triples_map",
        "source",
        formulation.alias("formulation"),
        "iterator",
        "subject_template",
        "classes",
        F.coalesce("_predicate", "_constant_predicate").alias("predicate"),
        F.when(F.col("_reference").isNotNull(), F.lit("reference"))
        .when(F.col("_template").isNotNull(), F.lit("template"))
        .when(fixed.isNotNull(), F.lit("constant"))
        .alias("obj_kind"),
        F.coalesce("_reference", "_template", fixed).alias("obj_value"),
        "datatype",
        "lang",
    )


# --- rules from the short notation ------------------------------------------


def braces(col):
    """`$(x)` references as `{x}`."""
    return F.regexp_replace(col, _DOLLAR_REF, "{$1}")


def expand_prefixes(rows, prefixes, columns):
    """Expand `prefix:local` in the given columns by a table (tenant, prefix, iri).

    The prefixes of a tenant are one map, which meets the rows in one join; texts without a known prefix stay as they are.
    """
    single = prefixes.groupBy("tenant", "prefix").agg(F.max("iri").alias("iri"))
    maps = single.groupBy("tenant").agg(F.map_from_entries(F.collect_list(F.struct("prefix", "iri"))).alias("_prefixes"))
    rows = checked_join(rows, maps, ["tenant"], "left", write_right=True)
    return rows.withColumns({name: expand_curie(F.col(name), F.col("_prefixes")) for name in columns}).drop("_prefixes")


def canonical_formulation(col):
    """Formulation names regardless of case; unknown names stay as they are."""
    pairs = [F.lit(x) for kv in FORMULATIONS.items() for x in kv]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), F.lower(F.trim(col))), col)


def normalise_short_rules(rows, prefixes):
    """Rules from rows (tenant, triples_map, source, formulation, iterator, s, p, o, datatype, lang).

    A lone `$(x)` is a reference, any other text with `$(` a template, the
    rest a constant. The predicate `a` gives a class, as a constant rule.
    """
    alone = F.col("o").rlike("^" + _DOLLAR_REF + "$")
    mixed = F.contains("o", F.lit("$("))
    kinds = rows.select(
        "*",
        (F.col("p") == "a").alias("_type"),
        F.when(F.col("p") == "a", F.lit("constant"))
        .when(alone, F.lit("reference"))
        .when(mixed, F.lit("template"))
        .otherwise(F.lit("constant"))
        .alias("obj_kind"),
        # Classes and templates may start with a prefix; plain constants stay as written.
        F.when((F.col("p") == "a") | (mixed & ~alone), F.col("o")).alias("_named"),
    )
    full = expand_prefixes(kinds, prefixes, ["s", "p", "_named", "datatype"])
    value = (
        F.when(F.col("obj_kind") == "reference", F.regexp_extract("o", _DOLLAR_REF, 1))
        .when(F.col("obj_kind") == "template", braces(F.col("_named")))
        .otherwise(F.coalesce("_named", "o"))
    )
    return full.select(
        "tenant",
        "triples_map",
        "source",
        canonical_formulation(F.col("formulation")).alias("formulation"),
        "iterator",
        braces(F.col("s")).alias("subject_template"),
        F.array().cast("array<string>").alias("classes"),
        F.when(F.col("_type"), F.lit(RDF_TYPE)).otherwise(F.col("p")).alias("predicate"),
        "obj_kind",
        value.alias("obj_value"),
        "datatype",
        "lang",
    )


# --- checks -------------------------------------------------------------------


def _error(condition, code):
    return F.when(condition, F.lit(code))


def rule_errors():
    """Array of error codes of a rule row; empty for a usable rule."""

    def blank(name):
        return F.coalesce(F.trim(F.col(name)), F.lit("")) == ""

    unresolved = reduce(
        lambda a, b: a | b,
        [F.coalesce(F.col(c).rlike(_UNRESOLVED), F.lit(False)) for c in ("subject_template", "obj_value", "source", "iterator")],
    )
    supported = list(FORMULATIONS.values())
    return F.array_compact(
        F.array(
            _error(blank("source"), "missing_source"),
            _error(blank("subject_template"), "missing_subject_template"),
            _error(~F.coalesce(F.col("formulation"), F.lit("JSONPath")).isin(supported), "unsupported_formulation"),
            _error(blank("predicate"), "missing_predicate"),
            _error(F.col("obj_kind").isNull(), "missing_object"),
            _error(unresolved, "unresolved_attribute"),
        )
    )


def validate_rules(rules, sources=None):
    """Rules with an `errors` column; `sources` (tenant, source) lists the known sources."""
    checked = rules.withColumn("errors", rule_errors())
    if sources is None:
        return checked
    known = sources.select("tenant", "source").distinct().withColumn("_known", F.lit(True))
    joined = checked_join(checked, known, ["tenant", "source"], "left", write_right=True)
    unknown = F.when(F.col("_known").isNull() & F.col("source").isNotNull(), F.lit("unknown_source"))
    return joined.withColumn("errors", F.array_compact(F.array_append("errors", unknown))).drop("_known")


def quarantine(rules, sources=None):
    """Split into (usable rules, rejected rules with their errors)."""
    checked = validate_rules(rules, sources)
    bad = F.size("errors") > 0
    return checked.filter(~bad).drop("errors"), checked.filter(bad)


def documents_without_maps(documents, rules):
    """Mapping documents (tenant) from which no rule came."""
    return documents.select("tenant").join(rules.select("tenant").distinct(), "tenant", "left_anti")


# --- choice of the mapping ----------------------------------------------------


def latest_mappings(catalog, keys, fetched_at, columns):
    """Newest version of a mapping per key, by a partial aggregate rather than a sort."""
    newest = F.max(F.struct(F.col(fetched_at), *[F.col(c) for c in columns]))
    return catalog.groupBy(*keys).agg(newest.alias("_m")).select(*keys, f"_m.{fetched_at}", *[f"_m.{c}" for c in columns])


def is_fresh(fetched_at, now, ttl_seconds):
    """Whether a cached mapping may still be used; a TTL of 0 never allows it."""
    return fetched_at > now - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(ttl_seconds))


# --- application --------------------------------------------------------------


def record_maps(df, columns, keep):
    """Rows as (kept columns, `record` map of reference to text)."""
    pairs = [x for c in columns for x in (F.lit(c), F.col(c).cast("string"))]
    return df.select(*keep, F.create_map(*pairs).alias("record"))


def template_parts(col):
    """Template as an array of pieces, references still in their braces."""
    return F.regexp_extract_all(col, F.lit(_PIECE), 1)


def fill_parts(parts, record):
    """Pieces joined with the record's values; null if one of them is null."""

    def value(piece):
        name = F.substr(piece, F.lit(2), F.length(piece) - 2)
        return F.when(piece.rlike(r"^\{[^}]+\}$"), F.try_element_at(record, name)).otherwise(piece)

    return F.aggregate(parts, F.lit(""), lambda text, piece: F.concat(text, value(piece)))


def rule_rows(rules):
    """One row per triple a record can yield, templates cut into pieces.

    Classes become constant rules, once per triples map.
    """
    keys = ["tenant", "source", "triples_map", "subject_template"]
    rows = rules.filter(F.col("predicate").isNotNull() & F.col("obj_kind").isNotNull()).select(
        *keys, "predicate", "obj_kind", "obj_value", "datatype", "lang"
    )
    null = F.lit(None).cast("string")
    classes = (
        rules.select(*keys, F.explode("classes").alias("obj_value"))
        .distinct()
        .select(
            *keys,
            F.lit(RDF_TYPE).alias("predicate"),
            F.lit("constant").alias("obj_kind"),
            "obj_value",
            null.alias("datatype"),
            null.alias("lang"),
        )
    )
    is_iri = (F.col("obj_kind") == "template") | (
        (F.col("obj_kind") == "constant") & (looks_like_iri(F.col("obj_value")) | (F.col("predicate") == RDF_TYPE))
    )
    return rows.unionByName(classes).select(
        "tenant",
        "source",
        template_parts(F.col("subject_template")).alias("subject_parts"),
        F.col("predicate").alias("p"),
        "obj_kind",
        "obj_value",
        F.when(F.col("obj_kind") == "template", template_parts(F.col("obj_value"))).alias("obj_parts"),
        F.when(is_iri, F.lit(IRI)).otherwise(F.lit(LITERAL)).alias("o_kind"),
        F.when(~is_iri, F.col("datatype")).alias("o_datatype"),
        F.when(~is_iri & F.col("datatype").isNull(), F.col("lang")).alias("o_lang"),
    )


def compile_rules(rules):
    """Rules as a table in the shared folder, to be applied any number of times: one array per tenant and source."""
    rows = rule_rows(rules)
    rule = F.struct(*[c for c in rows.columns if c not in ("tenant", "source")])
    return write_and_read(rows.groupBy("tenant", "source").agg(F.collect_list(rule).alias("rules")), "compiled-rules")


def apply_compiled(records, compiled, keep=(), broadcast_rows=BROADCAST_ROWS):
    """Triples of records (tenant, source, record map) by compiled rules.

    The rules of a tenant and source come as one array, so each record meets them in one row. They go to the records by
    broadcast if they measure small; else records are shuffled to them, those of a large tenant spread over many tasks.
    """
    joined = checked_join(records, compiled, ["tenant", "source"], max_rows=broadcast_rows)
    record = F.col("record")

    def triple(r):
        value = (
            F.when(r["obj_kind"] == "reference", F.try_element_at(record, r["obj_value"]))
            .when(r["obj_kind"] == "template", fill_parts(r["obj_parts"], record))
            .otherwise(r["obj_value"])
        )
        return F.struct(
            fill_parts(r["subject_parts"], record).alias("s"), r["p"].alias("p"), value.alias("o"), r["o_kind"], r["o_datatype"], r["o_lang"]
        )

    rows = joined.select(*keep, F.inline(F.transform("rules", triple))).toDF(*keep, "s", "p", "o", "o_kind", "o_datatype", "o_lang")
    return rows.filter(F.col("s").isNotNull() & F.col("o").isNotNull())


def apply_rules(records, rules, keep=(), broadcast_rows=BROADCAST_ROWS):
    """Triples of records by the rules of their tenant."""
    return apply_compiled(records, compile_rules(rules), keep, broadcast_rows)
