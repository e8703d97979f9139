"""Mappings of the test tables, and the same triples as SQL for the oracle."""

from pyspark.sql import functions as F

from tripleweft.mapping import TriplesMap, ref, template
from tripleweft.vocab import IRI, LITERAL, RDF_TYPE, SCHEMA, TRIPLE_COLUMNS, XSD

EX = "http://example.org/"
DECIMAL = XSD + "decimal"
INTEGER = XSD + "integer"
DATE = XSD + "date"


class Registry:
    """Queries by name, each with its oracle SQL if it has one."""

    def __init__(self):
        self.queries, self.oracles = {}, {}

    def add(self, name, oracle=None):
        def keep(fn):
            self.queries[name] = fn
            if oracle is not None:
                self.oracles[name] = oracle
            return fn

        return keep


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def money(column):
    """A double as a two-digit decimal, which prints the same everywhere."""
    return F.col(column).cast("decimal(18,2)")


def day(column):
    return F.date_format(column, "yyyy-MM-dd")


def money_sql(column):
    return f"CAST(CAST({column} AS DECIMAL(18,2)) AS VARCHAR)"


def day_sql(column):
    return f"strftime({column}, '%Y-%m-%d')"


def iri(path, key):
    """SQL for an IRI below the example namespace."""
    return f"'{EX}{path}/' || {key}"


def rule(p, o, kind=LITERAL, datatype=None, lang=None):
    return (p, o, kind, datatype, lang)


def link(p, o):
    return rule(p, o, IRI)


def kind_of(cls):
    return link(RDF_TYPE, f"'{cls}'")


def _text(value):
    return "CAST(NULL AS VARCHAR)" if value is None else f"'{value}'"


def triples_sql(source, subject, rules, where="TRUE", extra=""):
    """Triples of a source as one UNION ALL; `extra` adds columns in front."""
    parts = [
        f"SELECT {extra}{subject} AS s, '{p}' AS p, CAST({o} AS VARCHAR) AS o, '{kind}' AS o_kind, "
        f"{_text(dt)} AS o_datatype, {_text(lang)} AS o_lang FROM {source} "
        f"WHERE ({where}) AND ({subject}) IS NOT NULL AND ({o}) IS NOT NULL"
        for p, o, kind, dt, lang in rules
    ]
    return " UNION ALL ".join(parts)


COLS = ", ".join(TRIPLE_COLUMNS)

# N-Triples object and line of a triples row, as SQL.
OBJECT_SQL = (
    "CASE WHEN o_kind = 'iri' THEN '<' || o || '>' ELSE '\"' || "
    "replace(replace(replace(replace(o, '\\', '\\\\'), '\"', '\\\"'), chr(10), '\\n'), chr(13), '\\r') || '\"' || "
    "coalesce('^^<' || o_datatype || '>', '@' || o_lang, '') END"
)
LINE_SQL = f"'<' || s || '> <' || p || '> ' || {OBJECT_SQL} || ' .'"


def customer_map():
    return TriplesMap(
        source="customer",
        subject=EX + "customer/{c_custkey}",
        classes=(SCHEMA + "Person",),
        objects=(
            (SCHEMA + "name", ref("c_name")),
            (EX + "balance", ref(money("c_acctbal"), datatype=DECIMAL)),
            (EX + "nation", template(EX + "nation/{c_nationkey}")),
        ),
        unique_subject=True,
    )


CUSTOMER_SQL = triples_sql(
    "customer",
    iri("customer", "c_custkey"),
    [
        kind_of(SCHEMA + "Person"),
        rule(SCHEMA + "name", "c_name"),
        rule(EX + "balance", money_sql("c_acctbal"), datatype=DECIMAL),
        link(EX + "nation", iri("nation", "c_nationkey")),
    ],
)


def nation_map():
    return TriplesMap(
        source="nation",
        subject=EX + "nation/{n_nationkey}",
        classes=(SCHEMA + "Country",),
        objects=((SCHEMA + "name", ref("n_name")), (EX + "region", template(EX + "region/{n_regionkey}"))),
        unique_subject=True,
    )


NATION_SQL = triples_sql(
    "nation",
    iri("nation", "n_nationkey"),
    [kind_of(SCHEMA + "Country"), rule(SCHEMA + "name", "n_name"), link(EX + "region", iri("region", "n_regionkey"))],
)


def orders_map():
    return TriplesMap(
        source="orders",
        subject=EX + "order/{o_orderkey}",
        classes=(SCHEMA + "Order",),
        objects=(
            (SCHEMA + "customer", template(EX + "customer/{o_custkey}")),
            (SCHEMA + "price", ref(money("o_totalprice"), datatype=DECIMAL)),
            (SCHEMA + "orderDate", ref(day("o_orderdate"), datatype=DATE)),
            (SCHEMA + "orderStatus", ref("o_orderstatus")),
        ),
        unique_subject=True,
    )


ORDERS_SQL = triples_sql(
    "orders",
    iri("order", "o_orderkey"),
    [
        kind_of(SCHEMA + "Order"),
        link(SCHEMA + "customer", iri("customer", "o_custkey")),
        rule(SCHEMA + "price", money_sql("o_totalprice"), datatype=DECIMAL),
        rule(SCHEMA + "orderDate", day_sql("o_orderdate"), datatype=DATE),
        rule(SCHEMA + "orderStatus", "o_orderstatus"),
    ],
)


def lineitem_map():
    """Its subjects repeat, so bag and set differ."""
    return TriplesMap(
        source="lineitem",
        subject=EX + "lineitem/{l_orderkey}/{l_linenumber}",
        objects=(
            (EX + "order", template(EX + "order/{l_orderkey}")),
            (EX + "part", template(EX + "part/{l_partkey}")),
            (EX + "quantity", ref(money("l_quantity"), datatype=DECIMAL)),
            (SCHEMA + "price", ref(money("l_extendedprice"), datatype=DECIMAL)),
            (EX + "returnFlag", ref("l_returnflag")),
        ),
    )


LINEITEM_SQL = triples_sql(
    "lineitem",
    f"'{EX}lineitem/' || l_orderkey || '/' || l_linenumber",
    [
        link(EX + "order", iri("order", "l_orderkey")),
        link(EX + "part", iri("part", "l_partkey")),
        rule(EX + "quantity", money_sql("l_quantity"), datatype=DECIMAL),
        rule(SCHEMA + "price", money_sql("l_extendedprice"), datatype=DECIMAL),
        rule(EX + "returnFlag", "l_returnflag"),
    ],
)


def documents_map():
    return TriplesMap(
        source="documents",
        subject=EX + "document/{doc_id}",
        objects=((SCHEMA + "text", ref("text")), (EX + "source", ref("source"))),
        unique_subject=True,
    )


DOCUMENTS_SQL = triples_sql(
    "documents", iri("document", "doc_id"), [rule(SCHEMA + "text", "text"), rule(EX + "source", "source")]
)
