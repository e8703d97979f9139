"""Records of JSON documents at any depth: `..name` and `[?(...)]` in iterators.

A descent is a loop: each round takes the values of the name from what is open, and opens what lies one level deeper, until
nothing is left. Predicates become conditions on the items of an array.
"""

import re
from functools import reduce

from pyspark.sql import functions as F

from tripleweft.functions.paths import RECORD, json_steps, variant_path
from tripleweft.plans.compile import union_all
from tripleweft.scratch import Steps, write_and_read

_STEP = re.compile(r"(\.\.)([^.\[\]*]+)|\[\?\((.*?)\)\](?=[.\[]|$)|\.?([^.\[\]]+)|\[(\d+)\]|\['([^']*)'\]|\[(\*)\]")
_TEST = re.compile(r"""^\s*@((?:\.[^\s.\[\]=!<>&|]+|\[\d+\]|\['[^']*'\])+)\s*(?:(==|!=|<=|>=|<|>)\s*(?:'([^']*)'|"([^"]*)"|(-?\d+(?:\.\d+)?)|(true|false|null)))?\s*$""")
_COMPARE = {
    "==": lambda a, b: a == b,
    "!=": lambda a, b: a != b,
    "<": lambda a, b: a < b,
    "<=": lambda a, b: a <= b,
    ">": lambda a, b: a > b,
    ">=": lambda a, b: a >= b,
}


def deep_steps(iterator):
    """Steps as (kind, value): `name`, `at`, `each`, `deep` and `where`; anything else is an error."""
    rest = iterator[1:] if iterator.startswith("$") else iterator
    steps, pos = [], 0
    while pos < len(rest):
        m = _STEP.match(rest, pos)
        if not m:
            raise ValueError(f"unsupported JSON iterator: {iterator}")
        deep, below, predicate, name, index, quoted, star = m.groups()
        if deep:
            steps.append(("deep", below))
        elif predicate is not None:
            steps.append(("where", predicate))
        elif star or name == "*":
            steps.append(("each", None))
        elif index is not None:
            steps.append(("at", int(index)))
        else:
            steps.append(("name", quoted if quoted is not None else name))
        pos = m.end()
    return steps


def _one_test(text, predicate):
    m = _TEST.match(text)
    if not m:
        raise ValueError(f"unsupported JSON predicate: [?({predicate})]")
    path, compare, *texts, number, word = m.groups()
    value = F.try_variant_get(RECORD, variant_path(json_steps(path)), "variant")
    kind = F.coalesce(F.schema_of_variant(value), F.lit(""))
    if compare is None:
        return value.isNotNull()
    text = next((t for t in texts if t is not None), None)
    if text is not None:
        same, found, wanted = kind == "STRING", F.try_variant_get(value, "$", "string"), F.lit(text)
    elif number is not None:
        same = kind.rlike(r"^(BIGINT|DECIMAL.*|DOUBLE|FLOAT)$")
        found, wanted = F.try_variant_get(value, "$", "double"), F.lit(float(number))
    elif compare not in ("==", "!="):
        raise ValueError(f"unsupported JSON predicate: [?({predicate})]")
    elif word == "null":
        same, found, wanted = kind == "VOID", F.lit(1), F.lit(1)
    else:
        same, found, wanted = kind == "BOOLEAN", F.try_variant_get(value, "$", "boolean"), F.lit(word == "true")
    if compare == "!=":  # values of another kind differ
        return value.isNotNull() & ~F.coalesce(same & (found == wanted), F.lit(False))
    return F.coalesce(same & _COMPARE[compare](found, wanted), F.lit(False))


def condition(predicate):
    """A predicate as a condition on the record: tests joined by `&&` and `||`, of which `&&` binds closer."""
    alternatives = [[_one_test(t, predicate) for t in part.split("&&")] for part in predicate.split("||")]
    return reduce(lambda a, b: a | b, [reduce(lambda a, b: a & b, tests) for tests in alternatives])


def _items(documents, others):
    """The items of arrays."""
    return documents.select(*others, F.explode(F.try_variant_get(RECORD, "$", "array<variant>")).alias(RECORD))


def _may_hold(name):
    """Whether a value has the name at some depth, as far as its schema tells: types that differ are one VARIANT in it."""
    kind = F.schema_of_variant(RECORD)
    inside = kind.rlike("^(OBJECT|ARRAY)")
    if not re.fullmatch(r"[A-Za-z_][A-Za-z0-9_]*", name):  # how other names are spelt in a schema is left open
        return inside
    return inside & (F.contains(kind, F.lit(name)) | F.contains(kind, F.lit("VARIANT")))


def _descend(documents, name, others):
    """The values of a name at any depth; what cannot hold it is not opened further."""
    spark, steps, found = documents.sparkSession, Steps("json-open"), []
    open_ = steps.write(documents.select(*others, RECORD).where(_may_hold(name)))
    while not open_.isEmpty():
        here = open_.select(*others, F.try_variant_get(RECORD, variant_path([name]), "variant").alias(RECORD)).where(F.col(RECORD).isNotNull())
        found.append(write_and_read(here, "json-found"))
        inner = open_.lateralJoin(spark.tvf.variant_explode(F.col(RECORD).outer())).select(*others, F.col("value").alias(RECORD))
        open_ = steps.write(inner.where(_may_hold(name)))
    steps.drop(spark)
    return union_all(found) if found else documents.limit(0)


def iterate_deep(documents, iterator, column=RECORD):
    """Records below an iterator that may have `..name`, `[?(...)]`, `[*]`, positions and names.

    `documents` holds variants in `column`; its other columns stay. `..name` gives the values of a name at any depth, also
    within one another; it takes a round, with a written table, for each level of the deepest document. `[*]` and
    `[?(...)]` go through the items of arrays and give nothing elsewhere. A predicate has tests `@.path`, or `@.path` with
    `==`, `!=`, `<`, `<=`, `>`, `>=` and a text, number, `true`, `false` or `null`, joined by `&&` and `||`; values of
    another kind than the literal fail all but `!=`. Everything else is an error. Records come in any order; JSON null is none.
    """
    others = [c for c in documents.columns if c != column]
    records = documents.select(*others, F.col(column).alias(RECORD))
    for kind, value in deep_steps(iterator):
        if kind == "deep":
            records = _descend(records, value, others)
        elif kind in ("each", "where"):
            records = _items(records, others)
            if kind == "where":
                records = records.where(condition(value))
        else:
            records = records.select(*others, F.try_variant_get(RECORD, variant_path([value]), "variant").alias(RECORD))
    return records.where(F.col(RECORD).isNotNull() & ~F.is_variant_null(RECORD))
