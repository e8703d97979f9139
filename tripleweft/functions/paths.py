"""References to values inside records: flat names, JSON paths, XML paths.

Paths become field access on typed columns, so the reader can prune what no
mapping asks for, and a miss is null.
"""

import re

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripleweft.functions.text import value_text, variant_text

# Name of the column that holds a whole JSON record as a variant.
RECORD = "record"

_STEP = re.compile(r"\.?([^.\[\]]+)|\[(\d+)\]|\['([^']*)'\]|\[(\*)\]")


def null_text():
    return F.lit(None).cast("string")


def json_steps(path):
    """Steps of a simple JSON path: names, positions (int) and `*`."""
    rest = path[1:] if path.startswith("$") else path
    steps, pos = [], 0
    while pos < len(rest):
        m = _STEP.match(rest, pos)
        if not m:
            raise ValueError(f"unsupported JSON path: {path}")
        name, index, quoted, star = m.groups()
        if index is not None:
            steps.append(int(index))
        elif star or name == "*":
            steps.append("*")
        else:
            steps.append(quoted if quoted is not None else name)
        pos = m.end()
    return steps


def is_json_path(reference):
    return reference.startswith("$") or "." in reference or "[" in reference


def reference_steps(reference):
    return json_steps(reference) if is_json_path(reference) else [reference]


def variant_path(steps):
    """Steps as the path text that variant_get takes."""
    return "$" + "".join(f"[{s}]" if isinstance(s, int) else f"['{s}']" for s in steps)


def field(name):
    """A column by its exact name, dots included."""
    return F.col("`" + name.replace("`", "``") + "`")


def variant_at(col, steps):
    """Value below a variant as (column, type); a path with `[*]` gives the JSON text of the list."""
    if "*" not in steps:
        return F.try_variant_get(col, variant_path(steps), "variant"), T.VariantType()
    cut = steps.index("*")
    if "*" in steps[cut + 1 :]:
        raise ValueError("a reference may have one [*]")
    items = F.try_variant_get(col, variant_path(steps[:cut]), "array<variant>")
    if steps[cut + 1 :]:
        rest = variant_path(steps[cut + 1 :])
        items = F.filter(F.transform(items, lambda x: F.try_variant_get(x, rest, "variant")), lambda x: x.isNotNull())
    return F.to_json(items), T.StringType()


def walk_json(schema, steps):
    """Follow steps through typed columns; returns (column, type) or None on a miss.

    `[*]` gives the JSON text of the list; on typed columns it may only be the last step.
    """
    if isinstance(steps[0], int) or steps[0] not in schema.names:
        return None
    col, kind = field(steps[0]), schema[steps[0]].dataType
    for i, step in enumerate(steps[1:], start=1):
        if isinstance(kind, T.VariantType):
            return variant_at(col, steps[i:])
        if step == "*":
            if i < len(steps) - 1 or not isinstance(kind, T.ArrayType):
                raise ValueError(f"no value for [*] in {steps}")
            return F.to_json(col), T.StringType()
        if isinstance(step, int) and isinstance(kind, T.ArrayType):
            col, kind = F.get(col, step), kind.elementType
        elif isinstance(kind, T.StructType) and step in kind.names:
            col, kind = col.getField(step), kind[step].dataType
        elif isinstance(kind, T.MapType) and isinstance(step, str):
            col, kind = F.try_element_at(col, F.lit(step)), kind.valueType
        else:
            return None
    return col, kind


def json_value(schema, reference):
    """Value of a JSON reference as a string column."""
    steps = reference_steps(reference)
    if RECORD in schema.names and isinstance(schema[RECORD].dataType, T.VariantType):
        return value_text(*variant_at(F.col(RECORD), steps))
    found = walk_json(schema, steps)
    return null_text() if found is None else value_text(*found)


def json_text_value(col, reference):
    """Value of a JSON reference in a column of JSON text."""
    return F.get_json_object(col, variant_path(reference_steps(reference)))


def xml_steps(reference):
    """Steps of a relative element path; the last may be `@attribute` or `text()`."""
    steps = [s for s in reference.split("/") if s not in ("", ".")]
    for i, step in enumerate(steps):
        if step.startswith("@") and i < len(steps) - 1:
            raise ValueError(f"unsupported XML path: {reference}")
    return steps


def xml_value(schema, reference):
    """First match of an XML path as a string column; empty counts as null.

    Elements are read as arrays, since any of them may repeat.
    """
    col, kind = None, schema
    for step in xml_steps(reference):
        name = "_VALUE" if step == "text()" else "_" + step[1:] if step.startswith("@") else step
        inner = kind.elementType if isinstance(kind, T.ArrayType) else kind
        if not isinstance(inner, T.StructType):
            if step == "text()":
                continue
            return null_text()
        if name not in inner.names:
            return null_text()
        next_kind = inner[name].dataType
        if col is None:
            col, kind = field(name), next_kind
        elif isinstance(kind, T.ArrayType):
            col, kind = col.getField(name), T.ArrayType(next_kind)
            if isinstance(next_kind, T.ArrayType):
                col, kind = F.flatten(F.filter(col, lambda x: x.isNotNull())), next_kind
        else:
            col, kind = col.getField(name), next_kind
    if isinstance(kind, T.ArrayType):
        if isinstance(kind.elementType, T.StructType):
            if "_VALUE" not in kind.elementType.names:
                return null_text()
            col = col.getField("_VALUE")
        col = F.get(F.filter(col, lambda x: x.isNotNull()), 0)
    elif isinstance(kind, T.StructType):
        if "_VALUE" not in kind.names:
            return null_text()
        col = col.getField("_VALUE")
    return F.nullif(col.cast("string"), F.lit(""))


def xml_present(schema, path):
    """Whether an XML path of one step matches, empty elements included; a longer path must end in a value."""
    steps = xml_steps(path)
    if len(steps) > 1:
        return xml_value(schema, path).isNotNull()
    name = "_VALUE" if steps[0] == "text()" else "_" + steps[0][1:] if steps[0].startswith("@") else steps[0]
    if name not in schema.names:
        return F.lit(False)
    col = field(name)
    return F.coalesce(F.size(col) > 0, F.lit(False)) if isinstance(schema[name].dataType, T.ArrayType) else col.isNotNull()


def resolver(records, formulation):
    """Function from a reference (name, path or Column) to a string column."""
    schema = records.schema

    def resolve(reference):
        if not isinstance(reference, str):
            kind = records.select(reference).schema[0].dataType
            return value_text(reference, kind)
        if formulation == "json":
            return json_value(schema, reference)
        if formulation == "xml":
            return xml_value(schema, reference)
        if reference not in schema.names:
            return null_text()
        return value_text(field(reference), schema[reference].dataType)

    return resolve
