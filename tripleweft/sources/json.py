"""JSON files as records, with a read schema that follows the mapping."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripleweft.functions.paths import RECORD, field, json_steps, reference_steps, variant_path
from tripleweft.plans.once import evaluate_once
from tripleweft.sources.splits import JsonPieces, record_texts


def _insert(tree, steps):
    for step in steps:
        if isinstance(step, int):
            break
        if step == "*":
            break
        tree = tree.setdefault(step, {})
    return tree


def schema_for(references, iterator=None, leaf=None):
    """Schema that holds the references below the iterator, and nothing else.

    A path that goes through a position (`a[0].b`) or `[*]` is kept as one JSON value
    from there on. Leaves are variants, which keep numbers apart from strings,
    unless `leaf` names another type.
    """
    leaf = leaf or T.VariantType()
    tree, opaque = {}, set()
    for reference in references:
        steps = reference_steps(reference)
        cut = next((i for i, s in enumerate(steps) if isinstance(s, int) or s == "*"), None)
        if cut == 0:
            continue
        _insert(tree, steps[:cut])
        if cut is not None:
            opaque.add(tuple(steps[:cut]))

    def build(node, path):
        fields = []
        for name, inner in node.items():
            here = (*path, name)
            if here in opaque:
                kind = T.VariantType()
            elif inner:
                kind = build(inner, here)
            else:
                kind = leaf
            fields.append(T.StructField(name, kind))
        return T.StructType(fields)

    out = build(tree, ())
    for step in reversed(_below_root(iterator)):
        out = T.ArrayType(out) if step == "*" else T.StructType([T.StructField(step, out)])
    return out


def _below_root(iterator):
    steps = json_steps(iterator) if iterator else []
    return steps[1:] if steps[:1] == ["*"] else steps


def json_records(spark, path, references, iterator=None, multi_line=False, leaf=None, mode="FAILFAST"):
    """Records of a JSON path, typed by the mapping's references.

    With no iterator (`$`, `$[*]`) an array root gives one record per element
    and any other root one record. Other iterators walk names and `[*]`; every
    array on the way needs its `[*]`, since the read schema follows from the
    path (`iterate_variant` takes documents whose shape is not known).
    Files with one record per line are read in splits; `multi_line` takes
    each file as one document. The items of a root array are read in splits
    too (`sources/splits.py`); with any other iterator a document is one task's.
    """
    steps = _below_root(iterator)
    schema = schema_for(references, iterator, leaf)
    if multi_line and not steps:
        parsed = F.from_json("text", schema, {"mode": mode})
        return evaluate_once(record_texts(spark, path, JsonPieces()), parsed.alias(RECORD)).select(f"{RECORD}.*")
    reader = spark.read.schema(schema).option("multiLine", multi_line).option("mode", mode)
    records = reader.json(path)
    if not steps:
        return records
    col = field(steps[0])
    for step in steps[1:]:
        if step == "*":
            records = records.select(F.explode(col).alias(RECORD))
            col = F.col(RECORD)
        else:
            col = col.getField(step)
    return records.select(col.alias(RECORD)).filter(F.col(RECORD).isNotNull()).select(f"{RECORD}.*")


def variant_documents(spark, path, multi_line=True):
    """Whole JSON values as one variant column, for documents without a fixed shape."""
    return (
        spark.read.option("singleVariantColumn", RECORD).option("multiLine", multi_line).json(path)
    )


def iterate_variant(documents, iterator, column=RECORD):
    """Records below an iterator path of variant documents.

    Each `[*]` explodes an array. A path without `[*]` that ends at an array
    gives its items; null gives nothing, anything else is one record.
    """
    others = [c for c in documents.columns if c != column]
    steps = json_steps(iterator) if iterator else []
    value, pending = F.col(column), []
    for step in steps:
        if step == "*":
            items = F.try_variant_get(value, variant_path(pending), "array<variant>")
            documents = documents.select(*others, F.explode(items).alias(RECORD))
            value, pending = F.col(RECORD), []
        else:
            pending.append(step)
    if pending:
        value = F.try_variant_get(value, variant_path(pending), "variant")
    if "*" not in steps:
        whole = F.schema_of_variant(value).startswith("ARRAY")
        value = F.explode(
            F.when(whole, F.try_variant_get(value, "$", "array<variant>")).otherwise(F.array(value))
        )
    out = documents.select(*others, value.alias(RECORD))
    return out.filter(F.col(RECORD).isNotNull() & ~F.is_variant_null(RECORD))


def parse_text(df, column, keep=()):
    """A column of JSON text as variant records."""
    return df.select(*keep, F.try_parse_json(column).alias(RECORD))
