"""Templates such as `http://example.org/customer/{id}` as concat expressions."""

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed patterns: template reference, input attribute with optional default.
REFERENCE = re.compile(r"(?<!\$)\{([^}]+)\}")
ATTRIBUTE = re.compile(r"\$\{([^}:]+)(?::-([^}]*))?\}")


def template_pieces(text):
    """Split a template into ("text", literal) and ("ref", name) pieces."""
    parts = REFERENCE.split(text)
    return [("ref" if i % 2 else "text", part) for i, part in enumerate(parts) if part]


def template_refs(text):
    """Names of the references in a template, in order."""
    return [part for kind, part in template_pieces(text) if kind == "ref"]


def has_attributes(text):
    """Whether a text holds `${name}` parts."""
    return ATTRIBUTE.search(text) is not None


def fill_text(text, attributes, missing=None):
    """Fill `${name}` and `${name:-default}` of a text that is needed before reading, such as an iterator or a path.

    Without a default, a missing attribute takes `missing`, and is an error if that is None.
    """

    def value(m):
        found = attributes.get(m.group(1), m.group(2) if m.group(2) is not None else missing)
        if found is None:
            raise ValueError(f"no attribute {m.group(1)} for {text}")
        return found

    return ATTRIBUTE.sub(value, text)


def percent_encode(col):
    """Percent-encode a value for use inside an IRI."""
    return F.replace(F.url_encode(col), F.lit("+"), F.lit("%20"))


def expand(text, resolve, encode=False, attrs=None):
    """Template as a Column; null as soon as one reference is null.

    `resolve` maps a reference name to a string Column. Values go in as they
    are unless `encode` asks for percent-encoding. `attrs` is the map column
    that `${name}` parts are filled from; without it they are an error.
    """
    if has_attributes(text):
        return fill_then_expand(text, attrs, resolve, encode=encode)
    cols = []
    for kind, part in template_pieces(text):
        if kind == "text":
            cols.append(F.lit(part))
        else:
            cols.append(percent_encode(resolve(part)) if encode else resolve(part))
    if not cols:
        return F.lit("")
    return cols[0] if len(cols) == 1 else F.concat(*cols)


def fill_attributes(text, attrs: Column, missing="null"):
    """Fill `${name}` and `${name:-default}` from a map column of input attributes.

    Without a default, a missing attribute makes the result null, or is left
    empty with `missing="empty"`.
    """
    if attrs is None:
        raise ValueError(f"no attributes are given for {text}")
    cols, pos = [], 0
    for m in ATTRIBUTE.finditer(text):
        if m.start() > pos:
            cols.append(F.lit(text[pos : m.start()]))
        value = F.try_element_at(attrs, F.lit(m.group(1)))
        default = m.group(2) if m.group(2) is not None else ("" if missing == "empty" else None)
        cols.append(value if default is None else F.coalesce(value, F.lit(default)))
        pos = m.end()
    if pos < len(text) or not cols:
        cols.append(F.lit(text[pos:]))
    return cols[0] if len(cols) == 1 else F.concat(*cols)


def fill_then_expand(text, attrs, resolve, missing="null", encode=False):
    """Template with both `${attribute}` and `{reference}` parts as one concat."""
    cols, pos = [], 0
    for m in ATTRIBUTE.finditer(text):
        if m.start() > pos:
            cols.append(expand(text[pos : m.start()], resolve, encode))
        cols.append(fill_attributes(m.group(0), attrs, missing))
        pos = m.end()
    if pos < len(text) or not cols:
        cols.append(expand(text[pos:], resolve, encode))
    return cols[0] if len(cols) == 1 else F.concat(*cols)
