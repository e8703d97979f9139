"""Values as text, escaping for the output formats, and its inverse."""

from pyspark.sql import functions as F
from pyspark.sql import types as T


def variant_text(col):
    """Text of a JSON value held as a variant.

    Numbers with a fraction or exponent print as doubles do (`1.50` as `1.5`,
    `1e3` as `1000.0`); objects and arrays print as JSON. The text of a number
    starts with a digit or a minus and so sorts before a colon; only such text
    needs its kind looked up, to tell a number from a string.
    """
    text = F.try_variant_get(col, "$", "string")
    # How the names of the fractional types start (decimal, double, float).
    fraction = F.substring(F.schema_of_variant(col), 1, 2).isin("DE", "DO", "FL")
    return F.when(
        (text < ":") & fraction, F.try_variant_get(col, "$", "double").cast("string")
    ).otherwise(text)


def value_text(col, data_type):
    """Any column as the string that goes into a term."""
    if isinstance(data_type, T.StringType):
        return col
    if isinstance(data_type, T.VariantType):
        return variant_text(col)
    if isinstance(data_type, (T.StructType, T.ArrayType, T.MapType)):
        return F.to_json(col)
    return col.cast("string")


def replace_all(col, pairs):
    for old, new in pairs:
        col = F.replace(col, F.lit(old), F.lit(new))
    return col


# Characters that a quoted literal must escape.
LITERAL_ESCAPES = (("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n"), ("\r", "\\r"))
# Characters that XML text and attributes must escape.
XML_ESCAPES = (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("\r", "&#13;"))


def escape_literal(col):
    """Escape a literal for N-Triples and Turtle."""
    return replace_all(col, LITERAL_ESCAPES)


def escape_literal_text(text):
    for old, new in LITERAL_ESCAPES:
        text = text.replace(old, new)
    return text


def escape_xml(col):
    """Escape text for XML content and attribute values."""
    return replace_all(col, XML_ESCAPES)


# Fixed value: characters that XML 1.0 cannot hold, even escaped.
_NO_XML = r"[\x00-\x08\x0B\x0C\x0E-\x1F\uFFFE\uFFFF]"


def xml_characters(col, forbidden="raise"):
    """Text without characters that XML cannot hold: they are an error, or become U+FFFD with `forbidden="replace"`."""
    if forbidden == "replace":
        return F.regexp_replace(col, _NO_XML, "\uFFFD")
    failed = F.raise_error(F.lit("text with characters that XML 1.0 cannot hold")).cast("string")
    return F.when(col.rlike(_NO_XML), failed).otherwise(col)


# The one-letter escapes of N-Triples, without that of the backslash.
_ECHARS = (("\\n", "\n"), ("\\r", "\r"), ("\\t", "\t"), ("\\b", "\b"), ("\\f", "\f"), ('\\"', '"'), ("\\'", "'"))


def unescape_plain(col):
    """Inverse of `escape_literal` for text without `\\u` and `\\U` escapes.

    Escaped backslashes are set aside as `\\!`, which is no escape and so
    cannot stand in the text, lest one be taken for the start of the next.
    """
    return replace_all(col, (("\\\\", "\\!"), *_ECHARS, ("\\!", "\\")))


def has_code_escape(col):
    return F.contains(col, F.lit("\\u")) | F.contains(col, F.lit("\\U"))


def _code_units(col, mark, digits, charset):
    """Decode `\\uXXXX` or `\\UXXXXXXXX` runs: split at the mark, decode each head."""
    pieces = F.split(col, "\\\\" + mark)
    decoded = F.transform(
        pieces,
        lambda x, i: F.when(i == 0, x).otherwise(
            F.concat(F.decode(F.unhex(F.substring(x, 1, digits)), charset), F.substr(x, F.lit(digits + 1)))
        ),
    )
    return F.when(F.contains(col, F.lit("\\" + mark)), F.array_join(decoded, "")).otherwise(col)


def unescape_codes(col):
    """Inverse of `escape_literal` for every escape that N-Triples allows.

    The text is cut at escaped backslashes, and the pieces are decoded.
    """

    def piece(x):
        return replace_all(_code_units(_code_units(x, "u", 4, "UTF-16BE"), "U", 8, "UTF-32"), _ECHARS)

    return F.array_join(F.transform(F.split(col, "\\\\\\\\"), piece), "\\")


def short_key(col, length=16):
    """First characters of the SHA-256 hex digest, as a cache or join key."""
    return F.substring(F.sha2(col, 256), 1, length)
