"""IRI and file name helpers."""

from pyspark.sql import functions as F

from tripleweft.vocab import IRI_STARTS, OUTPUT_FORMATS


def looks_like_iri(col):
    """Test of a constant held in a column: is it to be written as an IRI?"""
    test = col.startswith(IRI_STARTS[0])
    for start in IRI_STARTS[1:]:
        test = test | col.startswith(start)
    return test


def expand_curie(col, prefixes):
    """`prefix:local` to a full IRI by a map column; others stay as they are.

    The text is split at its first colon.
    """
    colon = F.instr(col, ":")
    iri = F.try_element_at(prefixes, F.substr(col, F.lit(1), colon - 1))
    return F.when(
        (colon > 1) & iri.isNotNull(), F.concat(iri, F.substr(col, colon + 1))
    ).otherwise(col)


def xml_name(col):
    """Predicate IRI as (namespace, local name), cut at the first place from which an XML name reaches to the end.

    An IRI without such a place is an error, as RDF/XML cannot say it.
    """
    local = F.regexp_extract(col, r"([\p{L}_][\p{L}\p{N}_.\-]*)$", 1)
    none = F.raise_error(F.concat(F.lit("no XML name at the end of predicate "), col)).cast("string")
    return F.substr(col, F.lit(1), F.length(col) - F.length(local)), F.when(local == "", none).otherwise(local)


def format_key(col):
    """Normalise an output format name: `json-ld` and `RDF/XML` style spellings."""
    return F.translate(F.upper(F.trim(col)), "-/", "")


def _format_lookup(col, position):
    pairs = []
    for row in OUTPUT_FORMATS:
        pairs += [F.lit(row[0]), F.lit(row[position])]
    return F.try_element_at(F.create_map(*pairs), format_key(col))


def file_extension(format_col):
    return _format_lookup(format_col, 1)


def mime_type(format_col):
    return _format_lookup(format_col, 2)


def output_name(name_col, format_col):
    """File name up to its last dot plus the extension of the format."""
    stem = F.regexp_replace(name_col, r"\.[^.]*$", "")
    return F.concat(stem, F.lit("."), file_extension(format_col))
