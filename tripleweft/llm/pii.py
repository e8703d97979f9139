"""Personal data: regular expressions propose spans, validators confirm them, nearby words move their score."""

import re

import pyarrow as pa
from pyspark.sql import functions as F

# Kinds in the order that sorts spans of one start. The first four are the base kinds.
KINDS = ("email", "ip", "card", "phone", "iban", "ssn")
BASE = 4

# Shapes of the base kinds, per contract. Looking behind keeps each scan linear and changes no match, as
# no match of theirs starts inside a run of digits.
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
# Shapes of the kinds that the method adds.
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
_SSN = re.compile(r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])")

# Score of a confirmed span before its context, by kind; words nearby that raise or lower it.
START = {"email": 0.8, "ip": 0.6, "card": 0.7, "phone": 0.6, "iban": 0.8, "ssn": 0.4}
RAISE = {
    "email": ("mail", "contact", "write"),
    "ip": ("ip", "address", "host", "server"),
    "card": ("card", "visa", "credit", "payment"),
    "phone": ("phone", "call", "tel", "mobile", "fax"),
    "iban": ("iban", "bank", "account", "transfer"),
    "ssn": ("ssn", "social", "security"),
}
LOWER = ("version", "example", "isbn", "serial", "order")
STEP, REACH, LEAST = 0.2, 48, 0.5

_WORDS = re.compile(r"[a-z]+")


def luhn(digits):
    """Checksum of card numbers."""
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        total += n if i % 2 == 0 else (2 * n - 9 if n > 4 else 2 * n)
    return total % 10 == 0


def mod97(iban):
    """Checksum of account numbers."""
    moved = iban[4:] + iban[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def _emails(text):
    """Each '@' is tried once, with the longest local part that the match before leaves."""
    at, free = text.find("@"), 0
    while at >= 0:
        start = at
        while start > free and _LOCAL.match(text, start - 1):
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            free = m.end()
        at = text.find("@", max(at + 1, free))
        free = max(free, 0)


def _ips(text):
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) < 4 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
            yield m.span()


def _cards(text):
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 12:
            digits = m.group().replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                yield m.span()


def _phones(text):
    for m in _PHONE.finditer(text):
        if 9 <= sum(c.isdigit() for c in m.group()) <= 15:
            yield m.span()


def _ibans(text):
    m = _IBAN.search(text)
    while m:
        shape, next_ = m.group(), m.start() + 1
        while len(plain := shape.replace(" ", "")) >= 15:
            if len(plain) <= 34 and mod97(plain):
                next_ = m.start() + len(shape)
                yield m.start(), next_
                break
            shape = shape.rpartition(" ")[0]  # what follows a blank may be another word
        m = _IBAN.search(text, next_)


def _ssns(text):
    for m in _SSN.finditer(text):
        yield m.span()


_FINDERS = (_emails, _ips, _cards, _phones, _ibans, _ssns)
_DIGIT = re.compile(r"[0-9]")


def _score(text, kind, start, end):
    near = set(_WORDS.findall((text[max(0, start - REACH) : start] + " " + text[end : end + REACH]).lower()))
    moved = STEP * any(w in near for w in RAISE[kind]) - STEP * any(w in near for w in LOWER)
    return min(1.0, max(0.0, START[kind] + moved))


def spans_of(text):
    """Spans (start, kind number, end, score) of one text, in order of start and kind; offsets count code points.

    The base kinds are kept whatever their score; of the added kinds only those at `LEAST` or more. Kinds may overlap.
    """
    found = []
    if not text:
        return found
    digits = _DIGIT.search(text) is not None
    for k, finder in enumerate(_FINDERS):
        if k == 0 and "@" not in text or k and not digits or k == 3 and "+" not in text:
            continue
        for start, end in finder(text):
            score = _score(text, KINDS[k], start, end)
            if k < BASE or score >= LEAST:
                found.append((start, k, end, score))
    found.sort()
    return found


_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64()), ("base", pa.bool_())]))
_DDL = "array<struct<kind:string,start:bigint,end:bigint,score:double,base:boolean>>"


def find_pii(docs):
    """Spans of every text: doc_id, spans (kind, start, end, score, base), one row per row of `docs`, in one narrow pass.

    A null or empty text has no spans, a null doc_id stays null; further columns are ignored. Very long texts are read
    whole; each scan is linear in the length of the text.
    """

    def run(batches):
        for batch in batches:
            out = [
                [{"kind": KINDS[k], "start": s, "end": e, "score": v, "base": k < BASE} for s, k, e, v in spans_of(t)]
                for t in (x.as_py() for x in batch.column(1))
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, _SPANS)], ["doc_id", "spans"])

    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, spans {_DDL}")


def masked(text):
    """The text with every span replaced by its kind in brackets; spans that overlap become one, named by the first."""
    spans, out, at = spans_of(text), [], 0
    i = 0
    while i < len(spans):
        start, k, end, _ = spans[i]
        i += 1
        while i < len(spans) and spans[i][0] < end:
            end = max(end, spans[i][2])
            i += 1
        out += [text[at:start], f"[{KINDS[k].upper()}]"]
        at = end
    return "".join([*out, text[at:]]) if out else text


def mask_pii(docs):
    """`docs` with personal data in `text` masked and `n_chars`, if there is one, counted anew; other columns stay.

    Null texts stay null. Column names may be any, as the text alone passes through Python.
    """
    mask = F.pandas_udf(lambda texts: texts.map(masked, na_action="ignore"), "string")
    out = docs.withColumn("text", mask("text"))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text").cast(docs.schema["n_chars"].dataType)))
    return out
