"""CSV files as all-string records."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripleweft.plans.once import evaluate_once

# A separator that no line can contain, so that the reader hands over whole lines.
_NO_SEPARATOR = "\n"

# One cell after a comma: quoted (inner quotes doubled, text may follow the
# closing quote, a missing closing quote ends with the line) or plain.
_CELL = r',("[^"]*+(?:""[^"]*+)*+(?:"[^,]*+)?|[^,]*+)'
_QUOTED_BODY = r'^"([^"]*+(?:""[^"]*+)*+)'


def cells_of(line):
    """Cells of a CSV line as an array of raw (still quoted) strings."""
    quoted = F.regexp_extract_all(F.concat(F.lit(","), line), F.lit(_CELL), 1)
    return F.when(F.contains(line, F.lit('"')), quoted).otherwise(F.split(line, ","))


def unquote(cell):
    """Text of a raw cell."""
    body = F.regexp_extract(cell, _QUOTED_BODY, 1)
    tail = F.substr(cell, F.length(body) + 3)
    text = F.concat(F.replace(body, F.lit('""'), F.lit('"')), tail)
    return F.when(cell.startswith('"'), text).otherwise(cell)


def header_of(spark, path):
    """First line and the column names in it (one row, read by one task)."""
    names = F.transform(cells_of(F.col("value")), unquote)
    first = spark.read.text(path).limit(1).select("value", names.alias("names")).first()
    if first is None:
        raise ValueError(f"empty CSV input: {path}")
    return first.value, first.names


def exact_csv(spark, path, references=None):
    """CSV with missing cells (null) and empty cells ('') told apart.

    Lines stay splittable; only the cells that are asked for are unquoted. With
    a repeated header name the last column counts. All files of one path must
    share one header; one with another header fails the job.
    """
    header, names = header_of(spark, path)
    position = {name: i for i, name in enumerate(names)}
    wanted = list(position) if references is None else [r for r in references if r in position]
    # The only column of the reader is the line; its name is the header line,
    # against which the reader checks the first line of every file.
    lines = (
        spark.read.schema(T.StructType([T.StructField(header, T.StringType())]))
        .option("header", True)
        .option("enforceSchema", False)
        .option("sep", _NO_SEPARATOR)
        .option("quote", "")
        .csv(path)
        .toDF("line")
    )
    # The reader drops lines of only white space; they are records, unlike empty lines.
    blank = spark.read.text(path).where((F.col("value") != "") & ~F.col("value").rlike(r"[^\x00-\x20]")).toDF("line")
    lines = lines.unionByName(blank)
    cells = evaluate_once(lines, cells_of(F.col("line")).alias("cells"))
    return evaluate_once(cells, *[unquote(F.get("cells", position[n])).alias(n) for n in wanted])


def fast_csv(spark, path, references=None, empty_cells="empty"):
    """CSV by Spark's own reader with column pruning.

    Both missing and empty cells come as null from the reader;
    `empty_cells="empty"` turns them into '' and `"null"` leaves them.
    """
    _, names = header_of(spark, path)
    last = {name: i for i, name in enumerate(names)}
    repeated = len(last) < len(names)
    columns = [n if last[n] == i else f"{n}#{i}" for i, n in enumerate(names)]
    reader = (
        spark.read.schema(T.StructType([T.StructField(c, T.StringType()) for c in columns]))
        .option("header", True)
        .option("escape", '"')
        # Checks the header of every file against the schema.
        .option("enforceSchema", repeated)
    )
    wanted = list(last) if references is None else [r for r in references if r in last]
    out = reader.csv(path)
    quoted = ["`" + n.replace("`", "``") + "`" for n in wanted]
    if empty_cells == "empty":
        return out.select(*[F.coalesce(F.col(q), F.lit("")).alias(n) for q, n in zip(quoted, wanted, strict=True)])
    return out.select(*[F.col(q) for q in quoted])


def csv_records(spark, path, references=None, mode="exact", empty_cells="empty"):
    """Records of a CSV path; `references` limits the columns that are built."""
    if mode == "exact":
        return exact_csv(spark, path, references)
    return fast_csv(spark, path, references, empty_cells)
