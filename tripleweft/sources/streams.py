"""Directories watched as streams."""

from pyspark.sql import functions as F


def file_stream(
    spark, path, schema, fmt="parquet", name_glob=None, max_files=None, done="off", archive=None, **options
):
    """Stream of the files that arrive in a directory.

    `name_glob` filters file names, `max_files` bounds a batch, and `done`
    says what happens to a finished file: `off` keeps it, `archive` moves it to
    `archive`, `delete` removes it.
    """
    reader = spark.readStream.format(fmt).schema(schema).options(**options)
    if name_glob:
        reader = reader.option("pathGlobFilter", name_glob)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if done != "off":
        reader = reader.option("cleanSource", done)
    if archive:
        reader = reader.option("sourceArchiveDir", archive)
    return reader.load(path)


def with_file_attributes(df):
    """Add the name and size of the file a row came from."""
    return df.select(
        "*",
        F.col("_metadata.file_name").alias("file_name"),
        F.col("_metadata.file_size").alias("file_size"),
    )
