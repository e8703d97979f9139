"""Relational rows as records."""


def parquet_table(spark, path, spread=None):
    """A parquet table; `spread` shares out the rows of a small one over that many tasks.

    A file of one row group is read by one task, which then does all that
    follows. Large tables have row groups enough and need no spreading.
    """
    df = spark.read.parquet(path)
    return df.repartition(spread) if spread else df


def jdbc_table(spark, url, table, key=None, lower=None, upper=None, partitions=None, **options):
    """A database table; with a numeric key it is read in parallel ranges."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table).options(**options)
    if key is not None:
        reader = (
            reader.option("partitionColumn", key)
            .option("lowerBound", lower)
            .option("upperBound", upper)
            .option("numPartitions", partitions)
        )
    return reader.load()
