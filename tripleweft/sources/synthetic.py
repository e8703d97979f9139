"""Records made from ids by arithmetic: the same id gives the same record."""

from pyspark.sql import functions as F

# Names, cities and currencies of the made-up records.
FIRST_NAMES = ("Alice", "Bob", "Carol", "Dmitry", "Elena", "Farid", "Grace", "Hugo")
CITIES = ("Berlin", "Lyon", "Madrid", "Oslo", "Porto", "Riga", "Turin")
CURRENCIES = ("EUR", "USD", "GBP")


def _pick(values, key):
    return F.element_at(F.array(*[F.lit(v) for v in values]), (F.pmod(key, F.lit(len(values))) + 1).cast("int"))


def synthetic_customers(ids, id_column="id"):
    """Customers (id, name, email, city, loyalty) for a DataFrame of ids."""
    key = F.col(id_column).cast("bigint")
    text = key.cast("string")
    first = _pick(FIRST_NAMES, key)
    return ids.select(
        key.alias("id"),
        F.concat(first, F.lit(" "), text).alias("name"),
        F.concat(F.lower(first), F.lit("."), text, F.lit("@example.org")).alias("email"),
        _pick(CITIES, key * 7 + 3).alias("city"),
        F.pmod(key * 37, F.lit(1000)).cast("int").alias("loyalty"),
    )


def synthetic_invoices(ids, id_column="id", customers=1000):
    """Invoices (id, customer, amount, currency, issued) for a DataFrame of ids."""
    key = F.col(id_column).cast("bigint")
    day = F.lpad((F.pmod(key * 11, F.lit(28)) + 1).cast("string"), 2, "0")
    month = F.lpad((F.pmod(key * 5, F.lit(12)) + 1).cast("string"), 2, "0")
    cents = F.pmod(key * 7919, F.lit(100_000))
    return ids.select(
        F.concat(F.lit("INV-"), F.lpad(key.cast("string"), 8, "0")).alias("id"),
        F.pmod(key * 13, F.lit(customers)).cast("string").alias("customer"),
        (cents.cast("decimal(12,0)") / F.lit(100).cast("decimal(3,0)")).cast("decimal(12,2)").cast("string").alias("amount"),
        _pick(CURRENCIES, key).alias("currency"),
        F.concat(F.lit("2026-"), month, F.lit("-"), day).alias("issued"),
    )


def generate_ids(spark, n):
    """Ids 0..n-1, made in parallel."""
    return spark.range(n)


def rate_ids(spark, rows_per_second=10):
    """A stream of ids for the record generators."""
    stream = spark.readStream.format("rate").option("rowsPerSecond", rows_per_second).load()
    return stream.select(F.col("value").alias("id"), "timestamp")
