"""Rating sources.

``user::item::rating::ts`` text (exactly four fields) and delimited CSV with a
declared schema.  Parsing is column expressions on ``spark.read.text``; a
strict reader fails the job on the first bad line (like the reference), a
permissive reader routes bad lines to a second table instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The text layout and the delimited schema of the rating feeds.
RATING_SEPARATOR = "::"
RATING_FIELDS = 4
CSV_SCHEMA = "userid bigint, movieid bigint, rating double, timestamp string"

_TYPES = (("user", "int"), ("item", "int"), ("rating", "float"), ("ts", "bigint"))


def _parsed(df: DataFrame, value: str = "value") -> DataFrame:
    """(line, user, item, rating, ts), null fields if the line does not have four.

    Every line is split and cast once: the fields come out of a generator, and expressions
    over its columns aren't merged with what makes the line and its fields.
    """
    # Spark's split keeps trailing empty fields, so "1::2::3::" has four
    # fields with an empty last one; the empty field then fails to parse (Q13).
    fields = F.transform(F.array(F.split("line", RATING_SEPARATOR, -1)), lambda f: F.struct(
        *[F.when(F.size(f) == RATING_FIELDS, f.getItem(i).try_cast(t)).alias(n) for i, (n, t) in enumerate(_TYPES)]))
    return df.select(F.col(value).alias("line")).select("line", F.inline(fields))


def _good():
    return (F.col("user").isNotNull() & F.col("item").isNotNull()
            & F.col("rating").isNotNull() & F.col("ts").isNotNull())


def parse_rating_lines(df: DataFrame, value: str = "value") -> DataFrame:
    """Strict (S1/S4): (user int, item int, rating float, ts bigint); a bad line fails the job.

    The check is a filter on the whole row, so it runs whatever columns are read.
    """
    p = _parsed(df, value)
    fail = F.raise_error(F.concat(F.lit("not a rating line of four fields: "), F.coalesce("line", F.lit("null")))).cast("boolean")
    return p.filter(F.when(_good(), F.lit(True)).otherwise(fail)).select("user", "item", "rating", "ts")


def split_rating_lines(df: DataFrame, value: str = "value") -> tuple[DataFrame, DataFrame]:
    """Permissive: (good rows, bad lines).  P6: arity != 4 or an unparseable field is bad."""
    p = _parsed(df, value)
    good = p.filter(_good()).select("user", "item", "rating", "ts")
    bad = p.filter(~_good()).select("line")
    return good, bad


def read_rating_text(spark: SparkSession, path: str, strict: bool = True):
    """Read a text feed; strict returns one table, permissive returns (good, bad)."""
    lines = spark.read.text(path)
    return parse_rating_lines(lines) if strict else split_rating_lines(lines)


def read_rating_csv(spark: SparkSession, path: str, schema: str = CSV_SCHEMA,
                    header: bool = False) -> DataFrame:
    """Delimited feed with a declared schema (no inference)."""
    return spark.read.schema(schema).option("header", header).option("mode", "FAILFAST").csv(path)


def scan_rating_csv(spark: SparkSession, path: str, schema: str = CSV_SCHEMA, header: bool = False) -> tuple[DataFrame, DataFrame]:
    """S2, permissive: (good rows, bad lines) of delimited files with a declared schema.

    A line of another number of fields, or with one that does not parse, is bad and kept whole.
    Both sides look at all fields, so a line is judged alike whatever columns are read later.
    """
    corrupt = "_corrupt_line"
    read = spark.read.schema(f"{schema}, {corrupt} string").option("header", header).option("mode", "PERMISSIVE") \
        .option("columnNameOfCorruptRecord", corrupt).csv(path)
    fields = [c for c in read.columns if c != corrupt]
    whole = F.length(F.concat_ws("", *[F.col(c).cast("string") for c in fields])) >= 0
    return (read.where(F.col(corrupt).isNull() & whole).select(*fields),
            read.where(F.col(corrupt).isNotNull() & whole).select(F.col(corrupt).alias("line")))


def parse_csv_lines(df: DataFrame, value: str = "value", schema: str = CSV_SCHEMA) -> DataFrame:
    """S2 for a line column: the same CSV parser through ``from_csv``."""
    parsed = df.select(F.from_csv(F.col(value), schema, {"mode": "FAILFAST"}).alias("r"))
    return parsed.select("r.*")


def ingest_summary(lines: DataFrame, keys: list[str], fraction: float, value: str = "value"):
    """One pass over a feed: (good rows, bad lines, train rows, test rows).

    Parsing, validation and the key-hash split are all column expressions,
    so the four counts come from a single partially aggregated job.
    """
    from tessera.operators.split import hash_cut, key_hash
    p = _parsed(lines, value).withColumn("_good", _good())
    p = p.withColumn("_train", key_hash(keys) < hash_cut(fraction))
    row = p.selectExpr("count_if(_good) AS good", "count_if(NOT _good) AS bad",
                       "count_if(_good AND _train) AS train",
                       "count_if(_good AND NOT _train) AS test").first()
    return int(row["good"]), int(row["bad"]), int(row["train"]), int(row["test"])
