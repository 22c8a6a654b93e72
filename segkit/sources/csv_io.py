"""CSV and parquet sinks/sources, with a given or an inferred schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType
from pyspark.errors import AnalysisException

from segkit.sources.tables import MissingInputError, require_columns


def write_csv(df: DataFrame, path: str) -> str:
    """S3: header row, no index, overwrite; empty string means null."""
    (df.write.mode("overwrite").option("header", True).option("nullValue", "")
       .option("emptyValue", "").csv(path))
    return path


def read_csv(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """Columns by header name, typed by ``schema`` (no inference pass), empty field is null.

    The header is read first: a column of ``schema`` that it lacks raises ``SchemaContractError``; other columns are read as text and
    dropped.  Every file's header is checked against the first one's.
    """
    wanted = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    try:
        header = spark.read.option("header", True).option("inferSchema", False).csv(path)
        require_columns(header, wanted.fieldNames())
        kinds = {f.name: f for f in wanted}
        found = StructType([kinds.get(c, StructField(c, StringType())) for c in header.columns])
        return (spark.read.schema(found).option("header", True).option("enforceSchema", False).option("nullValue", "")
                .option("mode", "FAILFAST").csv(path).select(*wanted.fieldNames()))
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e):
            raise MissingInputError(f"input not found at '{path}'") from e
        raise


#: What a text column may hold, the narrowest first: name, type, pattern of its values, whether a value can be read.
KINDS = (("boolean", "boolean", "(?i)true|false", None), ("long", "bigint", r"[+-]?[0-9]+", "try_cast({0} as bigint) is not null"),
         ("double", "double", r"[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?", None), ("date", "date", r"[0-9]{4}-[0-9]{2}-[0-9]{2}", "try_cast({0} as date) is not null"),
         ("timestamp", "timestamp", r"[0-9]{4}-[0-9]{2}-[0-9]{2}[ T][0-9]{2}:[0-9]{2}:[0-9]{2}(\.[0-9]+)?Z?", "try_cast({0} as timestamp) is not null"))


def inferred_schema(rows: DataFrame) -> StructType:
    """The narrowest type of each text column of ``rows`` that holds all its values.

    boolean, long < double, date < timestamp; whatever has values of several of these, or others, is text, and so is a column without
    values.  One aggregate over all rows, a flag per column and type, combined in every task; empty fields are nulls.
    """
    flags = []
    for i, c in enumerate(rows.columns):
        ref = "`" + c.replace("`", "``") + "`"
        value = F.nullif(F.col(ref), F.lit(""))
        flags.append(F.count(value).alias(f"n{i}"))
        for name, _, pattern, readable in KINDS:
            fit = value.rlike(f"^({pattern})$")
            if readable:
                fit = fit & F.expr(readable.format(ref))
            flags.append(F.min(F.when(value.isNotNull(), fit)).alias(f"{name}{i}"))
    found = rows.agg(*flags).first()
    fields = []
    for i, c in enumerate(rows.columns):
        fits = [kind for name, kind, _, _ in KINDS if found[f"{name}{i}"]]
        if not fits and found[f"n{i}"] and _mixed_times(rows, c):
            fits = ["timestamp"]
        fields.append(StructField(c, _parse_type(fits[0]) if fits else StringType()))
    return StructType(fields)


def _mixed_times(rows: DataFrame, c: str) -> bool:
    """Whether the column holds dates and times, and nothing else."""
    ref = "`" + c.replace("`", "``") + "`"
    either = "|".join(p for name, _, p, _ in KINDS if name in ("date", "timestamp"))
    value = F.nullif(F.col(ref), F.lit(""))
    return bool(rows.agg(F.min(F.when(value.isNotNull(), value.rlike(f"^({either})$") & F.expr(f"try_cast({ref} as timestamp) is not null")))).first()[0])


def _parse_type(name: str):
    return StructType.fromDDL(f"c {name}")[0].dataType


def read_csv_inferred(spark: SparkSession, path: str) -> DataFrame:
    """A CSV table with a header, its types inferred from all values; empty field is null."""
    try:
        rows = spark.read.option("header", True).option("inferSchema", False).option("nullValue", "").csv(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e):
            raise MissingInputError(f"input not found at '{path}'") from e
        raise
    return read_csv(spark, path, inferred_schema(rows))


def write_parquet(df: DataFrame, path: str, partition_by=None) -> str:
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path
