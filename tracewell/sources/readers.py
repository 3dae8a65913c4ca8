"""Readers for CSV and databases."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tracewell.sources.schemas import TableSpec
from tracewell.sources.tables import conform

CORRUPT = "_corrupt_record"


def read_csv_table(spark: SparkSession, path: str, spec: TableSpec, line_breaks: bool = False) -> DataFrame:
    """A raw CSV export. All values are read as text, found by header name, and then cast,
    so the files may leave out or reorder columns."""
    return conform(read_csv_by_header(spark, path, [spec.key], line_breaks), spec)


def read_csv_checked(
    spark: SparkSession, path: str, spec: TableSpec, line_breaks: bool = False
) -> tuple[DataFrame, DataFrame]:
    """A raw CSV export whose rows may be malformed: the table of the good rows, and the rejected ones with
    `record` (the line) and `reasons`.

    A row is rejected when its line has too few or too many values, or when a value is not of the column's
    type; empty values are NULL, as in `read_csv_table`, and are no reason."""
    options = {"quote": '"', "escape": '"', "multiLine": line_breaks}
    header = read_csv_by_header(spark, path, [spec.key], line_breaks).columns
    names = [f"c{i}" for i in range(len(header))]  # whatever the header calls them
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*names, CORRUPT]])
    rows = spark.read.schema(schema).options(**options, header=True, mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT, columnPruning=False).csv(path)
    reasons, columns = [F.when(F.col(CORRUPT).isNotNull(), F.lit("wrong number of values"))], []
    kinds = {f.name: f.dataType for f in spec.schema}
    for raw, name in zip(names, header, strict=True):
        kind = kinds.get(name)
        if kind is None:
            continue
        if isinstance(kind, T.ArrayType | T.StringType):
            columns.append(F.col(raw).alias(name))
            continue
        value = F.expr(f"try_cast(trim({raw}) as {kind.simpleString()})")
        reasons.append(F.when(F.col(raw).isNotNull() & value.isNull(), F.lit(f"{name} is not a {kind.simpleString()}")))
        columns.append(value.alias(name))
    judged = rows.withColumn("reasons", F.array_compact(F.array(*reasons)))
    line = F.coalesce(F.col(CORRUPT), F.to_csv(F.struct(*names)))
    good = judged.filter(F.cardinality("reasons") == 0).select(columns)
    rejected = judged.filter(F.cardinality("reasons") > 0).select(line.alias("record"), "reasons")
    return conform(good, spec), rejected


def read_csv_by_header(spark: SparkSession, path: str, required: list[str], line_breaks: bool = False) -> DataFrame:
    """CSV with a header in any order, case and padding; ValueError when a column is missing.

    With line_breaks, quoted values may go over several lines; a file is then read by one task."""
    raw = spark.read.csv(path, header=True, inferSchema=False, quote='"', escape='"', multiLine=line_breaks)
    named = raw.toDF(*[c.strip().lower() for c in raw.columns])
    for name in required:
        if name not in named.columns:
            raise ValueError(f"Column '{name}' not found.")
    return named


def read_flagged_csv(spark: SparkSession, path: str) -> DataFrame:
    """Input of the executive report: `amount` and `biometric_evasion_flag` are required,
    `transaction_id` (any text) and `timestamp` are used when they are there. Rows are
    numbered in file order as `_row_number`."""
    df = with_row_number(read_csv_by_header(spark, path, ["amount", "biometric_evasion_flag"]))
    return df.withColumn("amount", F.expr("try_cast(amount as double)"))


def read_jdbc_table(
    spark: SparkSession,
    spec: TableSpec,
    options: dict[str, str],
    partition_column: str = "",
    bounds: tuple = (),
    partitions: int = 8,
    predicates: list[str] | None = None,
) -> DataFrame:
    """A database table in parallel slices: by ranges of a number or time column, or, for
    tables with text keys, one slice per predicate. Address and credentials come with the options."""
    table = options.get("dbtable", spec.name)
    if predicates:
        rest = {k: v for k, v in options.items() if k not in ("url", "dbtable")}
        return conform(spark.read.jdbc(options["url"], table, predicates=predicates, properties=rest), spec)
    low, high = bounds
    reader = spark.read.format("jdbc").options(**options).option("dbtable", table)
    reader = reader.option("partitionColumn", partition_column).option("numPartitions", partitions)
    return conform(reader.option("lowerBound", low).option("upperBound", high).load(), spec)


def with_row_number(df: DataFrame, first: int = 2) -> DataFrame:
    """Number rows in file order; the first data row below a header is row 2.

    Each task numbers its own rows; the tasks' row counts, one small row per input split, give
    the offsets. For these the input is read a second time."""
    numbered = df.withColumn("_at", F.monotonically_increasing_id())
    task, inside = F.shiftright("_at", 33), F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = numbered.groupBy(task.alias("_task")).agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_task", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    joined = numbered.withColumn("_task", task).join(F.broadcast(offsets), "_task")
    return joined.withColumn("_row_number", F.col("_offset") + inside + first).drop("_task", "_at", "_offset")

