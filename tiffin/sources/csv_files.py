"""CSV extracts to typed bronze rows.

Every column is read as text and converted by expressions. Text that is no date or no number becomes
NULL, so one odd value never fails a load. What would lose data without a trace does fail it, with
the column and value in the message: a number or text too large for its column, and a record that does not
fit the header. Such records can be set aside instead (``malformed="skip"``, ``malformed_records``).
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tiffin.plans.together import run_together
from tiffin.schemas import Field, TableSpec
from tiffin.sources import csv_records

# The texts that pandas reads as missing by default.
NULL_TOKENS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)

# A time of day after a date, with an optional zone. It is read over: a date is the day as written.
_TIME = (
    r"(?i)[ T]\s*([01]?\d|2[0-3]):[0-5]\d(:[0-5]\d([.]\d{1,9})?)?"
    r"(\s*[ap]m)?(\s*(Z|UTC|GMT|[+-]\d{2}(:?\d{2})?))?$"
)
# Spellings of a day, tried in turn; days and months of one digit fit too, and names in any case.
_DAY_FORMATS = ("yyyy-M-d", "yyyy/M/d", "d-MMM-yyyy", "d MMM yyyy", "MMM d, yyyy", "MMMM d, yyyy")
# The usual spelling, which is converted without trying formats; other ones, and other times of day, go by the formats.
_ISO_DAY = r"^[1-9]\d{3}-\d\d-\d\d([ T]([01]\d|2[0-3]):[0-5]\d:[0-5]\d)?\z"
_MONTH_FIRST, _DAY_FIRST = "M/d/yyyy", "d/M/yyyy"

_NUMBER = r"(?i)^\s*[+-]?((\d+[.]?\d*|[.]\d+)(e[+-]?\d+)?|inf(inity)?)\s*$"

RECORD, REASON = "_record", "_reason"
TOO_MANY_FIELDS, UNCLOSED_QUOTE = "Too many fields", "Unclosed quote"
RAISE, SKIP = "raise", "skip"

_CSV = {"quote": '"', "escape": '"', "columnNameOfCorruptRecord": RECORD}


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists on whatever file system it names."""
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    return hadoop_path.getFileSystem(conf).exists(hadoop_path)


def _as_written(files: list[str]) -> list[str]:
    """Paths for a reader that takes signs of patterns in file names as they are."""
    return [re.sub(r"([\\{}\[\]*?])", r"\\\1", f) for f in files]


def read_csv_text(
    spark: SparkSession, path: str, multiline: bool | None = None, lenient: bool = False
) -> list[tuple[str, DataFrame]]:
    """A headed extract as text columns, a table for each distinct header, with a file that has it.

    Columns are matched by name, not by position, so the parts of a folder may have them in any order. The
    columns ``_record`` and ``_reason`` are NULL for good records; for one that does not fit its header they
    are its text and what is wrong with it.

    Line breaks inside quotes are found by a scan of the lines that have quotes, and such extracts are read
    by many tasks (``csv_records``). Files are scanned and read with those of their own header, so each of them
    is read once, however many headers there are. ``multiline=False`` spares the scan: every line is a record, and one that
    ends inside quotes is malformed. ``multiline=True`` has Spark read every file in one task. An extract
    with a file that ends inside quotes is an error, or is read line by line if ``lenient``.
    """
    files = csv_records.input_files(spark, path)
    headers = csv_records.file_headers(spark, files)
    by_header: dict[tuple[str, ...], list[str]] = {}
    for file, header in zip(files, headers, strict=True):
        if header:
            by_header.setdefault(header, []).append(file)
    if not by_header:
        raise AnalysisException(f"no file of {path} has a header")
    # The scan and the reading of a header's files see the same splits, as they are given the same paths.
    paths = [path if len(own) == len(files) else _as_written(own) for own in by_header.values()]
    scans = []
    if multiline is None:
        scans = run_together(spark, lambda own: csv_records.scan_quotes(spark, own), paths)
    unclosed = frozenset().union(*[scan.unclosed for scan in scans])
    if unclosed and not lenient:
        numbers = csv_records.file_numbers(spark, files)
        broken = [f for f, n in zip(files, numbers, strict=True) if n in unclosed]
        raise ValueError(f"{UNCLOSED_QUOTE} at the end of {broken[0]}")
    by_records = not unclosed and any(scan.breaks for scan in scans)
    tables = []
    for i, (header, own) in enumerate(by_header.items()):
        names = csv_records.distinct_names(header)
        schema = T.StructType([T.StructField(n, T.StringType()) for n in [*names, RECORD]])
        if not by_records:
            text = (
                spark.read.options(**_CSV, header=True, multiLine=bool(multiline))
                # All fields are parsed whatever is selected later, as their number is what is checked.
                .option("columnPruning", False)
                .schema(schema)
                .csv(paths[i])
            )
        else:
            records = csv_records.read_records(spark, paths[i], scans[i])
            fields = ", ".join(f"`{f.name.replace('`', '``')}` string" for f in schema.fields)
            parsed = F.from_csv(F.col("record"), fields, {**_CSV, "multiLine": "true"})
            # By a generator, as a filter would be pushed below a projection and parse each record again.
            text = records.select(F.inline(F.array(parsed)))
        tables.append((own[0], text.withColumn(REASON, malformed_reason(text))))
    return tables


def malformed_reason(text: DataFrame) -> Column:
    """Why a record cannot be read; NULL for good ones.

    A record with too few fields is good: the missing ones are NULL. It is not if a quote is left
    open, which is what a line break inside quotes looks like when lines are read one by one.
    """
    record = F.col(RECORD)
    quotes = F.length(record) - F.length(F.replace(record, F.lit('"'), F.lit("")))
    bare = F.regexp_replace(record, '"[^"]*"', "")
    fields = F.length(bare) - F.length(F.replace(bare, F.lit(","), F.lit(""))) + 1
    header_fields = len([c for c in text.columns if c != RECORD])
    return F.when(quotes % 2 == 1, F.lit(UNCLOSED_QUOTE)).when(
        fields > header_fields, F.lit(TOO_MANY_FIELDS)
    )


def _field_is_read(text: DataFrame) -> Column:
    """Always true. Spark reads no CSV for the record alone, so a condition needs a field as well."""
    return F.length(F.coalesce(F.col(f"`{text.columns[0]}`"), F.lit(""))) >= 0


def null_tokens_to_null(c: Column) -> Column:
    return F.when(~c.isin(*NULL_TOKENS), c)


def to_day(c: Column, day_first: bool = False) -> Column:
    """Text to DATE by the first spelling that fits; NULL if none does.

    ``day_first`` says whether ``1/5/2024`` is the 1st of May or, as by default, the 5th of January.
    """
    day = F.regexp_replace(F.trim(c), _TIME, "")
    formats = (*_DAY_FORMATS, _DAY_FIRST if day_first else _MONTH_FIRST)
    spelled = F.coalesce(*[F.try_to_date(day, fmt) for fmt in formats])
    return F.when(c.rlike(_ISO_DAY), F.substring(c, 1, 10).try_cast("date")).otherwise(spelled)


def _fitting(c: Column, value: Column, name: str, type_name: str) -> Column:
    """``value``, made from text; fails the load where a number has none, NULL where there is no number."""
    message = F.concat(F.lit(f"{name} does not fit {type_name}: "), F.substring(c, 1, 200))
    missing = value.isNull() & c.rlike(_NUMBER)
    return F.when(missing, F.raise_error(message)).otherwise(value)


def to_decimal(c: Column, type_: T.DecimalType, name: str = "a number") -> Column:
    """Text to a decimal, rounded to its scale; NULL if it is no number."""
    number = F.when(c.rlike(_NUMBER), c)
    return _fitting(c, number.try_cast(type_), name, type_.simpleString())


def to_whole_number(c: Column, name: str = "a number") -> Column:
    """Text to INT through a decimal, so that ``2.0`` is 2 and ``2.5`` rounds to 3."""
    number = F.when(c.rlike(_NUMBER), c)
    return _fitting(c, F.round(number.try_cast("decimal(30,8)"), 0).try_cast("int"), name, "int")


def fit_length(c: Column, field: Field) -> Column:
    """Fail the load on a text longer than its declared width, but for blanks at its end, as a typed
    table would; such blanks are cut."""
    message = F.concat(
        F.lit(f"{field.name} is longer than {field.max_length} characters: "), F.substring(c, 1, 200)
    )
    return (
        F.when(F.length(c) <= field.max_length, c)
        .when(F.length(F.rtrim(c)) <= field.max_length, F.substring(c, 1, field.max_length))
        .when(c.isNotNull(), F.raise_error(message))
    )


def coerce(c: Column, field: Field, day_first: bool = False) -> Column:
    """A text column to the declared type of ``field``."""
    value = null_tokens_to_null(c)
    if isinstance(field.type, T.DateType):
        return to_day(value, day_first)
    if isinstance(field.type, T.TimestampNTZType):
        return to_day(value, day_first).cast(field.type)
    if isinstance(field.type, T.DecimalType):
        return to_decimal(value, field.type, field.name)
    if isinstance(field.type, T.IntegerType):
        return to_whole_number(value, field.name)
    return fit_length(value, field)


def to_bronze(text: DataFrame, spec: TableSpec, day_first: bool = False) -> DataFrame:
    """Declared columns, in declared order and type. Extra columns go, a missing one is an error."""
    columns = [coerce(F.col(f"`{f.name}`"), f, day_first).alias(f.name) for f in spec.fields]
    return text.select(*columns)


def _check_columns(file: str, text: DataFrame, spec: TableSpec) -> None:
    there = {c.lower() for c in text.columns}
    for field in spec.fields:
        if field.name.lower() not in there:
            raise AnalysisException(f"{file} has no column {field.name}")


def read_bronze_csv(
    spark: SparkSession,
    path: str,
    spec: TableSpec,
    multiline: bool | None = None,
    day_first: bool = False,
    malformed: str = RAISE,
) -> DataFrame:
    """Bronze rows of an extract. A malformed record fails the load, or is left out by ``"skip"``."""
    if malformed not in (RAISE, SKIP):
        raise ValueError(f"malformed must be '{RAISE}' or '{SKIP}', not {malformed!r}")
    parts = []
    for file, text in read_csv_text(spark, path, multiline, lenient=malformed == SKIP):
        _check_columns(file, text, spec)
        reason = F.col(REASON)
        if malformed == RAISE:
            message = F.concat(reason, F.lit(f" in {spec.bronze_name}: "), F.substring(RECORD, 1, 200))
            good = F.when(reason.isNotNull(), F.raise_error(message).cast("boolean")).otherwise(True)
        else:
            good = reason.isNull()
        parts.append(to_bronze(text.filter(good & _field_is_read(text)), spec, day_first))
    return reduce(DataFrame.unionAll, parts)


def malformed_records(
    spark: SparkSession, path: str, spec: TableSpec, multiline: bool | None = None
) -> DataFrame:
    """``(table_name, reason, row_data)`` of the records that cannot be read, as the audit has them."""
    return reduce(
        DataFrame.unionAll,
        [
            text.filter(F.col(REASON).isNotNull() & _field_is_read(text)).select(
                F.lit(spec.silver_name).alias("table_name"),
                F.col(REASON).alias("reason"),
                F.to_json(F.struct(F.col(RECORD).alias("record"))).alias("row_data"),
            )
            for _, text in read_csv_text(spark, path, multiline, lenient=True)
        ],
    )


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Headed CSV that ``read_csv_text`` reads back unchanged (outer blanks are kept)."""
    (
        df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])
        .write.mode(mode)
        .option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
