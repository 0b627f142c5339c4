"""Cleaning: normalise, apply ordered rules per key, audit what is rejected, keep one row per key.

Meaning of the rules:

* They see normalised, distinct rows, before duplicates of a key are removed.
* A row failing a rule rejects every row of its key. A key is rejected for the first rule, in order,
  that any of its rows fails.
* A NULL key equals no key. With ``null_key="keep"`` such rows pass all rules and stay, each once;
  with ``null_key="reject"`` each is rejected by itself.
* Of the rows left for a key, the smallest by the other columns (NULL last) is kept.

Nothing here puts the rows of one key into one task: keys are reduced by aggregates that combine
before the shuffle, and whole rows are shuffled by all their columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tiffin.schemas import TableSpec

KEEP, REJECT = "keep", "reject"
DUPLICATE_KEY = "Duplicate PK"

# Keys are counted in buckets of their hashes. One with more rows than a task should sort may hold a hot key.
KEY_BUCKETS = 1 << 16
HOT_ROWS = 500_000


def normalise(bronze: DataFrame, spec: TableSpec) -> DataFrame:
    """Silver columns from bronze columns, row by row."""
    return bronze.select(*[p.column() for p in spec.projections])


def first_failed_rule(spec: TableSpec) -> Column:
    """Position of the first rule a row fails; NULL for a good row."""
    return F.coalesce(
        F.lit(None).cast("int"),
        *[F.when(F.expr(rule.condition), F.lit(i)) for i, rule in enumerate(spec.rules)],
    )


def _reason(rule: Column, spec: TableSpec) -> Column:
    return F.element_at(F.array(*[F.lit(r.reason) for r in spec.rules]), rule + 1)


def _row_json() -> Column:
    return F.to_json(F.struct("*"), {"ignoreNullFields": "false"})


def _nulls_last(columns: list[str]) -> Column:
    """A struct that sorts by ``columns`` ascending with NULL last."""
    parts = []
    for i, name in enumerate(columns):
        parts.append(F.col(name).isNull().alias(f"absent_{i}"))
        parts.append(F.col(name).alias(name))
    return F.struct(*parts)


def _check_null_key(null_key: str) -> None:
    if null_key not in (KEEP, REJECT):
        raise ValueError(f"null_key must be '{KEEP}' or '{REJECT}', not {null_key!r}")


def _key_bucket(key: str) -> Column:
    return F.pmod(F.xxhash64(F.col(key)), F.lit(KEY_BUCKETS)).cast("int")


def hot_buckets(rows: DataFrame, key: str, hot_rows: int = HOT_ROWS) -> list[int]:
    """The buckets of keys that have more than ``hot_rows`` rows, found by one scan of the key.

    There is at most one such bucket for every ``hot_rows`` rows, and none without a hot key up to some 30 billion rows.
    """
    per_bucket = rows.filter(F.col(key).isNotNull()).groupBy(_key_bucket(key).alias("bucket"))
    found = per_bucket.agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > hot_rows)
    return sorted(row["bucket"] for row in found.select("bucket").collect())


def in_buckets(key: str, buckets: list[int]) -> Column:
    return _key_bucket(key).isin(buckets) if buckets else F.lit(False)


def one_row_per_key(
    rows: DataFrame, key: str, failed_rule: Column | None = None, hot: list[int] | None = None
) -> DataFrame:
    """The smallest row of every key, leaving out keys with a failed rule.

    One aggregate does distinct, rejection and dedup in a single shuffle. Rows without a key are
    grouped by their whole content instead, which makes them distinct and spreads them evenly.

    Rows are combined before the shuffle, for which tasks sort all that they read. ``hot``, the result of
    ``hot_buckets``, spares that for the keys of all other buckets: they are sorted after the shuffle only.
    """
    if failed_rule is None:
        failed_rule = F.lit(None).cast("int")
    if hot is None:
        return _smallest(rows, key, failed_rule)
    is_hot = in_buckets(key, hot)
    known = F.col(key).isNotNull()
    once_sorted = _smallest(rows.filter(known & ~is_hot).repartition(key), key, failed_rule, keyless=False)
    return once_sorted.unionAll(_smallest(rows.filter(~known | is_hot), key, failed_rule))


def _smallest(rows: DataFrame, key: str, failed_rule: Column, keyless: bool = True) -> DataFrame:
    rest = [c for c in rows.columns if c != key]
    by = [F.col(key)]
    if keyless:
        by.append(F.when(F.col(key).isNull(), F.struct(*rest)).alias("_keyless_row"))
    smallest = rows.groupBy(*by).agg(
        F.min(failed_rule).alias("_failed_rule"),
        F.min(_nulls_last(rest)).alias("_row"),
    )
    return smallest.filter(F.col("_failed_rule").isNull()).select(
        *[F.col(c) if c == key else F.col(f"_row.{c}").alias(c) for c in rows.columns]
    )


def clean(
    bronze: DataFrame, spec: TableSpec, null_key: str = KEEP, hot: list[int] | None = None
) -> DataFrame:
    """The silver table of a bronze table. ``hot`` is as in ``one_row_per_key``."""
    _check_null_key(null_key)
    failed = first_failed_rule(spec)
    if null_key == KEEP:
        failed = F.when(F.col(spec.key).isNotNull(), failed)
    return one_row_per_key(normalise(bronze, spec), spec.key, failed, hot)


def rejected_keys(rows: DataFrame, spec: TableSpec) -> DataFrame:
    """``(key, _rejection)`` per rejected key: the deciding rule and its smallest bad row as JSON."""
    failed = first_failed_rule(spec)
    return (
        rows.filter(F.col(spec.key).isNotNull() & failed.isNotNull())
        .groupBy(spec.key)
        .agg(F.min(F.struct(failed.alias("rule"), _row_json().alias("row_data"))).alias("_rejection"))
    )


def _rows_of_keys(rows: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Distinct ``rows`` of ``keys``, with the other columns of ``keys``.

    The shuffle by all columns between join and distinct lets Spark split a hot key in the join.
    """
    joined = rows.join(keys, key)
    return joined.repartition(*joined.columns).distinct()


def rejections(
    bronze: DataFrame, spec: TableSpec, null_key: str = KEEP, bad_keys: DataFrame | None = None
) -> DataFrame:
    """``(table_name, reason, row_data)``, one row for every distinct row that ``clean`` rejects.

    Bad keys are few, so they are found first, from a filtered scan. Rows meet them by key and rule alone;
    what is left after that, the distinct rows of bad keys, takes in the JSON. ``bad_keys`` is the
    result of ``rejected_keys`` as a stored table: Spark then knows its size, and broadcasts it or not
    by that.
    """
    _check_null_key(null_key)
    rows = normalise(bronze, spec)
    bad = rejected_keys(rows, spec) if bad_keys is None else bad_keys
    rules = bad.select(spec.key, F.col("_rejection.rule").alias("_rule"))
    rejected = _rows_of_keys(rows.filter(F.col(spec.key).isNotNull()), rules, spec.key)
    json = bad.select(spec.key, F.col("_rejection.row_data").alias("row_data"))
    out = (
        rejected.select(spec.key, F.col("_rule").alias("rule"))
        .join(json, spec.key)
        .select("rule", "row_data")
    )
    if null_key == REJECT:
        keyless = rows.filter(F.col(spec.key).isNull()).distinct()
        out = out.union(keyless.select(first_failed_rule(spec), _row_json()))
    return out.select(
        F.lit(spec.silver_name).alias("table_name"),
        _reason(F.col("rule"), spec).alias("reason"),
        "row_data",
    )


def duplicate_keys(rows: DataFrame, key: str) -> DataFrame:
    """``(key, copies)`` for every non-NULL key that more than one row has."""
    return (
        rows.filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.count(F.lit(1)).alias("copies"))
        .filter("copies > 1")
    )


def _row_hashes(columns: list[str]) -> tuple[Column, Column]:
    """Two hashes of a row, 96 bits. Hashes pass over NULL, so they also get which columns are NULL."""
    content = [*columns, *[F.col(c).isNull() for c in columns]]
    return F.xxhash64(*content), F.hash(*content)


def repeated_keys(rows: DataFrame, spec: TableSpec) -> DataFrame:
    """The good keys that more than one distinct row has.

    The state of a key is a few numbers: the first rule that fails, and the least and largest of two hashes of its rows.
    So this is a hash aggregate, and no row is sorted for it. Rows that differ are told apart by 96 bits.
    """
    wide, narrow = _row_hashes(rows.columns)
    per_key = (
        rows.filter(F.col(spec.key).isNotNull())
        .groupBy(spec.key)
        .agg(
            F.min(first_failed_rule(spec)).alias("_rule"),
            (F.min(wide) != F.max(wide)).alias("_wide"),
            (F.min(narrow) != F.max(narrow)).alias("_narrow"),
        )
    )
    return per_key.filter("_rule IS NULL AND (_wide OR _narrow)").select(spec.key)


def repeated_rows(bronze: DataFrame, spec: TableSpec, repeated: DataFrame | None = None) -> DataFrame:
    """The distinct rows of the keys of ``repeated``, which is the result of ``repeated_keys`` as a stored table."""
    rows = normalise(bronze, spec)
    keys = repeated_keys(rows, spec) if repeated is None else repeated
    return _rows_of_keys(rows, keys, spec.key).select(*rows.columns)


def duplicate_rejections(
    bronze: DataFrame, spec: TableSpec, several: DataFrame | None = None
) -> DataFrame:
    """``(table_name, reason, row_data)`` for the rows that lose against the kept row of their key.

    ``several`` is the result of ``repeated_rows`` as a stored table: only these rows are ordered. Losers are
    those less the kept ones, told by key and hashes, so the rows of a much repeated key stay spread out.
    """
    rows = repeated_rows(bronze, spec) if several is None else several
    kept = one_row_per_key(rows, spec.key)
    place = [spec.key, "_wide", "_narrow"]
    hashed, kept_places = (
        df.select("*", *[h.alias(n) for h, n in zip(_row_hashes(rows.columns), place[1:], strict=True)])
        for df in (rows, kept)
    )
    losers = hashed.join(kept_places.select(*place), place, "left_anti").select(*rows.columns)
    return _as_duplicates(losers, spec)


def losers_per_key(bronze: DataFrame, spec: TableSpec, hot: list[int]) -> DataFrame:
    """What ``duplicate_rejections`` gives, for the keys that are not in the buckets ``hot``.

    One scan, one shuffle, one sort: tasks rank the rows of their keys, and make the losers distinct. For that, all
    rows of a key meet in one task, so those of hot keys must go the other way.
    """
    rows = normalise(bronze, spec)
    own = rows.filter(F.col(spec.key).isNotNull() & ~in_buckets(spec.key, hot))
    of_key = Window.partitionBy(spec.key)
    in_order = of_key.orderBy(*[F.col(c).asc_nulls_last() for c in rows.columns if c != spec.key])
    ranked = own.repartition(spec.key).withColumn("_rank", F.rank().over(in_order))
    judged = ranked.withColumn("_rule", F.min(first_failed_rule(spec)).over(of_key))
    losers = judged.filter("_rule IS NULL AND _rank > 1").select(*rows.columns).distinct()
    return _as_duplicates(losers, spec)


def _as_duplicates(losers: DataFrame, spec: TableSpec) -> DataFrame:
    return losers.select(
        F.lit(spec.silver_name).alias("table_name"),
        F.lit(DUPLICATE_KEY).alias("reason"),
        _row_json().alias("row_data"),
    )


def audit_rows(rejected: DataFrame, rejected_at: Column | None = None) -> DataFrame:
    """Audit records: the rejected rows with one time for the whole load."""
    at = F.current_timestamp() if rejected_at is None else rejected_at
    return rejected.withColumn("rejected_at", at.cast("timestamp_ntz"))
