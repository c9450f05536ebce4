"""Data-quality reports. They count and list; no row is dropped or changed."""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Key values that occur more than once, with their number of rows."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")


def null_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row: the number of rows, and of NULLs per column."""
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count_if(F.col(c).isNull()).alias(f"{c}_nulls") for c in columns],
    )


def empty_keys(df: DataFrame, key: str) -> DataFrame:
    """Number of rows whose key is NULL or the empty string."""
    bad = F.col(key).isNull() | (F.col(key).cast("string") == "")
    return df.agg(F.count_if(bad).alias("empty_keys"))


def orphans(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Foreign-key values without a parent row, with their number of child rows.

    The child is counted per key first, so a key with very many rows is one row
    in the join. NULL is no reference.
    """
    used = (
        child.where(F.col(child_key).isNotNull())
        .groupBy(F.col(child_key).alias("missing_key"))
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    known = parent.select(F.col(parent_key).alias("known_key"))
    return used.join(known, F.col("missing_key") == F.col("known_key"), "left_anti")


def orphan_summary(relation: str, orphan_rows: DataFrame) -> DataFrame:
    """One row per relation: distinct missing keys and child rows pointing at them."""
    return orphan_rows.agg(
        F.lit(relation).alias("relation"),
        F.count(F.lit(1)).alias("missing_keys"),
        F.coalesce(F.sum("rows"), F.lit(0)).alias("orphan_rows"),
    ).select("relation", "missing_keys", "orphan_rows")


def non_positive(df: DataFrame, amount: str) -> DataFrame:
    """Number of rows whose amount is zero or less."""
    return df.agg(F.count_if(F.col(amount) <= 0).alias("non_positive"))


def domain(df: DataFrame, column: str) -> DataFrame:
    """Distinct values of a column and whether each is in upper case."""
    value = F.col(column)
    return df.select(value.alias("value")).distinct().withColumn(
        "is_upper", F.upper("value") == F.col("value")
    )


def distinct_count(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.count_distinct(column).alias("distinct_values"))


def reconcile(
    left: DataFrame, left_amount: Column, right: DataFrame, right_amount: Column, places: int = 2
) -> DataFrame:
    """One row: both sums, rounded to so many places, and whether they agree.

    Each side is reduced to one row; the two rows meet in a union, not a join. A side
    whose amounts were rounded before must add what that took away (a mart's ``residual``),
    or many groups differ from one sum by more than a cent.
    """
    total = f"decimal({26 + places},{places})"

    def side(df: DataFrame, amount: Column, name: str, other: str) -> DataFrame:
        reduced = df.agg(F.coalesce(F.round(F.sum(amount), places).cast(total), F.lit(0)).alias(name))
        return reduced.select(
            F.col(name).cast(total).alias(name), F.lit(0).cast(total).alias(other)
        )

    both = side(left, left_amount, "left_total", "right_total").unionByName(
        side(right, right_amount, "right_total", "left_total")
    )
    return both.agg(
        F.sum("left_total").alias("left_total"), F.sum("right_total").alias("right_total")
    ).withColumn("agrees", F.col("left_total") == F.col("right_total"))


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows per table."""
    counted = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table_name"), "rows")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counted)


def report(
    tables: dict[str, DataFrame],
    required: dict[str, list[str]],
    primary_keys: dict[str, list[str]],
    foreign_keys: tuple[tuple[str, str, str, str], ...],
    amounts: tuple[tuple[str, str], ...] = (),
    codes: tuple[tuple[str, str], ...] = (),
    known: dict[str, int] | None = None,
) -> DataFrame:
    """All checks as rows: audit, table_name, subject, found.

    ``found`` counts violations, for the audit "rows" the rows of the table: NULLs in
    required columns, rows beyond the first of a key, NULL or empty keys, rows whose
    reference has no parent, amounts of zero or less, codes that are not in upper case.
    Each table is scanned once for its column counts and once per key. ``known`` has the rows
    of tables that were counted when they were written, and refused if a required column held
    a NULL: neither is counted again.
    """
    rows = []
    known = known or {}
    listed = []

    def add(df: DataFrame, audit: str, table: str, subject, found: Column) -> None:
        rows.append(df.select(
            F.lit(audit).alias("audit"), F.lit(table).alias("table_name"),
            (F.lit(subject) if isinstance(subject, str) else subject).alias("subject"),
            F.coalesce(found, F.lit(0)).cast("long").alias("found"),
        ))

    for table, df in tables.items():
        counts = {}
        if table in known:
            listed.append(("rows", table, "*", known[table]))
            listed += [("nulls", table, column, 0) for column in required.get(table, ())]
        else:
            counts["rows", "*"] = F.count(F.lit(1))
            for column in required.get(table, ()):
                counts["nulls", column] = F.count_if(F.col(column).isNull())
        for column in primary_keys.get(table, ()):
            empty = F.col(column).isNull() | (F.col(column).cast("string") == "")
            counts["empty_keys", column] = F.count_if(empty)
        for column in (c for t, c in amounts if t == table):
            counts["non_positive", column] = F.count_if(F.col(column) <= 0)
        for column in (c for t, c in codes if t == table):
            counts["not_upper", column] = F.count_if(F.upper(column) != F.col(column))
        if not counts:
            continue
        found = F.array(*[
            F.struct(F.lit(audit).alias("audit"), F.lit(subject).alias("subject"), count.cast("long").alias("found"))
            for (audit, subject), count in counts.items()
        ])
        rows.append(df.agg(found.alias("all")).select(F.inline("all")).select(
            "audit", F.lit(table).alias("table_name"), "subject", "found"
        ))
    for table, keys in primary_keys.items():
        twice = duplicate_keys(tables[table], keys).agg(F.sum(F.col("rows") - 1).alias("found"))
        add(twice, "duplicate_keys", table, ",".join(keys), F.col("found"))
    for child, column, parent, parent_key in foreign_keys:
        missing = orphans(tables[child], column, tables[parent], parent_key)
        add(missing.agg(F.sum("rows").alias("found")), "orphans", child, column, F.col("found"))
    if listed:
        spark = next(iter(tables.values())).sparkSession
        rows.append(spark.createDataFrame(listed, "audit string, table_name string, subject string, found long"))
    return reduce(DataFrame.unionByName, rows)
