"""Database tables through Spark's JDBC source."""

import datetime
import decimal
import functools
import math

from pyspark.sql import functions as F


def read_jdbc_query(spark, url, sql, **options):
    """The result of a bare SELECT that the database evaluates.

    One task reads it; use ``read_jdbc_table`` with ranges for anything large.
    """
    return spark.read.format("jdbc").options(url=url, query=sql, **options).load()


def read_table_query(table, sql):
    """The same for a table in files: ``sql`` names it ``{samples}``; Catalyst prunes the scan."""
    return table.spark.sql(sql, samples=table.read())


def read_jdbc_table(spark, url, table, predicates=None, **options):
    """A whole table; with ``predicates`` one task per condition (they must not overlap).

    Filters and column choices made later are pushed into the database.
    """
    if predicates:
        return spark.read.jdbc(url, table, predicates=list(predicates), properties=options)
    return spark.read.format("jdbc").options(url=url, dbtable=table, **options).load()


def day_predicates(column, start, days):
    """One condition per day of ``column`` from the date ``start`` on, with both open ends and NULL."""
    marks = [(start + datetime.timedelta(days=i)).isoformat() for i in range(days + 1)]
    inner = [f"{column} >= '{a}' AND {column} < '{b}'" for a, b in zip(marks, marks[1:])]
    return [f"{column} < '{marks[0]}' OR {column} IS NULL", *inner, f"{column} >= '{marks[-1]}'"]


def _literal(value):
    """A number, date or time as SQL that databases and Spark read alike."""
    if isinstance(value, datetime.datetime):
        return f"TIMESTAMP '{value.isoformat(' ')}'"
    if isinstance(value, datetime.date):
        return f"DATE '{value.isoformat()}'"
    if isinstance(value, (int, float, decimal.Decimal)) and not isinstance(value, bool):
        return repr(value) if not isinstance(value, decimal.Decimal) else str(value)
    raise TypeError(f"ranges are cut at numbers, dates and times, not at {value!r}")


def range_predicates(column, marks):
    """One condition per range of a numeric or time column between ``marks``; every row meets exactly one.

    The first range is open below and has the NULLs, the last one is open above and has NaN, which sorts above all numbers.
    Marks may come in any order and more than once; NULL, NaN and infinite ones cut nothing.
    """
    kept = {m for m in marks if m is not None and not (isinstance(m, float | decimal.Decimal) and not math.isfinite(m))}
    if not kept:
        return [f"{column} IS NOT NULL OR {column} IS NULL"]
    cuts = [_literal(mark) for mark in sorted(kept)]
    inner = [f"{column} >= {a} AND {column} < {b}" for a, b in zip(cuts, cuts[1:])]
    return [f"{column} < {cuts[0]} OR {column} IS NULL", *inner, f"{column} >= {cuts[-1]}"]


def quantile_sql(table, column, parts, percent=None):
    """A SELECT of the values that cut ``column`` into ``parts`` ranges of equal size, as the one array ``marks``.

    ``percent`` lets the database look at that share of the table's pages: where ranges are cut changes their size
    alone, never which rows are read.
    """
    shares = ", ".join(repr(i / parts) for i in range(1, parts))
    sample = f" TABLESAMPLE SYSTEM ({percent})" if percent else ""
    return f"SELECT percentile_disc(ARRAY[{shares}]) WITHIN GROUP (ORDER BY {column}) AS marks FROM {table}{sample}"


def quantile_marks(df, column, parts):
    """The same values for a frame, about: one pass that combines sketches of a fixed size."""
    shares = F.array(*[F.lit(i / parts) for i in range(1, parts)])
    return df.agg(F.percentile_approx(column, shares, F.lit(100 * parts)).alias("marks")).first()["marks"] or []


def read_jdbc_ranges(spark, url, table, column, parts, percent=None, **options):
    """A whole table, read by up to ``parts`` tasks, each a range of ``column`` of about equal size.

    Values that many rows share are never cut apart, so there may be fewer and larger ranges.
    """
    marks = []
    if parts > 1:
        marks = read_jdbc_query(spark, url, quantile_sql(table, column, parts, percent), **options).first()["marks"]
    return read_jdbc_table(spark, url, table, range_predicates(column, marks or []), **options)


def read_table_ranges(table, column, parts):
    """The same for a table in files: one scan per range, pruned by the files' statistics, numbered ``range``."""
    df = table.read()
    marks = quantile_marks(df, column, parts) if parts > 1 else []
    found = [df.where(condition).withColumn("range", F.lit(i)) for i, condition in enumerate(range_predicates(f"`{column}`", marks))]
    return functools.reduce(lambda a, b: a.unionAll(b), found)


def recent_in_db(df, cutoff, split=None, column="send_timestamp"):
    """Recency (and split) filter on a JDBC frame; Spark hands both to the database."""
    df = df.filter(F.col(column) >= cutoff)
    return df if split is None else df.filter(F.col("usage") == split)
