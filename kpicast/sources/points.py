"""Range reads of measurement points and paged reads of documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .. import session


def range_scan(
    points: DataFrame,
    measurement: str,
    start: Column,
    stop: Column | None = None,
    tags: dict[str, str] | None = None,
    fields: dict[str, float] | None = None,
    time: str = "ts",
) -> DataFrame:
    """Points of one measurement in ``[start, stop)`` whose tags and fields equal
    the given values. Tags and fields are columns, or entries of the ``tags`` and
    ``fields`` maps when the table has those."""
    stop = F.current_timestamp() if stop is None else stop
    keep = (F.col("measurement") == measurement) & (F.col(time) >= start) & (F.col(time) < stop)
    for group, wanted in (("tags", tags), ("fields", fields)):
        for name, value in (wanted or {}).items():
            column = F.col(name) if name in points.columns else F.col(group)[name]
            keep = keep & (column == F.lit(value))
    return points.filter(keep)


def list_measurements(points: DataFrame) -> DataFrame:
    return (
        points.select("measurement").filter(F.coalesce(F.col("measurement"), F.lit("")) != "").distinct()
    )


def _matching(rows: DataFrame, query: dict | None) -> DataFrame:
    for name, value in (query or {}).items():
        rows = rows.filter(F.col(name).isNull() if value is None else F.col(name) == F.lit(value))
    return rows


def _project(rows: DataFrame, projection: dict[str, int] | None) -> DataFrame:
    """1 keeps the named columns, 0 leaves them out."""
    if not projection:
        return rows
    kept = [name for name, on in projection.items() if on]
    if kept:
        return rows.select(*kept)
    return rows.drop(*projection)


def find_all(
    rows: DataFrame,
    query: dict | None = None,
    sort: list[tuple[str, int]] | None = None,
    limit: int | None = None,
    skip: int | None = None,
    projection: dict[str, int] | None = None,
) -> DataFrame:
    """Rows equal to ``query``, sorted by (column, 1 or -1), one page of them."""
    if sort is not None:
        for item in sort:
            if not (isinstance(item, tuple) and len(item) == 2 and isinstance(item[0], str)):
                raise ValueError("sort items are (column, direction)")
            if item[1] not in (1, -1):
                raise ValueError("a sort direction is 1 or -1")
    out = _matching(rows, query)
    if sort:
        out = out.orderBy(*[F.col(n).asc() if d == 1 else F.col(n).desc() for n, d in sort])
    if limit and limit > 0:
        # A page is found by a top-k of its end.
        out = out.offset(skip) if skip and skip > 0 else out
        return _project(out.limit(limit), projection)
    return _project(after(out, skip) if skip and skip > 0 else out, projection)


def after(rows: DataFrame, skip: int) -> DataFrame:
    """``rows`` in their order without the first ``skip``, however many are left.

    A sort deals the rows to tasks by ranges, so the order is that of the tasks and of
    the rows inside: the rows of every task are counted, and a task keeps those that
    come after its share of ``skip``. Nothing is gathered but one count a task."""
    place = F.monotonically_increasing_id()
    numbered = session.written(rows.select("*", F.spark_partition_id().alias("_task"), place.alias("_place")), "page")
    sizes = sorted(numbered.groupBy("_task").count().collect())
    left, first = skip, []
    for task, size in sizes:
        if size > left:
            first.append((task, left))
        left = max(left - size, 0)
    if not first:
        return numbered.limit(0).drop("_task", "_place")
    # All tasks after the first that keeps rows keep all of theirs.
    task, own = first[0]
    in_task = F.col("_place").bitwiseAND((1 << 33) - 1)
    kept = (F.col("_task") > task) | ((F.col("_task") == task) & (in_task >= own))
    return numbered.filter(kept).orderBy("_place").drop("_task", "_place")


def find_one(rows: DataFrame, query: dict, projection: dict[str, int] | None = None) -> DataFrame:
    return _project(_matching(rows, query).limit(1), projection)


def count_matching(rows: DataFrame, query: dict | None = None) -> DataFrame:
    return _matching(rows, query).agg(F.count(F.lit(1)).alias("count"))
