"""The forecast table, report tables and the feature cache."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..functions import labels, localtime
from ..functions.ratios import fill_kpis
from ..functions.text import add, pick
from ..names import ENTITY, KPIS, SHORT
from ..schema import FORECAST, FORECAST_RANGES, RANGE_NAMES
from . import snapshots

_LEGACY = ["results", "payload"]
_LONG = {short: long for long, short in SHORT.items()}
_HOURS = {"24h": 24, "6h": 6}


def align_to_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of ``schema`` in its order and types: missing ones are added as
    null, JSON payload columns of old tables and all others are dropped."""
    df = df.drop(*[name for name in _LEGACY if name not in schema.names])
    present = set(df.columns)
    return df.select(
        *[
            (F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema
        ]
    )


def _first(df: DataFrame, names: list[str], kind: str) -> str:
    """Text of the first non-null value among the columns ``df`` has."""
    present = [name for name in names if name in df.columns]
    value = f"coalesce({', '.join(present)})" if present else "NULL"
    return f"CAST({value} AS {kind})"


def _values(df: DataFrame, horizon: str, families: list[str], prefix: str) -> DataFrame:
    """``<prefix>_*`` for all metrics and KPIs from the first family that has a
    value; missing KPIs are derived from the metrics."""
    given = {
        f"_{name}": _first(
            df, [f"{family}_{horizon}_{_LONG.get(name, name)}" for family in families], "double"
        )
        for name in [*SHORT.values(), *KPIS]
    }
    filled = fill_kpis({name[1:]: name for name in given})
    out = {f"{prefix}_{name}": f"_{name}" for name in SHORT.values()}
    out |= {f"{prefix}_{name}": filled[name] for name in KPIS}
    return add(add(df, given), out).drop(*given)


def served_values(df: DataFrame, horizon: str) -> DataFrame:
    """``result_*``: what was recommended, else the prediction."""
    return _values(df, horizon, ["recommended", "pred"], "result")


def raw_values(df: DataFrame, horizon: str) -> DataFrame:
    """``raw_pred_*``: the predictions as the model made them."""
    return _values(df, horizon, ["pred"], "raw_pred")


def range_structs(df: DataFrame, horizon: str) -> dict[str, str]:
    """p10, p50 and p90 per metric, for the metrics that have a range. ROAS ranges
    are read under the name the scorer gives them or under the raw one."""
    out, present = {}, set(df.columns)
    for name in RANGE_NAMES:
        long = _LONG.get(name, name)
        prefixes = [f"pred_{horizon}_{long}"]
        if name == "roas":
            prefixes.insert(0, f"recommended_{horizon}_{long}")
        ends = {e: [f"{p}_{e}" for p in prefixes] for e in ("p10", "p50", "p90")}
        if any(c in present for columns in ends.values() for c in columns):
            fields = [f"{_first(df, columns, 'double')} AS {e}" for e, columns in ends.items()]
            out[f"{name}_range"] = f"struct({', '.join(fields)})"
    return out


def forecast_rows(
    scored: DataFrame, horizon: str, created_at: Column | None = None, ranges: bool = True
) -> DataFrame:
    """Rows of the forecast table from scored rows.

    The scorers work in account-local wall clocks. They are kept in the ``_local``
    columns; ``forecast_anchor`` and the window are the true UTC instants. A
    window given as first and last hour label is stored half-open, so it always
    spans the whole horizon."""
    text = {
        name: f"coalesce({_first(scored, [name], 'string')}, '')"
        for name in [
            "timezone",
            *ENTITY,
            "forecast_confidence",
            "benchmark_source",
            "model_source",
        ]
    }
    anchors = ["forecast_anchor_local_date", "anchor_ts", "local_date"]
    anchor = _first(scored, anchors, "timestamp_ntz")
    start = f"coalesce({_first(scored, ['forecast_window_start'], 'timestamp_ntz')}, {anchor})"
    score = _first(scored, ["forecast_confidence_score", "confidence_score"], "string")
    status = _first(scored, ["forecast_status"], "string")
    columns = {f"_{name}": sql for name, sql in text.items()} | {
        "forecast_anchor_local": anchor,
        "forecast_window_start_local": start,
        "forecast_window_end_local": f"timestampadd(HOUR, {_HOURS[horizon]}, {start})",
        "_score": score,
        "_status": status,
        "_active": _first(scored, ["recently_active"], "boolean"),
    }
    if ranges:
        for name, struct in range_structs(scored, horizon).items():
            for end in ("p10", "p90"):
                columns[f"result_{name.removesuffix('_range')}_{end}"] = f"{struct}.{end}"
    out = raw_values(served_values(scored, horizon), horizon)
    results = [c for c in out.columns if c.startswith(("result_", "raw_pred_"))]
    out = pick(out, results, columns)
    out = add(
        out.withColumn("_zone", localtime.zone_or_utc("_timezone")),
        {name: f"_{name}" for name in text}
        | {
            "forecast_horizon": f"'{horizon}'",
            "forecast_local_date": "to_date(forecast_window_start_local)",
            "forecast_confidence_score": labels.confidence_score(
                "_score", "_forecast_confidence"
            ),
            "forecast_status": labels.sink_status(
                "_status", "_benchmark_source", "_forecast_confidence"
            ),
            "recently_active": "_active",
        },
    )
    instants = {
        name: localtime.to_instant(F.col(f"{name}_local"), F.col("_zone"))
        for name in ("forecast_anchor", "forecast_window_start", "forecast_window_end")
    }
    written = F.current_timestamp() if created_at is None else created_at
    schema = T.StructType([*FORECAST, *FORECAST_RANGES]) if ranges else FORECAST
    return align_to_schema(out.withColumns(instants | {"created_at": written}), schema)


def run_name(*scope) -> str:
    """A short name for everything that decides what a run returns."""
    return hashlib.sha256(repr(scope).encode()).hexdigest()[:16]


def write_forecasts(rows: DataFrame, path: str, run: str | None = None) -> None:
    """Write to the forecast table, partitioned by horizon and local day, as one commit
    (see :mod:`kpicast.sources.snapshots`).

    Rows of a named run replace all that the run wrote before, so a rerun doubles nothing;
    rows without a name are added. Other jobs may write the same days meanwhile. ``rows``
    should be a written table: it is counted first."""
    made = snapshots.write_attempt(rows, path)
    snapshots.commit(rows.sparkSession, path, run or made["attempt"], made)


def _stored(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.option("mergeSchema", True).parquet(path)
    except Exception as missing:  # noqa: BLE001
        if "PATH_NOT_FOUND" not in str(missing):
            raise
        return None


def write_forecasts_jdbc(
    rows: DataFrame, url: str, table: str, batch: int = 1000, writers: int = 8, **options: str
) -> None:
    """Append to a database table in batches, over a bounded number of
    connections."""
    (
        rows.repartition(writers)
        .write.format("jdbc")
        .mode("append")
        .option("url", url)
        .option("dbtable", table)
        .option("batchsize", batch)
        .options(**options)
        .save()
    )


def read_forecasts(
    spark: SparkSession, path: str, horizon: str | None = None, first=None, last=None
) -> DataFrame:
    """Forecast table with all columns, also those that old files lack; of one horizon
    and of the local days first..last, if given. Files of tables from before there were
    manifests, which lie in day folders at the top, are read as well."""
    schema = T.StructType([*FORECAST, *FORECAST_RANGES])
    tables = snapshots.read(spark, path, horizon, first, last)
    if snapshots.has_top_folders(spark, path):
        old = spark.read.option("basePath", path).option("mergeSchema", True).parquet(f"{path}/forecast_horizon=*")
        day = F.col("forecast_local_date").cast("date")
        for wanted in (
            horizon is None or F.col("forecast_horizon") == horizon,
            first is None or day >= F.lit(first).cast("date"),
            last is None or day <= F.lit(last).cast("date"),
        ):
            old = old if wanted is True else old.filter(wanted)
        tables.append(old)
    out = spark.createDataFrame([], schema)
    for table in tables:
        out = out.unionByName(align_to_schema(table, schema))
    return out


def screening(forecasts: DataFrame, limit: int = 100) -> DataFrame:
    """The newest forecast rows."""
    return forecasts.orderBy(
        F.col("created_at").desc(), "forecast_horizon", "account_id", "ad_id"
    ).limit(limit)


def write_report(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    """Whole report, or one more part with ``mode='append'``."""
    writer = df.write.mode(mode)
    if fmt == "csv":
        writer.option("header", True).csv(path)
    else:
        writer.format(fmt).save(path)


def feature_cache_path(root: str, horizon: str, anchor: str, scope: str = "all") -> str:
    """Folder of the features of one horizon, anchor and scope (see :func:`run_name`)."""
    return f"{root}/features/horizon={horizon}/scope={scope}/anchor={anchor}"


def cached_features(
    spark: SparkSession, build, path: str, reuse: bool = True
) -> DataFrame:
    """Features from the cache, or built and written to it first. ``build`` is
    called only when they have to be made."""
    if reuse and (found := _stored(spark, path)) is not None:
        return found
    build().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def payload_json(df: DataFrame, columns: list[str]) -> Column:
    """One JSON text of the given columns (legacy payload, feature payload)."""
    return F.to_json(F.struct(*[F.col(c) for c in columns]))


def read_payload(payload: Column, schema: T.StructType) -> Column:
    return F.from_json(payload, schema)


