"""A partitioned table of runs, each committed as a whole.

A run writes its files into a folder of its own (an attempt) and then moves one small
manifest into place: run, attempt, schema, and the rows of every horizon and day. Readers
follow the newest manifest of every run and read the named folders with the schema stored
there, so

* a job that is killed before the move leaves the table as it was;
* jobs of different runs may write one day at a time, as they share no file;
* of two jobs of one run the one with the later manifest counts, as a whole;
* a rerun takes the place of all its earlier rows, also on days it no longer has;
* no file's footer is read to learn the columns, however long the history is.

Attempts that no manifest names any more stay until :func:`vacuum`.
"""

from __future__ import annotations

import datetime as dt
import json
import time
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

PARTS = ["forecast_horizon", "forecast_local_date"]
ROWS_PER_FILE = 1_000_000
_NO_VALUE = "__HIVE_DEFAULT_PARTITION__"
_MANIFEST = (
    "run string, number long, attempt string, schema string, "
    "parts array<struct<horizon: string, day: string, rows: bigint>>"
)


def _files(spark: SparkSession, path: str):
    """Hadoop's view of ``path``: its file system, and a maker of paths below it."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    system = hadoop.Path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return system, lambda name: hadoop.Path(f"{path}/{name}")


def has_top_folders(spark: SparkSession, path: str) -> bool:
    """Whether a table without manifests lies at ``path``."""
    system, below = _files(spark, path)
    found = system.globStatus(below(f"{PARTS[0]}=*"))
    return found is not None and len(found) > 0


def manifests(spark: SparkSession, path: str) -> list:
    """The newest manifest of every run; their number is that of the runs."""
    system, below = _files(spark, path)
    if not system.exists(below("manifests")):
        return []
    rows = spark.read.schema(_MANIFEST).json(f"{path}/manifests")
    newest = F.max(F.struct("number", "attempt", "schema", "parts")).alias("m")
    return rows.groupBy("run").agg(newest).select("run", "m.*").collect()


def write_attempt(rows: DataFrame, path: str) -> dict:
    """Writes the rows and returns what a manifest says of them; nothing reads them yet.

    Files hold ranges of (horizon, day, ad) and are sorted by ad and window, so their
    statistics tell which ads they have. ``rows`` should be a written table: it is
    counted first."""
    attempt = f"{time.time_ns()}-{uuid.uuid4().hex}"
    parts = rows.groupBy(*PARTS).count().collect()
    files = sum(-(-p["count"] // ROWS_PER_FILE) for p in parts)
    (
        rows.repartitionByRange(max(files, 1), *PARTS, "ad_id")
        .sortWithinPartitions(*PARTS, "ad_id", "forecast_window_start")
        .write.partitionBy(*PARTS)
        .parquet(f"{path}/data/attempt={attempt}")
    )
    return {
        "attempt": attempt,
        "schema": rows.schema.json(),
        "parts": [
            {"horizon": p[PARTS[0]], "day": p[PARTS[1]] and str(p[PARTS[1]]), "rows": p["count"]} for p in parts
        ],
    }


def commit(spark: SparkSession, path: str, run: str, made: dict) -> None:
    """Moves the manifest of an attempt into place: from then on readers see it."""
    system, below = _files(spark, path)
    number = 1 + max((m["number"] for m in manifests(spark, path) if m["run"] == run), default=0)
    text = json.dumps({"run": run, "number": number, **made})
    name = f"{run}.{number}.{made['attempt']}.json"
    hidden = below(f"manifests/.{name}")
    stream = system.create(hidden, False)
    stream.write(bytearray(text.encode()))
    stream.close()
    if not system.rename(hidden, below(f"manifests/{name}")):
        raise OSError(f"manifest {name} could not be moved into place")


def read(
    spark: SparkSession, path: str, horizon: str | None = None, first=None, last=None
) -> list[DataFrame]:
    """Rows of all runs, of one horizon and of the days first..last if given: one
    DataFrame per schema that the runs were written with. Folders of other days are not
    even listed."""
    folders: dict[str, list[str]] = {}
    for m in manifests(spark, path):
        for p in m["parts"]:
            day = p["day"] or ""
            if horizon not in (None, p["horizon"]) or (first and day < str(first)) or (last and day > str(last)):
                continue
            place = "/".join(f"{k}={v or _NO_VALUE}" for k, v in zip(PARTS, (p["horizon"], p["day"])))
            folders.setdefault(m["schema"], []).append(f"{path}/data/attempt={m['attempt']}/{place}")
    return [
        spark.read.schema(T.StructType.fromJson(json.loads(schema))).option("basePath", f"{path}/data").parquet(*names)
        for schema, names in folders.items()
    ]


def vacuum(spark: SparkSession, path: str, older_than: dt.timedelta) -> list[str]:
    """Deletes attempts that no reader follows: replaced by a rerun, or left by a killed
    job. ``older_than`` has to be longer than any job or reader takes. Returns their
    names."""
    system, below = _files(spark, path)
    if not system.exists(below("data")):
        return []
    known = manifests(spark, path)
    live, limit = {m["attempt"] for m in known}, time.time_ns() - int(older_than.total_seconds() * 1e9)
    gone = []
    for status in system.listStatus(below("data")):
        attempt = status.getPath().getName().removeprefix("attempt=")
        if attempt not in live and int(attempt.split("-")[0]) < limit:
            gone.append(attempt)
    # Manifests first, so that none ever names a folder that is not there.
    if system.exists(below("manifests")):
        for status in system.listStatus(below("manifests")):
            if any(attempt in status.getPath().getName() for attempt in gone):
                system.delete(status.getPath(), False)
    for attempt in gone:
        system.delete(below(f"data/attempt={attempt}"), True)
    return gone
