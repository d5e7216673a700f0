"""Publish tables without a gap for readers, and read the newest complete one.

Each load goes to a new ``run=<id>`` folder under the table path.  Spark's
commit protocol writes ``_SUCCESS`` only after every task has committed, so a
reader that takes the newest run holding ``_SUCCESS`` never sees a half
written table, and a failed load leaves the previous run in place.  Older
complete runs are removed only after the new one is complete; runs without
``_SUCCESS`` are never read and never removed automatically, because one of
them may be a load that is still being written.

``publish_changed`` keeps tables whose files are laid out by code: a run then
holds the files of the changed codes only, and a version table beside it
(``_versions/<run>``, complete before the run is) names the files of older runs
that are carried over.  Reading a version reads both; pruning deletes a file
once no kept version names it.
"""

from __future__ import annotations

import datetime as dt
import json
import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RUN_PREFIX = "run="


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def complete_runs(spark: SparkSession, path: str) -> list[str]:
    """Run folder names under ``path`` that hold ``_SUCCESS``, oldest first."""
    jvm, fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    names = []
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        if st.isDirectory() and name.startswith(RUN_PREFIX):
            if fs.exists(jvm.org.apache.hadoop.fs.Path(st.getPath(), "_SUCCESS")):
                names.append(name)
    return sorted(names)


def new_run_id(runs: list[str] = ()) -> str:
    """Sortable by time, later than every given run (a host whose clock is behind
    cannot publish backwards), unique across concurrent writers."""
    last = max((int(r[len(RUN_PREFIX):].split("-")[0]) for r in runs), default=0)
    return f"{max(time.time_ns(), last + 1):020d}-{uuid.uuid4().hex[:8]}"


def complete(spark: SparkSession, path: str) -> bool:
    """Whether Spark finished writing ``path``."""
    jvm, fs, p = _fs(spark, path)
    return fs.exists(jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))


def publish(df: DataFrame, path: str, partition_by: list[str] | None = None,
            single_file: bool = False, keep: int = 2, sort_within: list[str] | None = None,
            before_success: Callable[[str], None] | None = None, dates: str | None = None) -> str:
    """Write ``df`` as a new complete run of the table at ``path``; return the run folder.

    ``partition_by`` writes one folder per value, after a rebalance on those
    columns: without it every task would write a file into every folder it
    touches.  ``single_file`` gives one output file (one task writes
    everything: only for small tables).  ``sort_within`` orders rows inside each file so Parquet
    row-group statistics can skip data on those columns.  ``keep`` complete
    runs stay; older ones are deleted after the new run is complete.  ``before_success``
    gets the run's name before its rows are written (a manifest without a
    complete run is never looked at).  ``dates`` names a date column whose
    smallest and two largest dates are observed while the rows are written and
    recorded beside the run (``run_dates``); the distinct days are all that is held for it.
    """
    spark = df.sparkSession
    name = f"{RUN_PREFIX}{new_run_id(complete_runs(spark, path))}"
    target = f"{path.rstrip('/')}/{name}"
    if before_success:
        before_success(name)
    seen = Observation()
    if dates:
        days = F.sort_array(F.collect_set(F.col(dates).cast("date")), asc=False)
        df = df.observe(seen, F.min(F.col(dates).cast("date")).alias("first"), F.slice(days, 1, 2).alias("newest"))
    out = df.coalesce(1) if single_file else df
    if partition_by and not single_file:
        # cluster rows by folder so each task writes few folders; AQE splits a
        # hot folder's rows over several tasks and merges small ones
        out = out.hint("rebalance", *partition_by)
    if sort_within:
        out = out.sortWithinPartitions(*sort_within)
    w = out.write.mode("errorifexists")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(target)
    if dates:
        _write_text(spark, _dates_path(path, name), json.dumps({"first": _iso(seen.get["first"]), "newest": list(map(_iso, seen.get["newest"] or []))}))
    prune_runs(spark, path, keep)
    return target


def _iso(day: dt.date | None) -> str | None:
    return day and day.isoformat()


def _dates_path(path: str, run: str) -> str:
    return f"{path.rstrip('/')}/_dates/{run}.json"


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    _, fs, p = _fs(spark, path)
    out = fs.create(p, True)
    out.write(bytearray(text.encode()))
    out.close()


def _read_text(spark: SparkSession, path: str) -> str | None:
    jvm, fs, p = _fs(spark, path)
    if not fs.exists(p):
        return None
    file = fs.open(p)
    try:
        return jvm.org.apache.commons.io.IOUtils.toString(file, "UTF-8")
    finally:
        file.close()


def run_dates(spark: SparkSession, path: str) -> tuple[dt.date | None, dt.date | None, dt.date | None] | None:
    """(first, latest, previous) dates of the newest complete run, as recorded when it was published; None if they were not.

    Dates that the run does not have are None.
    """
    runs = complete_runs(spark, path)
    text = _read_text(spark, _dates_path(path, runs[-1])) if runs else None
    if text is None:
        return None
    told = json.loads(text)
    first, latest, prev = (d and dt.date.fromisoformat(d) for d in [told["first"], *(told["newest"] + [None, None])[:2]])
    return first, latest, prev


VERSION = "kind string, value string"
PRUNED = "_PRUNED"


def _version_path(path: str, run: str) -> str:
    return f"{path.rstrip('/')}/_versions/{run}"


def is_versioned(spark: SparkSession, path: str, run: str | None = None) -> bool:
    """Whether a complete run (by default the newest) was published by ``publish_changed``."""
    runs = complete_runs(spark, path) if run is None else [run]
    return bool(runs) and complete(spark, _version_path(path, runs[-1]))


def _version(spark: SparkSession, path: str, run: str) -> DataFrame:
    return spark.read.schema(VERSION).parquet(_version_path(path, run))


def _own_files(spark: SparkSession, path: str, run: str) -> DataFrame:
    """(value): a run's data files, relative to the table; contents are not read."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
             .load(f"{path.rstrip('/')}/{run}").select("path"))
    return files.select(F.regexp_extract("path", rf"({run}/.*)$", 1).alias("value"))


def code_of_path(path_col: str, code_col: str):
    """The code in a ``<code_col>=<code>/`` folder of a path (folder names escape special characters)."""
    part = F.regexp_extract(path_col, rf"/{code_col}=([^/]*)/", 1)
    return F.url_decode(F.replace(part, F.lit("+"), F.lit("%2B")))


def publish_changed(rows: DataFrame, path: str, code_col: str, changed: DataFrame | None = None, keep: int = 2,
                    sort_within: list[str] | None = None, before_success: Callable[[str], None] | None = None) -> str:
    """Publish ``rows`` as all there is now for the codes in ``changed``; return the run folder.

    Other codes' files are carried over by name from the newest version, and
    not read.  Without ``changed``, or before the first version, nothing is
    carried over.  Readers see the old version whole until the new run is
    complete; a load that fails leaves it.  Rows without a code are not kept
    by code: they belong to the null folder and are replaced when ``changed`` holds null.
    """
    spark = rows.sparkSession
    runs = complete_runs(spark, path)

    def write_version(name: str) -> None:
        carried = spark.createDataFrame([], VERSION)
        if changed is not None and runs and is_versioned(spark, path, runs[-1]):
            files = _version(spark, path, runs[-1]).where("kind = 'file'").select("value").unionByName(_own_files(spark, path, runs[-1]))
            code = code_of_path("value", code_col)
            code = F.when(code != "__HIVE_DEFAULT_PARTITION__", code)
            hit = changed.select(F.col(code_col).cast("string").alias("_changed"))
            kept = files.withColumn("_code", code).join(hit, F.col("_code").eqNullSafe(F.col("_changed")), "left_anti")
            carried = kept.select(F.lit("file").alias("kind"), "value")
        shape = spark.createDataFrame([("schema", rows.schema.json())], VERSION)
        carried.unionByName(shape).write.mode("overwrite").parquet(_version_path(path, name))
        if before_success:
            before_success(name)

    return publish(rows, path, partition_by=[code_col], keep=keep, sort_within=sort_within, before_success=write_version)


def _read_version(spark: SparkSession, path: str, run: str) -> DataFrame:
    """The files of a version: its own and those it carries over (a list of names, as any scan's own file listing)."""
    told = _version(spark, path, run).collect()
    schema = T.StructType.fromJson(json.loads(next(r.value for r in told if r.kind == "schema")))
    root = path.rstrip("/")
    files = [f"{root}/{r.value}" for r in told if r.kind == "file"]
    return spark.read.schema(schema).option("basePath", root).parquet(f"{root}/{run}", *files).select(*schema.fieldNames())


def _prune_versions(spark: SparkSession, path: str, old: list[str], kept: list[str]) -> None:
    """Old runs stop being complete; their files go once no kept version carries them over."""
    jvm, fs, root = _fs(spark, path)
    to_path = jvm.org.apache.hadoop.fs.Path
    for name in old:
        fs.create(to_path(root, f"{name}/{PRUNED}"), True).close()
        fs.delete(to_path(root, f"{name}/_SUCCESS"), False)
    named = {r.value for run in kept if is_versioned(spark, path, run) for r in _version(spark, path, run).where("kind = 'file'").collect()}
    for st in fs.listStatus(root):
        name = st.getPath().getName()
        if not (st.isDirectory() and name.startswith(RUN_PREFIX) and fs.exists(to_path(st.getPath(), PRUNED))):
            continue
        if not any(v.startswith(f"{name}/") for v in named):
            fs.delete(st.getPath(), True)
            fs.delete(to_path(_version_path(path, name)), True)
            continue
        found = fs.listFiles(st.getPath(), True)
        while found.hasNext():
            file = found.next().getPath()
            value = file.toString().partition(f"/{name}/")[2]
            if value.endswith(".parquet") and f"{name}/{value}" not in named:
                fs.delete(file, False)


def prune_runs(spark: SparkSession, path: str, keep: int = 2) -> None:
    if keep < 1:
        raise ValueError("keep at least one run")
    runs = complete_runs(spark, path)
    jvm, fs, _ = _fs(spark, path)
    if is_versioned(spark, path):
        _prune_versions(spark, path, runs[:-keep], runs[-keep:])
        return
    for name in runs[:-keep]:
        fs.delete(jvm.org.apache.hadoop.fs.Path(_dates_path(path, name)), False)
        fs.delete(jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{name}"), True)


def latest_run(spark: SparkSession, path: str) -> str:
    runs = complete_runs(spark, path)
    if not runs:
        raise FileNotFoundError(f"no complete run under {path}")
    return f"{path.rstrip('/')}/{runs[-1]}"


def read_curated(spark: SparkSession, path: str) -> DataFrame:
    """The newest complete run of the table at ``path``, with what it carries over from older ones."""
    run = latest_run(spark, path).rpartition("/")[2]
    if is_versioned(spark, path, run):
        return _read_version(spark, path, run)
    return spark.read.parquet(latest_run(spark, path))


def stage(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` to a fresh folder under the shared scratch root and read it back.

    Used for small intermediates that several branches of a plan read (the
    training set of the forecasts): they are computed once, the lineage is
    cut (a lost executor does not recompute the fact-table scan), and AQE
    sees their real size.
    """
    from finseries.session import scratch_path
    spark = df.sparkSession
    path = scratch_path(spark, "stage", label)
    df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
