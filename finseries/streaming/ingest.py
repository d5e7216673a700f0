"""Republish a curated table when landed files change.

Each published run keeps a manifest of the landed files it was made from
(path, modification time, length).  The next run lists the landing folder
again (file metadata only, no contents) and compares: a file that is new,
was overwritten in place, or is gone marks its code as changed.  Nothing
changed: nothing is published.  Otherwise only the changed codes' files are
read, typed and written again; the other codes' published files are carried
over by name from the previous run (``store.publish_changed``), so a refresh
costs what changed, and readers switch when the new run is complete.  A
dataset whose published rows do not hold the code is curated again as a whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from finseries.schemas import DATASETS, PUBLISHED_SCHEMAS
from finseries.sources import raw as R
from finseries.sources import store as ST

MANIFEST = "path string, modificationTime timestamp, length long"


def landed_files(spark: SparkSession, landing: str) -> DataFrame:
    """path, modificationTime, length of every CSV file under ``landing``; contents are not read."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.csv")
            .load(landing).select("path", "modificationTime", "length"))


def _manifest_path(table: str, run: str) -> str:
    # a leading underscore keeps the folder out of table reads
    return f"{table.rstrip('/')}/_manifests/{run}"


def _last_manifest(spark: SparkSession, table: str) -> DataFrame | None:
    """The files behind the newest complete run; None without a run or if that run has none (then all is curated)."""
    runs = ST.complete_runs(spark, table)
    if not runs or not ST.complete(spark, _manifest_path(table, runs[-1])):
        return None
    return spark.read.schema(MANIFEST).parquet(_manifest_path(table, runs[-1]))


def changed_files(before: DataFrame, now: DataFrame) -> DataFrame:
    """Paths that are new, gone, or differ in modification time or length."""
    same = now.join(before, ["path", "modificationTime", "length"], "left_semi").select("path")
    return now.select("path").unionByName(before.select("path")).distinct().join(same, "path", "left_anti")


def _code(layout: str, code_col: str):
    if layout == "files":
        return F.regexp_extract("path", r"([^/]*)\.csv$", 1)
    return ST.code_of_path("path", code_col)


def republish_on_arrival(spark: SparkSession, landing: str, dataset: str, table: str,
                         layout: str = "partitioned", floor: str | None = "default",
                         header: bool = True, by_name: bool = False) -> list[str]:
    """Bring ``table`` up to the files landed so far; return the run folders published (none or one)."""
    now = ST.stage(landed_files(spark, landing), "manifest")
    before = _last_manifest(spark, table)
    code_col, schema = DATASETS[dataset]["code"], PUBLISHED_SCHEMAS[dataset]
    by_code = code_col in schema.fieldNames()
    codes = None
    if before is None:
        if now.isEmpty():
            return []
        paths = landing
    else:
        changed = ST.stage(changed_files(before, now), "changed")
        if changed.isEmpty():
            return []
        paths = None if now.isEmpty() else landing
        if by_code and ST.is_versioned(spark, table):
            codes = changed.select(_code(layout, code_col).alias(code_col)).distinct()
            # one path per changed file's code: the list the next read needs anyway
            paths = [r.path for r in now.withColumn(code_col, _code(layout, code_col)).join(codes, code_col, "left_semi").select("path").collect()]
    rows = (R.curate(spark, paths, dataset, layout, floor=floor, header=header, by_name=by_name, base=landing if codes is not None else None)
            if paths else spark.createDataFrame([], schema))
    rows, sort = rows.select(*schema.fieldNames()), ["date"] if "date" in schema.fieldNames() else None

    def keep_manifest(name: str) -> None:
        now.write.mode("overwrite").parquet(_manifest_path(table, name))

    if by_code:
        return [ST.publish_changed(rows, table, code_col, codes, sort_within=sort, before_success=keep_manifest)]
    return [ST.publish(rows, table, sort_within=sort, before_success=keep_manifest)]
