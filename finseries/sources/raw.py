"""Landed CSV files: land, scan, name and type them.

Two landing layouts are read:

* ``files``: one ``<code>.csv`` per asset or series in one folder, as a
  vendor drop leaves them; the code is the file stem.
* ``partitioned``: ``<code_col>=<code>/part-*.csv`` folders, as ``land_csv``
  writes them; the code is the discovered partition column (Spark unescapes
  folder names, so codes with ``#`` or ``/`` survive).

Every file is read by header name with ``enforceSchema=False``: a file whose
header differs from the expected column list fails the read instead of being
matched by position.
"""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from finseries.functions.parse import percent_to_number, strict_date, to_number
from finseries.schemas import DATASETS, PUBLISHED_SCHEMAS, RAW_COLUMNS, UNKNOWN_NAME, raw_schema

FILE_STEM_PATTERN = r"^(.*)\.csv$"


def _read_by_name(spark: SparkSession, path: str | list[str], names: list[str], partition_col: str | None,
                  base: str | None = None) -> DataFrame:
    """Header CSV files whose columns may come in any order, mapped by name.

    The files are scanned twice, without header handling: a row that is a permutation of the
    expected names is a file's header; from it each file gets the position of
    every name (one row per file, joined back on the file path), and the data
    rows of that file are read through those positions.
    """
    k = len(names)
    fields = [T.StructField(f"_c{i}", T.StringType()) for i in range(k)]
    if partition_col:
        fields.append(T.StructField(partition_col, T.StringType()))
    raw = (spark.read.schema(T.StructType(fields)).option("header", False).options(**({"basePath": base} if base else {})).csv(path)
           .withColumn("_file", F.col("_metadata.file_path"))
           .withColumn("_fname", F.col("_metadata.file_name")))
    cells = F.array(*[F.col(f"_c{i}") for i in range(k)])
    wanted = F.array_sort(F.array(*[F.lit(n) for n in names]))
    is_header = F.coalesce(F.array_sort(cells) == wanted, F.lit(False))
    pos = [f"_p_{n}" for n in names]
    layouts = (raw.where(is_header)
               .select("_file", *[F.array_position(cells, n).cast("int").alias(f"_p_{n}") for n in names])
               .groupBy("_file")
               .agg(F.count_distinct(F.struct(*pos)).alias("_n"), *[F.max(c).alias(c) for c in pos]))
    rows = raw.where(~is_header).join(layouts, "_file", "left")
    # a file without a header row, or with two different ones, fails the read:
    # its rows are never dropped or mapped twice
    bad = F.col("_n").isNull() | (F.col("_n") > 1)
    err = F.raise_error(F.concat(F.lit("no single header row in "), F.col("_file")))
    out = [F.when(bad, err).otherwise(F.element_at(cells, F.col(c))).alias(n) for n, c in zip(names, pos)]
    return rows.select(*([partition_col] if partition_col else []), *out, "_file", "_fname")


def read_raw(spark: SparkSession, path: str | list[str], dataset: str, layout: str = "partitioned",
             code_col: str | None = None, header: bool = True, by_name: bool = False,
             base: str | None = None) -> DataFrame:
    """All-string scan of a landed dataset; adds the code column when it has one.

    ``path`` is the landing folder, or a list of files below ``base``.

    With ``header=False`` the files have no header row and the columns are
    named by position from the dataset's fixed column list.  By default a
    file whose header differs from that list fails the read; with
    ``by_name=True`` each file's header is mapped by name instead, so files
    with different column orders are all read correctly.
    """
    code_col = code_col or DATASETS[dataset]["code"]
    if by_name:
        part = code_col if (layout == "partitioned" and code_col) else None
        df = _read_by_name(spark, path, RAW_COLUMNS[dataset], part, base)
        if layout == "files" and code_col:
            df = df.withColumn(code_col, F.regexp_extract(F.col("_fname"), FILE_STEM_PATTERN, 1))
        return df.select(*([code_col] if code_col else []), *RAW_COLUMNS[dataset])
    if layout == "partitioned" and code_col:
        schema = raw_schema(dataset, code_col)
    elif layout in ("files", "partitioned"):
        schema = raw_schema(dataset)
    else:
        raise ValueError(f"layout must be 'files' or 'partitioned', not {layout!r}")
    df = (spark.read.schema(schema)
          .option("header", header)
          .option("enforceSchema", not header)
          .option("mode", "PERMISSIVE")
          .options(**({"basePath": base} if base else {}))
          .csv(path))
    if layout == "files" and code_col:
        df = with_symbol(df, code_col)
    cols = ([code_col] if code_col else []) + RAW_COLUMNS[dataset]
    return df.select(*cols)


def with_symbol(df: DataFrame, code_col: str = "symbol", pattern: str = FILE_STEM_PATTERN) -> DataFrame:
    """Code from the file name (``_metadata.file_name``), by a regex with one group."""
    return df.withColumn(code_col, F.regexp_extract(F.col("_metadata.file_name"), pattern, 1))


def name_lookup(code: Column, names: dict[str, str]) -> Column:
    """Display name of an exact code from a fixed table, ``"Unknown"`` otherwise.

    The table is a literal map inside the expression: no join, no broadcast.
    """
    if not names:
        return F.lit(UNKNOWN_NAME)
    pairs = []
    for k, v in names.items():
        pairs += [F.lit(k), F.lit(v)]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), code), F.lit(UNKNOWN_NAME))


def with_names(df: DataFrame, code_col: str, name_col: str, names: dict[str, str]) -> DataFrame:
    return df.withColumn(name_col, name_lookup(F.col(code_col), names))


def date_floor(df: DataFrame, floor: str | None, inclusive: bool, date_col: str = "date") -> DataFrame:
    """Keep rows after ``floor`` (``>=`` when inclusive); no floor keeps all."""
    if floor is None:
        return df
    bound = F.lit(floor).cast("date")
    return df.where(F.col(date_col) >= bound if inclusive else F.col(date_col) > bound)


def typed(raw: DataFrame, dataset: str, floor: str | None = "default",
          names: dict[str, str] | None = None) -> DataFrame:
    """Typed rows in the published column order.

    Dates are strict (bad text raises), numbers lenient (bad text is NULL).
    ``floor="default"`` applies the dataset's own landing floor.
    """
    spec = DATASETS[dataset]
    cols = {}
    for c in raw.columns:
        if c == "date":
            cols[c] = strict_date(c)
        elif c in spec["numbers"]:
            cols[c] = percent_to_number(c) if c == "change_percentage" else to_number(c)
    df = raw.withColumns(cols)
    if spec["name"] and spec["names"] is not None:
        df = with_names(df, spec["code"], spec["name"], names if names is not None else spec["names"])
    if "date" in df.columns:
        use_floor = spec["floor"] if floor == "default" else floor
        df = date_floor(df, use_floor, spec["inclusive"])
    out = PUBLISHED_SCHEMAS[dataset]
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in out.fields])


def curate(spark: SparkSession, landing: str | list[str], dataset: str, layout: str = "partitioned",
           floor: str | None = "default", names: dict[str, str] | None = None,
           header: bool = True, by_name: bool = False, base: str | None = None) -> DataFrame:
    """Landed CSV to the typed table of ``dataset`` (lazy; one scan, two with ``by_name``)."""
    return typed(read_raw(spark, landing, dataset, layout, header=header, by_name=by_name, base=base),
                 dataset, floor, names)


def land_csv(df: DataFrame, path: str, dataset: str, code_col: str | None = None,
             max_records_per_file: int | None = None) -> str:
    """Write rows as header CSV, one folder per code.

    A rebalance on the code clusters each code's rows into few tasks, so each
    task writes few files, and lets AQE split a dominant code over several
    tasks (and merge small ones) from the actual shuffle sizes.  There is no
    sampling pass and nothing random, so a retried task writes the same rows.
    """
    code_col = code_col or DATASETS[dataset]["code"]
    cols = RAW_COLUMNS[dataset]
    out = df.select(*([code_col] if code_col else []), *cols)
    if code_col:
        out = out.hint("rebalance", code_col)
    w = out.write.mode("errorifexists").option("header", True)
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", max_records_per_file)
    if code_col:
        w = w.partitionBy(code_col)
    w.csv(path)
    return path


def land_files(df: DataFrame, path: str, dataset: str, code_col: str | None = None,
               header: bool = True, columns: list[str] | None = None) -> str:
    """Write one ``<code>.csv`` per code, as a vendor drop leaves them.

    One file per code means one task per code: this is the vendor's layout,
    for landing test data; ``land_csv`` writes the one that scales.
    ``columns`` gives the files another column order.
    """
    spark = df.sparkSession
    code_col = code_col or DATASETS[dataset]["code"]
    parts = f"{path.rstrip('/')}/_parts"
    (df.select(code_col, *(columns or RAW_COLUMNS[dataset])).repartition(code_col)
     .write.option("header", header).partitionBy(code_col).csv(parts))
    jvm = spark.sparkContext._jvm
    to_path = jvm.org.apache.hadoop.fs.Path
    fs = to_path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for folder in fs.listStatus(to_path(parts)):
        if folder.isDirectory():
            code = unquote(folder.getPath().getName().split("=", 1)[1])
            for f in fs.listStatus(folder.getPath()):
                target = to_path(path, f"{code}.csv")
                fs.delete(target, False)  # a new drop overwrites the old one
                fs.rename(f.getPath(), target)
    fs.delete(to_path(parts), True)
    return path
