"""Small helpers shared by the training-data operators.

Intermediates go to the shared scratch folder of the session
(``spark.checkpoint.dir``), so a lost executor never takes the only copy
of a result with it.
"""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from finseries.session import scratch_path
from finseries.session import ship_package as _ship_package

#: ASCII letters, for lower-casing A-Z alone.
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"

#: Fixed value: a run of characters that belong to no word (ASCII, not alphanumeric).
NON_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


#: Rows of whole texts that Spark sends to a Python worker at once: bounds memory on both sides of the pipe.
BATCH_ROWS = 1_000


def ship_package(spark: SparkSession) -> None:
    """Make the package importable in Python workers, and Arrow batches small enough for whole texts (a smaller setting stays)."""
    _ship_package(spark)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def save(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to a fresh shared scratch folder and read it back."""
    path = scratch_path(df.sparkSession, "llm", label)
    df.write.option("compression", "zstd").parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.scratch = path
    return out


def discard(*saved: DataFrame) -> None:
    """Delete tables that ``save`` wrote and no later step reads."""
    for df in saved:
        spark = df.sparkSession
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(df.scratch)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def release(spark: SparkSession) -> None:
    """Let Spark drop shuffle files of finished steps.

    Shuffle files live until the driver's garbage collector finds their plan
    unreachable; on a driver with a large heap that can be never, so steps
    that write a table ask for a collection before the next one starts.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def spare(df: DataFrame, *names: str) -> list[str]:
    """The given names, each lengthened until no column of ``df`` has it: for helper columns beside a user's own."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def map_texts(rows: DataFrame, make: Callable[[], Callable[[list], dict]], shape: str, at_once: int = 2_000) -> DataFrame:
    """``rows`` with column ``text`` replaced by the columns of ``shape``.

    ``make()`` is called once per task and gives a function from a list of at
    most ``at_once`` texts to a dict of columns.  All other columns pass as the
    Arrow arrays they are, so a null beside a 64-bit id changes neither.
    """
    kept = [c for c in rows.columns if c != "text"]
    more = StructType.fromDDL(shape)
    schema = StructType([rows.schema[c] for c in kept] + more.fields)
    arrow, text_at = to_arrow_schema(schema), rows.columns.index("text")
    kept_at = [i for i in range(len(rows.columns)) if i != text_at]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compute = make()
        for whole in batches:
            for i in range(0, whole.num_rows, at_once):
                b = whole.slice(i, at_once)
                made = compute(b.column(text_at).to_pylist())
                new = [made[f.name] if isinstance(made[f.name], pa.Array) else pa.array(made[f.name], type=arrow.field(f.name).type) for f in more.fields]
                yield pa.RecordBatch.from_arrays([*(b.column(k) for k in kept_at), *new], names=schema.names)

    return rows.mapInArrow(run, schema)


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only (``lower`` would also change other letters)."""
    return F.translate(c, UPPER, LOWER)


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once per row.

    An expression used inside a lambda is otherwise evaluated again for every
    element that the lambda visits.
    """
    return F.transform(F.array(value), body)[0]


def word_array(text: Column) -> Column:
    """Lower-cased ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` words; null text has none."""
    parts = F.split(ascii_lower(F.coalesce(text, F.lit(""))), NON_WORD)
    return F.filter(parts, lambda w: w != "")
