"""Arrow functions on executors, which get this package's source with the job."""

from __future__ import annotations

import contextlib
import ctypes
import functools
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_sent: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the package to the executors, once per application, as spark-submit --py-files would."""
    context = spark.sparkContext
    if context.applicationId in _sent:
        return
    package = Path(__file__).resolve().parent.parent
    archive = Path(tempfile.mkdtemp(prefix="package-")) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for file in sorted(package.rglob("*.py")):
            z.write(file, file.relative_to(package.parent))
    context.addPyFile(str(archive))
    _sent.add(context.applicationId)


def give_back() -> None:
    """Freed memory goes back to the system, since a worker lives on for the tasks of other stages."""
    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def tidy(function):
    """The same Arrow function, which gives memory back when its task ends."""

    @functools.wraps(function)
    def run(batches):
        yield from function(batches)
        give_back()

    return run


def map_arrow(df: DataFrame, function, schema: str) -> DataFrame:
    """df.mapInArrow, with the package at hand."""
    ship(df.sparkSession)
    return df.mapInArrow(tidy(function), schema)


def append_column(df: DataFrame, source: str, out: str, kind: str, compute, rows: int = 2000) -> DataFrame:
    """`df` with the column `out` of SQL type `kind`: compute(Arrow array of `source`) for slices of the batches.

    A column already named `out` is replaced; all others pass unchanged.
    """
    import pyarrow as pa
    from pyspark.sql.types import _parse_datatype_string

    names = [c for c in df.columns if c != out]
    df = df.select(*[f"`{c}`" for c in names], *([f"`{out}`"] if source == out else []))
    at = df.columns.index(source)

    def extend(batches):
        for batch in batches:
            for begin in range(0, batch.num_rows, rows):
                part = batch.slice(begin, rows)
                columns = [c for c, name in zip(part.columns, part.schema.names, strict=True) if name != out]
                yield pa.RecordBatch.from_arrays([*columns, compute(part.column(at))], [*names, out])

    schema = df.drop(out).schema.add(out, _parse_datatype_string(kind))
    ship(df.sparkSession)
    return df.mapInArrow(tidy(extend), schema)
