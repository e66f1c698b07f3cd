"""Helpers shared by the document operators: row mapping over whole texts, stored intermediate tables."""

from __future__ import annotations

import contextlib
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortline.session import checkpoint

# Bytes of text that one numpy step handles at a time; a longer text is a step of its own.
STEP_BYTES = 4 << 20

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
# Rows that go to a Python worker at a time while a table is stored: whole texts are long rows.
BATCH_ROWS = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


@contextlib.contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """The session with these settings, which then get their former values back."""
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def store(df: DataFrame) -> DataFrame:
    """``df`` as a table in the shared checkpoint folder, written in small Arrow batches.

    Its shuffle files go once it is written, not at the driver's next collection of garbage.
    """
    with settings(df.sparkSession, {_CLEANUP: "true", _BATCH: str(BATCH_ROWS)}):
        return checkpoint(df)


def with_text(df: DataFrame, id_col: str, text_col: str, null_text: str | None = "") -> DataFrame:
    """Only the id and the whole text (under the fixed names ``id`` and ``text``)."""
    text = F.col(text_col).cast("string")
    return df.select(F.col(id_col).alias("id"),
                     (text if null_text is None else F.coalesce(text, F.lit(null_text))).alias("text"))


def schema(df: DataFrame, id_name: str, fields: str) -> T.StructType:
    """``id_name`` with the type of ``df.id``, then the fields of the DDL string."""
    return T.StructType([T.StructField(id_name, df.schema["id"].dataType)]
                        + T.StructType.fromDDL(fields).fields)


def map_texts(df: DataFrame, id_name: str, fields: str,
              each: Callable[[list[str]], list[tuple]]) -> DataFrame:
    """One output row per row of (id, text): ``each`` turns a list of texts into value tuples."""
    out = schema(df, id_name, fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        target = None
        for batch in batches:
            if target is None:
                target = arrow_schema(out, batch.schema.field("id").type)
            for part in steps(batch):
                values = each(part.column("text").to_pylist())
                columns = list(zip(*values)) if values else [()] * (len(target) - 1)
                arrays = [part.column("id")] + [pa.array(list(c), type=f.type)
                                                for c, f in zip(columns, list(target)[1:])]
                yield pa.RecordBatch.from_arrays(arrays, schema=target)

    return df.mapInArrow(run, out)


def append_texts(df: DataFrame, text_col: str, fields: str,
                 each: Callable[[list[str]], list[tuple]]) -> DataFrame:
    """The rows as they are, with computed columns; these replace columns of the same names."""
    new = T.StructType.fromDDL(fields)
    src = df.select([c for c in df.columns if c not in new.names or c == text_col])
    kept = [c for c in src.columns if c not in new.names]
    out = T.StructType(src.select(kept).schema.fields + new.fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        target = arrow_schema(new)
        for batch in batches:
            for part in steps(batch, column=text_col):
                values = each([t or "" for t in part.column(text_col).to_pylist()])
                arrays = [part.column(c) for c in kept]
                names = list(kept)
                for i, f in enumerate(target):
                    arrays.append(pa.array([v[i] for v in values], type=f.type))
                    names.append(f.name)
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    return src.mapInArrow(run, out)


def steps(batch: pa.RecordBatch, limit: int = STEP_BYTES,
          column: str = "text") -> Iterator[pa.RecordBatch]:
    """The batch in slices of at most ``limit`` bytes of text (one row at least)."""
    sizes = pc.binary_length(batch.column(column)).to_pylist()
    begin = total = 0
    for i, n in enumerate(sizes):
        if total and total + (n or 0) > limit:
            yield batch.slice(begin, i - begin)
            begin, total = i, 0
        total += n or 0
    if begin < batch.num_rows:
        yield batch.slice(begin)


def arrow_schema(struct: T.StructType, id_type: pa.DataType | None = None) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    out = to_arrow_schema(struct)
    return out if id_type is None else out.set(0, out.field(0).with_type(id_type))
