"""What the operators share: cutting lineage in the shared folder, and walking Arrow batches in bounded blocks."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_SHIPPED: set[str] = set()
_ROOTS: dict[str, str] = {}

#: Bytes of text a task looks at in one go; temporaries are a small multiple of it.
BLOCK_BYTES = 4_000_000


def shipped(spark: SparkSession) -> SparkSession:
    """The session, with this package sent to its workers unless they find it by their own path."""
    root = Path(__file__).resolve().parents[2]
    reachable = [Path.cwd(), *map(Path, filter(None, os.environ.get("PYTHONPATH", "").split(os.pathsep)))]
    context = spark.sparkContext
    if root not in [p.resolve() for p in reachable] and context.applicationId not in _SHIPPED:
        base = Path(tempfile.mkdtemp(prefix="tickbars-code-")) / "tickbars"
        context.addPyFile(shutil.make_archive(str(base), "zip", root, "tickbars"))
        _SHIPPED.add(context.applicationId)
    return spark


def shared_root(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``. Where that is unset a local session (tests) gets a temporary one; on a
    cluster it is an error, as executors couldn't see each other's files."""
    base = spark.conf.get("spark.checkpoint.dir", "")
    if base:
        return base.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir is not set: name a folder on shared storage")
    if context.applicationId not in _ROOTS:
        _ROOTS[context.applicationId] = tempfile.mkdtemp(prefix="tickbars-llm-")
    return _ROOTS[context.applicationId]


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: a cut in the lineage that survives lost executors."""
    path = f"{shared_root(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def quoted(column: str) -> str:
    return "`" + column.replace("`", "``") + "`"


def named(column: str) -> Column:
    """A column by its exact name, dots included."""
    return F.col(quoted(column))


def column_of(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def texts_of(batch: pa.RecordBatch, name: str = "__text") -> pa.Array:
    """A column of text or bytes with nulls as empty."""
    texts = column_of(batch, name)
    return texts.fill_null("" if pa.types.is_string(texts.type) else b"") if texts.null_count else texts


def blocks(batches: Iterator[pa.RecordBatch], column: str = "__text", limit: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with about ``limit`` bytes of ``column`` at most, one row at least."""
    for batch in batches:
        start, size = 0, 0
        for i, n in enumerate(pa.compute.binary_length(column_of(batch, column)).to_pylist()):
            n = n or 0
            if i > start and size + n > limit:
                yield batch.slice(start, i - start)
                start, size = i, 0
            size += n
        if start < batch.num_rows:
            yield batch.slice(start)


def mapped(
    docs: DataFrame,
    keep: tuple[str, ...],
    text_col: str,
    made: str,
    task: Callable[[Iterator[pa.RecordBatch]], Iterator[tuple[pa.RecordBatch, list[pa.Array]]]],
    prefix: str = "",
    where: str | None = None,
) -> DataFrame:
    """The columns ``keep`` of every row beside the columns ``made`` (a schema) that ``task`` finds, without a shuffle.

    ``task`` gets batches with the text as ``__text`` and yields each block with its new columns; with ``where``, rows
    whose new boolean column of that name is false are dropped.
    """
    fields = [x.strip().split(" ", 1) for x in made.split(";")]
    names = [prefix + n for n, _ in fields]
    if set(names) & set(keep):
        raise ValueError(f"{sorted(set(names) & set(keep))}: choose a prefix")
    own = [f"__keep{k}" if c != text_col else "__text" for k, c in enumerate(keep)]
    columns = {f: named(c).alias(f) for c, f in zip(keep, own, strict=True)}
    columns["__text"] = named(text_col).cast("string").alias("__text")
    picked = docs.select(*columns.values())
    kinds = [picked.schema[f].dataType.simpleString() for f in own]
    schema = ", ".join(f"{quoted(n)} {k}" for n, k in [*zip(keep, kinds, strict=True), *zip(names, (t for _, t in fields), strict=True)])
    at = [n for n, _ in fields].index(where) if where else None
    all_names = [*keep, *names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, found in task(batches):
            out = pa.RecordBatch.from_arrays([*(column_of(block, f) for f in own), *found], names=all_names)
            yield out if at is None else out.filter(found[at])

    return picked.mapInArrow(run, schema)
