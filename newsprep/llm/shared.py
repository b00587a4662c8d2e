"""Small helpers of the operators in this subpackage.

Operators never use a document's id as a row's identity, since ids may be null or
repeated. Rows that must be found again carry the number of the task that read them
and their place in it; both are written to a table before anything builds on them, so
that a task that runs again after the loss of an executor can't renumber them.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Mapping

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from newsprep.session import new_path

#: Maps A-Z to a-z and leaves all other bytes, those of UTF-8 sequences among them.
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
    """Write a table to the shared folder and read it back.

    It cuts the lineage: what comes later reads files that every executor sees.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.option("compression", codec).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def utf8(column: pa.Array) -> Iterator[bytes]:
    """The UTF-8 bytes of each text of an Arrow column, null as empty."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    for value in column.cast(kind):
        yield value.as_py() or b""


def slices(batches: Iterable[pa.RecordBatch], column: int, size: int) -> Iterator[pa.RecordBatch]:
    """Cut batches so that a column's texts take about size bytes each, one row at least.

    What a task builds from a batch is then bounded by size, or by one long text.
    """
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
        start = held = 0
        for row, length in enumerate(lengths):
            if held and held + length > size:
                yield batch.slice(start, row - start)
                start, held = row, 0
            held += length
        if start < batch.num_rows:
            yield batch.slice(start)


def in_order(df: DataFrame, name: str) -> DataFrame:
    """A written copy with the columns part and pos: the table's own order of rows.

    part is the piece of the input that a row came from, pos grows within it. Pieces
    are bounded by the size of a file split, so no value of a column can make one large.
    """
    return written(
        df.withColumns({"part": F.spark_partition_id(), "pos": F.monotonically_increasing_id()}),
        name,
    )


#: Totals of so many parts are added up by one task.
FAN = 1024


def prefix_sums(df: DataFrame, measures: Mapping[str, Column]) -> tuple[DataFrame, dict[str, int]]:
    """Add, for each measure, the sum over all rows before this one, and the grand totals.

    Needs the columns of in_order(). Each part is summed by itself; the parts' totals
    are summed in groups of FAN, and the groups' totals once more. So a task orders the
    rows of one part, or at most FAN totals, but for the last step: one row for each FAN
    parts, some hundreds for 100 TB.
    """
    names = list(measures)
    df = df.withColumns({f"m_{m}": c for m, c in measures.items()})
    totals = df.groupBy("part").agg(*(F.sum(f"m_{m}").alias(m) for m in names))
    totals = totals.withColumn("fan", F.expr(f"part div {FAN}"))

    def before(window, column):
        window = window.rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum(column).over(window), F.lit(0))

    fans = totals.groupBy("fan").agg(*(F.sum(m).alias(m) for m in names))
    # Without a partition key on purpose: some hundreds of rows at most.
    fans = fans.select("fan", *(before(Window.orderBy("fan"), m).alias(f"f_{m}") for m in names))
    within = Window.partitionBy("fan").orderBy("part")
    bases = totals.select("fan", "part", *(before(within, m).alias(f"p_{m}") for m in names))
    bases = bases.join(fans, "fan").select(
        "part", *((F.col(f"p_{m}") + F.col(f"f_{m}")).alias(f"base_{m}") for m in names)
    )
    rows = Window.partitionBy("part").orderBy("pos")
    summed = df.withColumns({f"run_{m}": before(rows, f"m_{m}") for m in names})
    summed = summed.join(bases, "part").withColumns(
        {f"before_{m}": F.col(f"run_{m}") + F.col(f"base_{m}") for m in names}
    )
    drop = [f"{kind}_{m}" for kind in ("m", "run", "base") for m in names]
    grand = totals.agg(*(F.sum(m).alias(m) for m in names)).first()
    return summed.drop(*drop), {m: grand[m] or 0 for m in names}
