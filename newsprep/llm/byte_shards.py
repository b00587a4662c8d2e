"""Contiguous shards of nearly equal bytes, cut from global prefix sums of sizes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsprep.llm.shared import in_order, prefix_sums


def byte_shards(
    docs: DataFrame, *, shards: int = 16, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per row of docs: its shard and its place in the shard.

    A row's size is the UTF-8 length of its text plus 1, so a null or empty text has
    size 1. Rows keep the order of the table. With S the sum of all sizes, shard k takes
    the rows whose middle byte lies in [k*S/shards, (k+1)*S/shards): a shard differs from
    S/shards by less than the largest row, also when one text makes up much of S. The
    shards of a table with fewer rows than shards may be empty. slot counts from 0 in
    each shard. Repeated rows and rows with a null id are rows like any other, an empty
    table gives no rows, other columns of docs are ignored.

    Texts are read once and never moved: what is shuffled are an id and three numbers.
    """
    sizes = docs.select(
        F.col(id_col).alias("doc_id"),
        (F.coalesce(F.octet_length(text_col), F.lit(0)).cast("bigint") + 1).alias("size"),
        F.crc32(F.encode(F.coalesce(text_col, F.lit("")), "UTF-8")).alias("text_crc32"),
    )
    rows = in_order(sizes, "sizes")
    summed, total = prefix_sums(rows, {"size": F.col("size"), "row": F.lit(1)})
    # The middle of a row is (2 * before + size) / 2, below the total as sizes are positive.
    middle = f"(2 * before_size + size) * {shards}L div {max(1, 2 * total['size'])}L"
    cut = summed.withColumn("shard", F.expr(f"cast({middle} as int)"))
    starts = cut.groupBy("shard").agg(F.min("before_row").alias("first_row"))
    return cut.join(F.broadcast(starts), "shard").select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("before_row") - F.col("first_row")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
