"""Near copies by SimHash: exact comparison of fingerprint tiles with numpy."""

from __future__ import annotations

import itertools
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsprep.llm.shared import LOWER, utf8, written

SEED = 42
#: Bit ranges whose population counts make a fingerprint's cell: (shift, width).
PARTS = ((0, 16), (16, 16), (32, 32))
#: Fingerprints in a tile, on average; and rows of a tile compared at a time.
TILE, STRIP = 4096, 256


def fingerprint(text: bytes, shingle: int = 3) -> int:
    """The SimHash of a text's shingles as an unsigned number, 0 without a word."""
    words = text.translate(LOWER).split()
    if not words:
        return 0
    joined, width = b" ".join(words), min(shingle, len(words))
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])[: len(words) - width + 1].tolist()
    ends = ends[width - 1 :].tolist()
    hash64, votes = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for at in range(0, len(starts), 1 << 16):
        spans = zip(starts[at : at + (1 << 16)], ends[at : at + (1 << 16)], strict=True)
        hashes = np.array([hash64(joined[a:b], SEED) for a, b in spans], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        votes += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * votes > len(starts), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str, text_col: str, shingle: int = 3) -> DataFrame:
    """doc_id and fp, the fingerprint's 64 bits as a signed number."""
    schema = pa.schema([("doc_id", pa.int64()), ("fp", pa.int64())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t, shingle) for t in utf8(batch.column(1))], np.uint64)
            columns = [batch.column(0), pa.array(found.view(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    selected = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), text_col)
    return selected.mapInArrow(run, "doc_id bigint, fp bigint")


def forest(left: np.ndarray, right: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Links between two tiles that connect what is within the radius, without a ring.

    All pairs are compared, a strip of rows at a time. Of the pairs found, only those are
    returned that join two parts not yet joined: fewer than there are fingerprints.
    """
    values, at = np.unique(np.concatenate([left, right]), return_inverse=True)
    label, links = np.arange(len(values)), []
    rows, columns = at[: len(left)], at[len(left) :]
    for start in range(0, len(left), STRIP):
        strip = left[start : start + STRIP, None] ^ right[None, :]
        near = np.bitwise_count(strip) <= radius
        for i in np.flatnonzero(near.any(axis=1)):
            own, others = rows[start + i], columns[near[i]]
            labels, first = np.unique(label[others], return_index=True)
            for other, k in zip(labels, first, strict=True):
                mine = label[own]
                if other != mine:
                    links.append((int(values[own]), int(values[others[k]])))
                    label[label == other] = mine
    return links


def tile_links(distinct: DataFrame, radius: int = 2) -> DataFrame:
    """(a, b): links between fingerprints that connect all within the radius.

    distinct has each fingerprint once, in the column fp. Its cell is made of the
    population counts of PARTS. These differ in sum by no more than the number of
    differing bits, so tiles are compared only where their cells' counts differ by the
    radius in sum. Cells are split into tiles by a hash, so none is larger than about
    TILE, and a task holds two.
    """
    counts = [
        F.bit_count(F.shiftrightunsigned("fp", s).bitwiseAND((1 << w) - 1)).cast("int")
        for s, w in PARTS
    ]
    base = [1]
    for _, width in PARTS[:-1]:
        base.append(base[-1] * (width + 1 + 2 * radius))
    number = sum(((c + radius) * b for c, b in zip(counts, base, strict=True)), F.lit(0))
    cells = distinct.select("fp", number.cast("int").alias("cell"))
    # At most 17 * 17 * 33 rows, whatever the number of fingerprints.
    sizes = cells.groupBy("cell").agg(F.ceil(F.count("*") / TILE).cast("int").alias("n"))
    sizes = written(sizes, "cells")
    tiles = (
        cells.join(F.broadcast(sizes), "cell")
        .withColumn("tile", F.pmod(F.xxhash64("fp"), "n").cast("int"))
        .groupBy("cell", "tile")
        .agg(F.collect_list("fp").alias("fps"))
    )
    tiles = written(tiles, "tiles")

    steps = range(-radius, radius + 1)
    moves = [
        sum(d * b for d, b in zip(move, base, strict=True))
        for move in itertools.product(steps, repeat=len(PARTS))
        if sum(map(abs, move)) <= radius
    ]
    ahead = F.explode(F.array(*(F.lit(m) for m in sorted(moves) if m >= 0)))
    other = sizes.select(F.col("cell").alias("cell_b"), F.col("n").alias("n_b"))
    pairs = (
        sizes.withColumn("move", ahead)
        .withColumn("cell_b", F.col("cell") + F.col("move"))
        .join(F.broadcast(other), "cell_b")
        .withColumn("tile", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
        .withColumn("tile_b", F.explode(F.sequence(F.lit(0), F.col("n_b") - 1)))
        .filter("move > 0 OR tile <= tile_b")
        .select("cell", "tile", "cell_b", "tile_b")
    )
    right = tiles.toDF("cell_b", "tile_b", "fps_b")
    work = pairs.join(tiles, ["cell", "tile"]).join(right, ["cell_b", "tile_b"])
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: list[tuple[int, int]] = []
            for a, b in zip(batch.column(0), batch.column(1), strict=True):
                left = np.asarray(a.values).view(np.uint64)
                right = np.asarray(b.values).view(np.uint64)
                found += forest(left, right, radius)
            ends = np.array(found, np.uint64).reshape(-1, 2).view(np.int64)
            columns = [pa.array(ends[:, 0]), pa.array(ends[:, 1])]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return work.select("fps", "fps_b").mapInArrow(compare, "a bigint, b bigint")


def components(links: DataFrame) -> DataFrame:
    """(node, root) for each end of a link; root is the same through a component.

    Each round replaces a node's links by links to its least neighbour, first those to
    larger nodes, then those to smaller ones, until nothing changes. A round is two
    aggregations and two joins on the links, written to the shared folder; the number of
    rounds grows with the logarithm of the longest chain. The neighbours of a node are
    never gathered: a node with very many is split as any skewed join key.
    """

    def star(edges: DataFrame, larger: bool) -> DataFrame:
        """edges (u, v), u > v, without repeats."""
        if larger:
            both = edges.union(edges.select("v", "u").toDF("u", "v"))
        else:
            both = edges
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        least = written(least.withColumn("m", F.least("u", "m")), "least")
        joined = both.join(least, "u")
        kept = joined.filter("v > u") if larger else joined.filter("v <> m")
        moved = kept.select(F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v"))
        if not larger:
            moved = moved.union(least.select(F.col("u"), F.col("m").alias("v")))
        return written(moved.filter("u <> v").distinct(), "stars")

    def state(edges: DataFrame) -> tuple:
        mix = F.bit_xor(F.xxhash64("u", "v"))
        return tuple(edges.agg(F.count("*"), mix, F.sum(F.hash("u", "v").cast("bigint"))).first())

    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    edges = written(edges.filter("u <> v").distinct(), "links")
    before, now = None, state(edges)
    while now != before:
        edges = star(star(edges, larger=True), larger=False)
        before, now = now, state(edges)
    roots = edges.select("v").distinct()
    return edges.toDF("node", "root").union(roots.select("v", "v").toDF("node", "root"))


def clusters(prints: DataFrame, radius: int) -> DataFrame:
    """(fp, component_id, least, keeper) for each distinct fingerprint of prints (doc_id, fp).

    least is the least id with that fingerprint, component_id that of its component, and
    keeper marks the one fingerprint of a component that has it (the least, if several).
    """
    nodes = written(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "nodes")
    links = written(tile_links(nodes.select("fp"), radius), "near")
    found = written(components(links).toDF("fp", "root"), "components")
    rank = F.struct(F.col("least").isNull().alias("none"), "least", "fp")
    best = found.join(nodes, "fp").groupBy("root").agg(F.min(rank).alias("best"))
    best = written(best.select("root", "best.least", F.col("best.fp").alias("kept")), "roots")
    linked = found.join(best, "root").select("fp", F.col("least").alias("far"), "kept")
    named = nodes.join(linked, "fp", "left").select(
        "fp",
        F.when(F.col("kept").isNull(), F.col("least")).otherwise(F.col("far")).alias("component_id"),
        "least",
        F.coalesce(F.col("kept") == F.col("fp"), F.lit(True)).alias("keeper"),
    )
    return written(named, "named")


def simhash_components(
    docs: DataFrame, *, radius: int = 2, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per row of docs: doc_id, fingerprint (16 hex digits), component_id.

    Texts link whose fingerprints differ in radius bits or fewer; component_id is the
    least doc_id that links lead to. Texts without a word have the fingerprint 0, texts
    of fewer words than a shingle that of the whole sequence; both link like any other.
    Rows of one fingerprint are one node, so copies are never paired. Null ids are passed
    over for the least one; a component of null ids alone has a null component_id.
    Repeated rows get equal results, an empty table gives no rows, other columns are
    ignored.

    All fingerprints are compared with all in reach of their population counts: the work
    of the comparison grows with the square of the distinct fingerprints, about 1/25 of
    all pairs being left, and what a task holds stays the same.
    """
    prints = written(fingerprints(docs, id_col, text_col), "fingerprints")
    named = clusters(prints, radius).select("fp", "component_id")
    return prints.join(named, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def only_at(rows: DataFrame, chosen: DataFrame, place: str) -> DataFrame:
    """The rows whose place is one of chosen, a numbering by monotonically_increasing_id().

    chosen becomes one bitmap of 4 kB for each 32,768 places of a piece of the table, and
    rows look up their bit. So the join has a row for each bitmap, which Spark broadcasts
    as long as its measured size allows: the rows then stay where they are.
    """
    number = F.bitmap_bucket_number(place)
    maps = chosen.groupBy(number.alias("_number")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("_bits")
    )
    maps = written(maps, "bitmaps")
    at = F.bitmap_bit_position(place)
    byte = F.substring("_bits", F.floor(at / 8).cast("int") + 1, F.lit(1))
    bit = F.conv(F.hex(byte), 16, 10).cast("int").bitwiseAND(F.pow(F.lit(2), at % 8).cast("int"))
    joined = rows.join(maps, number == F.col("_number"))
    return joined.filter(bit != 0).drop("_number", "_bits")


def keep_one_each(
    docs: DataFrame, *, radius: int = 2, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """docs with one row of each component of simhash_components(), all columns kept.

    It is the row with the least id; of rows that share that id and their fingerprint, the
    one whose text has the least SHA-256, and of rows that share that too the first of the
    table. It is chosen by numbers alone; texts are written once with their fingerprints,
    and read again where they lie to take the chosen rows: see only_at().
    """
    row = F.struct(*(F.col(c) for c in docs.columns))
    held = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"), row.alias("row")
    )
    schema = T.StructType([*held.schema.fields, T.StructField("fp", T.LongType())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t) for t in utf8(batch.column(1))], np.uint64)
            columns = [*batch.columns, pa.array(found.view(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    digest = F.sha2(F.coalesce("text", F.lit("")), 256)
    marked = held.mapInArrow(run, schema).select(
        "doc_id", "fp", digest.alias("digest"), F.monotonically_increasing_id().alias("place"), "row"
    )
    marked = written(marked, "marked")
    named = clusters(marked.select("doc_id", "fp"), radius).filter("keeper")
    least = F.min(F.struct("digest", "place")).alias("least")
    single = marked.groupBy("fp", "doc_id").agg(least).select("fp", "doc_id", "least.place")
    kept = named.select("fp", F.col("least").alias("doc_id"))
    same = (single["fp"] == kept["fp"]) & single["doc_id"].eqNullSafe(kept["doc_id"])
    chosen = single.join(kept, same, "left_semi").select("place")
    return only_at(marked.select("place", "row"), chosen, "place").select("row.*")
