"""Quality rules by compression: texts outside length-specific bands are rejected."""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from newsprep.llm.shared import utf8

#: (code points, least ratio, greatest ratio), between which limits go with the logarithm of
#: the length. Prose of one byte a code point has about 1.5, 1.7, 1.9, 2.05, 2.2, 2.3, 2.4 at
#: these lengths. The least are 0.72 of that, which text of random letters does not reach;
#: the greatest are 1.4 times that, which the terms of licences, as formal as prose gets,
#: stay a tenth below, and text that says things again and again does not.
BANDS = (
    (250, 1.08, 2.1),
    (600, 1.22, 2.38),
    (1200, 1.37, 2.66),
    (2500, 1.48, 2.87),
    (6000, 1.58, 3.08),
    (16000, 1.66, 3.25),
    (64000, 1.73, 3.5),
)
#: The greatest are for one byte a code point. A script of two or three compresses
#: further, as its leading bytes say little: by this much for each byte more.
WIDER = 0.5
#: Bytes of a fixed chunk, its band, and the share of chunks that may lie outside it. A
#: last chunk of under half the size belongs to the one before.
CHUNK, CHUNK_BAND, CHUNK_SHARE = 4096, (1.4, 3.4), 0.25
LEVEL = 3

SPACE, SYMBOLS = b"\t\n\x0b\x0c\r ", b"#*$%&|<>"

VERDICT = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("word_chars", T.LongType()),
        T.StructField("n_symbols", T.LongType()),
        T.StructField("n_dup_lines", T.LongType()),
        T.StructField("n_repeat_words", T.LongType()),
        T.StructField("base_failed", T.BooleanType()),
        T.StructField("whole_ratio", T.DoubleType()),
        T.StructField("n_chunks", T.LongType()),
        T.StructField("chunks_outside", T.LongType()),
        T.StructField("band_reason", T.StringType()),
        T.StructField("reason", T.StringType()),
        T.StructField("kept", T.BooleanType()),
    ]
)


def repeated_words(words: list[bytes]) -> int:
    """How many words lie in a 3-word window that occurs twice or more."""
    n = len(words) - 2
    if n < 2:
        return 0
    ids = {w: i for i, w in enumerate(dict.fromkeys(words))}
    v = np.fromiter(map(ids.__getitem__, words), np.int64, len(words))
    pairs = v[:-1] * len(ids) + v[1:]
    if len(ids) ** 3 >= 1 << 63:
        pairs = np.unique(pairs, return_inverse=True)[1]
    windows = pairs[:n] * len(ids) + v[2:]
    _, place, times = np.unique(windows, return_inverse=True, return_counts=True)
    again = times[place] > 1
    covered = np.zeros(len(words), bool)
    for shift in range(3):
        covered[shift : shift + n] |= again
    return int(covered.sum())


def duplicate_lines(text: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [line for line in text.split(b"\n") if line.strip(SPACE)]
    return len(lines) - len(set(lines))


def chunks(text: bytes) -> Iterator[memoryview]:
    view, start = memoryview(text), 0
    while len(view) - start >= CHUNK * 3 // 2:
        yield view[start : start + CHUNK]
        start += CHUNK
    if len(view) > start:
        yield view[start:]


def judge(text: bytes, press: zstandard.ZstdCompressor, bands: Sequence[tuple] = BANDS) -> tuple:
    """The values of VERDICT for one text."""
    words = text.split()
    word_bytes = b"".join(words)
    # Code points are the bytes that don't continue one.
    points = len(word_bytes.decode("utf-8", "replace")) if words else 0
    symbols = sum(map(text.count, (bytes([s]) for s in SYMBOLS)))
    repeats = repeated_words(words)
    failed = len(words) < 50 or 100 * repeats > 50 * len(words)
    whole = len(text) / len(press.compress(text)) if text else 0.0
    length = len(text.decode("utf-8", "replace"))
    at, lows, highs = zip(*bands)
    place = math.log(max(1, length))
    low, high = (float(np.interp(place, np.log(at), limits)) for limits in (lows, highs))
    # What the script adds: the bytes of a code point beyond the first.
    wide = 1 + WIDER * (len(text) / max(1, length) - 1)
    parts = outside = 0
    for part in chunks(text) if len(text) > CHUNK else ():
        parts += 1
        ratio = len(part) / len(press.compress(part))
        outside += not CHUNK_BAND[0] <= ratio <= CHUNK_BAND[1] * wide
    band_reason = (
        "incompressible" if whole < low
        else "repetitive" if whole > high * wide
        else "chunks" if outside > CHUNK_SHARE * parts
        else None
    )
    reason = "base" if failed else band_reason
    counts = len(words), points, symbols, duplicate_lines(text), repeats
    return *counts, failed, whole, parts, outside, band_reason, reason, reason is None


def compression_verdicts(
    docs: DataFrame,
    *,
    keep: list[str] | None = None,
    text_col: str = "text",
    prefix: str = "",
    bands: Sequence[tuple] = BANDS,
) -> DataFrame:
    """docs (its columns keep, all by default) with the columns of VERDICT, prefixed.

    kept is false where the base rules fail (under 50 words, or over half of them in
    repeated 3-word windows), where the zstandard ratio of the whole text lies outside
    the band of its length in code points, or where more than CHUNK_SHARE of the fixed
    chunks of a longer text lie outside theirs. Upper limits grow with the bytes that a
    text has a code point, so each script has its own. reason names the first that applies,
    band_reason the first of the bands, whether or not the base rules fail.

    A null text is an empty one, which fails the base rules. Columns of docs with the
    name of a new one are replaced. Rows are judged one by one where they are read:
    nothing is shuffled, and equal rows get equal verdicts.
    """
    fields = [T.StructField(prefix + f.name, f.dataType) for f in VERDICT]
    labels = [f.name for f in fields]
    keep = [c for c in (docs.columns if keep is None else keep) if c not in labels]
    read = keep + ([] if text_col in keep else [text_col])
    schema = T.StructType([docs.schema[c] for c in keep] + fields)
    types = [pa.int64()] * 5 + [pa.bool_(), pa.float64(), pa.int64(), pa.int64()]
    types += [pa.string(), pa.string(), pa.bool_()]
    at, width = read.index(text_col), len(keep)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=LEVEL)
        for batch in batches:
            rows = [judge(text, press, bands) for text in utf8(batch.column(at))]
            values = list(zip(*rows, strict=True)) or [()] * len(types)
            new = [pa.array(v, t) for v, t in zip(values, types, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:width], *new], [*keep, *labels])

    return docs.select(*read).mapInArrow(run, schema)
