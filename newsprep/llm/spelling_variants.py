"""Spelling variants of a corpus' words, found through Bloom filters.

Every word probes the edits of itself against blocked Bloom filters of the vocabulary, one
set of filters for each word length. What they let through goes to a join with the
vocabulary, which takes out the few false ones. An edit is never spelled out before it
has passed: the hash of a word is a polynomial of its code points, so that of an edit
follows from the word's own by a few multiplications.

Each pair of near words is found once: the shorter of two lengths from the longer by a
deletion, equal lengths from the word with the lower code point by a replacement.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsprep.llm.shared import LOWER, slices, written

#: Code points of words after A-Z are lower-cased.
ALPHABET = np.array([*range(ord("a"), ord("z") + 1), *range(0xC0, 0x100)], dtype=np.uint64)
#: A run of so many letters may become a word; the run's own code points in UTF-8.
RUN = rb"(?:[a-z]|\xc3[\x80-\xbf])"

#: Words counted in a task before their counts are sent.
HELD = 200_000
#: Bytes of text looked at together.
SLICE = 4_000_000
#: A block has 8 lanes of 32 bits and one bit of a word in each.
LANES = 8
#: Words to a block on average, which lets about 1 in 1,000 foreign edits through.
PER_BLOCK = 16
#: Blocks that one task fills: 512 KB.
SEGMENT = 1 << 14
#: Blocks broadcast at once: 32 MB. A larger vocabulary is probed in several passes.
PASS = 1 << 20
#: Lengths from here on share a set of filters.
LONGEST = 64
#: Bytes of words, and probes, worked on at once.
WORDS = 16_384
PROBES = 1 << 20

BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
SALTS = np.array([0x47B6137B, 0x44974D91, 0x8824AD5B, 0xA2B7289D, 0x705495C7, 0x2DF1424B, 0x9EFC4947, 0x5C6BFB31],
                 dtype=np.uint32)


def _counts(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Counts of words, after the rule that deletes a letter of some runs."""
    runs = re.compile(RUN + b"{%d,}" % length)
    held: dict = {}

    def sent():
        return pa.RecordBatch.from_arrays(
            [pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], ["word", "n"])

    for batch in slices(batches, 1, SLICE):
        for doc, text in zip(batch.column(0), batch.column(1)):
            if not text.is_valid:
                continue
            head = zlib.crc32(b"" if not doc.is_valid else doc.as_py().encode())
            head = zlib.crc32(b":", head)
            own: dict = {}
            for run in runs.findall(text.as_py().encode().translate(LOWER)):
                own[run] = own.get(run, 0) + 1
            for run, n in own.items():
                h = zlib.crc32(run, head)
                word = run.decode()
                if h % 31 == 0:
                    at = h % len(word)
                    word = word[:at] + word[at + 1 :]
                if len(word) >= length:
                    held[word] = held.get(word, 0) + n
            if len(held) >= HELD:
                yield sent()
                held = {}
    yield sent()


def vocabulary(df: DataFrame, *, key: str, text: str, length: int = 7, times: int = 2) -> DataFrame:
    """The words and their counts, counted within tasks before the exchange."""
    rows = df.select(F.col(key).cast("string").alias("doc"), F.col(text).alias("text"))
    counted = rows.mapInArrow(lambda b: _counts(b, length), "word string, n bigint")
    counted = counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= times)
    return counted.withColumn("length", F.length("word"))


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread a polynomial hash over all 64 bits."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


def by_length(words: list[str]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, places in the list, code points as a matrix) for each length that occurs."""
    lengths = np.array([len(w) for w in words])
    for length in np.unique(lengths):
        at = np.flatnonzero(lengths == length)
        points = "".join(words[i] for i in at).encode("utf-32-le")
        yield int(length), at, np.frombuffer(points, dtype="<u4").reshape(len(at), length).astype(np.uint64)


def powers(length: int) -> np.ndarray:
    """BASE to the power of the letters that follow each place."""
    out = np.ones(length, dtype=np.uint64)
    if length > 1:
        out[:-1] = np.cumprod(np.full(length - 1, BASE, dtype=np.uint64))[::-1]
    return out


def places(h: np.ndarray, blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """The block of each mixed hash, and the 32 bits that choose a bit in every lane."""
    block = ((h >> np.uint64(32)) * np.uint64(blocks)) >> np.uint64(32)
    return block.astype(np.int64), h.astype(np.uint32)


def _slots(batches: Iterator[pa.RecordBatch], filters: dict) -> Iterator[pa.RecordBatch]:
    """Where each word's bits lie: the segment of its filter, the block in it, the hash."""
    for batch in slices(batches, 0, WORDS * 16):
        for length, _, points in by_length(batch.column(0).to_pylist()):
            start, blocks = filters[min(length, LONGEST)]
            h = mixed((points * powers(length)).sum(axis=1, dtype=np.uint64))
            block, bits = places(h, blocks)
            block += start
            yield pa.RecordBatch.from_arrays(
                [pa.array(block // SEGMENT), pa.array((block % SEGMENT).astype(np.int32)), pa.array(bits.astype(np.int64))],
                ["segment", "block", "bits"],
            )


def _filled(key: tuple[pa.Scalar, ...], slots: pa.Table) -> pa.Table:
    """One segment: its blocks with a bit set in each lane for every word."""
    lanes = np.zeros((SEGMENT, LANES), dtype=np.uint32)
    block, bits = slots["block"].to_numpy(), slots["bits"].to_numpy().astype(np.uint32)
    for lane in range(LANES):
        np.bitwise_or.at(lanes[:, lane], block, np.uint32(1) << ((bits * SALTS[lane]) >> np.uint32(27)))
    return pa.table({"segment": pa.array([key[0].as_py()], pa.int64()), "lanes": pa.array([lanes.tobytes()], pa.binary())})


def passed(lanes: np.ndarray, block: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Places of the probes whose bits are all set; each lane is read for what is left only."""
    left = None
    for lane in range(LANES):
        at, own = (block, bits) if left is None else (block[left], bits[left])
        hit = (lanes[at, lane] >> ((own * SALTS[lane]) >> np.uint32(27))) & np.uint32(1)
        left = np.flatnonzero(hit) if left is None else left[hit.astype(bool)]
        if not len(left):
            break
    return left


def _probed(batches: Iterator[pa.RecordBatch], filters: dict, held, first: int, last: int) -> Iterator[pa.RecordBatch]:
    """Edits of the words that pass the filters whose blocks lie in first to last."""
    lanes = np.frombuffer(held.value, dtype=np.uint32).reshape(-1, LANES)

    def hits(hashes: np.ndarray, length: int) -> np.ndarray:
        if min(length, LONGEST) not in filters:
            return np.empty(0, dtype=np.int64)
        start, blocks = filters[min(length, LONGEST)]
        if start >= last or start + blocks <= first:
            return np.empty(0, dtype=np.int64)
        block, bits = places(mixed(hashes), blocks)
        block += start - first
        if start >= first and start + blocks <= last:
            return passed(lanes, block, bits)
        inside = np.flatnonzero((block >= 0) & (block < last - first))
        return inside[passed(lanes, block[inside], bits[inside])]

    def edits(words: list[str]) -> Iterator[tuple[int, str]]:
        for length, at, points in by_length(words):
            power = powers(length)
            terms = points * power
            whole = terms.sum(axis=1, dtype=np.uint64)
            # A deletion moves what lies before it down by one power; one of equal neighbours is enough.
            before = np.zeros_like(terms)
            before[:, 1:] = np.cumsum(points[:, :-1] * power[1:], axis=1, dtype=np.uint64)
            after = whole[:, None] - np.cumsum(terms, axis=1, dtype=np.uint64)
            other = np.ones(points.shape, dtype=bool)
            other[:, 1:] = points[:, 1:] != points[:, :-1]
            row, place = np.nonzero(other)
            for hit in hits((before + after)[row, place], length - 1):
                w, i = words[at[row[hit]]], int(place[hit])
                yield at[row[hit]], w[:i] + w[i + 1 :]
            # Replacements by letters that come later, some places of all words at a time.
            step = max(1, PROBES // (len(at) * len(ALPHABET)))
            for begin in range(0, length, step):
                own = points[:, begin : begin + step]
                gain = ALPHABET[None, None, :] - own[:, :, None]
                row, place, letter = np.nonzero(ALPHABET[None, None, :] > own[:, :, None])
                hashes = whole[row] + gain[row, place, letter] * power[begin + place]
                for hit in hits(hashes, length):
                    w, i = words[at[row[hit]]], begin + int(place[hit])
                    yield at[row[hit]], w[:i] + chr(int(ALPHABET[letter[hit]])) + w[i + 1 :]

    for part in slices(batches, 0, WORDS):
        words, counts = part.column(0).to_pylist(), part.column(1).to_numpy()
        found = list(edits(words))
        yield pa.RecordBatch.from_arrays(
            [pa.array([words[i] for i, _ in found], pa.string()),
             pa.array([counts[i] for i, _ in found], pa.int64()),
             pa.array([e for _, e in found], pa.string())],
            ["word", "n", "near"],
        )


def near_words(words: DataFrame) -> DataFrame:
    """Every pair of near words, once: word, n, near and the near word's count m.

    words is a written table of word, n and length. The driver sees a count for each
    length, and the filters of one pass at a time, PASS blocks of 32 bytes.
    """
    spark = words.sparkSession
    sizes = words.groupBy(F.least("length", F.lit(LONGEST)).alias("length")).count().collect()
    filters, total = {}, 0
    for size in sorted(sizes, key=lambda r: r["length"]):
        blocks = -(-size["count"] // PER_BLOCK)
        filters[size["length"]] = (total, blocks)
        total += blocks
    if not total:
        return words.select("word", "n", F.col("word").alias("near"), F.col("n").alias("m"))
    slots = words.select("word").mapInArrow(lambda b: _slots(b, filters), "segment bigint, block int, bits bigint")
    segments = written(slots.groupBy("segment").applyInArrow(_filled, "segment bigint, lanes binary"), "bloom")

    found = None
    for first in range(0, total, PASS):
        last = min(first + PASS, total)
        own = segments.filter(F.col("segment").between(first // SEGMENT, (last - 1) // SEGMENT)).collect()
        # A block that no word has chosen leaves no row, if its whole segment is empty.
        lanes = bytearray((-(-(last - first) // SEGMENT)) * SEGMENT * LANES * 4)
        for s in own:
            at = (s["segment"] * SEGMENT - first) * LANES * 4
            lanes[at : at + len(s["lanes"])] = s["lanes"]
        held = spark.sparkContext.broadcast(bytes(lanes))
        del own, lanes

        def probe(batches, held=held, first=first, last=last):
            return _probed(batches, filters, held, first, last)

        probed = words.select("word", "n").mapInArrow(probe, "word string, n bigint, near string")
        found = probed if found is None else found.unionByName(probed)
    known = words.select(F.col("word").alias("near"), F.col("n").alias("m"))
    return found.join(known, "near").select("word", "n", "near", "m")


def spelling_variants(
    df: DataFrame, *, key: str = "doc_id", text: str = "text", length: int = 7, times: int = 2, factor: int = 10
) -> DataFrame:
    """The words of a corpus with the form that each is taken for, and that form's last form.

    Runs of letters are lower-cased and some lose a letter by a fixed rule of key and run.
    Words have ``length`` code points or more and occur ``times`` or more. A word's form is
    its near word (one code point inserted, deleted or replaced) of the largest count, the
    least in code-point order of several, if that count is ``factor`` times its own.

    Null texts have no words, a null key is empty text in the rule. Repeated rows count
    again. An empty table gives no rows; other columns are ignored.
    """
    words = written(vocabulary(df, key=key, text=text, length=length, times=times), "vocabulary")
    pairs = written(near_words(words), "near-words")
    both = pairs.select("word", "near", "m").unionByName(
        pairs.select(F.col("near").alias("word"), F.col("word").alias("near"), F.col("n").alias("m")))
    best = both.groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("m")).alias("m"), "near")).alias("best"))
    formed = words.select("word", "n").join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(-F.col("best.m") >= factor * F.col("n"), F.col("best.near")).alias("form"),
        F.when(-F.col("best.m") >= factor * F.col("n"), -F.col("best.m")).alias("form_n"),
    )
    formed = written(formed, "forms")
    # Counts grow by the factor from form to form, so chains are short; each round doubles
    # the part of a chain that is known.
    links = formed.filter("form IS NOT NULL").select("word", F.col("form").alias("root"))
    largest = formed.agg(F.max("n")).first()[0] or 1
    depth, reach = 0, times
    while reach * factor <= largest:
        depth, reach = depth + 1, reach * factor
    known = 1
    while known < depth:
        onward = links.select(F.col("word").alias("root"), F.col("root").alias("further"))
        links = written(
            links.join(onward, "root", "left").select("word", F.coalesce("further", "root").alias("root")), "roots")
        known *= 2
    return formed.join(links, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
