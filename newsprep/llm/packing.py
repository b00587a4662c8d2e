"""Packing without padding: documents cut at the binary digits of their lengths."""

from __future__ import annotations

import json
import string
import zlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsprep.llm.shared import LOWER, prefix_sums, utf8, written

#: Words whose ids a worker remembers, from task to task, before it starts afresh; about
#: 200 bytes each.
REMEMBERED = 1_000_000


PUNCTUATION = string.punctuation.encode()
#: A pattern by which a run of signs after a letter or digit is always a piece of its own.
SIGNS_APART = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


#: Steps that leave lower-case Latin letters as they are, and the spelling of bytes.
PLAIN_STEPS = ({"type": "NFC"}, {"type": "Lowercase"})
AS_BYTES = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}


def _byte_letters() -> dict[int, int]:
    """The letter that stands for a byte: itself if it prints in Latin-1, else one from 256 on."""
    prints = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in prints]
    return {b: 256 + i for i, b in enumerate(others)}


BYTE_LETTERS = _byte_letters()


def _shortcuts(path: str) -> tuple[bool, bool]:
    """Whether a tokenizer file lowers letters and cuts by SIGNS_APART, and if so, whether
    the model sees a word of lower-case Latin letters as its bytes and nothing else."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    steps = (spec["normalizer"] or {}).get("normalizers", [])
    cuts = (spec["pre_tokenizer"] or {}).get("pretokenizers", [{}])
    apart = {"type": "Lowercase"} in steps and cuts[0].get("pattern") == {"Regex": SIGNS_APART}
    plain = all(s in PLAIN_STEPS or s.get("pattern") == {"Regex": r"\s+"} for s in steps)
    return apart, apart and plain and cuts[1:] == [AS_BYTES] and not spec["model"].get("dropout")


class WordIds(dict):
    """The ids of a word between ASCII white space, as little-endian 32-bit numbers.

    A tokenizer that drops white space gives a text the ids of its words in a row, so a
    word is encoded once for as long as it is remembered. If the file's pattern allows it,
    a word with signs at its end, or with capitals, is put together from what is known of
    the word without them, and a word of lower-case Latin letters goes to the model itself:
    what normalizes and cuts a text has nothing to do in it, but takes most of the time.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        super().__init__()
        tokenizer = Tokenizer.from_file(path)
        self.encode = tokenizer.encode
        added = tokenizer.get_added_tokens_decoder().values()
        # With any of these characters a word may hold a special string.
        self.special = [t.content.encode()[:1] for t in added]
        self.apart, self.letters_alone = _shortcuts(path)
        self.model = tokenizer.model

    def __missing__(self, word: bytes) -> bytes:
        value = None
        if self.apart and not any(c in word for c in self.special):
            stem = word.rstrip(PUNCTUATION)
            if stem != word and stem[-1:].isalnum():
                value = self[stem] + self[word[len(stem) :]]
            elif (lower := word.translate(LOWER)) != word:
                value = self[lower]
        if value is None:
            value = np.array(self.ids(word.decode("utf-8", "replace")), "<u4").tobytes()
        self[word] = value
        return value

    def ids(self, word: str) -> list[int]:
        # Letters below U+0250 are single code points that no normal form changes.
        if self.letters_alone and word.isalpha() and max(word) < "\u0250" and word.lower() == word:
            spelt = word.encode().decode("latin-1").translate(BYTE_LETTERS)
            return [token.id for token in self.model.tokenize(spelt)]
        return self.encode(word, add_special_tokens=False).ids


@lru_cache(maxsize=1)
def word_ids(path: str) -> WordIds:
    """The words that this Python worker knows of a tokenizer file."""
    return WordIds(path)


def binary_pieces(n: int, most: int) -> list[tuple[int, int]]:
    """(start, length): as many pieces of length most as fit, then one per digit of the rest."""
    pieces = [(start, most) for start in range(0, n - most + 1, most)]
    start = n - n % most
    for bit in reversed(range(most.bit_length() - 1)):
        if n >> bit & 1:
            pieces.append((start, 1 << bit))
            start += 1 << bit
    return pieces


def pack_binary(
    docs: DataFrame,
    tokenizer: str,
    *,
    end_id: int = 2,
    most: int = 4096,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A document's ids are those of its text and end_id. It is cut into pieces of most, a
    power of two, and of one smaller power of two for each binary digit of the rest, the
    largest first. Each piece is a sequence of its own, so no sequence holds two
    documents and none is padded; offset is 0. Sequences of equal length are numbered
    together, the shortest first, gapless from 0 over all of them, so a trainer reads a
    length as one range of sequence_id. with_ids adds the ids as an array.

    A null or empty text is the piece of end_id alone. Repeated rows are packed once
    each, a null id stays null, an empty table gives no rows, other columns are ignored.
    Memory in a task is bounded by an Arrow batch and REMEMBERED words. Texts are never
    shuffled: the numbering moves one row of lengths and checksums per document (and the
    ids where they are asked for).

    The tokenizer must drop white space and see words alone, as one does whose pattern
    keeps nothing of white space; ids are then those of the whole text.
    """
    bits = most.bit_length()
    if most != 1 << (bits - 1):
        raise ValueError("most must be a power of two")
    piece = pa.struct(
        [("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())]
        + [("ids", pa.list_(pa.int32()))] * with_ids
    )
    out = pa.schema(
        [("doc_id", pa.int64()), ("part", pa.int32()), ("pos", pa.int64())]
        + [("doc_tokens", pa.int64()), ("pieces", pa.list_(piece))]
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, part, pos = word_ids(tokenizer), TaskContext.get().partitionId(), 0
        end = end_id.to_bytes(4, "little")
        for batch in batches:
            tokens, pieces = [], []
            for text in utf8(batch.column(1)):
                ids = b"".join(map(words.__getitem__, text.split())) + end
                tokens.append(len(ids) // 4)
                cut = []
                for start, length in binary_pieces(tokens[-1], most):
                    held = ids[4 * start : 4 * (start + length)]
                    row = {"start": start, "length": length, "ids_crc32": zlib.crc32(held)}
                    cut.append(row | ({"ids": memoryview(held).cast("i")} if with_ids else {}))
                pieces.append(cut)
                if len(words) > REMEMBERED:
                    words.clear()
            n = len(tokens)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([part] * n, pa.int32()),
                    pa.array(range(pos, pos + n), pa.int64()),
                    pa.array(tokens, pa.int64()),
                    pa.array(pieces, out.field("pieces").type),
                ],
                schema=out,
            )
            pos += n

    fields = "start: bigint, length: bigint, ids_crc32: bigint"
    fields += ", ids: array<int>" if with_ids else ""
    cut = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), text_col).mapInArrow(
        run,
        "doc_id bigint, part int, pos bigint, doc_tokens bigint, "
        f"pieces array<struct<{fields}>>",
    )
    cut = written(cut, "pieces")
    # How many sequences of length 2 ** k a document has, from its length alone.
    tokens = F.col("doc_tokens")
    counts = {str(k): F.shiftright(tokens, k).bitwiseAND(1) for k in range(bits - 1)}
    counts[str(bits - 1)] = F.shiftright(tokens, bits - 1)
    numbered, total = prefix_sums(cut, counts)
    first, start = [], 0
    for k in range(bits):
        first.append(F.col(f"before_{k}") + start)
        start += total[str(k)]
    sequence = F.array(*first)
    exploded = numbered.select(
        "doc_id", "doc_tokens", sequence.alias("first"), F.posexplode("pieces").alias("i", "p")
    )
    # Only pieces of the full length can be several; they come first, so i counts them.
    again = F.when(F.col("p.length") == most, F.col("i")).otherwise(0)
    rank = F.log2("p.length").cast("int")
    return exploded.select(
        "doc_id",
        "p.start",
        "p.length",
        "p.ids_crc32",
        "doc_tokens",
        (F.get("first", rank) + again).alias("sequence_id"),
        F.lit(0).cast("bigint").alias("offset"),
        *(["p.ids"] if with_ids else []),
    )
