"""Token counts by joining pieces per distinct pre-token with frequencies per document."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsprep.llm.shared import slices, written

#: The pattern of byte-level pre-tokenizers, a fixed value.
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: The most frequent pre-tokens are looked up where the documents are read: so many at
#: most, of so many characters at most. It bounds the broadcast to some MB; all others
#: are joined.
FREQUENT, FREQUENT_CHARS = 1 << 18, 32
#: Distinct entries that a worker holds before it passes them on or forgets them.
HELD = 150_000
#: Bytes of text whose frequencies are built at a time.
SLICE = 4 << 20


def _specials(path: str) -> list[str]:
    from tokenizers import Tokenizer

    added = Tokenizer.from_file(path).get_added_tokens_decoder().values()
    if any(t.single_word or t.lstrip or t.rstrip for t in added):
        raise ValueError("added tokens that depend on their surroundings aren't supported")
    return sorted((t.content for t in added), key=len, reverse=True)


class Words:
    """Cuts texts where a pre-token always begins, and cuts these words into pre-tokens.

    A space that a non-space follows begins a pre-token whatever precedes it, so a text
    is cut there first, and only distinct words meet the pattern.
    """

    def __init__(self, specials: list[str]):
        self.special = re.compile("|".join(map(re.escape, specials))) if specials else None
        self.odd = re.compile(r" \s| \Z").search
        self.cut = re.compile(r" (?=\S)").split
        self.pieces = regex.compile(PRE_TOKEN).findall

    def count(self, text: str) -> tuple[Counter, Counter, int]:
        """How often each word occurs after a space, without it; the words that begin a
        section; and the number of special strings, which part sections.
        """
        sections = self.special.split(text) if self.special else [text]
        words, firsts = Counter(), Counter()
        for section in sections:
            if section:
                first, *rest = self.cut(section) if self.odd(section) else section.split(" ")
                words.update(rest)
                firsts[first] += 1
        return words, firsts, len(sections) - 1

    def pre_tokens(self, word: str, is_first: bool) -> list[str]:
        return self.pieces(word if is_first else " " + word)


def _text(value: pa.Scalar) -> str:
    return value.as_py() or ""


def pre_token_table(docs: DataFrame, tokenizer: str, text_col: str = "text") -> DataFrame:
    """(pre_token, n, pieces): each distinct pre-token, its count, its number of ids."""
    specials = _specials(tokenizer)
    flat = pa.schema([("pre_token", pa.string()), ("n", pa.int64())])

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter = Words(specials)

        def flush() -> pa.RecordBatch:
            found: Counter = Counter()
            for is_first, words in enumerate(held):
                for word, n in words.items():
                    for p in cutter.pre_tokens(word, bool(is_first)):
                        found[p] += n
                words.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(found.keys(), pa.string()), pa.array(found.values(), pa.int64())],
                schema=flat,
            )

        held: tuple[Counter, Counter] = (Counter(), Counter())
        for batch in batches:
            for value in batch.column(0):
                found = cutter.count(_text(value))
                held[0].update(found[0])
                held[1].update(found[1])
                if len(held[0]) > HELD:
                    yield flush()
        yield flush()

    def pieces(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from tokenizers import Tokenizer

        encode = Tokenizer.from_file(tokenizer).encode
        for batch in batches:
            found = [
                len(encode(_text(p), add_special_tokens=False).ids) for p in batch.column(0)
            ]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(found, pa.int64())], ["pre_token", "n", "pieces"]
            )

    counted = docs.select(text_col).mapInArrow(count, "pre_token string, n bigint")
    counted = counted.groupBy("pre_token").agg(F.sum("n").alias("n"))
    return counted.mapInArrow(pieces, "pre_token string, n bigint, pieces bigint")


def _frequent(table: DataFrame) -> dict[str, int]:
    """The pieces of the most frequent pre-tokens, FREQUENT at most.

    A histogram of counts (64 rows per factor of 2 at most) gives the least count that
    keeps to the bound, so nothing is sorted.
    """
    short = table.filter(F.length("pre_token") <= FREQUENT_CHARS)
    step = F.floor(F.log2("n") * 16).cast("int")
    bins = short.groupBy(step.alias("step")).count().collect()
    least, held = None, 0
    for row in sorted(bins, reverse=True):
        held += row["count"]
        if held > FREQUENT:
            break
        least = row["step"]
    if least is None:
        return {}
    rows = short.filter(step >= least).select("pre_token", "pieces").toPandas()
    return dict(zip(rows["pre_token"], rows["pieces"].tolist(), strict=True))


def token_counts(
    docs: DataFrame,
    tokenizer: str,
    *,
    limit: int = 512,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per row of docs: doc_id, n_bytes, n_tokens, over_limit.

    n_tokens is the number of ids that a byte-level tokenizer file gives the whole text
    without adding any; a special string in a text is one. Each distinct pre-token of
    the corpus is encoded once. Frequencies per document are joined with that table: the
    FREQUENT most frequent pre-tokens from a broadcast of bounded size, all others by a
    shuffle, in which none of them can be hot. Ids are never kept.

    A null text counts as empty: 0 bytes and tokens. Repeated rows and null ids are rows
    like any other, an empty table gives no rows, other columns are ignored.
    """
    specials = _specials(tokenizer)
    pre_tokens = written(pre_token_table(docs, tokenizer, text_col), "pre-tokens")
    frequent = docs.sparkSession.sparkContext.broadcast(_frequent(pre_tokens))
    rare = pa.struct([("pre_token", pa.string()), ("n", pa.int64())])
    out = pa.schema(
        [("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("known", pa.int64())]
        + [("rare", pa.list_(rare))]
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter, pieces = Words(specials), frequent.value

        def looked_up(word: str, is_first: bool) -> tuple[int, list[str]]:
            found = cutter.pre_tokens(word, is_first)
            rest = [p for p in found if p not in pieces]
            return sum(pieces.get(p, 0) for p in found), rest

        memo: dict[str, tuple[int, list[str]]] = {}
        for batch in slices(batches, 1, SLICE):
            sizes, known, names, numbers, offsets = [], [], [], [], [0]
            for value in batch.column(1):
                text = _text(value)
                sizes.append(len(text.encode()))
                words, firsts, total = cutter.count(text)
                left: Counter = Counter()
                for word, n in words.items():
                    if (held := memo.get(word)) is None:
                        held = memo[word] = looked_up(word, False)
                    total += n * held[0]
                    for p in held[1]:
                        left[p] += n
                for word, n in firsts.items():
                    held = looked_up(word, True)
                    total += n * held[0]
                    for p in held[1]:
                        left[p] += n
                known.append(total)
                names.extend(left)
                numbers.extend(left.values())
                offsets.append(len(names))
                if len(memo) > HELD:
                    memo.clear()
            flat = pa.StructArray.from_arrays(
                [pa.array(names, pa.string()), pa.array(numbers, pa.int64())], fields=list(rare)
            )
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(sizes, pa.int64()),
                    pa.array(known, pa.int64()),
                    pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), flat),
                ],
                schema=out,
            )

    counted = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), text_col).mapInArrow(
        run,
        "doc_id bigint, n_bytes bigint, known bigint, "
        "rare array<struct<pre_token: string, n: bigint>>",
    )
    # Written, so that rows keep their numbers in both uses below.
    counted = written(counted.withColumn("row", F.monotonically_increasing_id()), "frequencies")
    pairs = counted.select("row", F.inline("rare")).withColumnRenamed("n", "times")
    rest = (
        pairs.join(pre_tokens.select("pre_token", "pieces"), "pre_token")
        .groupBy("row")
        .agg(F.sum(F.col("times") * F.col("pieces")).alias("rest"))
    )
    n_tokens = F.col("known") + F.coalesce("rest", F.lit(0))
    return (
        counted.select("row", "doc_id", "n_bytes", "known")
        .join(rest, "row", "left")
        .select("doc_id", "n_bytes", n_tokens.alias("n_tokens"))
        .withColumn("over_limit", F.col("n_tokens") > limit)
    )
