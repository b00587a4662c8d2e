"""Benchmark decontamination: an FM-index per shard, searched backwards for phrases."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from newsprep.llm.shared import utf8

#: Words of a window, words of a shard (a longer document is a shard of its own), and the
#: distance of sampled suffix positions.
WINDOW, SHARD_WORDS, SAMPLING = 13, 1 << 20, 32
#: Windows that a broadcast holds, and occurrences located at a time.
BLOCK_WINDOWS, LOCATED = 200_000, 1 << 18

#: Lower-cases A-Z and blanks every ASCII byte that isn't of a word.
WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
    for b in range(256)
)


def words_of(text: bytes) -> list[bytes]:
    return text.translate(WORD_BYTES).split()


def suffix_array(text: np.ndarray) -> np.ndarray:
    """All suffixes in order. The last symbol of the text must occur once.

    A suffix's rank is where its group of equal prefixes begins. Each round compares the
    members of groups that are left by the ranks of what follows, so the compared length
    triples (or doubles, for texts whose ranks don't fit three to a number).
    """
    n = len(text)
    parts = 3 if (n + 2) ** 3 < 1 << 63 else 2
    base = n + 2
    rank, open_, depth = text.astype(np.int64), np.arange(n), 1
    first = True
    while len(open_):
        key = rank[open_]
        for k in range(1, parts):
            at = open_ + k * depth
            after = np.where(at < n, rank[np.minimum(at, n - 1)] + 1, 0)
            key = key * base + after
        order = np.argsort(key, kind="stable")
        key, open_ = key[order], open_[order]
        old = np.zeros(len(key), np.int64) if first else rank[open_]
        places = np.arange(len(key))
        group = np.maximum.accumulate(np.where(np.diff(old, prepend=-1) != 0, places, 0))
        fresh = np.diff(key, prepend=key[0] - 1) != 0
        run = np.maximum.accumulate(np.where(fresh, places, 0))
        rank[open_] = old + run - group
        alone = fresh & np.append(fresh[1:], True)
        open_, depth, first = open_[~alone], depth * parts, False
    suffixes = np.empty(n, np.int64)
    suffixes[rank] = np.arange(n)
    return suffixes


class WaveletMatrix:
    """Ranks of symbols in a sequence, a bit vector for each binary digit."""

    def __init__(self, sequence: np.ndarray, symbols: int):
        self.levels = []
        for shift in reversed(range(max(1, (symbols - 1).bit_length()))):
            bits = (sequence >> shift & 1).astype(bool)
            packed = np.packbits(bits, bitorder="little")
            words = np.zeros(len(bits) // 64 + 1, np.uint64)
            words.view(np.uint8)[: len(packed)] = packed
            before = np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)])
            zeros = len(bits) - int(before[-1])
            self.levels.append((shift, words, before, zeros))
            sequence = np.concatenate([sequence[~bits], sequence[bits]])

    @staticmethod
    def _ones(words: np.ndarray, before: np.ndarray, at: np.ndarray) -> np.ndarray:
        block = at >> 6
        mask = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return before[block] + np.bitwise_count(words[block] & mask)

    def ranks(self, symbols: np.ndarray, *ends: np.ndarray) -> list[np.ndarray]:
        """For each array of ends: how often symbols[i] occurs before ends[i]."""
        held = [np.zeros_like(symbols), *ends]
        for shift, words, before, zeros in self.levels:
            one = (symbols >> shift & 1).astype(bool)
            ones = [self._ones(words, before, at) for at in held]
            held = [np.where(one, zeros + o, at - o) for at, o in zip(held, ones, strict=True)]
        return [at - held[0] for at in held[1:]]

    def access(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbols at these places, and how often each occurs before."""
        symbols, start, place = np.zeros_like(at), np.zeros_like(at), at
        for _, words, before, zeros in self.levels:
            one = (words[place >> 6] >> (place & 63).astype(np.uint64) & np.uint64(1)).astype(bool)
            symbols = symbols * 2 + one
            both = [(p, self._ones(words, before, p)) for p in (start, place)]
            start, place = (np.where(one, zeros + o, p - o) for p, o in both)
        return symbols, place - start


class FMIndex:
    """Counts and finds phrases in a text of numbers below symbols."""

    def __init__(self, text: np.ndarray, symbols: int):
        suffixes = suffix_array(text)
        self.n = len(text)
        self.first = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=symbols))])
        self.last = WaveletMatrix(text[suffixes - 1].astype(np.int64), symbols)
        sampled = suffixes % SAMPLING == 0
        self.samples = suffixes[sampled]
        self.rank = np.concatenate([[0], np.cumsum(sampled)])

    def search(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The rows [low, high) of suffixes that begin with each phrase.

        phrases has the symbols of a phrase from its end, one row for each phrase.
        """
        low, high = np.zeros(len(lengths), np.int64), np.full(len(lengths), self.n)
        for step in range(phrases.shape[1]):
            live = np.flatnonzero((lengths > step) & (low < high))
            if not len(live):
                break
            symbols = phrases[live, step].astype(np.int64)
            a, b = self.last.ranks(symbols, low[live], high[live])
            low[live], high[live] = self.first[symbols] + a, self.first[symbols] + b
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Where the suffixes of these rows begin: steps back to a sampled position."""
        found, walking, rows = np.empty(len(rows), np.int64), np.arange(len(rows)), rows.copy()
        steps = 0
        while len(walking):
            held = self.rank[rows + 1] > self.rank[rows]
            found[walking[held]] = self.samples[self.rank[rows[held]]] + steps
            walking, rows = walking[~held], rows[~held]
            symbols, before = self.last.access(rows)
            rows, steps = self.first[symbols] + before, steps + 1
        return found


class Phrases:
    """The windows of some items, as numbers of their distinct words."""

    def __init__(self, items: list[tuple[str, list[bytes]]]):
        numbers: dict[bytes, int] = {}
        rows, self.item, self.names = [], [], [name for name, _ in items]
        for k, (_, words) in enumerate(items):
            ids = [numbers.setdefault(w, len(numbers)) for w in words]
            width = min(WINDOW, len(ids))
            for start in range(len(ids) - width + 1):
                rows.append(ids[start : start + width][::-1])
                self.item.append(k)
        self.words = list(numbers)
        self.lengths = np.array(list(map(len, rows)), np.int64)
        self.reversed = np.zeros((len(rows), WINDOW), np.int32)
        for row, ids in enumerate(rows):
            self.reversed[row, : len(ids)] = ids
        self.item = np.array(self.item, np.int64)

    def windows(self) -> int:
        return len(self.lengths)


def blocks_of(benchmark: DataFrame, id_col: str, text_col: str) -> Iterator[Phrases]:
    """The items with words, in blocks of about BLOCK_WINDOWS windows."""
    held, windows = [], 0
    for name, text in benchmark.select(id_col, text_col).toLocalIterator():
        if words := words_of((text or "").encode()):
            held.append(("" if name is None else str(name), words))
            windows += max(1, len(words) - WINDOW + 1)
            if windows >= BLOCK_WINDOWS:
                yield Phrases(held)
                held, windows = [], 0
    if held:
        yield Phrases(held)


def search_shard(
    documents: list[list[bytes]], blocks: Iterable[Phrases]
) -> tuple[np.ndarray, np.ndarray, list[set[str]]]:
    """Which words are hit, where documents begin among them, and the items by document."""
    numbers = {w: i for i, w in enumerate(dict.fromkeys(w for d in documents for w in d))}
    n_docs = len(documents)
    # Each document ends with a number of its own, so nothing matches across documents.
    ends = np.cumsum([len(d) + 1 for d in documents])
    starts = np.concatenate([[0], ends[:-1]])
    text = np.empty(int(ends[-1]), np.int64)
    for k, words in enumerate(documents):
        text[starts[k] : ends[k] - 1] = np.fromiter(
            map(numbers.__getitem__, words), np.int64, len(words)
        )
        text[ends[k] - 1] = len(numbers) + k
    index = FMIndex(text, len(numbers) + n_docs)
    change, items = np.zeros(len(text) + 1, np.int64), [set() for _ in documents]
    for phrases in blocks:
        known = np.array([numbers.get(w, -1) for w in phrases.words], np.int64)
        symbols = known[phrases.reversed]
        unused = np.arange(WINDOW) >= phrases.lengths[:, None]
        possible = np.flatnonzero(((symbols >= 0) | unused).all(axis=1))
        low, high = index.search(symbols[possible], phrases.lengths[possible])
        times = high - low
        for part in _parts(times, LOCATED):
            which, first = np.repeat(possible[part], times[part]), np.repeat(low[part], times[part])
            within = np.arange(len(which)) - np.repeat(
                np.cumsum(times[part]) - times[part], times[part]
            )
            at = index.locate(first + within)
            np.add.at(change, at, 1)
            np.add.at(change, at + phrases.lengths[which], -1)
            doc = np.searchsorted(ends, at, side="right")
            for pair in np.unique(doc * len(phrases.names) + phrases.item[which]).tolist():
                items[pair // len(phrases.names)].add(phrases.names[pair % len(phrases.names)])
    return np.cumsum(change[:-1]) > 0, starts, items


def _parts(times: np.ndarray, most: int) -> Iterator[slice]:
    """Ranges of phrases with about so many occurrences together."""
    total, start = np.cumsum(times), 0
    while start < len(times):
        done = total[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(total, done + most, side="right")))
        if total[end - 1] > done:
            yield slice(start, end)
        start = end


RESULT = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("n_hit", T.LongType()),
        T.StructField("n_items", T.LongType()),
        T.StructField("items_sha256", T.StringType()),
        T.StructField("contaminated", T.BooleanType()),
        T.StructField(
            "removal_spans",
            T.ArrayType(
                T.StructType(
                    [T.StructField("first_word", T.LongType()), T.StructField("end", T.LongType())]
                )
            ),
        ),
    ]
)


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    keep: list[str] | None = None,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    prefix: str = "",
) -> DataFrame:
    """docs (its columns keep, all by default) with the columns of RESULT, prefixed.

    A word of a document is hit if it lies in an occurrence of a window of an item: WINDOW
    words in a row, or all words of a shorter item. removal_spans are the runs of hit
    words, merged over all windows and items; contaminated says that at least one word in
    twenty is hit. n_items counts the ids of items with an occurrence.

    Each task packs the documents it reads into shards of about SHARD_WORDS words and
    indexes them, so memory is bounded by a shard, or one document if that is longer, and
    no text is shuffled. The benchmark is the query set: it passes the driver block
    by block and is broadcast in blocks of BLOCK_WINDOWS windows, each searched in turn. A
    worker keeps the blocks that it has read, so all windows have to fit in its memory.

    A null text has no words. An item without words matches nothing; items of one id are
    one item, a null id counts as an empty one. Repeated rows get equal results, empty
    tables give no rows or no hits, columns with the name of a result are replaced.
    """
    names = [prefix + f.name for f in RESULT]
    keep = [c for c in (docs.columns if keep is None else keep) if c not in names]
    read = keep + ([] if text_col in keep else [text_col])
    spark = docs.sparkSession
    blocks = [
        spark.sparkContext.broadcast(b) for b in blocks_of(benchmark, item_col, item_text_col)
    ]
    at, width = read.index(text_col), len(keep)
    spans = pa.list_(pa.struct([("first_word", pa.int64()), ("end", pa.int64())]))
    types = [pa.int64()] * 3 + [pa.string(), pa.bool_(), spans]

    def result(hit: np.ndarray, items: set[str]) -> tuple:
        edges = np.flatnonzero(np.diff(hit.astype(np.int8), prepend=0, append=0))
        digest = hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()
        n_hit = int(hit.sum())
        runs = [{"first_word": a, "end": b} for a, b in edges.reshape(-1, 2).tolist()]
        return len(hit), n_hit, len(items), digest, n_hit > 0 and 20 * n_hit >= len(hit), runs

    def flush(held: list[pa.RecordBatch], documents: list[list[bytes]]) -> pa.RecordBatch:
        hits, starts, items = search_shard(documents, (b.value for b in blocks))
        rows = [
            result(hits[s : s + len(d)], found)
            for s, d, found in zip(starts, documents, items, strict=True)
        ]
        new = [pa.array(v, t) for v, t in zip(zip(*rows, strict=True), types, strict=True)]
        whole = pa.Table.from_batches(held).combine_chunks().to_batches()[0] if width else None
        return pa.RecordBatch.from_arrays([*(whole.columns if width else []), *new], [*keep, *names])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, documents, n = [], [], 0
        for batch in batches:
            start = 0
            for row, text in enumerate(utf8(batch.column(at))):
                documents.append(words_of(text))
                n += len(documents[-1]) + 1
                if n >= SHARD_WORDS:
                    held.append(batch.slice(start, row + 1 - start).select(keep))
                    yield flush(held, documents)
                    held, documents, n, start = [], [], 0, row + 1
            if start < batch.num_rows:
                held.append(batch.slice(start).select(keep))
        if documents:
            yield flush(held, documents)

    fields = [T.StructField(n, f.dataType) for n, f in zip(names, RESULT, strict=True)]
    schema = T.StructType([docs.schema[c] for c in keep] + fields)
    return docs.select(*read).mapInArrow(run, schema)
