import hashlib
import random
import re

import numpy as np
import pytest

from newsprep.llm import decontamination as D
from tests.llm.rows import AWKWARD, documents, given, ordered

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(rows, items):
    out = []
    for doc_id, text in rows:
        w = words(text)
        hit, ids = [False] * len(w), set()
        for item_id, item in items:
            iw = words(item)
            width = min(13, len(iw))
            for s in range(len(iw) - width + 1) if iw else ():
                window = iw[s : s + width]
                for i in range(len(w) - width + 1):
                    if w[i : i + width] == window:
                        hit[i : i + width] = [True] * width
                        ids.add("" if item_id is None else str(item_id))
        digest = hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest()
        n = sum(hit)
        spans = [(m.start(), m.end()) for m in re.finditer("1+", "".join("01"[h] for h in hit))]
        out.append((doc_id, len(w), n, len(ids), digest, n > 0 and 20 * n >= len(w), spans))
    return ordered(out)


def ours(df):
    rows = []
    for r in df.collect():
        spans = [(s["first_word"], s["end"]) for s in r["removal_spans"]]
        rows.append((r["doc_id"], *(r[c] for c in D.RESULT.names[:-1]), spans))
    return ordered(rows)


def items_of(spark, small):
    found = spark.read.parquet(f"{small}/benchmark.parquet").collect()
    passage = "the quick brown fox jumps over the lazy dog and runs away from it all again"
    return [(r["item_id"], r["text"]) for r in found] + [
        (900, "Same TEXT twice"), (901, "a"), (902, None), (903, " ,. "), (None, "no identity"),
        (904, passage), (904, passage + " more"), (905, passage[4:]), (906, "mat mat mat"),
    ]


PASSAGE = [
    (20, "Before. The quick, brown fox jumps over the lazy dog and runs away from it all again!"),
    (21, "the quick brown fox jumps over the lazy dog and runs"),
    (22, ("the quick brown fox jumps over the lazy dog and runs away from it all again " * 3)),
    (23, "mat " * 7),
    (24, "the quick brown fox jumps over the lazy dog and runs away from " + "filler " * 400),
]


@pytest.mark.parametrize("parts", [1, 4])
def test_against_brute_force(spark, small, parts):
    rows = [r for r in AWKWARD if r[0] != 4] + PASSAGE + given(spark, small, 80)
    items = items_of(spark, small)
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    found = D.decontaminate(documents(spark, rows, clash=False).repartition(parts), benchmark)
    assert ours(found) == brute(rows, items)


def test_columns_of_documents_stay(spark, small):
    benchmark = spark.createDataFrame([(1, "same text twice")], "item_id bigint, text string")
    docs = documents(spark)
    found = D.decontaminate(docs, benchmark)
    assert found.count() == len(AWKWARD)
    assert set(found.columns) == set(docs.columns) | set(D.RESULT.names)
    assert found.filter("contaminated").count() == 3
    prefixed = D.decontaminate(docs, benchmark, prefix="b_").filter("b_contaminated")
    assert prefixed.select("n_words").distinct().collect()[0][0] == "n_words"


def test_empty_tables(spark):
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert D.decontaminate(documents(spark, []), none).count() == 0
    assert D.decontaminate(documents(spark, clash=False), none).filter("n_hit > 0").count() == 0


@pytest.mark.parametrize("seed", range(6))
def test_index(seed):
    rng = random.Random(seed)
    symbols = rng.choice([1, 2, 5, 200])
    text = [rng.randrange(symbols) for _ in range(rng.randrange(1, 700))]
    if seed % 2:
        text = text[:40] * 12
    text.append(symbols)
    text = np.array(text)
    suffixes = D.suffix_array(text)
    as_list = text.tolist()
    assert suffixes.tolist() == sorted(range(len(text)), key=lambda i: as_list[i:])
    index = D.FMIndex(text, symbols + 1)
    for _ in range(30):
        at, width = rng.randrange(len(text)), rng.randrange(1, 14)
        phrase = as_list[at : at + width]
        low, high = index.search(np.array([phrase[::-1]]), np.array([len(phrase)]))
        places = sorted(index.locate(np.arange(low[0], high[0])).tolist())
        n = len(phrase)
        assert places == [i for i in range(len(text)) if as_list[i : i + n] == phrase]


def test_shards_and_blocks_change_nothing(spark, small, monkeypatch):
    rows, items = PASSAGE + given(spark, small, 30), items_of(spark, small)
    docs = [D.words_of((t or "").encode()) for _, t in rows]
    held = [("" if n is None else str(n), D.words_of((t or "").encode())) for n, t in items]
    held = [h for h in held if h[1]]
    whole = D.search_shard(docs, [D.Phrases(held)])
    blocks = D.search_shard(docs, [D.Phrases(held[i : i + 3]) for i in range(0, len(held), 3)])
    monkeypatch.setattr(D, "LOCATED", 3)
    parts = D.search_shard(docs, [D.Phrases(held)])
    for other in (blocks, parts):
        assert (whole[0] == other[0]).all() and whole[2] == other[2]
