import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from newsprep.llm.packing import WordIds, binary_pieces, pack_binary
from tests.llm.rows import AWKWARD, collected, documents, given

PATH = public_tokenizers.path("word_bpe_49k.json")


def ids_of(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]


def expected(rows, most=4096):
    tokenizer, out = Tokenizer.from_file(PATH), []
    for doc_id, text in rows:
        ids, start, width = ids_of(tokenizer, text), 0, most
        while start < len(ids):
            while len(ids) - start < width:
                width //= 2
            held = np.array(ids[start : start + width], "<u4").tobytes()
            out.append((doc_id, start, width, zlib.crc32(held), len(ids)))
            start += width
    return sorted(out, key=lambda r: tuple((v is not None, v) for v in r))


COLUMNS = ("doc_id", "start", "length", "ids_crc32", "doc_tokens")


@pytest.mark.parametrize("parts", [1, 5])
def test_pieces_and_numbers(spark, small, parts):
    rows = AWKWARD + given(spark, small)
    packed = pack_binary(documents(spark, rows).repartition(parts), PATH).cache()
    assert collected(packed, *COLUMNS) == expected(rows)
    numbers = packed.select("sequence_id", "length", "offset").toPandas().sort_values("sequence_id")
    # One piece to a sequence, gapless, lengths in one range each.
    assert numbers["sequence_id"].tolist() == list(range(len(numbers)))
    assert numbers["length"].is_monotonic_increasing and (numbers["offset"] == 0).all()


def test_ids_are_returned_on_request(spark):
    rows = AWKWARD[:8]
    packed = pack_binary(documents(spark, rows), PATH, most=8, with_ids=True).collect()
    tokenizer = Tokenizer.from_file(PATH)
    for doc_id, text in rows:
        if doc_id in (2, 4):
            own = sorted((r["start"], r["ids"]) for r in packed if r["doc_id"] == doc_id)
            assert [i for _, ids in own for i in ids] == ids_of(tokenizer, text)


def test_words_as_the_library_sees_them(spark, small):
    """Every distinct word of the given texts, and words of odd letters."""
    letters = [chr(c) for c in range(1, 0x260)] + list("ΣσςİKÅﬁ½²Ⅷ中٣e\u0301")
    odd = {f"a{c}B{c}{c}" for c in letters} | {"don't", "we'LL,", "x<|endoftext|>y", "'s's", "A1b22", "it'S", "Ab'", "a',", "9.", "é.", "A\u030a!", "...", "X!!'s"}
    texts = [t for _, t in given(spark, small.replace("0.001", "0.1"), 3000)] + sorted(odd)
    words = {w for t in texts for w in t.encode().split()}
    memo, tokenizer = WordIds(PATH), Tokenizer.from_file(PATH)
    assert memo.apart
    for word in sorted(words):
        ids = tokenizer.encode(word.decode(), add_special_tokens=False).ids
        assert memo[word] == np.array(ids, "<u4").tobytes(), word


def test_a_tokenizer_of_unknown_steps_is_left_to_the_library():
    other = public_tokenizers.path("byte_bpe_50k.json")
    memo, tokenizer = WordIds(other), Tokenizer.from_file(other)
    assert not memo.apart
    ids = tokenizer.encode("Word,", add_special_tokens=False).ids
    assert memo[b"Word,"] == np.array(ids, "<u4").tobytes()


def test_binary_pieces():
    assert binary_pieces(0, 8) == []
    assert binary_pieces(8, 8) == [(0, 8)]
    assert binary_pieces(21, 8) == [(0, 8), (8, 8), (16, 4), (20, 1)]


def test_empty_table_and_wrong_length(spark):
    assert pack_binary(documents(spark, []), PATH).count() == 0
    with pytest.raises(ValueError):
        pack_binary(documents(spark), PATH, most=1000)
