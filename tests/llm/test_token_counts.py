import public_tokenizers
import pytest
from tokenizers import Tokenizer

from newsprep.llm import token_counts as C
from tests.llm.rows import AWKWARD, collected, documents, given, ordered

PATH = public_tokenizers.path("byte_bpe_50k.json")

SPACES = [
    (30, "  two  spaces   three\t\ttabs \n \n lines \r\n end "),
    (31, " a"),
    (32, "a  b  c　d \x1c e \x85f"),
    (33, "<|endoftext|><|endoftext|> x <|endoftext"),
    (34, "it's we'LL they've I'm he'd 'sup '' 's's"),
    (35, "مرحبا 你好 世界 ١٢٣ ½ ²³ Ⅷ é 👩‍👩‍👧 𝔘"),
    (36, " "),
    (37, "\n\n\n"),
    (38, "tab\t end\t"),
    (39, "\0 nul \0x"),
]


def expected(rows):
    tokenizer = Tokenizer.from_file(PATH)
    out = []
    for doc_id, text in rows:
        n = len(tokenizer.encode(text or "", add_special_tokens=False).ids)
        out.append((doc_id, len((text or "").encode()), n, n > 512))
    return ordered(out)


@pytest.mark.parametrize(("parts", "frequent"), [(1, 1 << 18), (4, 50), (3, 0)])
def test_as_the_library_counts(spark, small, parts, frequent, monkeypatch):
    monkeypatch.setattr(C, "FREQUENT", frequent)
    rows = AWKWARD + SPACES + given(spark, small, 150)
    found = C.token_counts(documents(spark, rows).repartition(parts), PATH)
    ours = collected(found, "doc_id", "n_bytes", "n_tokens", "over_limit")
    assert ours == expected(rows)


def test_each_pre_token_is_counted_once(spark, small):
    rows = given(spark, small, 50)
    found = C.pre_token_table(documents(spark, rows), PATH).collect()
    assert len({r["pre_token"] for r in found}) == len(found)
    total = sum(r["n"] * r["pieces"] for r in found)
    assert total == sum(r[2] for r in expected(rows))


def test_empty_table(spark):
    assert C.token_counts(documents(spark, []), PATH).count() == 0
