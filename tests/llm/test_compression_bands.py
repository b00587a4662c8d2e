import random
import re
from collections import Counter
from pathlib import Path

import zstandard

from newsprep.llm.compression_bands import LEVEL, VERDICT, compression_verdicts, judge
from tests.llm.rows import AWKWARD, documents, given, ordered

WORD = re.compile("[^\x20\x09-\x0d]+")


def base(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(zip(words, words[1:], words[2:], strict=False))
    repeat = set()
    for i in range(len(words) - 2):
        if windows[tuple(words[i : i + 3])] > 1:
            repeat |= {i, i + 1, i + 2}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    failed = len(words) < 50 or 100 * len(repeat) > 50 * len(words)
    return len(words), sum(map(len, words)), symbols, dup, len(repeat), failed


def test_base_rules(spark, small):
    rows = AWKWARD + given(spark, small, 200)
    found = compression_verdicts(documents(spark, rows).repartition(3)).collect()
    ours = ordered((r["doc_id"], *(r[c] for c in VERDICT.names[:6])) for r in found)
    assert ours == ordered((d, *base(t)) for d, t in rows)
    assert all(not r["kept"] for r in found if r["base_failed"])


def test_bands(spark, small):
    rng = random.Random(3)
    clean = max((t for _, t in given(spark, small, 200) if len(t) > 3000), key=len)
    noise = " ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/", k=60)) for _ in range(100))
    often = " ".join(f"{w}{i % 3}" for i in range(800) for w in ("alpha", "beta"))
    mixed = clean[:9000] + " " + " ".join(f"{a} {a}{b}" for a in "ab" for b in range(3)) * 2000
    rows = [(1, clean), (2, noise), (3, often), (4, mixed), (5, None)]
    found = {r["doc_id"]: r for r in compression_verdicts(documents(spark, rows)).collect()}
    assert found[1]["kept"] and found[1]["reason"] is None
    assert not found[2]["base_failed"] and found[2]["reason"] == "incompressible"
    assert not found[4]["kept"] and not found[3]["kept"]
    assert found[5]["reason"] == "base" and found[5]["whole_ratio"] == 0.0


def test_clean_documents_stay(spark, small):
    folder = small.replace("0.001", "0.01")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    judged = compression_verdicts(docs, keep=["doc_id"]).join(labels, "doc_id")
    good = judged.filter("quality = 1 AND NOT base_failed")
    assert good.filter("NOT kept").count() <= 0.01 * good.count()


def test_columns_and_empty_table(spark):
    docs = documents(spark)
    judged = compression_verdicts(docs)
    assert set(judged.columns) == set(docs.columns) | set(VERDICT.names)
    assert compression_verdicts(docs, prefix="q_").filter("kept = 'kept'").count() == len(AWKWARD)
    assert compression_verdicts(documents(spark, [])).count() == 0


RUSSIAN = """
Осенью в деревне рано темнеет, и к шести часам в окнах уже горит свет. Старый учитель
возвращался с почты пешком, хотя сосед предлагал подвезти его на телеге. Дорога шла вдоль
реки, где летом купались дети, а теперь только ветер гонял по воде жёлтые листья. Он думал
о письме, которое лежало в кармане: сын писал, что приедет не раньше января, потому что на
заводе много работы и отпуск перенесли. У моста учитель остановился, достал очки и ещё раз
прочитал последнюю страницу. Внук, оказывается, выучил таблицу умножения и просил передать
дедушке, что умеет считать до тысячи. Старик улыбнулся, аккуратно сложил бумагу и пошёл
дальше быстрее прежнего, будто дома его кто-нибудь ждал.
"""
HINDI = """
गाँव के बाहर एक पुराना बरगद का पेड़ था जिसके नीचे हर शाम बूढ़े लोग बैठकर बातें करते थे। उस दिन डाकिया
शहर से एक चिट्ठी लाया और सबने पूछा कि किसकी है। रामू ने काँपते हाथों से लिफ़ाफ़ा खोला और चश्मा लगाकर
पढ़ने लगा। उसका बेटा लिख रहा था कि इस बार दीवाली पर छुट्टी मिल गई है, इसलिए पूरा परिवार रेलगाड़ी से
आएगा। बच्चों ने नदी देखने की ज़िद की है और छोटी बेटी पूछती है कि क्या बकरी अब भी आँगन में बँधी रहती है।
यह सुनकर पड़ोसी हँस पड़े और किसी ने मिठाई मँगवाई। अँधेरा होने तक चर्चा चलती रही कि मेहमानों को कहाँ
ठहराया जाए और कौन स्टेशन तक बैलगाड़ी लेकर जाएगा।
"""
LICENCES = [Path("/usr/share/common-licenses", n) for n in ("Apache-2.0", "LGPL-3", "MPL-1.1", "MPL-2.0", "GPL-3")]


def test_natural_prose_stays(spark):
    texts = [RUSSIAN, HINDI, *(p.read_text() for p in LICENCES if p.exists())]
    found = compression_verdicts(documents(spark, list(enumerate(texts)))).collect()
    assert [(r["doc_id"], r["reason"]) for r in found if not r["kept"]] == []


def test_bands_of_scripts():
    """A repeated text goes in every script; licences stay when spelt in Cyrillic."""
    press = zstandard.ZstdCompressor(level=LEVEL)
    for text in (RUSSIAN, HINDI):
        assert judge((text * 40).encode(), press)[-1] is False
    letters = {c: chr(0x430 + i) for i, c in enumerate("abcdefghijklmnopqrstuvwxyz")}
    for path in LICENCES:
        if path.exists():
            cyrillic = "".join(letters.get(c, c) for c in path.read_text().lower())
            assert judge(cyrillic.encode(), press)[-2] is None


def test_each_band_rejects(spark, small):
    """Documents that the base rules pass, made from the given ones, and the given ones.

    The given tables have none that only a band rejects; among those that fail the base
    rules the bands find the ones that repeat themselves.
    """
    draw = random.Random(7)
    folder = small.replace("0.001", "0.01")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    longest = [r["text"] for r in docs.orderBy("n_chars", ascending=False).limit(40).collect()]
    longest = [t for t in longest if not base(t)[-1]][:30]
    letters = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/"
    planted = []
    for i, text in enumerate(longest):
        words = text.split()
        # Key and value lines: no three words are said twice, little is said at all.
        planted.append((3 * i, " ".join(f"field_{k:04d} =" for k in range(len(words) // 4))))
        planted.append((3 * i + 1, " ".join("".join(draw.choices(letters, k=48)) for _ in range(60 + i))))
        # A good text, then a list in which every line says nearly the same.
        filler = "".join(
            f"\nentry {k} has the value {draw.randrange(10**6)}, as before" for k in range(len(text) // 60))
        planted.append((3 * i + 2, text + filler))
    found = {r["doc_id"]: r for r in compression_verdicts(documents(spark, planted)).collect()}
    assert not any(r["base_failed"] for r in found.values())
    reasons = Counter(r["reason"] for r in found.values())
    assert min(reasons[k] for k in ("repetitive", "incompressible", "chunks")) >= 5, reasons
    assert {found[3 * i]["reason"] for i in range(30)} == {"repetitive"}
    assert {found[3 * i + 1]["reason"] for i in range(30)} == {"incompressible"}
    assert {found[3 * i + 2]["reason"] for i in range(30) if len(longest[i]) > 17_000} == {"chunks"}
    own = compression_verdicts(docs, keep=["doc_id"])
    assert own.filter("NOT base_failed AND NOT kept").count() == 0
    assert own.filter("base_failed AND n_words >= 50 AND band_reason = 'repetitive'").count() >= 3
