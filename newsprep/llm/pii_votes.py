"""Personal data by weak supervision: labelers vote, a label model weighs, a classifier decides."""

from __future__ import annotations

import hashlib
import ipaddress
import math
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Kinds in their order; the first four are those of the base rules.
KINDS = ("email", "ip", "card", "phone", "iban", "secret", "ssn", "birth", "passport", "address")
BASE = KINDS[:4]

DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# No part of a number can begin where the whole can't, so numbers are never taken apart.
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")
# A card's digits alone or in fours, which a longer run of numbers may hide.
GROUPED = re.compile(r"(?<![0-9])(?:[0-9]{13,19}|[0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{1,4})(?![0-9])")

NATIONAL = re.compile(r"(?<![0-9+])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9])")
SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
SECRET = re.compile(
    r"""(?i)(?:token|secret|password|passwd|key)["']?[ \t]{0,3}[:=][ \t]{0,3}["']?([A-Za-z0-9+/_=-]{16,})"""
)
HEX = re.compile(r"(?<![A-Za-z0-9])[0-9a-fA-F]{32,}(?![A-Za-z0-9])")
SPELT = re.compile(
    r"(?i)(?<![a-z0-9._%+-])[a-z0-9._%+-]{1,64} ?(?:\[at\]|\(at\)) ?[a-z0-9-]{1,63}"
    r"(?: ?(?:\.|\[dot\]|\(dot\)) ?[a-z0-9-]{1,24}){1,3}"
)
# Secrets that their form gives away: cloud access keys, signed tokens of three parts, and
# tokens that say what they are for.
ACCESS = re.compile(r"(?<![A-Za-z0-9])(?:AKIA|ASIA)[A-Z0-9]{16}(?![A-Za-z0-9])")
SIGNED = re.compile(r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+")
PREFIXED = re.compile(r"(?<![A-Za-z0-9])(?:sk|pk|ghp|gho|ghs|glpat|xox[abp])[_-][A-Za-z0-9_-]{16,}")
KEY_BEGINS, KEY_ENDS = re.compile(r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"), re.compile(r"-----END [A-Z ]{0,40}KEY-----")
IPV6 = re.compile(r"(?<![0-9A-Za-z:.])[0-9A-Fa-f]{0,4}(?::[0-9A-Fa-f]{0,4}){2,7}(?![0-9A-Za-z:])")
# A national number after its trunk zero.
TRUNK = re.compile(r"(?<![0-9+().-])\(?0[0-9]{1,4}\)?[ /-][0-9]{3,4}(?:[ -]?[0-9]{2,4}){1,2}(?![0-9])")
# What only a word before it makes personal; the value is the group.
BIRTH = re.compile(
    r"(?i)(?<![a-z])(?:date of birth|birth ?date|born on|born|dob)[:,]? {0,3}"
    r"([0-9]{1,4}[./-][0-9]{1,2}[./-][0-9]{2,4}|[0-9]{1,2}\.? [a-z]{3,9},? [0-9]{4}|[a-z]{3,9} [0-9]{1,2},? [0-9]{4})(?![0-9])"
)
PASSPORT = re.compile(r"(?i)(?<![a-z])passport(?: ?(?:no|number|nr))?\.?[:#]? {0,3}([A-Z]{0,2}[0-9]{6,9})(?![A-Za-z0-9])")
ADDRESS = re.compile(
    r"(?<![0-9A-Za-z])[0-9]{1,5}[A-Za-z]? (?:[A-Z][a-z]{1,15} ){1,3}"
    r"(?:Street|St|Avenue|Ave|Road|Rd|Lane|Ln|Drive|Dr|Boulevard|Blvd|Court|Ct)(?![A-Za-z])"
)

# Gazetteers, fixed values.
DOMAINS = frozenset(
    "com org net edu gov io info biz app dev ai co me tv uk de fr es it nl be at ch se no dk fi "
    "pl cz pt ie gr hu ro bg hr ru ua tr il in cn jp kr au nz ca us mx br ar cl za eu".split()
)
CALLING = frozenset(
    "1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 "
    "63 64 65 66 81 82 84 86 90 91 92 93 94 95 98".split()
)
IBAN_LANDS = frozenset(
    "AD AT BE BG CH CY CZ DE DK EE ES FI FR GB GR HR HU IE IS IT LI LT LU LV MC MT NL NO PL PT "
    "RO SE SI SK SM TR".split()
)
ISSUERS = re.compile(r"4|5[1-5]|3[47]|6011|65|2[2-7]|35|36|30")
#: Words shortly before a span that speak for its kind, and words that speak against any.
FOR = {
    "email": ("mail", "contact", "write", "reach"),
    "ip": ("ip", "host", "server", "address", "login", "from"),
    "card": ("card", "visa", "credit", "debit", "pay", "account"),
    "phone": ("phone", "call", "tel", "mobile", "fax", "contact"),
    "iban": ("iban", "account", "bank", "transfer"),
    "secret": ("token", "secret", "passw", "key", "auth"),
    "ssn": ("ssn", "social", "security"),
    "birth": ("birth", "born", "dob"),
    "passport": ("passport", "travel"),
    "address": ("address", "live", "resid", "home", "mail", "ship", "deliver", "at "),
}
AGAINST = ("isbn", "issn", "version", "order", "invoice", "page", "figure", "serial", "sha", "md5")
BEFORE = 40

MONTHS = frozenset("jan feb mar apr may jun jul aug sep oct nov dec".split())

LABELERS = ("pattern", "checksum", "gazetteer", "context", "surroundings", "variety")
#: What the classifier sees besides kind and votes, each with its number of values.
FEATURES = {"length": 4, "digits": 3, "left": 4, "right": 4}


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(map(int, reversed(digits))):
        d = 2 * d if k % 2 else d
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def octets(text: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in text.split("."))


def digits_of(text: str) -> str:
    return "".join(DIGIT.findall(text))


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost addresses that don't overlap; each '@' is looked at once."""
    at, free = text.find("@"), 0
    while at >= 0:
        start = at
        while start > free and text[start - 1] in LOCAL:
            start -= 1
        if start < at and (domain := DOMAIN.match(text, at + 1)):
            free = domain.end()
            yield start, free
        at = text.find("@", max(at + 1, free))


def base_spans(text: str) -> list[tuple[int, str, int]]:
    """(start, kind, end) of the base rules, in order."""
    found = [(a, "email", b) for a, b in emails(text)] if "@" in text else []
    if DIGIT.search(text):
        found += [(m.start(), "ip", m.end()) for m in IP.finditer(text) if octets(m[0])]
        for m in CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                found.append((m.start(), "card", m.end()))
        if "+" in text:
            for m in PHONE.finditer(text):
                if 10 <= len(digits_of(m[0])) <= 15:
                    found.append((m.start(), "phone", m.end()))
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[1]), s[2]))


def private_keys(text: str) -> Iterator[tuple[int, int]]:
    """Blocks of private keys, each to its end line, or the text's end."""
    at = 0
    while begins := KEY_BEGINS.search(text, at):
        ends = KEY_ENDS.search(text, begins.end())
        at = ends.end() if ends else len(text)
        yield begins.start(), at


def is_ipv6(value: str) -> bool:
    try:
        return bool(ipaddress.IPv6Address(value))
    except ValueError:
        return False


def candidates(text: str, base: list[tuple[int, str, int]]) -> list[tuple[int, str, int]]:
    """Other spans that may be personal data, none overlapping a span of the base rules."""
    found = []
    if ":" in text or "=" in text:
        found += [(m.start(1), "secret", m.end(1)) for m in SECRET.finditer(text)]
    if "[at]" in text or "(at)" in text:
        found += [(m.start(), "email", m.end()) for m in SPELT.finditer(text)]
    if DIGIT.search(text):
        for kind, pattern in (("phone", NATIONAL), ("ssn", SSN), ("iban", IBAN), ("secret", HEX)):
            found += [(m.start(), kind, m.end()) for m in pattern.finditer(text)]
        found += [(m.start(), "card", m.end()) for m in GROUPED.finditer(text)]
        for kind, pattern in (("phone", TRUNK), ("address", ADDRESS)):
            found += [(m.start(), kind, m.end()) for m in pattern.finditer(text)]
        for kind, pattern in (("birth", BIRTH), ("passport", PASSPORT)):
            found += [(m.start(1), kind, m.end(1)) for m in pattern.finditer(text)]
    for sign, pattern in (("AKIA", ACCESS), ("ASIA", ACCESS), ("eyJ", SIGNED), ("_", PREFIXED), ("-", PREFIXED)):
        if sign in text:
            found += [(m.start(), "secret", m.end()) for m in pattern.finditer(text)]
    if "-----BEGIN" in text:
        found += [(a, "secret", b) for a, b in private_keys(text)]
    if "::" in text or text.count(":") > 6:
        found += [(m.start(), "ip", m.end()) for m in IPV6.finditer(text) if is_ipv6(m[0])]
    ends = np.array([0] + sorted(b for _, _, b in base))
    starts = np.array(sorted(a for a, _, _ in base) + [len(text) + 1])
    # As many base spans end at or before a span as begin before its end, if none overlaps.
    return sorted(
        {
            s for s in found
            if np.searchsorted(ends, s[0], "right") - 1 == np.searchsorted(starts, s[2])
        }
    )


def entropy(text: str) -> float:
    shares = np.unique(list(text), return_counts=True)[1] / len(text)
    return float(-(shares * np.log2(shares)).sum())


def side(character: str) -> int:
    """0: nothing or white space, 1: letter or digit, 2: a joining sign, 3: else."""
    if not character or character.isspace():
        return 0
    return 1 if character.isalnum() else 2 if character in "-_./+@" else 3


def votes_of(text: str, span: tuple[int, str, int], is_base: bool) -> tuple[int, ...]:
    """One vote for each labeler: 1 for, -1 against, 0 abstains."""
    start, kind, end = span
    value, before = text[start:end], text[max(0, start - BEFORE) : start].lower()
    digits = digits_of(value) if kind in ("card", "phone", "ssn") else ""
    sign = lambda yes: 1 if yes else -1
    pattern = 1 if is_base else 0
    if kind == "email":
        top = re.split(r"[^A-Za-z0-9]+", value.rstrip(")]"))[-1].lower()
        check, gazetteer = sign(top.isalpha() and len(top) > 1), 1 if top in DOMAINS else 0
    elif kind == "ip" and ":" in value:
        parsed = ipaddress.IPv6Address(value)
        pattern = sign(len(value) > 6)
        check, gazetteer = sign(not (parsed.is_loopback or parsed.is_unspecified)), 0
    elif kind == "ip":
        first = value.split(".")[0].lstrip("0")
        check, gazetteer = sign(octets(value)), 0 if first else -1
    elif kind == "card":
        check, gazetteer = sign(luhn(digits)), 1 if ISSUERS.match(digits) else -1
    elif kind == "phone":
        check = sign(10 <= len(digits) <= 15)
        code = any(digits[:n] in CALLING for n in (1, 2)) if value[:1] == "+" else False
        gazetteer = 1 if code else 0
    elif kind == "iban":
        plain = value.replace(" ", "")
        number = "".join(str(int(c, 36)) for c in plain[4:] + plain[:4])
        check = sign(int(number) % 97 == 1)
        gazetteer = sign(plain[:2] in IBAN_LANDS)
    elif kind == "secret":
        mixed = any(c.isdigit() for c in value) and any(c.isalpha() for c in value)
        form = value.startswith("-----BEGIN") or ACCESS.fullmatch(value) or SIGNED.fullmatch(value)
        check, gazetteer = sign(mixed and entropy(value) > (2.5 if form else 3)), 1 if form else 0
        pattern = 0 if HEX.fullmatch(value) and SECRET.search(before + value) is None else 1
    elif kind == "birth":
        years = [int(y) for y in re.findall(r"(?<![0-9])[0-9]{4}(?![0-9])", value)]
        names = [w[:3].lower() for w in re.findall(r"[A-Za-z]+", value)]
        pattern, check = 1, sign(all(1880 <= y <= 2030 for y in years))
        gazetteer = sign(names[0] in MONTHS) if names else 0
    elif kind == "passport":
        pattern, check, gazetteer = 1, sign(len(set(value)) > 2), 0
    elif kind == "address":
        pattern, check, gazetteer = 0, sign(not value.startswith("0")), 1
    else:
        area = digits[:3]
        check = sign(area not in ("000", "666") and area < "900" and digits[3:5] != "00")
        gazetteer = 0
    context = 1 if any(w in before for w in FOR[kind]) else 0
    context = -1 if any(w in before for w in AGAINST) else context
    outside = (side(text[max(0, start - 1) : start]), side(text[end : end + 1]))
    surroundings = -1 if 1 in outside else 1 if outside == (0, 0) else 0
    variety = -1 if len(set(value)) <= 3 else 0
    return pattern, check, gazetteer, context, surroundings, variety


def features_of(text: str, span: tuple[int, str, int]) -> tuple[int, ...]:
    start, _, end = span
    value = text[start:end]
    share = len(DIGIT.findall(value)) / len(value)
    return (
        min(3, len(value) // 12),
        0 if share < 0.3 else 1 if share < 0.9 else 2,
        side(text[max(0, start - 1) : start]),
        side(text[end : end + 1]),
    )


@dataclass
class Model:
    """The label model's reliabilities and the classifier's weights."""

    #: P(vote | kind of truth) as [labeler, truth, vote + 1], for the record.
    reliability: np.ndarray | None = None
    prior: dict[str, float] = field(default_factory=dict)
    weights: np.ndarray | None = None

    def score(self, kind: str, votes: tuple[int, ...], features: tuple[int, ...]) -> float:
        if self.weights is None:
            return 0.0
        at = np.flatnonzero(design([(kind, votes, features)])[0])
        return float(1 / (1 + math.exp(-self.weights[at].sum())))


def design(rows: list[tuple[str, tuple[int, ...], tuple[int, ...]]]) -> np.ndarray:
    """One column for 1, each kind, each vote of each labeler and each value of a feature."""
    sizes = [1, len(KINDS)] + [3] * len(LABELERS) + list(FEATURES.values())
    starts = np.cumsum([0, *sizes])
    matrix = np.zeros((len(rows), starts[-1]))
    for k, (kind, votes, features) in enumerate(rows):
        values = [0, KINDS.index(kind), *(v + 1 for v in votes), *features]
        matrix[k, starts[:-1] + values] = 1
    return matrix


def fit(rows: list[tuple[str, tuple[int, ...], tuple[int, ...], int]]) -> Model:
    """Fit to counts of (kind, votes, features, n), which stand for all spans of a corpus.

    Expectation-maximisation estimates how often each labeler votes for and against true
    and false spans, with a prior for each kind, from agreement alone. The posteriors are
    the soft labels of a logistic regression with a small penalty.
    """
    if not rows:
        return Model()
    kinds = np.array([KINDS.index(r[0]) for r in rows])
    votes = np.array([r[1] for r in rows]) + 1
    n = np.array([r[3] for r in rows], float)
    # Begin with the majority of the votes.
    truth = 1 / (1 + np.exp(-(votes - 1).sum(axis=1).astype(float)))
    for _ in range(50):
        both = np.stack([(1 - truth) * n, truth * n])
        held = np.zeros((len(LABELERS), 2, 3))
        for j in range(len(LABELERS)):
            for v in range(3):
                held[j, :, v] = both[:, votes[:, j] == v].sum(axis=1)
        # Counts before any data say that a labeler is right more often than not.
        held += np.array([[4.0, 3.0, 1.0], [1.0, 3.0, 4.0]])
        reliability = held / held.sum(axis=2, keepdims=True)
        share = np.zeros((len(KINDS), 2))
        for y in range(2):
            np.add.at(share[:, y], kinds, both[y])
        share = (share + 1) / (share.sum(axis=1, keepdims=True) + 2)
        log = np.log(share)[kinds].T.copy()
        for j in range(len(LABELERS)):
            log += np.log(reliability[j][:, votes[:, j]])
        truth = 1 / (1 + np.exp(np.clip(log[0] - log[1], -50, 50)))
    x, weights = design([r[:3] for r in rows]), None
    weights = np.zeros(x.shape[1])
    penalty = np.eye(x.shape[1]) * 1e-2
    scale = n / n.sum() * len(n)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        slope = x.T @ (scale * (truth - p)) - penalty @ weights
        curve = (x * (scale * p * (1 - p))[:, None]).T @ x + penalty
        weights += np.linalg.solve(curve, slope)
    prior = {k: float(share[i, 1]) for i, k in enumerate(KINDS)}
    return Model(reliability, prior, weights)


def train(docs: DataFrame, text_col: str = "text") -> Model:
    """The model of all spans of all texts.

    Tasks count equal (kind, votes, features); only these counts reach the driver. There
    are at most 10 * 3**6 * 4*3*4*4 of them, whatever the size of the corpus, and some
    hundreds in fact.
    """
    names = [*LABELERS, *FEATURES]
    out = pa.schema([("kind", pa.string())] + [(c, pa.int32()) for c in names] + [("n", pa.int64())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[tuple, int] = {}
        for batch in batches:
            for value in batch.column(0):
                text = value.as_py() or ""
                base = base_spans(text)
                for is_base, spans in ((True, base), (False, candidates(text, base))):
                    for s in spans:
                        key = (s[1], *votes_of(text, s, is_base), *features_of(text, s))
                        counts[key] = counts.get(key, 0) + 1
        rows = [(*k, n) for k, n in counts.items()]
        columns = [pa.array([r[i] for r in rows], f.type) for i, f in enumerate(out)]
        yield pa.RecordBatch.from_arrays(columns, schema=out)

    schema = "kind string, " + ", ".join(f"{c} int" for c in names) + ", n bigint"
    counted = docs.select(text_col).mapInArrow(run, schema)
    counted = counted.groupBy("kind", *names).agg(F.sum("n").alias("n"))
    split = 1 + len(LABELERS)
    rows = sorted((r[0], tuple(r[1:split]), tuple(r[split:-1]), r[-1]) for r in counted.collect())
    return fit(rows)


def spans_of(text: str, model: Model, threshold: float) -> tuple[list, list]:
    """The base spans, and all: with those that the classifier adds, which don't overlap."""
    base = base_spans(text)
    scored = []
    for s in candidates(text, base):
        p = model.score(s[1], votes_of(text, s, False), features_of(text, s))
        if p >= threshold:
            scored.append((-p, s))
    added: list[tuple[int, str, int]] = []
    for _, s in sorted(scored):
        if all(s[2] <= o[0] or o[2] <= s[0] for o in added):
            added.append(s)
    return base, sorted(base + added, key=lambda s: (s[0], KINDS.index(s[1]), s[2]))


def redacted(text: str, spans: list[tuple[int, str, int]]) -> str:
    """The text with its spans, overlapping ones together, replaced by their kind."""
    parts, done = [], 0
    for start, kind, end in spans:
        if start >= done:
            parts += [text[done:start], f"<{kind.upper()}>"]
        done = max(done, end)
    return "".join(parts) + text[done:]


RESULT = T.StructType(
    [T.StructField(f"n_{k}", T.LongType()) for k in BASE]
    + [
        T.StructField("base_sha256", T.StringType()),
        T.StructField("spans", T.StringType()),
        T.StructField("redacted", T.StringType()),
    ]
)


def find_personal_data(
    docs: DataFrame,
    *,
    keep: list[str] | None = None,
    text_col: str = "text",
    threshold: float = 0.5,
    with_text: bool = True,
    prefix: str = "",
) -> DataFrame:
    """docs (its columns keep, all by default) with the columns of RESULT, prefixed.

    The base rules' spans always stay; n_email and so on count them and base_sha256 is
    their digest. Candidates of further patterns are judged by a classifier that is
    trained on all spans of docs without labels: see train(). spans has all as
    kind:start:end, in code points, in order of start and kind. redacted is the text with
    <KIND> for each span (left out unless with_text).

    A null text is an empty one, which has no spans and a null redacted text. Repeated
    rows get equal results; an empty table trains nothing and gives no rows; columns with
    the name of a result are replaced. Two passes over the texts, nothing is shuffled but
    the counts of the training. Every pattern looks at a character a bounded number of
    times, so a long run of digits or letters costs no more than other text.
    """
    model = train(docs, text_col)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    fields = [f for f in RESULT if with_text or f.name != "redacted"]
    names = [prefix + f.name for f in fields]
    keep = [c for c in (docs.columns if keep is None else keep) if c not in names]
    read = keep + ([] if text_col in keep else [text_col])
    at, width = read.index(text_col), len(keep)
    types = [pa.int64()] * len(BASE) + [pa.string()] * (len(fields) - len(BASE))

    def row(value: str | None) -> tuple:
        text = value or ""
        base, spans = spans_of(text, shared.value, threshold)
        said = [",".join(f"{k}:{a}:{b}" for a, k, b in s) for s in (base, spans)]
        counts = [sum(s[1] == k for s in base) for k in BASE]
        digest = hashlib.sha256(said[0].encode()).hexdigest()
        clean = None if value is None else redacted(text, spans)
        return (*counts, digest, said[1], *([clean] if with_text else []))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [row(value.as_py()) for value in batch.column(at)]
            values = list(zip(*rows, strict=True)) or [()] * len(types)
            new = [pa.array(v, t) for v, t in zip(values, types, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:width], *new], [*keep, *names])

    schema = T.StructType(
        [docs.schema[c] for c in keep]
        + [T.StructField(n, f.dataType) for n, f in zip(names, fields, strict=True)]
    )
    return docs.select(*read).mapInArrow(run, schema)
