"""Personal data: patterns propose spans, checks confirm them, context adjusts.

Base kinds, leftmost and without overlap within a kind:

- email  `[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+`
- ip     four dotted numbers, each at most 255
- card   14 to 19 digits, single spaces or hyphens between, that pass Luhn
- phone  `\\+[0-9][\\x20().0-9-]+[0-9]` with 10 to 15 digits

Added kinds, kept when their score reaches LEAST_SCORE: a checksum or a nearby
context word (within NEARBY code points, in any of several languages) raises it.

- iban   two letters, two digits, 11 to 30 letters or digits, passing mod-97; of the
         ends at a space, the one by the country's length, else the last that passes
- ssn    `ddd-dd-dddd` outside the ranges that are never given out; needs context
- local  a phone number without a plus; needs context

The patterns take time in proportion to the text: a run of characters that cannot
match is passed over whole. Places are code points, ends exclusive.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hubloom.llm.texts import chunks

KINDS = ("email", "ip", "card", "phone", "iban", "ssn", "local")
BASE = KINDS[:4]
LEAST_SCORE = 0.5
NEARBY = 40

_LOCAL_PART = re.compile(r"[A-Za-z0-9._%+-]+\Z")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_DOTTED = re.compile(r"[0-9]++(?:\.[0-9]++)*+")
_DIGITS = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_IBAN_START = re.compile(r"\b[A-Z]{2}[0-9]{2}(?=\x20?[A-Z0-9])")
_IBAN_REST = re.compile(r"(?:\x20?[A-Z0-9]){11,30}")
_ALNUM = re.compile(r"[A-Za-z0-9]")
_SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
_LOCAL = re.compile(r"(?<![0-9+.])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9-])")
_PERSONAL = re.compile(r"[0-9@]")

CONTEXT = {
    "iban": re.compile(r"iban|account|bank|konto|cuenta|compte", re.I),
    "ssn": re.compile(r"ssn|social security|tax id|taxpayer", re.I),
    "local": re.compile(r"phone|\btel|call|mobile|fax|telefon|téléphone|teléfono", re.I),
}

#: Letters and digits of an IBAN, by country.
_IBAN_LENGTHS = {country: n for n, countries in {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI",
    20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA",
    23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM",
    28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE",
    31: "MT SC", 32: "LC", 33: "RU"}.items() for country in countries.split()}

Span = tuple[int, int, str]


def passes_luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2]))
    return (total + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def passes_mod97(iban: str) -> bool:
    moved = iban[4:] + iban[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def emails(text: str) -> Iterator[Span]:
    """A local part ends at its @ and has no other, so each @ is tried once."""
    after, at = 0, text.find("@")
    while at >= 0:
        domain = _DOMAIN.match(text, at)
        start = at
        if domain:
            allowed = "._%+-"
            while start > after and ((c := text[start - 1]) in allowed
                                     or c.isascii() and c.isalnum()):
                start -= 1
        if start < at:
            yield start, domain.end(), "email"
            after = domain.end()
            at = text.find("@", after)
        else:
            at = text.find("@", at + 1)


def addresses(text: str) -> Iterator[Span]:
    """A run of dotted numbers gives a match for every four of them."""
    for run in _DOTTED.finditer(text):
        if run[0].count(".") < 3:
            continue
        parts, start = run[0].split("."), run.start()
        for i in range(0, len(parts) - 3, 4):
            four = parts[i:i + 4]
            end = start + sum(map(len, four)) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in four):
                yield start, end, "ip"
            start = end + 1


def cards(text: str) -> Iterator[Span]:
    for run in _DIGITS.finditer(text):
        digits = run[0].replace(" ", "").replace("-", "")
        if 14 <= len(digits) <= 19 and passes_luhn(digits):
            yield run.start(), run.end(), "card"


def phones(text: str) -> Iterator[Span]:
    for run in _PHONE.finditer(text):
        if 10 <= sum(map(str.isdigit, run[0])) <= 15:
            yield run.start(), run.end(), "phone"


def _iban_ends(text: str, start: int) -> Iterator[int]:
    """Where an IBAN from `start` passes mod-97 and ends, the last such end first."""
    rest = _IBAN_REST.match(text, start + 4)
    while rest:
        end = rest.end()
        if not _ALNUM.match(text, end) and passes_mod97(text[start:end].replace(" ", "")):
            yield end
        # The next end before a space; none is within a word.
        space = text.rfind(" ", start + 4, end)
        rest = _IBAN_REST.fullmatch(text, start + 4, space) if space >= 0 else None


def ibans(text: str, taken: bytearray) -> Iterator[tuple[int, int]]:
    """IBANs that overlap nothing taken, nor each other.

    Those of their country's length come first, so that no chance match takes a part.
    """
    starts = [m.start() for m in _IBAN_START.finditer(text)]
    ends = [list(_iban_ends(text, s)) for s in starts]
    taken = taken[:]
    for by_country in (True, False):
        for start, passing in zip(starts, ends, strict=True):
            length = _IBAN_LENGTHS.get(text[start:start + 2])
            for end in passing:
                fits = len(text[start:end].replace(" ", "")) == length
                if fits >= by_country and not any(taken[start:end]):
                    taken[start:end] = b"\1" * (end - start)
                    yield start, end
                    break


def _score(text: str, kind: str, start: int, end: int, confirmed: bool) -> float:
    near = text[max(0, start - NEARBY):start] + " " + text[end:end + NEARBY]
    return 0.2 + 0.4 * confirmed + 0.4 * bool(CONTEXT[kind].search(near))


def added(text: str, base: list[Span]) -> Iterator[tuple[int, int, str, float]]:
    """Spans of the added kinds that reach LEAST_SCORE and overlap no base span."""
    proposals = [("ssn", m) for m in _SSN.finditer(text)]
    proposals += [("local", m) for m in _LOCAL.finditer(text)]
    accounts = _IBAN_START.search(text)
    taken = bytearray(len(text) if proposals or accounts else 0)
    for start, end, _ in base if proposals or accounts else ():
        taken[start:end] = b"\1" * (end - start)
    for start, end in ibans(text, taken) if accounts else ():
        score = _score(text, "iban", start, end, True)
        if score >= LEAST_SCORE:
            yield start, end, "iban", score
    for kind, m in proposals:
        start, end = m.span()
        if any(taken[start:end]):
            continue
        if kind == "ssn":
            area, group, serial = m[0].split("-")
            if area in ("000", "666") or area >= "900" or group == "00" or serial == "0000":
                continue
        score = _score(text, kind, start, end, False)
        if score >= LEAST_SCORE:
            yield start, end, kind, score


def find_personal(text: str) -> tuple[list[Span], list[tuple[int, int, str, float]]]:
    """Base spans in order, and the added ones with their scores."""
    if not _PERSONAL.search(text):
        return [], []
    base = [*emails(text), *addresses(text), *cards(text), *phones(text)]
    order = {k: i for i, k in enumerate(KINDS)}
    base.sort(key=lambda s: (s[0], order[s[2]]))
    return base, sorted(added(text, base), key=lambda s: (s[0], order[s[2]]))


def _written(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


_FOUND = pa.schema([*((f"n_{k}", pa.int64()) for k in BASE), ("base_sha256", pa.string()),
                    ("spans", pa.string()), ("scores", pa.list_(pa.float64()))])


def _searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    order = {k: i for i, k in enumerate(KINDS)}
    for batch in batches:
        for part in chunks(batch):
            columns = [[] for _ in _FOUND]
            for text in part.column("text").to_pylist():
                base, more = find_personal(text or "")
                kinds = [s[2] for s in base]
                spans = sorted([(*s, 1.0) for s in base] + more,
                               key=lambda s: (s[0], order[s[2]]))
                values = [*(kinds.count(k) for k in BASE),
                          hashlib.sha256(_written(base).encode()).hexdigest(),
                          _written([s[:3] for s in spans]), [s[3] for s in spans]]
                for column, value in zip(columns, values, strict=True):
                    column.append(value)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), *(pa.array(c, f.type) for c, f in
                                          zip(columns, _FOUND, strict=True))],
                ["doc_id", *_FOUND.names])


def personal_data(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, scores per row.

    spans lists all spans as kind:start:end, by start, then kind; scores are theirs
    (1 for a base span). base_sha256 is the digest of the base spans written
    likewise. A null text counts as empty. Rows are independent: equal ones get
    equal results, and an empty table gives an empty result.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(_searched, "doc_id long, n_email long, n_ip long, n_card long, "
                           "n_phone long, base_sha256 string, spans string, scores array<double>")
