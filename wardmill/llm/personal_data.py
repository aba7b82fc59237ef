"""Personal data: patterns propose spans, checksums confirm them, nearby words adjust the score.

Kinds in order: email, ip, card (Luhn), phone, then what the method adds: iban (mod-97) and ssn. An iban ends where its
country's length says, so upper-case words and numbers after it are no part of it; of other countries every end of a
group is tried, the longest first. Spans of the first four stand whatever their score; an added one must reach the threshold. A null or empty text has no spans; long texts
are read whole; rows are treated one by one, so repeated ids or rows each give a row and a null id stays null. Other
columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "iban", "ssn")

# A run of local-part characters ends at its @, so the search starts there and goes back to the start of the run.
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# A match can only start where a run of digits does, which keeps the search linear.
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
#: The lengths of account numbers by country (ISO 13616).
LENGTHS = {
    country: length
    for length, countries in {
        15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
        22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST",
        26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA",
        30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
    }.items()
    for country in countries.split()
}
SSN = re.compile(r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])")

# Words that speak for a kind, and words that speak against any.
CONTEXT = {
    "email": ("email", "e-mail", "mail", "contact", "write", "courriel", "correo"),
    "ip": ("ip", "host", "server", "address", "login", "adresse"),
    "card": ("card", "visa", "mastercard", "credit", "payment", "karte", "carte", "tarjeta"),
    "phone": ("phone", "tel", "call", "mobile", "fax", "telefon", "téléphone", "teléfono"),
    "iban": ("iban", "bank", "account", "transfer", "konto", "compte", "cuenta"),
    "ssn": ("ssn", "social", "security", "taxpayer"),
}
AGAINST = ("example", "sample", "dummy", "version", "isbn", "test")
PRIOR = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.7, "iban": 0.8, "ssn": 0.4}
BONUS, MALUS = 0.2, 0.3
WORD = re.compile(r"[^\W\d_]+(?:-[^\W\d_]+)*")


def luhn(digits: str) -> bool:
    """Whether the check digit is right: every second digit from the end is doubled, its digits summed."""
    total = sum(map(int, digits[-1::-2])) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return total % 10 == 0


def mod97(iban: str) -> bool:
    """Whether an account number read as base 36, its first four places moved to the end, leaves 1."""
    turned = iban[4:] + iban[:4]
    return int("".join(str(int(c, 36)) for c in turned)) % 97 == 1


def emails(text: str) -> Iterator[tuple[int, int]]:
    after = 0
    for m in DOMAIN.finditer(text):
        start = m.start()
        while start > after and text[start - 1] in LOCAL:
            start -= 1
        if start < m.start():
            yield start, m.end()
            after = m.end()


def iban_end(match: re.Match) -> int | None:
    """Where the account number that starts with the match ends, if there is one."""
    text = match[0]
    ends = [len(text), *(m.start() for m in reversed(list(re.finditer(" ", text))))]
    sizes = {e: e - text.count(" ", 0, e) for e in ends}
    own = LENGTHS.get(text[:2])
    if own is not None:
        # the whole match is tried as well, whatever its length
        ends = [*(e for e in ends if sizes[e] == own), len(text)]
    return next((match.start() + e for e in ends if 15 <= sizes[e] <= 34 and mod97(text[:e].replace(" ", ""))), None)


def ibans(text: str) -> Iterator[tuple[int, int]]:
    at = 0
    while m := IBAN.search(text, at):
        end = iban_end(m)
        if end is not None:
            yield m.start(), end
        # a match that is none may hold the start of one
        at = m.start() + 1 if end is None else end


def found(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of what patterns propose and checks confirm."""
    out = []
    if "@" in text:
        out += [(a, 0, b) for a, b in emails(text)]
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 12:
            digits = m[0].replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), 2, m.end()))
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split(".")):
            out.append((m.start(), 1, m.end()))
    if "+" in text:
        out += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 9 <= sum(c.isdigit() for c in m[0]) <= 15]
    out += [(a, 4, b) for a, b in ibans(text)]
    if "-" in text:
        out += [(m.start(), 5, m.end()) for m in SSN.finditer(text)]
    return sorted(out)


def score(text: str, start: int, kind: str, end: int, reach: int = 60) -> float:
    """The kind's prior, raised by one of its words within ``reach`` characters and lowered by a word against it."""
    near = {w.lower() for w in WORD.findall(text[max(0, start - reach) : start] + " " + text[end : end + reach])}
    s = PRIOR[kind] + BONUS * any(w in near for w in CONTEXT[kind]) - MALUS * any(w in near for w in AGAINST)
    return round(min(1.0, max(0.0, s)), 2)


def spans(docs: DataFrame, threshold: float = 0.6, reach: int = 60) -> DataFrame:
    """doc_id, a count per base kind, base_sha256, spans (kind:start:end), scores, and counts of the added kinds."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = [[] for _ in KINDS]
            digest, text_spans, scores = [], [], []
            for value in batch.column(1):
                text = value.as_py() or ""
                rows = [(a, k, b, score(text, a, KINDS[k], b, reach)) for a, k, b in found(text)] if text else []
                rows = [r for r in rows if r[1] < len(BASE) or r[3] >= threshold]
                named = [f"{KINDS[k]}:{a}:{b}" for a, k, b, _ in rows]
                base = ",".join(n for n, r in zip(named, rows, strict=True) if r[1] < len(BASE))
                for k in range(len(KINDS)):
                    counts[k].append(sum(r[1] == k for r in rows))
                digest.append(hashlib.sha256(base.encode()).hexdigest())
                text_spans.append(",".join(named))
                scores.append(",".join(f"{r[3]:.2f}" for r in rows))
            yield pa.record_batch(
                [batch.column(0), *(pa.array(counts[k], pa.int64()) for k in range(4)), pa.array(digest, pa.string()), pa.array(text_spans, pa.string()), pa.array(scores, pa.string()), pa.array(counts[4], pa.int64()), pa.array(counts[5], pa.int64())],
                names=["doc_id", *(f"n_{k}" for k in BASE), "base_sha256", "spans", "scores", "n_iban", "n_ssn"],
            )

    return docs.select("doc_id", "text").mapInArrow(
        work,
        "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, scores string, n_iban long, n_ssn long",
    )


def redacted(docs: DataFrame, threshold: float = 0.6) -> DataFrame:
    """``docs`` with each span of the text replaced by its kind in brackets; spans inside others go with them."""

    def clean(text: str) -> str:
        parts, at = [], 0
        for a, k, b in found(text):
            if a >= at and (k < len(BASE) or score(text, a, KINDS[k], b) >= threshold):
                parts += [text[at:a], f"[{KINDS[k]}]"]
                at = b
        return "".join(parts) + text[at:]

    place = docs.columns.index("text")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pa.array([None if t is None else clean(t) for t in batch.column(place).to_pylist()], pa.string())
            yield batch.set_column(place, "text", texts)

    return docs.mapInArrow(work, docs.schema)
