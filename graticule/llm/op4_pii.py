"""Personal data: regular expressions propose spans, checksums confirm them, nearby context words adjust a score.

Kinds: email, ip, card (Luhn) and phone follow fixed base rules and are always kept; the method adds IBANs (mod-97), and
digit groups that only words such as "phone" or "card" nearby make telephone or card numbers.  A span's score is the prior of
its kind, raised by context words within ``WINDOW`` characters, lowered by words that speak against it.

Texts are searched whole; offsets are code points, ends exclusive.  A missing text counts as empty and has no spans.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.functions import pandas_udf

from graticule.llm.common import ids_and_texts

# The order of kinds in digests, base ones first.
KINDS = ("email", "ip", "card", "phone", "iban", "local_phone", "spaced_card")
BASE = KINDS[:4]

# Score before context, words that raise it, words that lower it.
PRIOR = {"email": 0.95, "ip": 0.8, "card": 0.9, "phone": 0.85, "iban": 0.95, "local_phone": 0.35, "spaced_card": 0.35}
SUPPORT = {
    "email": ("mail", "contact", "write"), "ip": ("ip", "address", "host", "server"), "card": ("card", "visa", "mastercard", "credit"),
    "phone": ("phone", "tel", "call", "mobile", "fax"), "iban": ("iban", "account", "bank", "konto"),
    "local_phone": ("phone", "tel", "telephone", "call", "mobile", "fax", "telefon"),
    "spaced_card": ("card", "visa", "mastercard", "credit"),
}
AGAINST = ("version", "isbn", "order", "invoice", "release")
WINDOW, THRESHOLD = 40, 0.5

# A span can start only where its run of characters starts, which keeps the search linear: a later start within the run would
# meet the same end.  The e-mail rule alone can also start right after a match; see _emails.
_EMAIL_TAIL = r"[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"
_EMAIL = re.compile(r"(?<![A-Za-z0-9._%+-])" + _EMAIL_TAIL)
_EMAIL_HERE = re.compile(_EMAIL_TAIL)
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
# Characters of an IBAN by country (registry of ISO 13616).
IBAN_LENGTH = {c[:2]: int(c[2:]) for c in (
    "AD24 AE23 AL28 AT20 AZ28 BA20 BE16 BG22 BH22 BI27 BR29 BY28 CH21 CR22 CY28 CZ24 DE22 DJ27 DK18 DO28 EE20 EG29 ES24 FI18 FK18 "
    "FO18 FR27 GB22 GE22 GI23 GL18 GR27 GT28 HR21 HU28 IE22 IL23 IQ23 IS26 IT27 JO30 KW30 KZ20 LB28 LC32 LI21 LT20 LU20 LV21 LY25 "
    "MC27 MD24 ME22 MK19 MN20 MR27 MT31 MU30 NI28 NL18 NO15 OM23 PK24 PL28 PS29 PT25 QA29 RO24 RS22 RU33 SA24 SC31 SD18 SE24 SI19 "
    "SK24 SM27 SO23 ST25 SV28 TL23 TN24 TR26 UA29 VA22 VG24 XK20 YE30").split()}
_LOCAL = re.compile(r"(?<![0-9+.-])\(?[0-9]{2,5}\)?[ ./-][0-9][0-9 ./-]{4,12}[0-9](?![0-9])")
_DIGIT = re.compile(r"[0-9]")
_WORDS = re.compile(r"[a-z]+")


def luhn(digits: str) -> bool:
    doubled = [d * 2 - 9 * (d > 4) for d in map(int, digits[-2::-2])]
    return (sum(map(int, digits[-1::-2])) + sum(doubled)) % 10 == 0


def mod97(iban: str) -> bool:
    """Country code and check digits moved to the end, letters read as 10 to 35."""
    moved = iban[4:] + iban[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def _digits(s: str) -> str:
    return "".join(_DIGIT.findall(s))


def _emails(text: str) -> Iterator[tuple[int, int]]:
    at = 0
    if "@" not in text:
        return
    while True:
        m = (at and _EMAIL_HERE.match(text, at)) or _EMAIL.search(text, at)
        if not m:
            return
        yield m.span()
        at = m.end()


def _ibans(text: str) -> Iterator[tuple[int, int]]:
    """Spans that pass mod-97: of the country's length, else the whole match.

    A match may take in words and codes behind the number, so the search goes on at the end found, or one place on if none passes.
    """
    at = 0
    while m := _IBAN.search(text, at):
        ends, s = [], ""
        for i in range(m.start(), m.end()):
            if text[i] != " ":
                s += text[i]
                if i + 1 == m.end() or text[i + 1] == " ":
                    ends.append((len(s) == IBAN_LENGTH.get(s[:2]), i + 1, s))
        ends = [e for e in ends if e[0] or e[1] == m.end()]
        end = next((e for _, e, s in sorted(ends, reverse=True) if 15 <= len(s) <= 34 and mod97(s)), None)
        if end:
            yield m.start(), end
        at = end or m.start() + 1


def base_spans(text: str) -> list[tuple[int, str, int]]:
    """(start, kind, end) by the base rules; matches that fail their check are dropped and not tried again."""
    out = [(a, "email", b) for a, b in _emails(text)]
    if not _DIGIT.search(text):
        return out
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            out.append((m.start(), "ip", m.end()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 14 and 14 <= len(d := _digits(m[0])) <= 19 and luhn(d):
            out.append((m.start(), "card", m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= len(_digits(m[0])) <= 15:
                out.append((m.start(), "phone", m.end()))
    return out


def _score(text: str, kind: str, start: int, end: int) -> float:
    near = set(_WORDS.findall((text[max(0, start - WINDOW):start] + " " + text[end:end + WINDOW]).lower()))
    score = PRIOR[kind] + 0.3 * (not near.isdisjoint(SUPPORT[kind])) - 0.3 * (not near.isdisjoint(AGAINST))
    return min(1.0, max(0.0, score))


def _merged(spans: Iterable[tuple[int, int]]) -> tuple[list[int], list[int]]:
    """Starts and ends of the disjoint stretches that the spans cover, ascending."""
    starts, ends = [], []
    for a, b in sorted(spans):
        if ends and a < ends[-1]:
            ends[-1] = max(ends[-1], b)
        else:
            starts.append(a)
            ends.append(b)
    return starts, ends


def find_spans(text: str | None) -> list[tuple[int, str, int, float]]:
    """(start, kind, end, score) in digest order: every base span, and added ones that reach THRESHOLD and overlap no other."""
    text = text or ""
    base = base_spans(text)
    found = [(a, k, b, max(THRESHOLD, _score(text, k, a, b))) for a, k, b in base]
    if _DIGIT.search(text):
        more = [(a, "iban", b) for a, b in _ibans(text)]
        more += [(m.start(), "local_phone", m.end()) for m in _LOCAL.finditer(text) if 7 <= len(_digits(m[0])) <= 12]
        more += [(m.start(), "spaced_card", m.end()) for m in _CARD.finditer(text)
                 if " " in m[0] and len(d := _digits(m[0])) in (15, 16) and not luhn(d)]
        starts, ends = _merged((a, b) for a, _, b in base)
        reached = 0  # candidates come by start, so of the added spans only the farthest end can be in the way
        for a, k, b in sorted(more):
            before = bisect_left(starts, b) - 1
            if a >= reached and (before < 0 or ends[before] <= a) and (score := _score(text, k, a, b)) >= THRESHOLD:
                found.append((a, k, b, score))
                reached = b
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[1]), s[2]))


def redact(text: str, spans: list[tuple[int, str, int, float]]) -> str:
    """Each span replaced by its kind in angle brackets; overlapping spans are replaced together."""
    out, at = [], 0
    for start, kind, end, _ in spans:
        if start >= at:
            out += [text[at:start], f"<{kind.upper()}>"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def span_table(docs: DataFrame) -> DataFrame:
    """One row per span: doc_id, kind, start, end, score, value."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(i, k, a, b, s, t[a:b]) for i, t in zip(batch["doc_id"], batch["text"]) for a, k, b, s in find_spans(t)]
            yield pd.DataFrame(rows, columns=["doc_id", "kind", "start", "end", "score", "value"])

    return ids_and_texts(docs).mapInPandas(run, "doc_id long, kind string, start long, end long, score double, value string")


def digest(docs: DataFrame) -> DataFrame:
    """Per document: counts of the base kinds, the hash of all base spans, all spans written out, the least score."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for text in batch["text"]:
                spans = find_spans(text)
                written = [(k, f"{k}:{a}:{b}") for a, k, b, _ in spans]
                base = ",".join(w for k, w in written if k in BASE)
                rows.append((
                    *(sum(k == kind for k, _ in written) for kind in BASE), hashlib.sha256(base.encode()).hexdigest(),
                    ",".join(w for _, w in written), min((s for *_, s in spans), default=None)))
            out = pd.DataFrame(rows, columns=["n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "least_score"])
            out.insert(0, "doc_id", batch["doc_id"].to_numpy())
            yield out

    return ids_and_texts(docs).mapInPandas(
        run, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, least_score double")


def redacted(docs: DataFrame) -> DataFrame:
    """``docs`` with personal data replaced in ``text`` (missing texts stay so) and ``n_chars``, if present, brought up to date."""

    @pandas_udf("string")
    def clean(text: pd.Series) -> pd.Series:
        return text.map(lambda t: t if t is None else redact(t, find_spans(t)))

    out = docs.withColumn("text", clean(docs["text"].cast("string")))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return out
