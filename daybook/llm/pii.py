"""Personal data: patterns propose spans, checksums confirm, context adjusts.

Null and empty texts have no spans. A text is scanned whole and in one task;
the scan is linear in its length. Repeated rows, ties and null ids are scanned
like any others, one result row for each input row. An empty table gives an
empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.llm.rows import id_and_text, map_text

BASE_KINDS = ("email", "ip", "card", "phone")
ADDED_KINDS = ("iban", "short_card", "local_phone", "us_ssn")
KINDS = BASE_KINDS + ADDED_KINDS

SPAN = T.StructType(
    [
        T.StructField("kind", T.StringType()),
        T.StructField("start", T.IntegerType()),
        T.StructField("end", T.IntegerType()),
        T.StructField("value", T.StringType()),
        T.StructField("score", T.DoubleType()),
        T.StructField("base", T.BooleanType()),
    ]
)
_ARROW_SPAN = pa.struct(
    [
        ("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()),
        ("value", pa.string()), ("score", pa.float64()), ("base", pa.bool_()),
    ]
)

# Score of a span whose validator passed, before its context is read.
PRIOR = {
    "email": 0.8, "ip": 0.5, "card": 0.7, "phone": 0.6,
    "iban": 0.8, "short_card": 0.4, "local_phone": 0.3, "us_ssn": 0.35,
}
CONTEXT_BONUS = 0.35
CONTEXT_MALUS = 0.3
CONTEXT_CHARS = 40
MIN_SCORE = 0.65
CONTEXT = {
    "email": r"e-?mail|contact|write to|reach",
    "ip": r"\bip\b|address|host|server|client|login",
    "card": r"card|visa|master|amex|credit|debit|payment",
    "phone": r"phone|tel\b|tel[.:]|call|mobile|fax|whatsapp",
    "iban": r"iban|account|bank|transfer|konto|cuenta|compte",
    "us_ssn": r"ssn|social security|tax id",
}
CONTEXT["short_card"], CONTEXT["local_phone"] = CONTEXT["card"], CONTEXT["phone"]
CONTEXT = {kind: re.compile(words, re.IGNORECASE) for kind, words in CONTEXT.items()}
# Words that speak against personal data.
AGAINST = re.compile(r"version|order no|invoice no|isbn|serial|example|sample|test", re.IGNORECASE)

_LOCAL_PART = re.compile(r"[A-Za-z0-9._%+-]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9][0-9.]+[0-9]")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_DIGITS = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])([A-Z]{2})[0-9]{2}(?= ?[A-Z0-9])")
# Characters of an international account number, by country.
IBAN_LENGTHS = {
    "AD": 24, "AE": 23, "AL": 28, "AT": 20, "AZ": 28, "BA": 20, "BE": 16, "BG": 22, "BH": 22, "BR": 29,
    "BY": 28, "CH": 21, "CR": 22, "CY": 28, "CZ": 24, "DE": 22, "DK": 18, "DO": 28, "EE": 20, "EG": 29,
    "ES": 24, "FI": 18, "FO": 18, "FR": 27, "GB": 22, "GE": 22, "GI": 23, "GL": 18, "GR": 27, "GT": 28,
    "HR": 21, "HU": 28, "IE": 22, "IL": 23, "IQ": 23, "IS": 26, "IT": 27, "JO": 30, "KW": 30, "KZ": 20,
    "LB": 28, "LC": 32, "LI": 21, "LT": 20, "LU": 20, "LV": 21, "LY": 25, "MC": 27, "MD": 24, "ME": 22,
    "MK": 19, "MR": 27, "MT": 31, "MU": 30, "NL": 18, "NO": 15, "PK": 24, "PL": 28, "PS": 29, "PT": 25,
    "QA": 29, "RO": 24, "RS": 22, "SA": 24, "SC": 31, "SE": 24, "SI": 19, "SK": 24, "SM": 27, "ST": 25,
    "SV": 28, "TL": 23, "TN": 24, "TR": 26, "UA": 29, "VA": 22, "VG": 24, "XK": 20,
}
_SSN = re.compile(r"[0-9]{3}-[0-9]{2}-[0-9]{4}")


def luhn(digits: str) -> bool:
    """The check of payment card numbers."""
    total = 0
    for place, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        if place % 2:
            n = n * 2 - 9 if n > 4 else n * 2
        total += n
    return total % 10 == 0


def mod97(iban: str) -> bool:
    """The check of international account numbers (blanks removed, upper case)."""
    turned = iban[4:] + iban[:4]
    rest = 0
    for c in turned:
        rest = (rest * 10 + ord(c) - 48 if c <= "9" else rest * 100 + ord(c) - 55) % 97
    return rest == 1


def _emails(text: str) -> Iterator[tuple[int, int]]:
    # The local part before an @ is a run of its characters; looking back from
    # each @ finds the leftmost start without trying every place of the run.
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and _LOCAL_PART.match(text[start - 1]):
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield start, found.end()
        done = found.end() if found else at + 1
        at = text.find("@", done)


def _ips(text: str) -> Iterator[tuple[int, int]]:
    for run in _DOTTED.finditer(text):
        if run.group().count(".") < 3:
            continue
        for m in _IP.finditer(run.group()):
            parts = [p.lstrip("0") for p in m.group().split(".")]
            if all(len(p) < 3 or (len(p) == 3 and p <= "255") for p in parts):
                yield run.start() + m.start(), run.start() + m.end()


def _iban_end(text: str, head: re.Match) -> int | None:
    """Where an account number ends that begins with a country and its check digits.

    It has as many characters as its country says, single blanks between them,
    none of which follows; and its check passes.
    """
    length = IBAN_LENGTHS.get(head[1], 0)
    plain, at = [], head.start()
    while len(plain) < length and at < len(text):
        c = text[at]
        if c == " " and text[at - 1] != " ":
            pass
        elif "0" <= c <= "9" or "A" <= c <= "Z":
            plain.append(c)
        else:
            return None
        at += 1
    follows = text[at : at + 1]
    if not length or len(plain) < length or follows.isascii() and follows.isalnum():
        return None
    return at if mod97("".join(plain)) else None


def _propose(text: str) -> Iterator[tuple[str, int, int]]:
    """Spans of every kind whose own check passes, by kind."""
    if "@" in text:
        for start, end in _emails(text):
            yield "email", start, end
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= sum("0" <= c <= "9" for c in m.group()) <= 15:
                yield "phone", *m.span()
    dotted = False
    for m in _DIGITS.finditer(text):
        dotted = True
        plain = m.group().replace(" ", "").replace("-", "")
        n = len(plain)
        if 16 <= n <= 19:
            if luhn(plain):
                yield "card", *m.span()
        elif 13 <= n <= 15 and luhn(plain):
            yield "short_card", *m.span()
        elif n == 9 and _SSN.fullmatch(m.group()):
            if plain[:3] not in ("000", "666") and plain[0] != "9" and plain[3:5] != "00" and plain[5:] != "0000":
                yield "us_ssn", *m.span()
        elif 9 <= n <= 12:
            yield "local_phone", *m.span()
    if dotted or "." in text:
        for start, end in _ips(text):
            yield "ip", start, end
    if dotted:
        done = 0
        for m in _IBAN.finditer(text):
            end = _iban_end(text, m) if m.start() >= done else None
            if end is not None:
                yield "iban", m.start(), end
                done = end


def scan(text: str, min_score: float = MIN_SCORE) -> list[tuple]:
    """All spans of one text as (kind, start, end, value, score, base).

    Ordered by kind as listed in `KINDS`, then by start. Base kinds always
    stay; an added kind needs `min_score` and must not touch a base span.
    """
    found = []
    for kind, start, end in _propose(text):
        near = f"{text[max(0, start - CONTEXT_CHARS):start]} {text[end:end + CONTEXT_CHARS]}"
        score = PRIOR[kind]
        score += CONTEXT_BONUS * bool(CONTEXT[kind].search(near))
        score -= CONTEXT_MALUS * bool(AGAINST.search(near))
        found.append((kind, start, end, text[start:end], round(min(1.0, max(0.0, score)), 3), kind in BASE_KINDS))
    base = sorted((s for s in found if s[5]), key=lambda s: s[1])
    kept, at, reach = list(base), 0, -1
    for span in sorted((s for s in found if not s[5] and s[4] >= min_score), key=lambda s: s[1]):
        while at < len(base) and base[at][1] < span[2]:
            reach = max(reach, base[at][2])
            at += 1
        if reach <= span[1]:
            kept.append(span)
    return sorted(kept, key=lambda s: (KINDS.index(s[0]), s[1]))


def find_pii(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_score: float = MIN_SCORE
) -> DataFrame:
    """`doc_id` and `pii`, an array of spans, for each row of `docs`.

    Offsets are code points, the end is exclusive.
    """

    def make():
        def work(texts: list[str]) -> list[pa.Array]:
            names = _ARROW_SPAN.names
            spans = [[dict(zip(names, s)) for s in scan(t, min_score)] for t in texts]
            return [pa.array(spans, type=pa.list_(_ARROW_SPAN))]

        return work

    return map_text(
        id_and_text(docs, id_col, text_col), make, [T.StructField("pii", T.ArrayType(SPAN))]
    )


def mask_pii(text: Column, spans: Column) -> Column:
    """The text with every span replaced by its kind in brackets.

    Where spans touch, the one that starts first counts.
    """
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"], s["end"], s["kind"])))
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))
    done = F.aggregate(
        ordered,
        start,
        lambda acc, s: F.when(s["start"] < acc["at"], acc).otherwise(
            F.struct(
                F.concat(
                    acc["out"],
                    F.substring(text, acc["at"] + 1, s["start"] - acc["at"]),
                    F.lit("["), s["kind"], F.lit("]"),
                ).alias("out"),
                s["end"].alias("at"),
            )
        ),
    )
    tail = F.substring(text, done["at"] + 1, F.length(text))
    return F.concat(done["out"], tail)
