import re
import random

import pytest
from pyspark.sql import functions as F

from daybook.llm.pii import find_pii, luhn, mask_pii, mod97, scan

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain_base(text):
    """The base spans by the plain patterns, one after the other."""
    digits = lambda s: re.sub(r"[^0-9]", "", s)
    out = {("email", *m.span()) for m in EMAIL.finditer(text)}
    out |= {("ip", *m.span()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))}
    out |= {("card", *m.span()) for m in CARD.finditer(text) if 16 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))}
    out |= {("phone", *m.span()) for m in PHONE.finditer(text) if 8 <= len(digits(m[0])) <= 15}
    return out


def base(text):
    return {(k, s, e) for k, s, e, _, _, is_base in scan(text) if is_base}


@pytest.mark.parametrize(
    "text",
    [
        "", "a@b.cc_x@d.ee", "a@b_c@d.ee", "x@@y.zz", "é.ñ@b.de.", "1.2.3.4.5.6.7.8", "1.2.3.256 0001.02.3.4",
        "4111 1111 1111 1111", "4111-1111-1111-1112", "+49 (30) 123-456 78 ", "+1((((", "++1 22 33 44 55",
        "1" * 500, "." * 300 + "1.1.1.1", "a." * 200 + "@b.c", "@" * 50, "𝒳 4111111111111111 𝒳 me@x.org",
    ],
)
def test_base_spans_are_those_of_the_plain_patterns(text):
    assert base(text) == plain_base(text)


def test_base_spans_on_random_texts():
    rng = random.Random(7)
    for _ in range(3000):
        text = "".join(rng.choice("a@.+-_ 0123456789()é%") for _ in range(rng.randrange(40)))
        assert base(text) == plain_base(text), text


def test_long_texts_are_scanned_in_linear_time():
    for text in ("a" * 400_000, "1" * 400_000, "1." * 200_000, "a@" * 200_000, "+1(" * 150_000, "A0" * 200_000):
        scan(text)


def test_checksums_and_context_decide_on_added_spans():
    assert mod97("GB82WEST12345698765432") and not mod97("GB82WEST12345698765431")
    kinds = lambda t: [s[0] for s in scan(t) if not s[5]]
    assert kinds("my account GB82 WEST 1234 5698 7654 32 thanks") == ["iban"]
    assert kinds("my account GB82 WEST 1234 5698 7654 31 thanks") == []
    assert kinds("amex card 378282246310005") == ["short_card"]
    assert kinds("number 378282246310005") == []
    assert kinds("my ssn is 123-45-6789") == ["us_ssn"]
    assert kinds("order no 123-45-6789") == []


def test_rows_nulls_clashing_columns_and_mask(spark):
    rows = [(1, "mail me@x.org now", "k"), (1, "mail me@x.org now", "k"), (None, None, None), (2, "", "q")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, pii string")
    out = find_pii(docs)
    assert out.columns == ["doc_id", "pii"]
    assert sorted((r.doc_id or 0, len(r.pii)) for r in out.collect()) == [(0, 0), (1, 1), (1, 1), (2, 0)]
    assert find_pii(docs.limit(0)).count() == 0
    both = find_pii(docs).withColumn("t", F.lit("mail me@x.org now"))
    masked = {r.m for r in both.where("doc_id = 1").select(mask_pii(F.col("t"), F.col("pii")).alias("m")).collect()}
    assert masked == {"mail [email] now"}


def test_account_numbers_have_the_length_of_their_country():
    def found(text):
        return [text[s[1] : s[2]] for s in scan(text) if s[0] == "iban"]

    number = "DE89 3704 0044 0532 0130 00"
    assert found(f"IBAN {number} BIC COBADEFFXXX") == [number]
    assert found("account GB29 NWBK 6016 1331 9268 19 THANKS") == ["GB29 NWBK 6016 1331 9268 19"]
    assert found("iban GB29NWBK60161331926819, bank") == ["GB29NWBK60161331926819"]
    for wrong in ("DE89 3704 0044 0532 0130 01", "DE89  3704 0044 0532 0130 00", "XX89 3704 0044 0532 0130 00", "DE89 3704"):
        assert found(f"IBAN {wrong} bank") == []
    assert found(f"IBAN {number}7 bank") == [] and found(f"IBAN x{number} bank") == []
    scan("IBAN " + "DE89 " * 100_000)
