"""Normalisers on small tables of invented values."""

import datetime

import pytest
from pyspark.sql import functions as F

from tidelock.functions import normalize as N

CASES = {
    "ssn": (N.ssn_last4, "string", [
        (None, "missing", None, None), ("  ", "missing", None, None), ("12", "malformed", None, "wrong_length_2"), ("12a4", "malformed", None, "non_numeric"), ("5555", "placeholder", None, "repeated_digits"),
        ("4567", "placeholder", None, "sequential_digits"), ("8901", "placeholder", None, "sequential_digits"), ("3210", "placeholder", None, "sequential_digits"), ("1098", "placeholder", None, "sequential_digits"), (" 4921 ", "valid", "4921", None), ("１２３５", "malformed", None, "non_numeric"),
    ]),
    "dob": (N.birthday, "date", [
        (None, "missing", None, None), (datetime.date(1970, 1, 1), "placeholder", None, "canonical_epoch"), (datetime.date(1900, 1, 1), "placeholder", None, "canonical_epoch"), (datetime.date(1909, 12, 31), "malformed", None, "implausible_year"),
        (datetime.date(2026, 8, 19), "malformed", None, "implausible_year"), (datetime.date(1984, 2, 29), "valid", "1984-02-29", None),
    ]),
    "name": (N.name, "string", [
        (None, "missing", None, None), (" \t ", "missing", None, None), ("  Žofie   KRÁLOVÁ ", "valid", "zofie kralova", None), ("Groß", "valid", "gross", None), ("O’Neil-Díaz", "valid", "o’neil-diaz", None), ("ﬁnn", "valid", "finn", None),
    ]),
    "email": (N.email, "string", [
        (None, "missing", None, None), ("", "missing", None, None), ("NONE", "placeholder", None, "placeholder_literal"), ("kаi@post.io", "malformed", None, "non_ascii[U+0430]"), ("kai.post.io", "malformed", None, "missing_at"), ("kai k@post.io", "malformed", None, "internal_whitespace"),
        ("kai,k@post.io", "malformed", None, "illegal_character"), ("a@b@c", "malformed", None, "illegal_character"), ("k" * 65 + "@post.io", "malformed", None, "local_part_length"), ("kai@post..io", "malformed", None, "double_dot_domain"), ("kai@post.io.", "malformed", None, "trailing_punctuation"),
        ("kai@-post.io", "malformed", None, "trailing_punctuation"), ("kai@post", "malformed", None, "missing_tld"), ("kai@example.org", "placeholder", None, "reserved_domain"), ("kai@post.invalid", "placeholder", None, "reserved_domain"), (" Kai+X@Post.IO\n", "valid", "kai+x@post.io", None),
    ]),
    "phone": (N.phone, "string", [
        (None, "missing", None, None), (" - ", "missing", None, None), ("7777777777", "placeholder", None, "repeated_digits"), ("234-567-8901", "placeholder", None, "sequential_digits"), ("712-555-01３3", "malformed", None, "non_ascii[U+FF13]"), ("712-CALL-NOW", "malformed", None, "vanity_or_letters"),
        ("44712555013", "malformed", None, "eleven_digits_non_us"), ("712 555", "malformed", None, "digit_count_6"), ("112 555 0133", "malformed", None, "invalid_nanp_prefix"), ("712 155 0133", "malformed", None, "invalid_nanp_prefix"), ("1 (712) 555-0133", "valid", "+17125550133", None),
        ("712.555.0133 ext. 9", "valid", "+17125550133", "extension_dropped"), ("712 555 0133 x12", "valid", "+17125550133", "extension_dropped"), ("7125550133x12", "malformed", None, "vanity_or_letters"),
    ]),
}


@pytest.mark.parametrize("kind", CASES)
def test_normaliser(spark, kind):
    function, dtype, rows = CASES[kind]
    table = spark.createDataFrame([(k, r[0]) for k, r in enumerate(rows)], f"k int, raw {dtype}").withColumn("n", function(F.col("raw"))).orderBy("k").collect()
    assert [(r.n.status, r.n.normalized, r.n.defect_class) for r in table] == [r[1:] for r in rows]


def test_status_meaning(spark):
    rows = [(None, "missing"), (" ", "missing"), ("FUNDED ", "funded"), ("Paid  Off", "paid_off"), ("paid_off", "paid_off"), ("CANCELED", "cancelled"), ("on hold", "unrecognised")]
    got = spark.createDataFrame([(k, r[0]) for k, r in enumerate(rows)], "k int, s string").orderBy("k").select(N.status_meaning(F.col("s")).alias("m")).collect()
    assert [r.m for r in got] == [r[1] for r in rows]


def test_raw_email_parts_keep_what_normalising_refuses(spark):
    local, domain = N.raw_email_parts(F.col("e"))
    rows = spark.createDataFrame([(" QA+Test@Example.com ",), ("none",), (None,), ("a@b@c",)], "e string").select(local.alias("l"), domain.alias("d"), N.subaddress_tag(local).alias("t")).collect()
    assert [tuple(r) for r in rows] == [("qa+test", "example.com", "test"), ("none", "", ""), ("", "", ""), ("a", "b@c", "")]
