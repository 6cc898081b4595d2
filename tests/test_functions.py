"""Expressions against the standard library and hand-made cases."""

import html
import sys
import unicodedata

import pytest
from pyspark.sql import functions as F

from tallyweave.functions import html as H
from tallyweave.functions import ids, urls as U, values as N


def column(spark, values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, t string")


def evaluate(spark, values, expr):
    rows = column(spark, values).select("i", expr(F.col("t")).alias("o")).collect()
    return [r.o for r in sorted(rows, key=lambda r: r.i)]


def test_fold_matches_unicode_database(spark):
    chars = [chr(c) for c in range(0x20, sys.maxunicode + 1)
             if not 0xD800 <= c <= 0xDFFF and unicodedata.category(chr(c))[0] not in "C"]
    texts = ["".join(chars[i:i + 64]) for i in range(0, len(chars), 64)]
    want = [unicodedata.normalize("NFKD", t).encode("ascii", "ignore").decode() for t in texts]
    assert evaluate(spark, texts, ids.ascii_fold) == want


def test_words_separate_at_accents(spark):
    assert evaluate(spark, ["Doña Ana", "St. Mary's", "ﬁve ½", "Straße"], ids.words) == [
        "don a ana", "st mary s", "five 1 2", "strasse"]


def test_unescape_matches_standard_library(spark):
    texts = ["a &amp; b", "&lt;&gt;", "&#233;&#xE9;", "&notit;", "&copy2", "& &;", "&amp;lt;",
             "&hellip;&frac12;", "x&ampy", "&#128512;", "plain", "&NotEqualTilde;", "AT&T"]
    assert evaluate(spark, texts, H.unescape) == [html.unescape(t) for t in texts]


@pytest.mark.parametrize("base,raw,want", [
    ("https://a.example.org/x/y", "z?b=2&a=1&utm_source=q#f", "https://a.example.org/x/z?a=1&b=2"),
    ("https://a.example.org/x/y", "../../q/./r/..", "https://a.example.org/q/"),
    ("https://a.example.org/x/y", "//B.Example.org", "https://b.example.org/"),
    ("https://a.example.org/x/y?k=1", "", ""),
    ("https://a.example.org/x/y?k=1", "#top", "https://a.example.org/x/y?k=1"),
    ("https://a.example.org/", "/%7Euser/%2fa%e9", "https://a.example.org/~user/%2Fa%E9"),
    ("https://a.example.org/", "http://a.example.org:443/", "http://a.example.org/"),
    ("https://a.example.org/", "http://a.example.org:8080/", ""),
    ("https://a.example.org/", "http://u:p@a.example.org/", ""),
    ("https://a.example.org/", "http://10.1.2.3/", ""),
    ("https://a.example.org/", "http://8.8.8.8/x", "http://8.8.8.8/x"),
    ("https://a.example.org/", "http://[::1]/", ""),
    ("https://a.example.org/", "http://printer.local/", ""),
    ("https://a.example.org/", "javascript:void(0)", ""),
    ("https://a.example.org/", "?q=a+b&q=&c=%26*~", "https://a.example.org/?c=%26%2A~&q=&q=a+b"),
    ("https://a.example.org/", "a&amp;b", "https://a.example.org/a&b"),
])
def test_normalize(spark, base, raw, want):
    df = spark.createDataFrame([(base, raw)], "base string, raw string")
    if raw == "":
        want = base
    assert U.normalize_urls(df, "raw", "out", "base").first().out == want


def test_publishable(spark):
    urls = ["https://e.org/a?year=2024", "https://e.org/?token=1", "https://e.org/a@b.co",
            "https://e.org/?page=" + "x" * 41, "https://x.cloudflare.com/",
            "https://e.org/cdn-cgi/x", "https://e.org/?ref=1"]
    assert evaluate(spark, urls, U.publishable) == [True] + [False] * 6


def test_integers(spark):
    texts = ["1,234", "12,34", " 5 ", "x", "", "-3", "40.5%"]
    assert evaluate(spark, texts, N.lenient_int) == [1234, 1234, 5, None, None, -3, None]
    assert evaluate(spark, texts, N.strict_count) == [1234, None, 5, None, None, None, None]
    assert evaluate(spark, texts, N.digits_or_zero) == [1234, 1234, 5, 0, 0, -3, 405]
    assert evaluate(spark, texts, N.first_int) == [1234, 1234, 5, None, None, -3, 40]


def test_invalid_ids_are_null(spark):
    df = spark.createDataFrame([("Michigan", "county", "A"), ("MI", "planet", "A"),
                                ("MI", "county", "--"), ("MI", "county", "A")],
                               "s string, l string, n string")
    got = [r[0] for r in df.select(ids.jurisdiction_id(
        F.col("s"), F.col("l"), F.col("n"))).collect()]
    assert got == [None, None, None, "us:mi:county:a"]


def test_hostile_character_references(spark):
    from tallyweave.functions.html import unescape

    cases = {"&#55296;x": "\ufffdx", "&#1114112;": "\ufffd", "&#0;": "\ufffd", "&#128;": "€",
             "&#129;": "\x81", "&#x80;": "€", "&#00000065;": "A", "&#x0000041;": "A",
             "&#99999999999999999999;": "\ufffd", "&#xD800;": "\ufffd", "a &#233 b": "a é b"}
    df = spark.createDataFrame([(k,) for k in cases], "t string")
    got = {r[0]: r[1] for r in df.select("t", unescape(F.col("t"))).collect()}
    assert got == cases


def test_payload_kind_reads_any_bytes_and_whole_lines(spark):
    from tallyweave.sources.results import payload_kind

    long = b"x" * 70_000 + b",a,b\n1"
    cases = [(b"\xff\xfe\x00,a,b", "csv"), (long, "csv"), (b" \n{", "json"), (b"", "unknown"),
             (b"PK\x03\x04", "excel"), ("é".encode() * 40_000, "unknown")]
    df = spark.createDataFrame([(bytearray(b), k) for b, k in cases], "b binary, k string")
    assert df.where(payload_kind(F.col("b")) != F.col("k")).count() == 0
