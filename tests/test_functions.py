import datetime as dt
from decimal import Decimal
from urllib.parse import urljoin, urlparse

from pyspark.sql import functions as F

from ratewatch.functions import (clip_text, error_text, gate_detail, page_label, resolve_url,
                                 safe_path_component, sha256_hex, to_bool_pg, to_numeric, to_timestamptz,
                                 url_join)


def _one(spark, rows, schema, expr):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expr.alias("x")).collect()]


def test_numeric_text(spark):
    vals = ["0.05", "-1", "007", "", "1e-3", "+5", ".5", " 5", "5%", "1.5\n", None]
    got = _one(spark, [(v,) for v in vals], "s string", to_numeric("s"))
    assert got == [Decimal("0.05"), Decimal("-1"), Decimal("7")] + [None] * 8


def test_numeric_overflow_is_null(spark):
    got = _one(spark, [("12345678901234567890.12",)], "s string", to_numeric("s"))
    assert got == [None]


def test_booleans(spark):
    vals = ["true", "T", "on", "off", "yes", "0", "", "maybe", " No ", "of", "o"]
    got = _one(spark, [(v,) for v in vals], "s string", to_bool_pg("s"))
    assert got == [True, True, True, False, True, False, None, None, False, False, None]


def test_timestamps(spark):
    vals = ["2026-02-10T01:00:00+11:00", "2026-02-10", "", "garbage"]
    got = _one(spark, [(v,) for v in vals], "s string", F.date_format(to_timestamptz("s"), "yyyy-MM-dd HH:mm"))
    assert got == ["2026-02-09 14:00", "2026-02-10 00:00", None, None]


def test_text_helpers(spark):
    df = spark.createDataFrame([("abc", "abcdef", "a/b c:é", 7, 12345)], "a string, b string, c string, n int, m int")
    r = df.select(clip_text("a", 5), clip_text("b", 5), safe_path_component("c"), page_label("n"),
                  page_label("m"), sha256_hex(F.lit("")), error_text(F.lit(200), F.lit("x")),
                  error_text(F.lit(503), F.lit("")), error_text(F.lit(500), F.lit("boom")),
                  url_join(F.lit("https://h.example//"), F.lit("//cds/x"))).first()
    assert list(r) == ["abc", "ab...", "a_b_c_é", "0007", "12345", None, None, "HTTP 503", "boom",
                       "https://h.example/cds/x"]


def test_gate_detail_formats_like_python(spark):
    r = spark.range(1).select(gate_detail(F.lit(1e7), F.lit(5.0), F.lit(">="), "h"),
                              gate_detail(F.lit(2.5), F.lit(36.0), F.lit("<="))).first()
    assert r[0] == f"{1e7}h >= {5.0}h"
    assert r[1] == f"{2.5} <= {36.0}"


def _py_resolve(cur, nxt):
    if not nxt:
        return ""
    p = urlparse(nxt)
    if p.scheme and p.netloc:
        return nxt
    return urljoin(cur, nxt)


def test_resolve_url_matches_rfc_resolution(spark):
    cur = ["http://a.example.com/b/c/d;p?q#f", "https://h.example.com", "https://h.example.com/x/y/",
           "http://h/a//b/c"]
    nxt = ["g", "./g", "g/", "/g", "//g", "?y", "g?y", "#s", "g#s", "..", "../", "../g", "../..", "../../g",
           "../../../g", "/./g", "/../g", "g.", ".g", "g..", "..g", "./../g", "./g/.", "g/./h", "g/../h",
           "https://z.example.org/p?x", "", None, "?page=2&x=1", "/cds/products?page=3", "a//b"]
    rows = [(c, n) for c in cur for n in nxt]
    got = spark.createDataFrame(rows, "c string, n string").select("c", "n", resolve_url("c", "n")).collect()
    bad = [(c, n, r, _py_resolve(c, n)) for c, n, r in got if r != _py_resolve(c, n)]
    assert not bad, bad[:5]
