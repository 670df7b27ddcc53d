"""Text, hashing, URL and formatting helpers (all native Spark expressions)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _lit(c) -> Column:
    return F.lit(c) if isinstance(c, (str, int, float)) and not isinstance(c, bool) else c


def safe_path_component(c) -> Column:
    """Every character that is not a letter, digit, '-', '_' or '.' becomes '_'."""
    return F.regexp_replace(_col(c), r"[^\p{L}\p{N}\-_.]", "_")


def page_label(n) -> Column:
    """Zero-padded page number (at least 4 digits, never truncated)."""
    return F.format_string("%04d", _col(n))


def sha256_hex(b) -> Column:
    """SHA-256 hex of a body (UTF-8 for strings); NULL for an empty or missing body."""
    b = _col(b)
    return F.when(F.length(b) > 0, F.sha2(b, 256))


def clip_text(s, n: int = 4000) -> Column:
    """Text of at most ``n`` characters; longer text keeps n-3 characters plus '...'."""
    s = _col(s)
    return F.when(F.length(s) <= n, s).otherwise(F.concat(F.substring(s, 1, n - 3), F.lit("...")))


def error_text(status, body) -> Column:
    """NULL for HTTP 200; else the first 500 characters of the body, else 'HTTP <status>'."""
    status, body = _col(status), _col(body)
    snippet = F.substring(body, 1, 500)
    return F.when(status == 200, F.lit(None).cast("string")).otherwise(
        F.coalesce(F.when(snippet != "", snippet), F.concat(F.lit("HTTP "), status.cast("string"))))


def url_join(base, path) -> Column:
    """base + '/' + path with exactly one slash between them."""
    return F.concat(F.regexp_replace(_col(base), r"/+\z", ""), F.lit("/"),
                    F.regexp_replace(_col(path), r"\A/+", ""))


def fill_template(template, product_id) -> Column:
    """Replace '{productId}' in a path template (no URL encoding)."""
    return F.replace(_col(template), F.lit("{productId}"), _col(product_id))


# ---- RFC 3986 reference resolution -------------------------------------------------------

_SCHEME_HOST = r"\A([A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*)"
_ABSOLUTE = r"\A[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]+"


def _remove_dot_segments(path: Column, squeeze_middle: bool) -> Column:
    segs = F.split(path, "/", -1)
    if squeeze_middle:
        segs = F.filter(segs, lambda s, i: (i == 0) | (i == F.size(segs) - 1) | (s != ""))
    resolved = F.aggregate(
        segs, F.array().cast("array<string>"),
        lambda acc, s: F.when(s == "..", F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))))
                        .when(s == ".", acc)
                        .otherwise(F.concat(acc, F.array(s))))
    last = F.element_at(segs, -1)
    resolved = F.when(last.isin(".", ".."), F.concat(resolved, F.array(F.lit("")))).otherwise(resolved)
    out = F.array_join(resolved, "/")
    return F.when(out.startswith("/"), out).otherwise(F.concat(F.lit("/"), out))


def resolve_url(current, nxt) -> Column:
    """Resolve a next-page link against the current URL.

    '' or NULL -> '' (end of chain); a link with scheme and host is kept as is; otherwise it is
    resolved relative to ``current`` (network-path, rooted path, query-only, fragment-only and
    relative-path forms, with '.' and '..' segments removed).
    """
    cur, n = _col(current), F.coalesce(_col(nxt), F.lit(""))
    origin = F.regexp_extract(cur, _SCHEME_HOST, 1)
    scheme = F.regexp_extract(cur, r"\A([A-Za-z][A-Za-z0-9+.\-]*):", 1)
    cur_path = F.regexp_extract(cur, _SCHEME_HOST + r"([^?#]*)", 2)
    cur_no_frag = F.regexp_extract(cur, r"\A([^#]*)", 1)
    cur_no_query = F.regexp_extract(cur, r"\A([^?#]*)", 1)
    cur_query = F.regexp_extract(cur, r"\A[^?#]*(\?[^#]*)?", 1)
    n_path = F.regexp_extract(n, r"\A([^?#]*)", 1)
    n_rest = F.substring(n, F.length(n_path) + 1, 1 << 30)
    cur_dir = F.regexp_extract(cur_path, r"\A(.*/)", 1)
    cur_dir = F.when(cur_dir == "", F.lit("/")).otherwise(cur_dir)
    return (F.when(n == "", F.lit(""))
             .when(n.rlike(_ABSOLUTE), n)
             .when(n.startswith("//"), F.concat(scheme, F.lit(":"), n))
             .when(n.startswith("/"), F.concat(origin, _remove_dot_segments(n_path, False), n_rest))
             .when(n.startswith("?"), F.concat(cur_no_query, n))
             .when(n.startswith("#"), F.concat(cur_no_query, cur_query, n))
             .otherwise(F.concat(origin,
                                 _remove_dot_segments(F.concat(cur_dir, n_path), True), n_rest)))


# ---- number formatting ---------------------------------------------------------------------

def py_float_text(x) -> Column:
    """Float text the way Python prints it for integral values and for 1e-3 <= |x| < 1e7
    (e.g. 10000000.0 rather than 1.0E7)."""
    x = _col(x).cast("double")
    integral = (x == F.floor(x)) & (F.abs(x) < F.lit(1e16))
    return (F.when(x.isNull(), F.lit(None).cast("string"))
             .when(integral, F.concat(x.cast("decimal(20,0)").cast("string"), F.lit(".0")))
             .otherwise(x.cast("string")))


def gate_detail(actual, threshold, op, unit: str = "") -> Column:
    """'<actual><unit> <op> <threshold><unit>'."""
    return F.concat(py_float_text(actual), F.lit(unit), F.lit(" "), _lit(op), F.lit(" "),
                    py_float_text(threshold), F.lit(unit))


def hours_between(anchor, ts) -> Column:
    """(anchor - ts) in hours as double."""
    return (F.unix_micros(_col(anchor)) - F.unix_micros(_col(ts))) / F.lit(3.6e9)
