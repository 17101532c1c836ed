"""URL expressions (F1-F5, P6-P8): native Spark Column expressions, no Python per row.

Every function takes Columns and returns a Column, so it also works inside a
higher-order function lambda (``F.transform(arr, canonical_url)``) and on a
streaming DataFrame.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sourcelens.rules import BrandRules

# Split of a URL into scheme (1), authority (2) and path (3); query and fragment are dropped.
URL_RE = r"(?s)^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)"
# Absolute URLs in free text.
URL_IN_TEXT_RE = r"""(?U)https?://[^\s)\]"'>,]+"""
# Schemes that get '//' when they have no authority (Python's urllib ``uses_netloc``; fixed values).
USES_NETLOC = ("ftp", "http", "gopher", "nntp", "telnet", "imap", "wais", "file", "mms", "https", "shttp",
               "snews", "prospero", "rtsp", "rtsps", "rtspu", "rsync", "svn", "svn+ssh", "sftp", "nfs", "git",
               "git+ssh", "ws", "wss", "itms-services")


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def strip_ws(u) -> Column:
    """Strip leading and trailing whitespace of any kind (Spark ``trim`` only strips spaces)."""
    return F.regexp_replace(_c(u), r"(?U)^\s+|\s+$", "")


def host_of(u) -> Column:
    """lower-cased authority (port and userinfo kept), one leading ``www.`` removed."""
    netloc = F.regexp_extract(_c(u), URL_RE, 2)
    return F.regexp_replace(F.lower(netloc), r"^www\.", "")


def path_of(u) -> Column:
    return F.regexp_extract(_c(u), URL_RE, 3)


def canonical_url(u) -> Column:
    """canonical URL.

    trim; scheme lower-cased (default https); host lower-cased without one leading
    ``www.``; trailing ``/`` removed from the path; query and fragment dropped.
    Pseudo-URLs (``aioverview::q``) pass through, losing any ``?...``.  A string with
    neither scheme nor authority is returned trimmed and unchanged.  Never throws.
    """
    t = strip_ws(u)
    scheme = F.lower(F.regexp_extract(t, URL_RE, 1))
    host = F.regexp_replace(F.lower(F.regexp_extract(t, URL_RE, 2)), r"^www\.", "")
    path = F.regexp_replace(F.regexp_extract(t, URL_RE, 3), "/+$", "")
    scheme_out = F.when(scheme == "", F.lit("https")).otherwise(scheme)
    slashes = F.when(
        path.startswith("//") | (scheme_out.isin(*USES_NETLOC) & ((path == "") | path.startswith("/"))),
        F.lit("//")).otherwise(F.lit(""))
    return (F.when((scheme == "") & (host == ""), t)
            .when(host != "", F.concat(scheme_out, F.lit("://"), host, path))
            .otherwise(F.concat(scheme_out, F.lit(":"), slashes, path)))


def with_url_parts(df: DataFrame, url: str = "url", prefix: str = "") -> DataFrame:
    """Add ``canon_url``, ``host`` and ``path`` once, early, so later rules reuse them."""
    return (df.withColumn(f"{prefix}canon_url", canonical_url(url))
              .withColumn(f"{prefix}host", host_of(F.col(f"{prefix}canon_url")))
              .withColumn(f"{prefix}path", path_of(F.col(f"{prefix}canon_url"))))


def host_under(host, domains) -> Column:
    """host equals a domain or is a dot-boundary subdomain of it (OR over a short literal list)."""
    h = _c(host)
    domains = [d.lower() for d in domains]
    if not domains:
        return F.lit(False)
    return reduce(lambda a, b: a | b, [(h == d) | h.endswith("." + d) for d in domains])


def url_mentions(text, strip_punct: bool = False) -> Column:
    """all absolute URLs in a text, in order (array<string>).  Like the reference, a URL
    keeps trailing sentence punctuation (``https://a.test/x.``); ``strip_punct=True`` drops
    trailing ``.,;:!?`` from each match."""
    found = F.regexp_extract_all(F.coalesce(_c(text), F.lit("")), F.lit(URL_IN_TEXT_RE), 0)
    if strip_punct:
        return F.transform(found, lambda u: F.regexp_replace(u, r"[.,;:!?]+$", ""))
    return found


def is_nonprod(host, rules: BrandRules) -> Column:
    """Host is strictly under an owned domain and its first label is a non-production prefix."""
    h = _c(host)
    if not rules.owned_domains or not rules.nonprod_prefixes:
        return F.lit(False)
    strictly_under = reduce(lambda a, b: a | b, [h.endswith("." + d.lower()) for d in rules.owned_domains])
    first_label = F.substring_index(h, ".", 1)
    return strictly_under & first_label.isin(*rules.nonprod_prefixes)


def is_nonprod_url(url, rules: BrandRules) -> Column:
    return is_nonprod(host_of(url), rules)


def any_nonprod(urls, rules: BrandRules) -> Column:
    """Any URL of an array is a non-production owned URL."""
    return F.coalesce(F.exists(_c(urls), lambda s: is_nonprod_url(s, rules)), F.lit(False))


def is_asset(host, path, rules: BrandRules) -> Column:
    """Asset or tracker link: path ends with an asset extension, or host contains a tracker fragment."""
    p = F.lower(_c(path))
    h = F.lower(_c(host))
    conds = [p.endswith(e) for e in rules.asset_ext] + [h.contains(x) for x in rules.asset_hosts]
    if not conds:
        return F.lit(False)
    return reduce(lambda a, b: a | b, conds)


def outbound_links(text, page_url, rules: BrandRules, cap: int | None = None, strip_punct: bool = False) -> Column:
    """canonical outbound links of a body: not on the page's host, not assets, ordered distinct; all of them
    unless ``cap`` is given.  Each link is taken apart once, into a struct of canonical URL, host and path.

    Array form (for the sheet); ``operators.links.link_table`` explodes it into edges.
    """
    page_host = F.when(F.coalesce(_c(page_url), F.lit("")) == "", F.lit(None)).otherwise(host_of(page_url))
    canon = F.array_distinct(F.transform(url_mentions(text, strip_punct), canonical_url))
    parts = F.transform(canon, lambda n: F.struct(n.alias("u"), host_of(n).alias("h"), path_of(n).alias("p")))
    kept = F.filter(parts, lambda x: (x["u"] != "") & ~F.coalesce(x["h"] == page_host, F.lit(False))
                    & ~is_asset(x["h"], x["p"], rules))
    links = F.transform(kept, lambda x: x["u"])
    return links if cap is None else F.slice(links, 1, cap)
