"""Column functions on urls: their parts, references made absolute, one form for each."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from townlens.functions.text import c, let

NETLOC = r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)"


def netloc(url: Column | str) -> Column:
    """Lower-case host with its port, empty where there is none."""
    return F.lower(F.regexp_extract(F.coalesce(c(url), F.lit("")), NETLOC, 1))


def domain(url: Column | str) -> Column:
    """Host without a leading www., null where there is none."""
    return F.nullif(F.regexp_replace(netloc(url), r"^www\.", ""), F.lit(""))


def path(url: Column | str) -> Column:
    return F.regexp_extract(F.coalesce(c(url), F.lit("")), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/?#]*)?([^?#]*)", 1)


def query(url: Column | str) -> Column:
    return F.regexp_extract(F.coalesce(c(url), F.lit("")), r"\?([^#]*)", 1)


def with_scheme(url: Column | str) -> Column:
    t = F.trim(F.coalesce(c(url), F.lit("")))
    return F.when(t.rlike("^https?://"), t).otherwise(F.concat(F.lit("https://"), t))


def normalize_absolute(url: Column | str) -> Column:
    """http(s) only; scheme and host in lower case, no fragment; anything else is null."""
    t = F.trim(F.coalesce(c(url), F.lit("")))
    scheme = F.lower(F.regexp_extract(t, "^([A-Za-z]+)://", 1))
    rest = F.regexp_replace(F.regexp_replace(t, r"^[A-Za-z]+://[^/?#]*", ""), "#.*$", "")
    return F.when(scheme.isin("http", "https") & (netloc(t) != ""), F.concat(scheme, F.lit("://"), netloc(t), rest))


def is_internal(host: Column, town_domain: Column) -> Column:
    """The host is the domain or lies under it."""
    return (host == town_domain) | host.endswith(F.concat(F.lit("."), town_domain))


def normalized_path(url: Column | str) -> Column:
    """Decoded path in lower case, slashes squeezed, none at the end; / for the root."""
    p = F.regexp_replace(F.lower(F.try_url_decode(F.replace(path(url), F.lit("+"), F.lit("%2B")))), "/+", "/")
    return F.coalesce(F.nullif(F.regexp_replace(p, "/+$", ""), F.lit("")), F.lit("/"))


#: The parts of a reference: scheme, authority, path, query, fragment.
REFERENCE = r"(?s)^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?$"
#: Schemes whose references may be relative.
RELATIVE_SCHEMES = ("", "ftp", "http", "gopher", "nntp", "imap", "wais", "file", "https", "shttp", "mms", "prospero", "rtsp", "rtsps", "rtspu", "sftp", "svn", "svn+ssh", "ws", "wss")


def without_dots(segments: Column) -> Column:
    """Segments of a path with `.` dropped and `..` taking back the one before it; either at the end leaves a directory."""
    none = F.array().cast("array<string>")
    back = lambda acc: F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(0)))
    kept = F.aggregate(segments, none, lambda acc, s: F.when(s == "..", back(acc)).when(s == ".", acc).otherwise(F.concat(acc, F.array(s))))
    return F.when(F.element_at(segments, -1).isin(".", ".."), F.concat(kept, F.array(F.lit("")))).otherwise(kept)


def merged_path(base: Column, relative: Column) -> Column:
    """A relative path behind the folder of a base path; one that starts with / stands alone."""
    folder = F.split(base, "/", -1)
    folder = F.when(F.element_at(folder, -1) == "", folder).otherwise(F.slice(folder, F.lit(1), F.size(folder) - 1))
    joined = F.concat(folder, F.split(relative, "/", -1))
    inner = F.filter(F.slice(joined, F.lit(2), F.greatest(F.size(joined) - 2, F.lit(0))), lambda s: s != "")
    behind = F.when(F.size(joined) < 2, joined).otherwise(F.concat(F.slice(joined, 1, 1), inner, F.array(F.element_at(joined, -1))))
    path = F.array_join(without_dots(F.when(relative.startswith("/"), F.split(relative, "/", -1)).otherwise(behind)), "/")
    return F.when(path == "", "/").otherwise(path)


def resolve(base: Column | str, reference: Column | str) -> Column:
    """A reference as found on a page, made absolute against the page's url. Null base and null reference are empty; an empty
    one leaves the other. References of other schemes stay as they are; an empty authority (file:///) is none."""
    strip = lambda x: F.regexp_replace(F.regexp_replace(F.coalesce(c(x), F.lit("")), "[\t\r\n]", ""), r"^[\x00-\x20]+|\s+$", "")
    names = ("scheme", "host", "path", "query", "fragment")
    parts = lambda x: let(strip(x), lambda t: F.struct(t.alias("text"), *[F.regexp_extract(t, REFERENCE, i + 1).alias(n) for i, n in enumerate(names)]))

    def joined(both: Column) -> Column:
        b, r = both["b"], both["r"]
        scheme, own = F.lower(b["scheme"]), F.lower(r["scheme"])
        apart = ((own != "") & (own != scheme)) | ~F.when(own != "", own).otherwise(scheme).isin(*RELATIVE_SCHEMES)
        host = F.when(r["host"] != "", r["host"]).otherwise(b["host"])
        path = F.when(r["host"] != "", r["path"]).when(r["path"] == "", b["path"]).otherwise(let(F.struct(b["path"].alias("b"), r["path"].alias("r")), lambda x: merged_path(x["b"], x["r"])))
        query = F.when((r["host"] != "") | (r["path"] != "") | (r["query"] != ""), r["query"]).otherwise(b["query"])
        sign = lambda mark, x: F.when(x != "", F.concat(F.lit(mark), x)).otherwise("")
        rooted = let(path, lambda p: F.when(host == "", p).when((p != "") & ~p.startswith("/"), F.concat(F.lit("//"), host, F.lit("/"), p)).otherwise(F.concat(F.lit("//"), host, p)))
        whole = F.concat(F.when(scheme != "", F.concat(scheme, F.lit(":"))).otherwise(""), rooted, sign("?", query), sign("#", r["fragment"]))
        return F.when(b["text"] == "", r["text"]).when(r["text"] == "", b["text"]).when(apart, r["text"]).otherwise(whole)

    return let(F.struct(parts(base).alias("b"), parts(reference).alias("r")), joined)


def normalize(url: Column | str, base: Column | str) -> Column:
    """normalize_absolute() of a reference against a page's url."""
    return let(resolve(base, url), normalize_absolute)
