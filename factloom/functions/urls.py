"""URL expressions; an invalid URL gives null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Suffixes of two labels under which a name is registered.
TWO_LEVEL = ["co.jp", "or.jp", "ne.jp", "go.jp", "ac.jp", "ed.jp", "co.uk"]


def host(u: Column) -> Column:
    return F.lower(F.try_parse_url(u, F.lit("HOST")))


def domain(u: Column) -> Column:
    return F.regexp_replace(host(u), "^www\\.", "")


def origin(u: Column) -> Column:
    scheme = F.lower(F.try_parse_url(u, F.lit("PROTOCOL")))
    port = F.regexp_extract(F.try_parse_url(u, F.lit("AUTHORITY")), ":([0-9]+)$", 1)
    usual = (port == "") | ((scheme == "http") & (port == "80")) | ((scheme == "https") & (port == "443"))
    return F.concat(scheme, F.lit("://"), host(u), F.when(usual, "").otherwise(F.concat(F.lit(":"), port)))


def path(u: Column) -> Column:
    p = F.try_parse_url(u, F.lit("PATH"))
    return F.when(p == "", "/").otherwise(p)


def normalize(u: Column) -> Column:
    """Repeated slashes of the path become one."""
    head = F.regexp_extract(u, "^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*", 0)
    rest = F.substring(u, F.length(head) + 1, F.length(u))
    tail = F.regexp_extract(rest, "[?#].*$", 0)
    bare = F.substring(rest, F.lit(1), F.length(rest) - F.length(tail))
    return F.when(head == "", u).otherwise(F.concat(head, F.regexp_replace(bare, "/{2,}", "/"), tail))


def same_site(a: Column, b: Column) -> Column:
    """Equal hosts, or one below the other."""
    return (a == b) | F.endswith(a, F.concat(F.lit("."), b)) | F.endswith(b, F.concat(F.lit("."), a))


def core(h: Column) -> Column:
    """The registered label of a host."""
    labels = F.split(h, "\\.")
    two = F.array_join(F.slice(labels, -2, 2), ".").isin(TWO_LEVEL)
    # without a label before the suffix there is none
    return F.coalesce(F.when(two, F.try_element_at(labels, F.lit(-3))).otherwise(F.try_element_at(labels, F.lit(-2))), F.lit(""))


def same_brand(a: Column, b: Column) -> Column:
    return (core(a) == core(b)) & (F.length(core(a)) >= 4)


def complete(u: Column) -> Column:
    """https:// where the scheme is missing; null where there is no host."""
    full = F.when(u.rlike("^[a-zA-Z]+://"), u).otherwise(F.concat(F.lit("https://"), u))
    return F.when(host(full).contains("."), full)


def bare(u: Column) -> Column:
    """For comparing: without scheme, ``www.``, fragment and last slashes."""
    return F.regexp_replace(F.rtrim(F.substring_index(u, "#", 1), F.lit("/")), "^https?://(www\\.)?", "")
