"""Results of checks: their severity, which of them pass, and failures to reach a site."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.text import holds_any

SEVERITY = ["OK", "OK (redirect)", "OK (human)", "check", "NG"]
PASSING = SEVERITY[:3]
# What messages say where a site could not be reached, where it refused, and where it forbids.
UNREACHED = ["timeout", "net::", "err_", "econn", "enotfound", "etimedout", "navigation", "connection closed", "target closed"]
REFUSED = ["robots.txt を取得できない", "連続して拒否"]
FORBIDDEN = "robots.txt disallows"
REFUSING = [401, 403, 429]


def access_failure(message: Column, status: Column | None) -> Column:
    """Was a site not reached or did it refuse, as against a page that is not there or not allowed?

    A status decides (one that the message names, if none is given) unless the message tells of robots.txt or of a breaker.
    """
    message = F.coalesce(message, F.lit(""))
    named = F.nullif(F.regexp_extract(message, "HTTP ([0-9]{3})", 1), F.lit("")).try_cast("int")
    code = named if status is None else F.coalesce(status.cast("int"), named)
    by_code = code.isin(REFUSING) | (code >= 500)
    return F.when(F.contains(message, F.lit(FORBIDDEN)), False).when(holds_any(message, REFUSED), True).when(code.isNotNull(), by_code).otherwise(holds_any(F.lower(message), UNREACHED))


def with_human(result: Column, decision: Column) -> Column:
    """A reviewer's decision goes before the rule's."""
    return F.when(decision == "OK", SEVERITY[2]).when(decision == "NG", "NG").otherwise(result)


def passes(result: Column) -> Column:
    return result.isin(PASSING)
