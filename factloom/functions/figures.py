"""Dates, ranges and head counts in text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import nfkc

AS_OF = "(20[0-9]{2})\\s*年\\s*(?:([0-9]{1,2})\\s*月?)?"
RANGE = "([0-9][0-9,]*)\\s*(?:名|人)?\\s*[〜~～-]\\s*([0-9][0-9,]*)\\s*(?:名|人)"
AT_LEAST = "([0-9][0-9,]*)\\s*(?:名|人)\\s*以上"
# Labels of a head count, those that say "number of" first, and its units.
COUNT_LABELS = ["従業員数", "社員数", "スタッフ数", "人員数", "職員数"]
PLAIN_LABELS = ["従業員", "社員"]
UNITS = ["名", "人"]
WINDOW = 90


def _int(c: Column) -> Column:
    return F.replace(c, F.lit(","), F.lit("")).try_cast("bigint")


def as_of(c: Column) -> Column:
    """struct(year, month) of the first date mark."""
    c = nfkc(c)
    year, month = F.regexp_extract(c, AS_OF, 1), F.regexp_extract(c, AS_OF, 2)
    return F.when(year != "", F.struct(year.cast("int").alias("year"), month.try_cast("int").alias("month")))


def as_of_ordinal(c: Column) -> Column:
    """Months since year 0, June where only the year is known, -1 for no date."""
    d = as_of(c)
    return F.coalesce(d["year"] * 12 + F.coalesce(d["month"], F.lit(6)), F.lit(-1))


def headcount_range(c: Column) -> Column:
    """struct(min, max) of "N-M" or "N and more"."""
    low = F.regexp_extract(c, RANGE, 1)
    more = F.regexp_extract(c, AT_LEAST, 1)
    return F.when(low != "", F.struct(_int(low).alias("min"), _int(F.regexp_extract(c, RANGE, 2)).alias("max"))).when(
        more != "", F.struct(_int(more).alias("min"), F.lit(None).cast("bigint").alias("max"))
    )


def range_to_point(low: Column, high: Column, limit: int = 20) -> Column:
    """A range that does not straddle the limit as one number."""
    return F.when(low >= limit, low).when(high < limit, high)


def _read_count(window: Column) -> Column:
    """struct(value, approx, strong, fits) of the head count that a text starting with its label states; parts are taken off one by one."""
    label = F.regexp_extract(window, f"^({'|'.join(COUNT_LABELS + PLAIN_LABELS)})", 1)
    rest = F.regexp_replace(F.substring(window, F.length(label) + 1, F.lit(WINDOW)), "^(?:（[^）]*）|\\([^)]*\\))", "")
    gap = F.regexp_extract(rest, "^[\\s|:：]*", 0)
    said = F.substring(rest, F.length(gap) + 1, F.lit(WINDOW))
    about = F.regexp_extract(said, "^(約|およそ)", 1)
    body = F.regexp_replace(said, "^(?:約|およそ)?\\s*(?:正社員\\s*)?", "")
    low = F.regexp_extract(body, "^[0-9][0-9,]*", 0)
    tail = F.substring(body, F.length(low) + 1, F.lit(WINDOW))
    high = F.regexp_extract(tail, "^\\s*[〜~～-]\\s*([0-9][0-9,]*)", 1)
    tail_ = F.regexp_replace(tail, "^\\s*[〜~～-]\\s*[0-9][0-9,]*", "")
    unit = F.regexp_extract(tail_, f"^\\s*({'|'.join(UNITS)})", 1)
    end = F.regexp_replace(tail_, f"^\\s*(?:{'|'.join(UNITS)})", "")
    strong = label.isin(COUNT_LABELS)
    listed = tail.rlike("^[.．]\\s*[^\\s0-9]")  # the number of an item
    timed = end.rlike("^\\s*(?:年|から)")
    fits = (low != "") & ~listed & ~timed & (strong | ((gap != "") & (unit != ""))) & _int(low).between(1, 500_000)
    return F.struct(_int(low).alias("value"), ((high != "") | (about != "") | F.contains(gap, F.lit("約"))).alias("approx"), strong.alias("strong"), fits.alias("fits"), window.alias("raw"))


def headcount(c: Column) -> Column:
    """struct(value, approx, strong, raw) of the first head count; ``c`` is folded and flattened.

    A label without the word for number needs a separator and a unit.
    """
    # every label with what follows it: a look-ahead, so that a label inside a window does not cut it off
    labelled = F.regexp_extract_all(c, F.lit(f"(?=((?:{'|'.join(COUNT_LABELS + PLAIN_LABELS)})[\\s\\S]{{0,{WINDOW}}}))"), F.lit(1))
    first = F.try_element_at(F.filter(F.transform(labelled, _read_count), lambda p: p["fits"]), F.lit(1))
    return F.when(first.isNotNull(), F.struct(first["value"].alias("value"), first["approx"].alias("approx"), first["strong"].alias("strong"), F.substring(first["raw"], 1, 60).alias("raw")))


def period_label(c: Column) -> Column:
    return F.concat(F.year(c), F.lit("年"), F.month(c), F.lit("月期"))


def date_label(c: Column) -> Column:
    return F.concat(F.year(c), F.lit("年"), F.month(c), F.lit("月"), F.day(c), F.lit("日"))
