"""Links, labelled fields, classification and near-sameness of pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text, urls

def anchors(pages: DataFrame, key: str, html: str) -> DataFrame:
    """(key, pos, href, text) of every link of raw HTML, in order."""
    tag = '<a href="([^"]*)"[^>]*>([^<]*)</a>'
    found = F.regexp_extract_all(F.col(html), F.lit(tag), F.lit(0))
    rows = pages.select(key, F.posexplode(found).alias("pos", "tag"))
    return rows.select(key, "pos", F.regexp_extract("tag", tag, 1).alias("href"), F.regexp_extract("tag", tag, 2).alias("text"))


def top_links(links: DataFrame, page: str, url: str, score: str, pos: str, k: int) -> DataFrame:
    """Distinct urls of a page by score, then position; the best k with a positive score."""
    per_url = Window.partitionBy(page, url).orderBy(F.desc(score), pos)
    once = links.where(F.col(score) > 0).withColumn("_u", F.row_number().over(per_url)).where("_u = 1").drop("_u")
    per_page = Window.partitionBy(page).orderBy(F.desc(score), pos)
    return once.withColumn("place", F.row_number().over(per_page)).where(F.col("place") <= k)


def near_same(a: Column, b: Column, limit: float = 0.8) -> Column:
    """Jaccard of two arrays of lines; empty is like nothing."""
    both, either = F.size(F.array_intersect(a, b)), F.size(F.array_union(a, b))
    return (F.size(a) > 0) & (F.size(b) > 0) & (both >= either * limit)


def same_pages(docs: DataFrame, key: str, body: str, limit: float = 0.8) -> DataFrame:
    """(key, class_id, n_links): documents by equal sets of lines, and how many others are like each by Jaccard of lines.

    Equal sets are one class.  Two classes at the limit share one of their rarest lines: of a set of n lines the first
    n - ceil(limit * n) + 1 in the order of rarity meet each other, so that a line that many pages share is seldom met.
    Every pair that meets there is checked on the full sets, in its first common line only.
    """
    rows = docs.select(F.col(key).alias("id"), F.array_sort(F.array_distinct(text.lines(F.col(body)))).alias("lines"))
    named = rows.withColumn("h", F.xxhash64("lines")).withColumn("h2", F.xxhash64("lines", F.lit(1)))
    classes = named.where(F.size("lines") > 0).groupBy("h", "h2").agg(F.min("id").alias("rep"), F.count("*").alias("times"), F.any_value("lines").alias("lines"))
    hashed = classes.select("rep", "times", F.transform("lines", lambda x: F.xxhash64(x)).alias("set"))
    counts = hashed.select(F.explode("set").alias("line")).groupBy("line").agg(F.count("*").alias("n"))
    dealt = hashed.select("rep", F.explode("set").alias("line")).join(counts, "line")
    rare = dealt.groupBy("rep").agg(F.sort_array(F.collect_list(F.struct("n", "line"))).alias("r"))
    kept = F.size("r") - F.ceil(F.lit(limit) * F.size("r")).cast("int") + 1
    prefix = rare.select("rep", F.transform(F.slice("r", F.lit(1), kept), lambda x: x["line"]).alias("prefix"))
    sets = hashed.join(prefix, "rep")
    met = sets.select("rep", "times", "set", "prefix", F.explode("prefix").alias("line"))
    a, b = (met.select("line", *[F.col(c).alias(f"{s}_{c}") for c in ("rep", "times", "set", "prefix")]) for s in ("a", "b"))
    fits = (F.size("a_set") >= F.lit(limit) * F.size("b_set")) & (F.size("b_set") >= F.lit(limit) * F.size("a_set"))
    pairs = a.join(b, "line").where((F.col("a_rep") < F.col("b_rep")) & fits)
    first = F.array_min(F.array_intersect("a_prefix", "b_prefix")) == F.col("line")
    both = F.size(F.array_intersect("a_set", "b_set"))
    like = pairs.where(first & (both >= F.lit(limit) * (F.size("a_set") + F.size("b_set") - both)))
    sides = like.select(F.explode(F.array(F.struct(F.col("a_rep").alias("rep"), F.col("b_times").alias("n")), F.struct(F.col("b_rep").alias("rep"), F.col("a_times").alias("n")))).alias("s")).select("s.*")
    more = sides.groupBy("rep").agg(F.sum("n").alias("more")).withColumnRenamed("rep", "_m")
    settled = classes.join(more, F.col("rep") == F.col("_m"), "left").select("h", "h2", "rep", (F.col("times") - 1 + F.coalesce("more", F.lit(0))).alias("links"))
    return named.join(settled, ["h", "h2"], "left").select(F.col("id").alias(key), F.coalesce("rep", "id").alias("class_id"), F.coalesce("links", F.lit(0)).cast("long").alias("n_links"))


def segments(lines: DataFrame, doc: str, pos: str, starts: Column) -> DataFrame:
    """Lines with the number of the record they belong to; a record starts where ``starts`` holds."""
    w = Window.partitionBy(doc).orderBy(pos)
    return lines.withColumn("block", F.sum(F.when(starts, 1).otherwise(0)).over(w))


def labelled(lines: DataFrame, doc: str, pos: str, line: str, labels: list[str]) -> DataFrame:
    """Value lines under the last label line before them; a label that comes again starts anew."""
    w = Window.partitionBy(doc).orderBy(pos)
    is_label = F.col(line).isin(labels)
    marked = lines.withColumn("label", F.last(F.when(is_label, F.col(line)), True).over(w)).withColumn("label_pos", F.last(F.when(is_label, F.col(pos)), True).over(w))
    latest = F.max(F.when(is_label, F.col(pos))).over(Window.partitionBy(doc, "label"))
    return marked.withColumn("_latest", latest).where(F.col("label").isNotNull() & ~is_label & (F.col("label_pos") == F.col("_latest"))).drop("_latest")


def ordinal_zip(left: DataFrame, right: DataFrame, doc: str, pos: str) -> DataFrame:
    """The k-th left row of a document beside its k-th right row."""
    w = Window.partitionBy(doc).orderBy(pos)
    a, b = (x.withColumn("k", F.row_number().over(w)).drop(pos) for x in (left, right))
    return a.join(b, [doc, "k"])


def classify(text: Column, rules: dict[str, list[list[str]]]) -> Column:
    """Labels whose every group of words has a hit (one group: any of its words)."""
    found = []
    for label, groups in rules.items():
        ok = F.lit(True)
        for words in groups:
            any_hit = F.lit(False)
            for w in words:
                any_hit = any_hit | F.contains(text, F.lit(w.lower()))
            ok = ok & any_hit
        found.append(F.when(ok, F.lit(label)))
    return F.array_compact(F.array(*found))


def keywords(text: Column, rules: dict[str, list[list[str]]]) -> Column:
    """The words that make the labels of ``classify``, label by label."""
    found = []
    for label, groups in rules.items():
        own = F.concat(*[F.filter(F.array(*[F.lit(w) for w in words]), lambda w: F.contains(text, F.lower(w))) for words in groups])
        found.append(F.when(F.array_contains(classify(text, {label: groups}), label), own).otherwise(F.array().cast("array<string>")))
    return F.array_distinct(F.concat(*found))


def same_site_link(base: Column, href: Column) -> Column:
    return F.startswith(href, F.lit("/")) | F.coalesce(urls.same_site(urls.domain(base), urls.domain(href)), F.lit(False))
