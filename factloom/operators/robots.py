"""Robots rules: parsing into rows, and the policy as a join.

The longest matching pattern decides, a tie allows, no match allows; an origin
whose file can't be read denies all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def parse(files: DataFrame, key: str = "origin", text: str = "text") -> DataFrame:
    """(key, agent, allow, pattern) rows; consecutive user-agent lines share the rules after them."""
    bare = F.trim(F.regexp_replace("raw", "#.*$", ""))
    rows = files.select(key, F.posexplode(F.split(F.coalesce(F.col(text), F.lit("")), "\r\n|\r|\n")).alias("pos", "raw"))
    split = rows.select(key, "pos", F.lower(F.trim(F.split_part(bare, F.lit(":"), F.lit(1)))).alias("field"), F.trim(F.regexp_replace(bare, "^[^:]*:", "")).alias("value"))
    kept = split.where(F.col("field").isin("user-agent", "allow", "disallow"))
    w = Window.partitionBy(key).orderBy("pos")
    is_agent = F.col("field") == "user-agent"
    starts = is_agent & (F.coalesce(F.lag("field").over(w), F.lit("")) != "user-agent")
    grouped = kept.withColumn("group", F.sum(F.when(starts, 1).otherwise(0)).over(w))
    agents = grouped.where(is_agent).select(key, "group", F.lower("value").alias("agent"))
    rules = grouped.where(~is_agent & (F.col("value") != "") & (F.col("group") > 0))
    return agents.join(rules, [key, "group"]).select(key, "agent", (F.col("field") == "allow").alias("allow"), F.col("value").alias("pattern"))


def regex_of(pattern: Column) -> Column:
    """A pattern as a regular expression: * is anything, a last $ ends the path."""
    ended = F.endswith(pattern, F.lit("$"))
    body = F.regexp_replace(F.regexp_replace(pattern, "\\$$", ""), "([.?+^$\\[\\](){}|\\\\])", "\\\\$1")
    return F.concat(F.lit("^"), F.replace(body, F.lit("*"), F.lit(".*")), F.when(ended, "$").otherwise(""))


def literal_head(pattern: Column) -> Column:
    """What a path must start with for a pattern to hold: all before its first *, and without a closing $."""
    return F.regexp_replace(F.substring_index(pattern, "*", 1), "\\$$", "")


def allowed(requests: DataFrame, rules: DataFrame, key: str, path: str, ident: str, agent: str = "*", files: DataFrame | None = None) -> DataFrame:
    """requests with ``allowed``; rules of groups that the agent's name holds go before those of ``*``.

    ``path`` is the path with its query.  With ``files`` (key, policy) an origin that is closed, or has no file, allows nothing, and a free one all.
    """
    named = rules.where((F.col("agent") != "*") & F.contains(F.lit(agent.lower()), F.lower("agent")))
    general = rules.where("agent = '*'")
    chosen = named.union(general.join(named.select(key).distinct(), key, "left_anti"))
    chosen = chosen.select(F.col(key).alias("_k"), "allow", F.length("pattern").alias("_n"), literal_head(F.col("pattern")).alias("_head"), F.when(F.col("pattern").rlike("[*]|[$]$"), regex_of(F.col("pattern"))).alias("_re"))
    # a rule can only hold where the path starts with its literal head: those of the lengths that the origin's rules have are the join keys
    lengths = chosen.groupBy(F.col("_k").alias("_l")).agg(F.collect_set(F.length("_head")).alias("_lengths"))
    tried = requests.select(ident, key, F.col(path).alias("_path")).join(lengths, F.col(key) == F.col("_l"))
    tried = tried.select(ident, F.col(key).alias("_o"), "_path", F.explode(F.filter("_lengths", lambda n: n <= F.length("_path"))).alias("_at"))
    tried = tried.select(ident, "_o", "_path", F.substring("_path", F.lit(1), F.col("_at")).alias("_start"))
    met = tried.join(chosen, (F.col("_o") == F.col("_k")) & (F.col("_start") == F.col("_head"))).where("_re IS NULL OR _path rlike _re")
    best = met.groupBy(ident).agg(F.max(F.struct("_n", "allow")).alias("_best")).select(F.col(ident).alias("_i"), F.col("_best.allow").alias("_allow"))
    out = requests.join(best, F.col(ident) == F.col("_i"), "left").withColumn("allowed", F.coalesce("_allow", F.lit(True))).drop("_i", "_allow")
    if files is None:
        return out
    state = files.select(F.col(key).alias("_f"), F.col("policy").alias("_policy"))
    judged = out.join(state, F.col(key) == F.col("_f"), "left")
    return judged.withColumn("allowed", F.when(F.col("_policy") == "free", True).when(F.col("_policy") == "rules", F.col("allowed")).otherwise(False)).drop("_f", "_policy")


def request_path(url: Column) -> Column:
    """Path and query of an address, as rules see them."""
    rest = F.regexp_replace(F.regexp_replace(url, "^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*", ""), "#.*$", "")
    return F.when(F.startswith(rest, F.lit("/")), rest).otherwise(F.concat(F.lit("/"), rest))


def used_urls(targets: DataFrame, extra: DataFrame) -> DataFrame:
    """(source, url): addresses that the configuration names (http only) and the paths that a source's reader goes on to."""
    return targets.where(F.col("url").rlike("^https?:")).select("source", "url").union(extra.select("source", "url")).distinct()


def report(files: DataFrame, used: DataFrame, sites: DataFrame) -> DataFrame:
    """(source, origin, status, error, groups, star_rules, checks): each source's file and whether the addresses used are allowed.

    files: origin, status, text, error; sites: source, origin; used: source, url.
    """
    rules = parse(files.where(policy(F.col("status")) == "rules"))
    star = rules.where("agent = '*'").groupBy("origin").agg(F.count("*").alias("star_rules"))
    groups = files.select("origin", F.size(F.regexp_extract_all(F.concat(F.lit("\n"), F.lower(F.coalesce("text", F.lit("")))), F.lit("(?:\\nuser-agent[^\\n]*)+"), F.lit(0))).alias("groups"))
    asked = used.join(sites, "source").withColumn("path", request_path(F.col("url")))
    asked = asked.withColumn("ident", F.struct("origin", "path"))  # a verdict's own key: the place of a row can change between two readings of it
    verdict = allowed(asked, rules, "origin", "path", "ident", files=files.select("origin", policy(F.col("status")).alias("policy")))
    per = verdict.groupBy("source").agg(F.sort_array(F.collect_list(F.struct("url", "allowed"))).alias("checks"))
    own = sites.join(files.select("origin", "status", "error"), "origin", "left").join(star, "origin", "left").join(groups, "origin", "left").join(per, "source", "left")
    return own.select("source", "origin", F.coalesce("status", F.lit("error")).alias("status"), "error", F.coalesce("groups", F.lit(0)).alias("groups"), F.coalesce("star_rules", F.lit(0)).cast("long").alias("star_rules"), "checks")


def policy(status: Column) -> Column:
    """What a file's status means: its rules, free, or closed."""
    code = status.try_cast("int")
    return F.when((code >= 200) & (code < 300), "rules").when(code.isin(404, 410), "free").otherwise("closed")


def crawl_counts(log: DataFrame) -> DataFrame:
    """(host, outcome, level, requests) of a log of requests (host, outcome): every host and outcome, every host, every outcome, and all."""
    levels = {"host and outcome": 0, "host": 1, "outcome": 2, "all": 3}
    per = log.groupingSets([["host", "outcome"], ["host"], ["outcome"], []], "host", "outcome").agg(F.grouping_id().alias("_level"), F.count("*").alias("requests"))
    named = F.lit(None).cast("string")
    for name, k in levels.items():
        named = F.when(F.col("_level") == k, name).otherwise(named)
    return per.select("host", "outcome", named.alias("level"), "requests")


def outcome(cached: Column, allowed_: Column, tripped: Column, status: Column, error: Column) -> Column:
    """What became of a request: from the store, not asked for (forbidden, or the host's breaker is open), failed, or fetched."""
    return F.when(cached, "cached").when(~allowed_ | tripped, "blocked").when(error.isNotNull() | (status >= 400), "failed").otherwise("fetched")
