"""How filters overlap: every order of the filters, what each step removes and what it would have removed anyway.

The orders form a trie.  It is walked depth first: a node's survivors are a
persisted DataFrame, an edge applies one more filter to them and counts what that
removes.  Which rows survive depends on the set of filters applied and not on
their order, so a node is remembered by its unordered prefix: n filters have n!
orders but 2**n states and n * 2**(n-1) edges, and each is computed once.  Only the
survivors along one path are held at a time; a lost executor recomputes its part
of them from the written table of flags.

A row that is audited is narrow: its part, one bit for each filter that it fails
and its marks.  Texts are read once, for the flags.  The counts of a state are
partial sums per part, appended to a table; the driver sees none of them.

Defined cases: a null text is an empty one (no words, no characters); rows equal to
an earlier document's text fail E, rows without a doc_id never do and no row fails
for their sake; rows that repeat an id and its text do not fail for each other's
sake; a null source is the part of the empty string, together with sources that are
empty; several labels of one document count as any of them; an empty table has no
parts and gives an empty result; other columns are not read.
"""

from __future__ import annotations

import functools
import itertools
import uuid

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

#: Between words: the blank and the controls from tab to carriage return.
GAP = r"[\x20\x09-\x0D]+"


def text_filters(text: Column) -> dict[str, Column]:
    """The conditions under which a text fails the filters A to D."""
    text = F.coalesce(text, F.lit(""))
    words = F.filter(F.split(text, GAP), lambda w: w != "")
    counts = F.transform(F.array(words), lambda w: F.struct(F.size(w).cast("long").alias("n"), F.size(F.array_distinct(w)).cast("long").alias("distinct")))[0]
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    return {
        "A": counts["n"] < 50,
        "B": 100 * counts["distinct"] < 65 * counts["n"],
        "C": 100 * capitals.cast("long") > 5 * F.length(text).cast("long"),
        "D": text.rlike("[#$%&*|]"),
    }


def bits(failures: list[Column]) -> Column:
    """One bit for each condition that holds, the first the lowest."""
    return functools.reduce(lambda a, b: a.bitwiseOR(b), [F.when(c, F.lit(1 << k)).otherwise(F.lit(0)) for k, c in enumerate(failures)])


def flagged(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, fails, good, toxic) for every document: the filters A to E as bits, and whether its labels say good or toxic."""
    text = F.coalesce("text", F.lit(""))
    narrow = docs.select(
        F.col("doc_id").cast("long").alias("id"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"),
        bits(list(text_filters(F.col("text")).values())).alias("fails"), F.unhex(F.sha2(text, 256)).alias("print"),
    )
    narrow = common.stored(narrow, "audit-texts")
    repeated = narrow.groupBy("print").agg(F.min("id").alias("first_id"), F.count("*").alias("n")).where("n > 1").select(F.col("print").alias("r_print"), "first_id")
    repeated = common.stored(repeated, "audit-repeated")  # without the sums in its stage the join can split a text that very many documents have
    said = labels.groupBy(F.col("doc_id").cast("long").alias("l_id")).agg(*[F.max(F.coalesce(F.col(c) == 1, F.lit(False))).alias(a) for c, a in (("quality", "good"), ("toxic", "toxic"))])
    met = narrow.join(repeated, F.col("print") == F.col("r_print"), "left").select("id", "part", "fails", F.coalesce(F.col("id") > F.col("first_id"), F.lit(False)).alias("later"))
    met = met.join(said.where("good OR toxic"), F.col("id") == F.col("l_id"), "left")
    fails = F.col("fails").bitwiseOR(F.when(F.col("later"), F.lit(16)).otherwise(F.lit(0)))
    return met.select("part", fails.alias("fails"), *[F.coalesce(c, F.lit(False)).alias(c) for c in ("good", "toxic")])


def edges(rows: DataFrame, filters: int) -> DataFrame:
    """(state, filter, part, alive, removed, good, toxic): what every edge of the trie removes from what its state left alive.

    ``state`` has a bit for each filter applied before; a part without survivors in a state has no row there.
    """
    spark = rows.sparkSession
    path = f"{common.shared_dir(spark)}/factloom/audit-edges-{uuid.uuid4().hex}"
    seen: set[int] = set()
    counted = []  # the same expressions in every state, so that Spark compiles them once; filters already applied remove nothing
    for k in range(filters):
        fails = F.col("fails").bitwiseAND(F.lit(1 << k)) != 0
        counted.append(F.struct(F.lit(k).alias("filter"), *[F.count_if(fails & c).alias(a) for c, a in ((F.lit(True), "removed"), (F.col("good"), "good"), (F.col("toxic"), "toxic"))]))

    def visit(state: int, alive: DataFrame) -> None:
        seen.add(state)
        survivors = alive.persist(StorageLevel.MEMORY_AND_DISK)
        per_part = survivors.groupBy("part").agg(F.count("*").alias("alive"), F.array(*counted).alias("edges"))
        per_part.select("part", "alive", F.inline("edges")).write.parquet(f"{path}/state={state}")
        for k in range(filters):
            child = state | 1 << k
            if child not in seen and child != (1 << filters) - 1:  # after the last filter there is no edge to count
                visit(child, survivors.where(F.col("fails").bitwiseAND(F.lit(1 << k)) == 0))
        survivors.unpersist()

    visit(0, rows)
    table = spark.read.schema("part string, alive long, filter int, removed long, good long, toxic long, state int").parquet(path)
    return table.where("state & shiftleft(1, filter) = 0")


def audit(rows: DataFrame, letters: str = "ABCDE") -> DataFrame:
    """One row for every part, order of the filters and step, from rows (part, fails, good, toxic).

    kept, removed, good_lost and toxic_lost are the step's own edge of the trie; redundant is what the
    filter removes when it comes first, less that; unique_fails is what it removes when it comes last.
    """
    n = len(letters)
    full = (1 << n) - 1
    counts = F.struct("alive", "removed", "good", "toxic")
    by_edge = edges(rows, n).groupBy("part").agg(F.map_from_entries(F.collect_list(F.struct((F.col("state") * n + F.col("filter")).alias("k"), counts.alias("v")))).alias("at"))  # n * 2**(n-1) entries
    orders = ",".join("".join(p) for p in itertools.permutations(letters))
    steps = by_edge.select("part", "at", F.explode(F.split(F.lit(orders), ",")).alias("filter_order")).select("*", F.posexplode(F.split("filter_order", "")).alias("place", "letter"))
    bit = lambda letter: F.lit(1).cast("int") * F.pow(F.lit(2), F.instr(F.lit(letters), letter) - 1).cast("int")
    before = F.aggregate(F.slice(F.split("filter_order", ""), F.lit(1), F.col("place")), F.lit(0), lambda state, letter: state + bit(letter))
    steps = steps.select("*", (F.instr(F.lit(letters), F.col("letter")) - 1).alias("filter"), before.alias("state"))
    edge = lambda state, name: F.coalesce(F.try_element_at("at", state * n + F.col("filter"))[name], F.lit(0))
    last = F.lit(full) - bit(F.col("letter"))
    told = steps.select(
        "part", "filter_order", (F.col("place") + 1).cast("int").alias("step"), "filter",
        (edge(F.col("state"), "alive") - edge(F.col("state"), "removed")).alias("kept"), edge(F.col("state"), "removed").alias("removed"),
        (edge(F.lit(0), "removed") - edge(F.col("state"), "removed")).alias("redundant"), edge(last, "removed").alias("unique_fails"),
        edge(F.col("state"), "good").alias("good_lost"), edge(F.col("state"), "toxic").alias("toxic_lost"),
    )
    whole = told.groupBy(F.col("part").alias("s_part"), F.col("filter").alias("s_filter")).agg(F.sum("removed").alias("shapley"))
    return told.join(whole, (F.col("part") == F.col("s_part")) & (F.col("filter") == F.col("s_filter"))).select(
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"
    )


def op12_audit(spark, sf_dir: str) -> DataFrame:
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    return audit(common.stored(flagged(docs, labels), "audit-flags"))


SQL = r"""
WITH said AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id),
texts AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
firsts AS (SELECT t, min(doc_id) AS first_id FROM texts GROUP BY t),
worded AS (SELECT x.doc_id, part, x.t, list_filter(string_split_regex(x.t, '[\x20\x09-\x0D]+'), lambda w: w <> '') AS ws, x.doc_id > first_id AS later FROM texts x JOIN firsts f ON x.t = f.t),
fails AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic, {
    'A': len(ws) < 50, 'B': 100 * len(list_distinct(ws)) < 65 * len(ws),
    'C': 100 * length(regexp_replace(w.t, '[^A-Z]', '', 'g')) > 5 * length(w.t),
    'D': regexp_matches(w.t, '[#$%&*|]'), 'E': coalesce(later, false)} AS f
  FROM worded w LEFT JOIN said s ON w.doc_id = s.doc_id),
kinds AS (SELECT part, f, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM fails GROUP BY ALL),
one AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS c),
orders AS (
  SELECT a.c || b.c || d.c || e.c || g.c AS filter_order FROM one a, one b, one d, one e, one g
  WHERE len(list_distinct([a.c, b.c, d.c, e.c, g.c])) = 5),
steps AS (SELECT filter_order, s.step, filter_order[s.step] AS c, filter_order[1:s.step - 1] AS earlier FROM orders, (SELECT unnest(range(1, 6)) AS step) s),
judged AS (
  SELECT part, filter_order, step, c, n, good, toxic,
    (CASE c WHEN 'A' THEN f.A WHEN 'B' THEN f.B WHEN 'C' THEN f.C WHEN 'D' THEN f.D ELSE f.E END) AS fails_it,
    ((f.A AND contains(earlier, 'A')) OR (f.B AND contains(earlier, 'B')) OR (f.C AND contains(earlier, 'C')) OR (f.D AND contains(earlier, 'D')) OR (f.E AND contains(earlier, 'E'))) AS gone,
    f.A::INT + f.B::INT + f.C::INT + f.D::INT + f.E::INT AS failed
  FROM steps, kinds),
told AS (
  SELECT part, filter_order, step, c,
    coalesce(sum(n) FILTER (NOT gone AND NOT fails_it), 0)::BIGINT AS kept, coalesce(sum(n) FILTER (fails_it AND NOT gone), 0)::BIGINT AS removed,
    coalesce(sum(n) FILTER (fails_it AND gone), 0)::BIGINT AS redundant, coalesce(sum(n) FILTER (fails_it AND failed = 1), 0)::BIGINT AS unique_fails,
    coalesce(sum(good) FILTER (fails_it AND NOT gone), 0)::BIGINT AS good_lost, coalesce(sum(toxic) FILTER (fails_it AND NOT gone), 0)::BIGINT AS toxic_lost
  FROM judged GROUP BY ALL)
SELECT part, filter_order, step::INT AS step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  (sum(removed) OVER (PARTITION BY part, c))::BIGINT AS shapley
FROM told
"""
