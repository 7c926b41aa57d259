"""Preference formatting: one prompt, two completions with loss spans.

Conversations 2k and 2k + 1 are the chosen and the rejected answer of pair k.
Their longest common prefix of turns (equal role and text, in order) is rendered
once as the prompt; what remains of each is its completion.  A loss span is
"start-end" in characters of a completion, over an assistant turn's text and
end mark; all else is masked.  DataFrame functions only: one shuffle by pair.

Defined cases: a null role is ``unknown``, a null text is empty; turns are put in
order by turn, role, text, nulls first; repeated turns stay; equal conversations
have empty completions; a pair with one side only has an empty prompt and a null
other side; rows with a null conv_id take no part; an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

OPEN, MIDDLE, CLOSE = "<|", "|>\n", "<|end|>\n"


def _rendered(turn):
    return F.concat(F.lit(OPEN), turn["role"], F.lit(MIDDLE), turn["text"], F.lit(CLOSE))


def _spans(turns):
    """Loss spans over the rendered turns, joined by commas."""
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("spans"))

    def step(acc, turn):
        head = acc["at"] + F.length(turn["role"]) + F.lit(len(OPEN) + len(MIDDLE))
        tail = head + F.length(turn["text"]) + F.lit(len(CLOSE))
        span = F.concat(head.cast("string"), F.lit("-"), tail.cast("string"))
        spans = F.when(turn["role"] == "assistant", F.array_append(acc["spans"], span)).otherwise(acc["spans"])
        return F.struct(tail.cast("long").alias("at"), spans.alias("spans"))

    return F.array_join(F.aggregate(turns, start, step)["spans"], ",")


def format_pairs(conversations: DataFrame) -> DataFrame:
    side = F.pmod("conv_id", F.lit(2))
    turn = F.struct("turn", F.coalesce("role", F.lit("unknown")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    pairs = (
        conversations.where("conv_id IS NOT NULL")
        .groupBy(F.expr("(conv_id - pmod(conv_id, 2)) div 2").alias("pair_id"))
        .agg(F.sort_array(F.collect_list(F.when(side == 0, turn))).alias("a"), F.sort_array(F.collect_list(F.when(side == 1, turn))).alias("b"))
    )
    def equal(i):
        return (F.element_at("a", i)["role"] == F.element_at("b", i)["role"]) & (F.element_at("a", i)["text"] == F.element_at("b", i)["text"])

    both = F.least(F.size("a"), F.size("b"))
    steps = F.when(both > 0, F.sequence(F.lit(1), both)).otherwise(F.array().cast("array<int>"))
    shared = F.aggregate(steps, F.lit(0), lambda n, i: F.when((n == i - 1) & equal(i), i).otherwise(n))
    cut = pairs.withColumn("shared", shared)

    def rest(c):
        return F.slice(c, F.col("shared") + 1, F.size(c))

    cut = cut.select("pair_id", "a", "b", "shared", F.slice("a", 1, F.col("shared")).alias("prompt"), rest("a").alias("x"), rest("b").alias("y"))
    text = {c: F.array_join(F.transform(c, _rendered), "") for c in ("prompt", "x", "y")}
    return cut.select(
        "pair_id", F.col("shared").alias("prompt_turns"), text["prompt"].alias("prompt"),
        F.when(F.size("a") > 0, text["x"]).alias("chosen"), F.when(F.size("a") > 0, _spans(F.col("x"))).alias("chosen_spans"),
        F.when(F.size("b") > 0, text["y"]).alias("rejected"), F.when(F.size("b") > 0, _spans(F.col("y"))).alias("rejected_spans"),
    )


def op10_preference(spark, sf_dir: str) -> DataFrame:
    return format_pairs(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


SQL = """WITH turns AS (
  SELECT (conv_id - ((conv_id % 2) + 2) % 2) // 2 AS pair_id, ((conv_id % 2) + 2) % 2 AS side,
         coalesce(role, 'unknown') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn ASC NULLS FIRST, coalesce(role, 'unknown'), coalesce(text, '')) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
pairs AS (SELECT pair_id, count(*) FILTER (side = 0) AS n, count(*) FILTER (side = 1) AS m FROM turns GROUP BY pair_id),
broken AS (
  SELECT a.pair_id, min(a.pos) AS pos FROM turns a LEFT JOIN turns b ON b.pair_id = a.pair_id AND b.side = 1 AND b.pos = a.pos AND b.role = a.role AND b.text = a.text
  WHERE a.side = 0 AND b.pair_id IS NULL GROUP BY a.pair_id),
cut AS (SELECT p.pair_id, n, m, CASE WHEN n = 0 OR m = 0 THEN 0 ELSE coalesce(b.pos - 1, n) END AS shared FROM pairs p LEFT JOIN broken b USING (pair_id)),
rendered AS (
  SELECT t.*, c.shared, pos <= shared AS common, '<|' || role || '|>' || chr(10) || text || '<|end|>' || chr(10) AS body FROM turns t JOIN cut c USING (pair_id)),
placed AS (
  SELECT *, coalesce(sum(length(body)) OVER (PARTITION BY pair_id, side, common ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + length(role) + 5 AS head FROM rendered),
joined AS (
  SELECT pair_id,
    string_agg(body, '' ORDER BY pos) FILTER (side = 0 AND common) AS prompt,
    string_agg(body, '' ORDER BY pos) FILTER (side = 0 AND NOT common) AS chosen,
    string_agg(CAST(CAST(head AS BIGINT) AS VARCHAR) || '-' || CAST(CAST(head + length(text) + 8 AS BIGINT) AS VARCHAR), ',' ORDER BY pos) FILTER (side = 0 AND NOT common AND role = 'assistant') AS chosen_spans,
    string_agg(body, '' ORDER BY pos) FILTER (side = 1 AND NOT common) AS rejected,
    string_agg(CAST(CAST(head AS BIGINT) AS VARCHAR) || '-' || CAST(CAST(head + length(text) + 8 AS BIGINT) AS VARCHAR), ',' ORDER BY pos) FILTER (side = 1 AND NOT common AND role = 'assistant') AS rejected_spans
  FROM placed GROUP BY pair_id)
SELECT c.pair_id, CAST(c.shared AS INTEGER) AS prompt_turns, coalesce(prompt, '') AS prompt,
  CASE WHEN n > 0 THEN coalesce(chosen, '') END AS chosen, CASE WHEN n > 0 THEN coalesce(chosen_spans, '') END AS chosen_spans,
  CASE WHEN m > 0 THEN coalesce(rejected, '') END AS rejected, CASE WHEN m > 0 THEN coalesce(rejected_spans, '') END AS rejected_spans
FROM cut c JOIN joined USING (pair_id)"""
