"""Chat formatting with collapse of cumulative snapshots.

Chat logs often hold a conversation again and again as it grows. Each turn of
a conversation gets the hash of all turns up to it (a running exclusive-or of
hashes that hold the turn's place, role and text; two of 64 bits). A
conversation whose last hash is an inner hash of another, at the same length,
is a prefix of it and goes, by an anti-join; of equal ones the smallest
conv_id stays. The rest is rendered. DataFrame functions only.

A conversation of any length is spread: the running hash is made in parts of
PART turns, whose ends are carried over by one small row per part; a rendered
row holds at most PART turns, and ``part`` numbers the rows of a longer
conversation from 0. Joins are on distinct hashes, so a first turn that all
conversations share is one key with one row.

Cases: turns are ordered by turn, role, text (null first); rows that repeat
all three are one turn; rows with a null conv_id are no conversation; a null
role or text counts as empty; an empty table gives none; other columns
aren't read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from airshed.session import materialize

PART = 1024


def numbered(turns: DataFrame, part: int = PART) -> DataFrame:
    """(conv_id, pos, part, role, text, a, b): distinct turns with their
    places from 1 and the hashes of all turns up to each."""
    rows = turns.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")).where("conv_id IS NOT NULL")
    rows = rows.distinct().withColumn("cut", F.floor(F.coalesce(F.col("turn"), F.lit(-1)) / part))
    order = Window.partitionBy("conv_id", "cut").orderBy("turn", "role", "text")
    rows = materialize(rows.withColumn("at", F.row_number().over(order)), "chat-turns")
    # Where each cut begins; a row per cut.
    sizes = rows.groupBy("conv_id", "cut").agg(F.count(F.lit(1)).alias("n"))
    upto = Window.partitionBy("conv_id").orderBy("cut").rowsBetween(Window.unboundedPreceding, -1)
    first = sizes.select("conv_id", "cut", F.coalesce(F.sum("n").over(upto), F.lit(0)).alias("first"))
    placed = rows.join(first, ["conv_id", "cut"]).withColumn("pos", F.col("first") + F.col("at"))
    for name in ("a", "b"):
        placed = placed.withColumn(f"h{name}", F.xxhash64(F.lit(name), "pos", "role", "text"))
    placed = materialize(placed, "chat-placed")
    whole = placed.groupBy("conv_id", "cut").agg(F.bit_xor("ha").alias("ha"), F.bit_xor("hb").alias("hb"))
    start = whole.select("conv_id", "cut", *[F.coalesce(F.bit_xor(f"h{x}").over(upto), F.lit(0)).alias(f"s{x}") for x in ("a", "b")])
    run = Window.partitionBy("conv_id", "cut").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    joined = placed.join(start, ["conv_id", "cut"])
    for x in ("a", "b"):
        joined = joined.withColumn(x, F.bit_xor(f"h{x}").over(run).bitwiseXOR(F.col(f"s{x}")))
    return joined.select("conv_id", "pos", F.floor((F.col("pos") - 1) / part).cast("int").alias("part"), "role", "text", "a", "b")


def maximal(rows: DataFrame) -> DataFrame:
    """(conv_id, n_turns) of the conversations that no other continues."""
    ends = rows.groupBy("conv_id").agg(F.max(F.struct("pos", "a", "b")).alias("e")).select("conv_id", "e.*")
    unique = ends.groupBy("pos", "a", "b").agg(F.min("conv_id").alias("conv_id"))
    inner = rows.join(ends.select("conv_id", F.col("pos").alias("end")), "conv_id").where("pos < end").select("pos", "a", "b").distinct()
    return unique.join(inner, ["pos", "a", "b"], "left_anti").select("conv_id", F.col("pos").alias("n_turns"))


def render(role, text):
    """One turn in the chat format."""
    return F.concat(F.lit("<|im_start|>"), role, F.lit("\n"), text, F.lit("<|im_end|>\n"))


def format_chats(turns: DataFrame, part: int = PART) -> DataFrame:
    """(conv_id, part, n_turns, text): the rendered maximal conversations;
    n_turns counts the whole conversation."""
    rows = materialize(numbered(turns, part), "chat-rows")
    kept = rows.join(maximal(rows), "conv_id")
    lines = F.transform(F.sort_array(F.collect_list(F.struct("pos", "role", "text"))), lambda x: render(x["role"], x["text"]))
    return kept.groupBy("conv_id", "part", "n_turns").agg(F.array_join(lines, "").alias("text")).select("conv_id", "part", "n_turns", "text")


SQL = """
WITH t AS (SELECT DISTINCT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
n AS (SELECT conv_id, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos FROM t),
r AS (SELECT conv_id, pos, '<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10) AS line FROM n),
c AS (SELECT conv_id, count(*) AS n_turns, list(line ORDER BY pos) AS whole FROM r GROUP BY conv_id),
u AS (SELECT min(conv_id) AS conv_id, n_turns, whole FROM c GROUP BY n_turns, whole),
i AS (SELECT DISTINCT whole[1:k] AS prefix FROM (SELECT whole, unnest(range(1, n_turns)) AS k FROM c))
SELECT conv_id, 0::INTEGER AS part, n_turns, array_to_string(whole, '') AS text FROM u WHERE NOT EXISTS (SELECT 1 FROM i WHERE i.prefix = u.whole)
"""
