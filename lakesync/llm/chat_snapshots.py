"""Chat formatting after collapsing cumulative snapshots.

Logged conversations often hold every earlier state of themselves. Each turn gets a rolling hash of the turns up to
it; a conversation whose last hash is an inner hash of another is a prefix of it and goes by an anti-join. Of equal
conversations the one with the smallest id stays. What remains is rendered with role markers.

Turns are ordered by turn (null first), then role and text; repeated rows are repeated turns. A null role or text is
an empty one. A row without a conversation id is a conversation of its own, of one turn. Turns are numbered, hashed and
rendered in parts of about PART_TURNS turn numbers, which are then put together; this changes nothing in the result, so
that a long conversation keeps many tasks busy, and only its rendered text is in one place. An empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Scratch, read_table, spread_join

PART_TURNS = 1024
#: Role markers of the rendered text. An opening of a marker inside a turn's own text is broken up by a space.
TURN_START, ROLE_END, TURN_END = "<|im_start|>", "\n", "<|im_end|>\n"
MARK, BROKEN_MARK = "<|", "< |"


def _turns(conversations: DataFrame, conv_id: str, turn: str, role: str, text: str) -> DataFrame:
    """The turns under fixed names, with the part they belong to and two hashes of what was said."""
    said = conversations.select(
        F.col(conv_id).alias("conv_id"), F.col(turn).cast("long").alias("turn"),
        F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
    )
    return said.select(
        "*", F.coalesce(F.floor(F.col("turn") / F.lit(PART_TURNS)), F.lit(-(2**62))).cast("long").alias("part"),
        F.xxhash64(F.lit(1), "role", "text").alias("h1"), F.xxhash64(F.lit(2), "role", "text").alias("h2"),
    )


def _at(pos: Column) -> tuple[Column, Column]:
    """The two hashes of a turn at a position."""
    return F.xxhash64(F.lit(3), pos, "h1"), F.xxhash64(F.lit(4), pos, "h2")


def _alone(turns: DataFrame) -> DataFrame:
    """Turns without a conversation, each with the hashes of a conversation of one turn."""
    g1, g2 = _at(F.lit(1).cast("long"))
    return turns.where("conv_id is null").withColumns({"pos": F.lit(1).cast("long"), "n_turns": F.lit(1).cast("long"), "p1": g1, "p2": g2})


def prefix_hashes(turns: DataFrame) -> DataFrame:
    """conv_id, pos (from 1), n_turns and the rolling hash p1, p2 of the first pos turns, for each turn.

    The hash of a prefix is the exclusive or of its turns' hashes, each taken together with its position.
    """
    said = turns.where("conv_id is not null").select("conv_id", "part", "turn", "role", "h1", "h2")
    own = Window.partitionBy("conv_id", "part")
    ordered = own.orderBy(F.col("turn").asc_nulls_first(), "role", "h1", "h2")
    so_far = own.orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)  # not by what equal rows share
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = said.groupBy("conv_id", "part").agg(F.count(F.lit(1)).alias("n")).select(
        "conv_id", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("start"), F.sum("n").over(Window.partitionBy("conv_id")).alias("n_turns")
    )
    placed = said.withColumn("pos", F.row_number().over(ordered)).join(starts, ["conv_id", "part"]).withColumn("pos", F.col("pos") + F.col("start"))
    g1, g2 = _at(F.col("pos"))
    hashed = placed.withColumns({"g1": g1, "g2": g2})
    rolled = hashed.withColumn("p1", F.bit_xor("g1").over(so_far)).withColumn("p2", F.bit_xor("g2").over(so_far))
    parts = hashed.groupBy("conv_id", "part").agg(F.bit_xor("g1").alias("x1"), F.bit_xor("g2").alias("x2")).select(
        "conv_id", "part", F.coalesce(F.bit_xor("x1").over(earlier), F.lit(0)).alias("b1"), F.coalesce(F.bit_xor("x2").over(earlier), F.lit(0)).alias("b2")
    )
    rolled = rolled.join(parts, ["conv_id", "part"]).select(
        "conv_id", "pos", "n_turns", F.col("p1").bitwiseXOR(F.col("b1")).alias("p1"), F.col("p2").bitwiseXOR(F.col("b2")).alias("p2")
    )
    return rolled.union(_alone(turns).select("conv_id", "pos", "n_turns", "p1", "p2"))


def collapse(hashes: DataFrame) -> DataFrame:
    """conv_id (null for turns without one), n_turns, copies and hash p1, p2 of the conversations that no other one continues."""
    whole = hashes.where("pos = n_turns").groupBy("p1", "p2", "n_turns").agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("copies"))
    inner = hashes.where("pos < n_turns").select("p1", "p2", F.col("pos").alias("n_turns")).distinct()
    return whole.join(inner, ["p1", "p2", "n_turns"], "left_anti").select("conv_id", "n_turns", "copies", "p1", "p2")


def render(turns: DataFrame, kept: DataFrame) -> DataFrame:
    """conv_id, n_turns, copies and the rendered text of the kept conversations."""
    piece = F.concat(F.lit(TURN_START), "role", F.lit(ROLE_END), F.replace("text", F.lit(MARK), F.lit(BROKEN_MARK)), F.lit(TURN_END))
    named = kept.where("conv_id is not null").select("conv_id", "n_turns", "copies")
    said = spread_join(turns.where("conv_id is not null"), named, "conv_id", F.struct("turn", "h1"), named.select("conv_id", F.col("n_turns").alias("n")))
    said = said.select("conv_id", "part", "n_turns", "copies", F.struct("turn", "role", "h1", "h2", piece.alias("piece")).alias("said"))
    parts = said.groupBy("conv_id", "part").agg(F.first("n_turns").alias("n_turns"), F.first("copies").alias("copies"), F.array_sort(F.collect_list("said")).alias("said"))
    parts = parts.select("conv_id", "n_turns", "copies", F.struct("part", F.array_join("said.piece", "").alias("piece")).alias("said"))
    whole = parts.groupBy("conv_id").agg(F.first("n_turns").alias("n_turns"), F.first("copies").alias("copies"), F.array_join(F.array_sort(F.collect_list("said"))["piece"], "").alias("rendered"))
    alone = _alone(turns).groupBy("p1", "p2").agg(F.first(piece).alias("rendered"))
    alone = kept.where("conv_id is null").join(alone, ["p1", "p2"])
    return whole.union(alone.select("conv_id", "n_turns", "copies", "rendered"))


def format_chats(conversations: DataFrame, *, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Maximal conversations, rendered: conv_id, n_turns, copies (equal conversations it stands for), rendered."""
    turns, scratch = _turns(conversations, conv_id, turn, role, text), Scratch(conversations.sparkSession, "chat")
    return render(turns, scratch.table(collapse(scratch.table(prefix_hashes(turns), "hashes")), "kept"))


def op5_chat_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return format_chats(read_table(spark, sf_dir, "conversations"))


OP5_SQL = """
WITH said AS (
  SELECT CASE WHEN conv_id IS NULL THEN 'n' || row_number() OVER () ELSE 'c' || conv_id END AS key, conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY key ORDER BY turn NULLS FIRST, role, text) AS pos, count(*) OVER (PARTITION BY key) AS n_turns FROM said
), hashed AS (
  SELECT key, conv_id, pos, n_turns, md5(string_agg(md5(role || chr(1) || text), '') OVER (PARTITION BY key ORDER BY pos ROWS UNBOUNDED PRECEDING)) AS h FROM placed
), whole AS (
  SELECT h, n_turns, first(key ORDER BY conv_id NULLS LAST) AS key, count(*) AS copies FROM hashed WHERE pos = n_turns GROUP BY h, n_turns
), kept AS (
  SELECT * FROM whole WHERE h NOT IN (SELECT h FROM hashed WHERE pos < n_turns)
)
SELECT p.conv_id, k.n_turns, k.copies,
  string_agg('<|im_start|>' || p.role || chr(10) || replace(p.text, '<|', '< |') || '<|im_end|>' || chr(10), '' ORDER BY p.pos) AS rendered
FROM placed p JOIN kept k ON p.key = k.key GROUP BY p.key, 1, 2, 3
"""
