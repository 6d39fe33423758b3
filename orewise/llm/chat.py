"""Chat formatting: multi-party perspective rotation.

For every participant of a dialogue the dialogue is rendered with that speaker as the
assistant and the others as named users, with the character spans of the assistant's turns
(what a loss mask keeps). System turns stay system turns for everyone.

A rendering is kept in parts of a fixed number of turns, with each part's character offset,
so that a dialogue of any length is never gathered in one row or task; a dialogue of at
most that many turns is one part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import small, written

#: Turns of a part.
PART_TURNS = 512
SYSTEM = "system"
START, END = "<|im_start|>", "<|im_end|>\n"
#: How marks within a text or a name begin, and what stands for that in a rendering, so that no text ends its turn or opens another.
MARK, BROKEN = "<|im_", "<| im_"


def _ranked_small(turns: DataFrame) -> DataFrame:
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    return turns.withColumn("seq", F.row_number().over(order) - 1)


def _ranked_large(turns: DataFrame) -> DataFrame:
    """seq of dialogues of any length: rows are dealt by range, so a long dialogue spans many
    tasks; counts of its ranges give each range's first seq. Only equal rows are told by tie."""
    ranged = written(
        turns.withColumn("tie", F.monotonically_increasing_id())
        .repartitionByRange("conv_id", "turn", "role", "text", "tie")
        .withColumn("range", F.spark_partition_id()),
        "turns",
    )
    before = Window.partitionBy("conv_id").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    first = (
        ranged.groupBy("conv_id", "range").agg(F.count("*").alias("n"))
        .select(F.col("conv_id").alias("c"), F.col("range").alias("r"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    )
    within = Window.partitionBy("conv_id", "range").orderBy("turn", "role", "text", "tie")
    ranked = ranged.withColumn("seq", F.row_number().over(within) - 1)
    return ranked.join(first, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("range") == F.col("r"))).select(
        "conv_id", "turn", "role", "text", (F.col("seq") + F.col("first")).alias("seq")
    )


def _header(speaker: Column, role: Column) -> Column:
    as_assistant = F.when(role == speaker, F.lit("assistant"))
    return F.concat(
        F.lit(START), F.when(role == SYSTEM, F.lit(SYSTEM)).otherwise(F.coalesce(as_assistant, F.concat(F.lit("user name="), role))), F.lit("\n")
    )


def rotate(turns: DataFrame, part_turns: int = PART_TURNS) -> DataFrame:
    """turns(conv_id, turn, role, text) -> conv_id, speaker, part, n_turns, offset, rendered, mask.

    One row per dialogue, participant (distinct role but system) and part of part_turns
    turns. rendered is the part's text, offset its first character in the whole rendering,
    mask an array of (start, end) within the whole rendering: the texts of the speaker's own
    turns with their end marks. Turns are in the order (turn, role, text), nulls first, so
    ties and repeated rows have a place. A null role is the participant "unknown", a null
    text is empty; rows with a null conv_id are one dialogue. Marks within texts and roles
    are broken (BROKEN) before anything else, so they are plain text. A dialogue of system turns
    only has no participant and gives no row. An empty table gives none.
    """
    base = turns.select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"),
        *[F.replace(F.coalesce(F.col(c).cast("string"), F.lit(empty)), F.lit(MARK), F.lit(BROKEN)).alias(c) for c, empty in (("role", "unknown"), ("text", ""))],
    )
    long = base.groupBy("conv_id").agg(F.count("*").alias("n")).where(F.col("n") > part_turns).select(F.col("conv_id").alias("c"))
    same = F.col("conv_id").eqNullSafe(F.col("c"))
    one_part = long.isEmpty()
    if one_part:
        ranked = _ranked_small(base)
    else:
        long = small(written(long, "long"))
        ranked = _ranked_small(base.join(long, same, "left_anti")).unionByName(_ranked_large(base.join(long, same, "left_semi")))
    ranked = ranked.withColumn("part", F.floor(F.col("seq") / part_turns))

    # A part's turns are gathered once; each of its dialogue's participants then renders them.
    parts = ranked.groupBy("conv_id", "part").agg(F.array_sort(F.collect_list(F.struct("seq", "role", "text"))).alias("turns"))
    speakers = base.where(F.col("role") != SYSTEM).select(F.col("conv_id").alias("c"), F.col("role").alias("speaker")).distinct()
    each = parts.join(speakers, same).drop("c")
    length = lambda t: F.length(_header(F.col("speaker"), t.role)) + F.length(t.text) + len(END)
    each = each.withColumn("ends", F.transform("turns", length))
    each = each.withColumn("n_chars", F.aggregate("ends", F.lit(0).cast("long"), lambda a, x: a + x))
    if one_part:
        each = each.withColumn("offset", F.lit(0).cast("long"))
    else:  # offsets are summed over rows without the turns, which then meet their parts again
        each = written(each, "parts")
        before = Window.partitionBy("conv_id", "speaker").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
        light = each.select(F.col("conv_id").alias("c"), F.col("speaker").alias("s"), F.col("part").alias("p"), F.coalesce(F.sum("n_chars").over(before), F.lit(0)).alias("offset"))
        each = each.join(light, same & (F.col("speaker") == F.col("s")) & (F.col("part") == F.col("p"))).drop("c", "s", "p")
    rendered = F.array_join(F.transform("turns", lambda t: F.concat(_header(F.col("speaker"), t.role), t.text, F.lit(END))), "")
    # Running (place, spans) over the part's turns.
    state = F.struct(F.col("offset").alias("at"), F.array().cast("array<struct<start:bigint,end:bigint>>").alias("spans"))

    def step(acc: Column, t: Column) -> Column:
        body = acc.at + F.length(_header(F.col("speaker"), t.role))
        end = body + F.length(t.text) + len(END)
        own = F.array(F.struct(body.alias("start"), (end - 1).alias("end")))  # the line end after the mark isn't learned
        return F.struct(end.alias("at"), F.when(t.role == F.col("speaker"), F.concat(acc.spans, own)).otherwise(acc.spans).alias("spans"))

    return each.select(
        "conv_id", "speaker", "part", F.size("turns").cast("long").alias("n_turns"), "offset",
        rendered.alias("rendered"), F.aggregate("turns", state, step, lambda a: a.spans).alias("mask"),
    )


def rotate_sql(part_turns: int = PART_TURNS) -> str:
    """DuckDB SQL for the rows of rotate() with the mask as text."""
    header = f"'{START}' || CASE WHEN role = '{SYSTEM}' THEN role WHEN role = speaker THEN 'assistant' ELSE 'user name=' || role END || chr(10)"
    end = f"'{END[:-1]}' || chr(10)"
    return f"""
WITH base AS (SELECT conv_id, turn, replace(coalesce(role, 'unknown'), '{MARK}', '{BROKEN}') AS role, replace(coalesce(text, ''), '{MARK}', '{BROKEN}') AS text FROM conversations),
ranked AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) - 1 AS seq FROM base),
speakers AS (SELECT DISTINCT conv_id AS c, role AS speaker FROM base WHERE role <> '{SYSTEM}'),
turned AS (
  SELECT conv_id, speaker, role, seq, seq // {part_turns} AS part, text, {header} AS head FROM ranked JOIN speakers ON conv_id IS NOT DISTINCT FROM c),
placed AS (
  SELECT *, coalesce(sum(length(head) + length(text) + {len(END)}) OVER (
    PARTITION BY conv_id, speaker ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS place FROM turned)
SELECT conv_id, speaker, part::BIGINT AS part, count(*) AS n_turns, min(place) AS "offset",
  string_agg(head || text || {end}, '' ORDER BY seq) AS rendered,
  coalesce(string_agg((place + length(head)) || ':' || (place + length(head) + length(text) + {len(END) - 1}), ',' ORDER BY seq)
    FILTER (role = speaker), '') AS mask
FROM placed GROUP BY conv_id, speaker, part"""
