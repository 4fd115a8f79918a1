"""Chat formatting with Spark expressions only.

The turns of a conversation are collected as structs and sorted; adjacent turns of one role become
one block, whose texts stay apart by a mark of their own, so that formatting can be undone:

    ### user: first text</part>second text</turn>
    ### assistant: answer</turn>

Control strings inside texts and roles are written as codes (``ESCAPES``). A code begins with a
backslash, and a backslash of the text is itself a code, so an escaped text holds no control string
and only one text has that escaped form. What a model learns from (the loss mask) is carried as the pieces of the
output with a flag each.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from webloom.llm.common import table
from webloom.session import cut_lineage

HEAD, AFTER_ROLE, PART, TURN = "### ", ": ", "</part>", "</turn>\n"
#: The backslash first: the codes of the others bring new ones.
ESCAPES = [("\\", "\\b"), ("###", "\\h"), ("</turn>", "\\t"), ("</part>", "\\p")]
#: Additionally in roles, which end at the first colon.
ROLE_ESCAPES = [*ESCAPES, (":", "\\c")]
SEGMENT_TURNS = 1024


def _replace(text: Column, pairs: Sequence[tuple[str, str]]) -> Column:
    for old, new in pairs:
        text = F.replace(text, F.lit(old), F.lit(new))
    return text


def escape(text: Column, escapes: Sequence[tuple[str, str]] = ESCAPES) -> Column:
    return _replace(text, escapes)


def unescape(text: Column, escapes: Sequence[tuple[str, str]] = ESCAPES) -> Column:
    return _replace(text, [(code, mark) for mark, code in reversed(escapes)])


def merged(blocks: Column) -> Column:
    """Adjacent blocks (role, texts) of one role made one. Linear in the number of blocks."""
    begins = F.filter(
        F.transform(blocks, lambda b, i: F.when((i == 0) | (F.get(blocks, i - 1)["role"] != b["role"]), i).otherwise(-1)), lambda i: i >= 0
    )
    until = lambda j: F.coalesce(F.get(begins, j + 1), F.size(blocks))
    return F.transform(
        begins,
        lambda at, j: F.struct(
            F.get(blocks, at)["role"].alias("role"),
            F.flatten(F.transform(F.slice(blocks, at + 1, until(j) - at), lambda b: b["texts"])).alias("texts"),
        ),
    )


def pieces_of(blocks: Column, loss_roles: Sequence[str]) -> Column:
    """The pieces (text, loss) whose concatenation is the formatted conversation."""
    piece = lambda text, loss: F.struct(text.alias("text"), loss.alias("loss"))
    never = F.lit(False)

    def block(b: Column) -> Column:
        loss = b["role"].isin(list(loss_roles))
        texts = F.transform(
            b["texts"],
            lambda x, i: F.when(i == 0, F.array(piece(escape(x), loss))).otherwise(F.array(piece(F.lit(PART), never), piece(escape(x), loss))),
        )
        head = piece(F.concat(F.lit(HEAD), escape(b["role"], ROLE_ESCAPES), F.lit(AFTER_ROLE)), never)
        return F.concat(F.array(head), F.flatten(texts), F.array(piece(F.lit(TURN), never)))

    return F.flatten(F.transform(blocks, block))


def format_conversations(
    turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
    loss_roles: Sequence[str] = ("assistant",), segment_turns: int = SEGMENT_TURNS,
) -> DataFrame:
    """One row per conversation: (conv_id, formatted, pieces array<struct<text, loss>>).

    Turns are ordered by number (null first), equal numbers by role, then by text; a row that is repeated whole is
    formatted as often as it is there. A null or empty text is the empty text, a null role the empty role; rows with a null
    conv_id are one conversation. An empty table gives an empty result. No other column is read.

    A conversation whose turn numbers span several segments of ``segment_turns`` is collected per segment first, many
    tasks at once, and its merged blocks are then put together; the others are shuffled once. The result is one value a
    conversation, so a conversation must fit in one.
    """
    rows = turns.select(
        F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"),
        F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
        F.coalesce(F.floor(F.col(turn_col) / segment_turns), F.lit(0)).cast("bigint").alias("segment"),
    )
    spans = rows.groupBy("conv_id").agg(F.min("segment").alias("least"), F.max("segment").alias("most"))
    long = cut_lineage(spans.where("least < most").select(F.col("conv_id").alias("long_id")), "long")
    same = F.col("conv_id").eqNullSafe(F.col("long_id"))
    collected = F.sort_array(F.collect_list(F.struct("turn", "role", "text")))
    as_blocks = F.transform(F.col("got"), lambda t: F.struct(t["role"].alias("role"), F.array(t["text"]).alias("texts")))

    short = rows.join(long, same, "left_anti").groupBy("conv_id").agg(collected.alias("got"))
    short = short.select("conv_id", as_blocks.alias("blocks"))
    parts = rows.join(long, same, "left_semi").groupBy("conv_id", "segment").agg(collected.alias("got"))
    parts = parts.select("conv_id", "segment", as_blocks.alias("blocks")).select("conv_id", "segment", merged(F.col("blocks")).alias("blocks"))
    whole = parts.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("segment", "blocks"))).alias("parts"))
    whole = whole.select("conv_id", F.flatten(F.col("parts")["blocks"]).alias("blocks"))
    return (
        short.unionByName(whole)
        .select("conv_id", merged(F.col("blocks")).alias("blocks"))
        .select("conv_id", pieces_of(F.col("blocks"), loss_roles).alias("pieces"))
        .select("conv_id", F.array_join(F.col("pieces")["text"], "").alias("formatted"), "pieces")
    )


def read_back(formatted: Column) -> Column:
    """The turns (role, text) of a formatted conversation, in order."""
    lines = F.split(formatted, TURN, -1)
    blocks = F.slice(lines, 1, F.size(lines) - 1)

    def turns(block: Column) -> Column:
        colon = F.locate(AFTER_ROLE, block)
        role = unescape(F.substr(block, F.lit(len(HEAD) + 1), colon - len(HEAD) - 1), ROLE_ESCAPES)
        texts = F.split(F.substr(block, colon + len(AFTER_ROLE)), PART, -1)
        return F.transform(texts, lambda x: F.struct(role.alias("role"), unescape(x).alias("text")))

    return F.flatten(F.transform(blocks, turns))


def loss_text(pieces: Column) -> Column:
    """All text under the loss mask, as it was before escaping."""
    return F.array_join(F.transform(F.filter(pieces, lambda p: p["loss"]), lambda p: unescape(p["text"])), "")


def digests(formatted: DataFrame) -> DataFrame:
    """What can be read back from (conv_id, formatted, pieces): counts and digests of turns and of the text under the mask."""
    read = formatted.select(
        "conv_id", read_back(F.col("formatted")).alias("turns"), loss_text(F.col("pieces")).alias("loss"), F.length("formatted").cast("bigint").alias("formatted_chars")
    )
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    digest = lambda text: F.sha2(text.cast("binary"), 256)
    return read.select(
        "conv_id", F.size("turns").cast("bigint").alias("n_turns"), digest(F.array_join(lines, "")).alias("turns_sha256"),
        F.length("loss").cast("bigint").alias("loss_chars"), digest(F.col("loss")).alias("loss_sha256"), "formatted_chars",
    )


#: A conversation whose texts look like the template of another format.
PLANTED = r"\### Assistant: </turn> ok"


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    planted = spark.range(2).select(
        F.lit(-7).cast("bigint").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(PLANTED).alias("text"),
    )
    return digests(format_conversations(turns.unionByName(planted)))


_ESCAPED = "replace(replace(replace(replace({0}, '\\', '\\b'), '###', '\\h'), '</turn>', '\\t'), '</part>', '\\p')"

SQL = rf"""
with c as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -7, 0, 'user', '{PLANTED}' union all select -7, 1, 'assistant', '{PLANTED}'
), r as (select *, lag(role) over (partition by conv_id order by turn, role, text) as before from c)
select conv_id, count(*) as n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
  cast(sum(case when role = 'assistant' then length(text) else 0 end) as bigint) as loss_chars,
  sha256(string_agg(case when role = 'assistant' then text else '' end, '' order by turn, role, text)) as loss_sha256,
  cast(sum(length({_ESCAPED.format('text')}) + case when before = role then {len(PART)}
    else length(replace({_ESCAPED.format('role')}, ':', '\c')) + {len(HEAD + AFTER_ROLE + TURN)} end) as bigint) as formatted_chars
from r group by conv_id
"""
