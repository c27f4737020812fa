"""Quotation linking: who answers whom, and conversations without quoted text.

Lines that begin with `>` are quoted, as deeply as they have such marks; a line like "On ...
wrote:" right before them belongs to them. Paragraphs and lines, quoted or not, are normalised
(case, white space) and hashed. A quoted passage is joined to the latest earlier message of its
conversation that holds it unquoted, else to the first message of an earlier conversation that
does, at whatever level. A message answers the message most of whose characters it quotes at the
first level, of equal ones the latest; without a found quote there the next deeper level decides,
and without any it answers the message before it. Threads follow the answers up to their first
message by pointer doubling.

Passages of a key are never paired with each other: each asks for one message, by a running
maximum over slices of `CHUNK` turns and over the slices, so a frequent line or a very long
conversation is spread over tasks.

Defined cases: a null text counts as empty; messages with a null conversation or turn answer
nothing and are threads of their own; repeated rows are one message; of two messages with one
turn the one with the smaller hash stands for the turn; an empty table gives no rows; other
columns are not looked at.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wardlight.llm.common import pieces, text_of
from wardlight.session import cut_lineage

CHUNK = 4096
_QUOTED = re.compile(r"[ \t]*((?:>[ \t]?)+)")
_WROTE = re.compile(r"^\s*(on\b.*\bwrote|.{0,80}\bwrote|.{0,80}\bschrieb|.{0,80}\ba écrit)\s*:\s*$", re.I)


def key_of(text: str) -> int:
    """A signed hash of a passage without regard to case and white space."""
    h = xxhash.xxh64_intdigest(" ".join(text.lower().split()).encode("utf-8", "surrogatepass"))
    return h - (1 << 64) if h >> 63 else h


def parse(text: str) -> tuple[str, list[tuple[int, str]]]:
    """The text without quotes, and its paragraphs (level, text), level 0 for unquoted ones."""
    own: list[str] = []
    blocks: list[tuple[int, list[str]]] = []
    for line in re.split(r"\r\n|\n|\r", text):
        mark = _QUOTED.match(line)
        level = mark[1].count(">") if mark else 0
        body = line[mark.end() :] if mark else line
        if level and own and _WROTE.match(own[-1]):
            own.pop()
            if blocks and blocks[-1][0] == 0 and blocks[-1][1]:
                blocks[-1][1].pop()
        if not level:
            own.append(line)
        if not blocks or blocks[-1][0] != level or not body.strip():
            blocks.append((level, []))
        if body.strip():
            blocks[-1][1].append(body)
    return "\n".join(own).strip(), [(level, "\n".join(lines)) for level, lines in blocks if lines]


def passages(blocks: list[tuple[int, str]]) -> list[tuple[int, int, int]]:
    """(level, key, characters) of each paragraph and of its lines, each once."""
    found = set()
    for level, text in blocks:
        for part in {text, *text.split("\n")}:
            if part.strip():
                found.add((level, key_of(part), len(" ".join(part.split()))))
    return sorted(found)


_PARTS = pa.list_(pa.struct([("level", pa.int32()), ("key", pa.int64()), ("size", pa.int32())]))


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in pieces(batch):
            parsed = [parse(t) for t in part.column("text").to_pylist()]
            parts = [[{"level": a, "key": k, "size": n} for a, k, n in passages(blocks)] for _, blocks in parsed]
            yield pa.record_batch([*(part.column(c) for c in ("conv", "turn", "mark", "role")), pa.array([b for b, _ in parsed], pa.string()), pa.array(parts, _PARTS)], names=["conv", "turn", "mark", "role", "body", "parts"])


def messages(rows: DataFrame) -> DataFrame:
    """conv, turn, mark (a hash of role and text), role, body and passages of every message."""
    own = rows.select(F.col("conv_id").cast("bigint").alias("conv"), F.col("turn").cast("bigint").alias("turn"), F.xxhash64(F.col("role"), text_of()).alias("mark"), F.col("role").cast("string").alias("role"), text_of().alias("text"))
    parsed = own.mapInArrow(_parse, "conv bigint, turn bigint, mark bigint, role string, body string, parts array<struct<level:int,key:bigint,size:int>>")
    return parsed.dropDuplicates(["conv", "turn", "mark"])


def latest_before(held: DataFrame, asked: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """For each (conv, key, turn) asked for, the latest earlier (turn, mark) of held(conv, key, turn, mark)."""
    both = held.unionByName(asked.select("conv", "key", "turn", F.lit(None).cast("bigint").alias("mark")))
    turns = both.groupBy("conv", "key", "turn").agg(F.min("mark").alias("mark")).withColumn("chunk", F.floor(F.col("turn") / chunk))
    place = F.when(F.col("mark").isNotNull(), F.struct("turn", "mark"))
    before = Window.partitionBy("conv", "key", "chunk").orderBy("turn").rowsBetween(Window.unboundedPreceding, -1)
    inside = turns.withColumn("inside", F.max(place).over(before))
    chunks = turns.groupBy("conv", "key", "chunk").agg(F.max(place).alias("last"))
    earlier = Window.partitionBy("conv", "key").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    carried = chunks.withColumn("carried", F.max("last").over(earlier)).drop("last")
    found = inside.join(carried, ["conv", "key", "chunk"]).withColumn("source", F.coalesce("inside", "carried")).filter("source IS NOT NULL")
    return found.select("conv", "key", "turn", F.struct("conv", "source.turn", "source.mark").alias("source"))


def _answers(all_messages: DataFrame) -> DataFrame:
    """conv, turn, mark, the message it answers (up, null if there is none) and the originals of its quotes by level."""
    placed = all_messages.filter("conv IS NOT NULL AND turn IS NOT NULL")
    parts = placed.select("conv", "turn", "mark", F.explode("parts").alias("part")).select("conv", "turn", "mark", "part.*")
    held = parts.filter("level = 0").select("conv", "key", "turn", "mark")
    asked = parts.filter("level > 0").select("conv", "turn", "mark", "key", "level", "size")
    near = asked.join(latest_before(held, asked.select("conv", "key", "turn")), ["conv", "key", "turn"], "left")
    first = held.groupBy("key").agg(F.min(F.struct("conv", "turn", "mark")).alias("first"))
    far = near.filter("source IS NULL").join(first, "key").filter("first.conv < conv").withColumn("source", F.col("first")).drop("first")
    quoted = near.filter("source IS NOT NULL").unionByName(far)
    votes = quoted.groupBy("conv", "turn", "mark", "level", "source").agg(F.sum("size").alias("size"))
    original = F.struct("level", F.col("source.conv").alias("conv_id"), F.col("source.turn").alias("turn"))
    best = votes.groupBy("conv", "turn", "mark").agg(
        F.max(F.struct((-F.col("level")).alias("nearest"), "size", "source")).getField("source").alias("quoted"),
        F.array_sort(F.collect_set(original)).alias("originals"),
    )
    turns = placed.select("conv", F.lit(0).cast("bigint").alias("key"), "turn", "mark")
    previous = latest_before(turns, turns).select("conv", "turn", F.col("source").alias("previous"))
    return placed.select("conv", "turn", "mark").join(best, ["conv", "turn", "mark"], "left").join(previous, ["conv", "turn"], "left").select("conv", "turn", "mark", F.coalesce("quoted", "previous").alias("up"), "originals")


def threads(answers: DataFrame) -> DataFrame:
    """node, root and depth of each message, by pointer doubling: every round doubles the way up."""
    state = cut_lineage(answers.select(F.struct("conv", "turn", "mark").alias("node"), "up", F.when(F.col("up").isNull(), 0).otherwise(1).alias("steps"), F.col("up").isNull().alias("done")))
    while not state.filter("NOT done").isEmpty():
        above = state.select(F.col("node").alias("up"), F.col("up").alias("further"), F.col("steps").alias("more"))
        moved = state.filter("NOT done").join(above, "up", "left").select("node", F.coalesce("further", "up").alias("up"), (F.col("steps") + F.coalesce("more", F.lit(0))).alias("steps"), F.col("further").isNull().alias("done"))
        state = cut_lineage(state.filter("done").unionByName(moved))
    return state.select("node", F.coalesce("up", "node").alias("root"), F.col("steps").alias("depth"))


def link(rows: DataFrame) -> DataFrame:
    """One row per message, in reply order: thread by thread, answers after what they answer.

    conv_id, turn, role, reply_conv, reply_turn, thread_conv, thread_turn, depth, n_quoted
    (quoted passages), levels (deepest quote), body (without quotes), originals (level, conv_id
    and turn of every message that holds a quoted passage of that level).
    """
    every = cut_lineage(messages(rows))
    answers = cut_lineage(_answers(every))
    rooted = threads(answers).select("node.*", "root", "depth")
    keys = ["conv", "turn", "mark"]

    linked = every.join(answers, keys, "left").join(rooted, keys, "left")
    own = F.struct(*keys)
    return linked.select(
        F.col("conv").alias("conv_id"),
        "turn",
        "role",
        F.col("up.conv").alias("reply_conv"),
        F.col("up.turn").alias("reply_turn"),
        F.coalesce("root", own).getField("conv").alias("thread_conv"),
        F.coalesce("root", own).getField("turn").alias("thread_turn"),
        F.coalesce("depth", F.lit(0)).alias("depth"),
        F.size(F.filter("parts", lambda p: p["level"] > 0)).alias("n_quoted"),
        F.coalesce(F.array_max(F.transform("parts", lambda p: p["level"])), F.lit(0)).alias("levels"),
        "body",
        F.coalesce("originals", F.array().cast("array<struct<level:int,conv_id:bigint,turn:bigint>>")).alias("originals"),
    ).orderBy("thread_conv", "thread_turn", "depth", "conv_id", "turn")
