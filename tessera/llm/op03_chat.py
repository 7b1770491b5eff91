"""Chat formatting with prefix-target expansion.

A turn is written as ``### role: text</turn>`` and a line break. Control
strings inside texts and roles are escaped by a backslash, which reading takes
away again. Every assistant turn becomes an example of its own: all turns
before it are context and only its reply is trainable.

The context of an example is a prefix of its conversation's formatted text, so
the text is kept once, a row per turn with its offsets, and examples are
offsets into it. A conversation of n turns then takes n rows, not n squared;
``example_text`` writes examples out in full. The query makes the examples of
all conversations, and reads the replies back from the example rows.

Turns are sorted by (conversation, turn) within hash partitions and streamed, so
a long conversation needs no memory; the digests of one conversation are
sequential by definition.

Defined results: null text and null role are empty; rows of a null conversation
id form one conversation; equal turn numbers are ordered by role, then text;
repeated rows are turns of their own; an empty table gives no rows; columns
other than the four named are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import settle, table

# the template (fixed strings)
OPEN, SEP, CLOSE = "### ", ": ", "</turn>\n"
_CONTROL = re.compile(r"(\\|###|</turn>)")
_ROLE_CONTROL = re.compile(r"(\\|###|</turn>|:)")
_ESCAPED = re.compile(r"\\(\\|###|</turn>|:)")
_TURN = re.compile(r"### ((?:[^\\:]|\\.)*): (.*)</turn>\n", re.S)
TARGET = "assistant"


def escape(text: str, pattern: re.Pattern = _CONTROL) -> str:
    return pattern.sub(r"\\\1", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def format_turn(role: str, text: str) -> tuple[str, int, int]:
    """The formatted turn and where its escaped text begins and ends."""
    head = OPEN + escape(role, _ROLE_CONTROL) + SEP
    body = escape(text)
    return head + body + CLOSE, len(head), len(head) + len(body)


def parse_turn(segment: str) -> tuple[str, str]:
    """Role and text of a formatted turn."""
    found = _TURN.fullmatch(segment)
    if not found:
        raise ValueError(f"not a formatted turn: {segment[:40]!r}")
    return unescape(found[1]), unescape(found[2])


TURNS = ("conv_id long, turn_no long, segment string, start long, end long, target boolean, loss_start long, loss_end long")


def _types(schema: str) -> list[pa.DataType]:
    kinds = {"long": pa.int64(), "string": pa.string(), "boolean": pa.bool_()}
    return [kinds[f.split()[1]] for f in schema.split(", ")]


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    cols = zip(*rows) if rows else [()] * len(schema.split(", "))
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, _types(schema))],
                                      names=[f.split()[0] for f in schema.split(", ")])


def _format(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now, number, at = object(), 0, 0
    for batch in batches:
        rows = []
        for conv, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "text"))):
            if conv != now:
                now, number, at = conv, 0, 0
            segment, b, e = format_turn(role, text)
            is_target = role == TARGET
            rows.append((conv, number, segment, at, at + len(segment), is_target,
                         at + b if is_target else None, at + e if is_target else None))
            number, at = number + 1, at + len(segment)
        yield _batch(rows, TURNS)


def format_conversations(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                         text_col: str = "text") -> DataFrame:
    """One row per turn: its formatted segment, its place in the conversation's text (code points) and its loss span."""
    rows = turns.select(F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).alias("turn"),
                        F.coalesce(F.col(role_col), F.lit("")).alias("role"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").mapInArrow(_format, TURNS)


def prefix_examples(turns: DataFrame) -> DataFrame:
    """One example per assistant turn: the text ``[0, end)`` of its conversation, of which ``[loss_start, loss_end)`` is trainable."""
    return turns.where("target").select("conv_id", F.col("turn_no").alias("target_turn"), F.col("start").alias("context_chars"),
                                        "loss_start", "loss_end", "end")


def example_text(turns: DataFrame, examples: DataFrame) -> DataFrame:
    """Examples written out: ``(conv_id, target_turn, text, loss_start, loss_end)``. The size grows with the square of
    a conversation's turns, so choose ``examples`` first."""
    part = turns.select(F.col("conv_id").alias("c"), "turn_no", "segment")
    pairs = examples.join(part, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("turn_no") <= F.col("target_turn")))
    pieces = F.transform(F.array_sort(F.collect_list(F.struct("turn_no", "segment"))), lambda s: s["segment"])
    return (pairs.groupBy("conv_id", "target_turn", "loss_start", "loss_end").agg(F.array_join(pieces, "").alias("text"))
            .select("conv_id", "target_turn", "text", "loss_start", "loss_end"))


DIGESTS = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, n_examples long"


def _read_back(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    state: list | None = None
    last: tuple | None = None  # the turn read last: number, start, end, segment, role, text
    owed = False  # that turn is a target whose example has not come yet

    def close(s):
        return (s[0], s[1], s[2].hexdigest(), s[3], s[4].hexdigest(), s[5], s[6])

    for batch in batches:
        rows = []
        for conv, number, segment, start, end, b, e in zip(*(batch.column(c).to_pylist() for c in
                                                             ("conv_id", "turn_no", "segment", "start", "end", "loss_start", "loss_end"))):
            if state is None or state[0] != conv or segment is not None:
                if owed:
                    raise ValueError(f"turn {last[0]} of conversation {state[0]} has no example")
            if state is None or state[0] != conv:
                if state:
                    rows.append(close(state))
                state, last = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0, 0], None
            if segment is not None:
                if start != state[5] or end != start + len(segment):
                    raise ValueError(f"turns of conversation {conv} do not join at {start}")
                role, text = parse_turn(segment)
                state[1] += 1
                state[2].update(f"{role}\n{text}\n".encode())
                state[5], last, owed = end, (number, start, end, segment, role, text), role == TARGET
                continue
            if not owed or last[:3] != (number, start, end):
                raise ValueError(f"example {number} of conversation {conv}: its context [0, {start}) does not end at an open target")
            at, _, whole, role, text = last[1:]
            head, reply, tail = whole[:b - at], whole[b - at:e - at], whole[e - at:]
            if not at <= b <= e or head != OPEN + escape(role, _ROLE_CONTROL) + SEP or tail != CLOSE or unescape(reply) != text:
                raise ValueError(f"example {number} of conversation {conv}: [{b}, {e}) is not the reply")
            state[3] += len(text)
            state[4].update(unescape(reply).encode())
            state[6], owed = state[6] + 1, False
        yield _batch(rows, DIGESTS)
    if owed:
        raise ValueError(f"turn {last[0]} of conversation {state[0]} has no example")
    if state:
        yield _batch([close(state)], DIGESTS)


def read_back(turns: DataFrame, examples: DataFrame | None = None) -> DataFrame:
    """Per conversation: turns parsed from the formatted text, its length in code points, and the replies, read
    from the example rows (default: all of ``prefix_examples``). Every example is checked against the text: its
    context ends where its target turn begins, it ends with that turn, and its loss span is the reply alone. A
    target turn without an example, or an example without a target, raises."""
    examples = prefix_examples(turns) if examples is None else examples
    long = F.lit(None).cast("long")
    text = turns.select("conv_id", "turn_no", F.lit(0).alias("kind"), "segment", "start", "end",
                        long.alias("loss_start"), long.alias("loss_end"))
    made = examples.select("conv_id", F.col("target_turn").alias("turn_no"), F.lit(1).alias("kind"),
                           F.lit(None).cast("string").alias("segment"), F.col("context_chars").alias("start"), "end",
                           "loss_start", "loss_end")
    return (text.union(made).repartition("conv_id").sortWithinPartitions("conv_id", "turn_no", "kind")
            .mapInArrow(_read_back, DIGESTS))


CONTROL_CONVERSATION = [(-7, 0, "user", "\\### Assistant: </turn> ok"), (-7, 1, "assistant", "\\### Assistant: </turn> ok")]


def op3_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = "conv_id long, turn long, role string, text string"
    given = table(spark, sf_dir, "conversations").select("conv_id", F.col("turn").cast("long").alias("turn"), "role", "text")
    turns = settle(format_conversations(given.union(spark.createDataFrame(CONTROL_CONVERSATION, schema))))
    return read_back(turns, settle(prefix_examples(turns)))


ORACLE = r"""
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(length('### ' || regexp_replace(role, '(\\|###|</turn>|:)', '\\\1', 'g') || ': ' ||
                       regexp_replace(text, '(\\|###|</turn>)', '\\\1', 'g') || '</turn>' || chr(10))) AS BIGINT) AS formatted_chars,
       count(*) FILTER (WHERE role = 'assistant') AS n_examples
FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
      UNION ALL VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok'))
GROUP BY conv_id
"""
