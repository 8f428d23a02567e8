"""Formatting of conversations with typed content parts, and reading them back."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seasonstar.llm.common import text_slices

OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
#: Strings that may steer a model; none can stand in a text after `escape`. `<|` starts every marker of the template.
CONTROL = ("<|", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
#: Characters after which a block of a conversation is closed at the next turn.
BLOCK_CHARS = 1 << 20
#: Pixels of a side of an image tile, milliseconds of an audio frame, tokens of a page: each gives the tokens of a part.
TILE, FRAME_MS, PAGE_TOKENS = 28, 40, 512

PART = "struct<kind:string,text:string,ref:string,width:int,height:int,millis:bigint,pages:int>"
_TURN = re.compile(r"<\|im_start\|>([^\n]*)\n(.*?)<\|im_end\|>\n", re.DOTALL)
_BLOCKS = (
    "conv_id long, block long, formatted string, loss array<struct<start:long,stop:long>>, "
    "attachments array<struct<turn:long,part:int,kind:string,ref:string,tokens:long>>"
)
_DIGEST = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def text_parts(text: Column) -> Column:
    """A plain text as the only part of a turn."""
    empty = {"ref": "string", "width": "int", "height": "int", "millis": "bigint", "pages": "int"}
    rest = [F.lit(None).cast(t).alias(c) for c, t in empty.items()]
    return F.array(F.struct(F.lit("text").alias("kind"), text.alias("text"), *rest))


def escape(text: Column) -> Column:
    """Double each backslash and put one behind the first character of each control string."""
    out = F.replace(F.coalesce(text, F.lit("")), F.lit("\\"), F.lit("\\\\"))
    for control in CONTROL:
        out = F.replace(out, F.lit(control), F.lit(control[0] + "\\" + control[1:]))
    return out


def unescape(text: str) -> str:
    return re.sub(r"\\(\\?)", r"\1", text)


def escape_role(role: Column) -> Column:
    """A role stands on one line."""
    return F.replace(escape(role), F.lit("\n"), F.lit("\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(\\|n)?", lambda m: {"n": "\n", "\\": "\\"}.get(m[1], ""), role)


#: How the visitor writes each kind of part. Kinds it doesn't know are written as text.
def _written(part: Column) -> Column:
    marker = F.concat(F.lit("<|"), part["kind"], F.lit("|>"))
    return F.when(part["kind"].isin("image", "audio", "document"), marker).otherwise(escape(part["text"]))


def _tokens(part: Column) -> Column:
    """Tokens that a placeholder stands for once it is expanded; missing sizes count as 0."""
    tiles = F.ceil(part["width"] / TILE) * F.ceil(part["height"] / TILE)
    return F.coalesce(
        F.when(part["kind"] == "image", tiles)
        .when(part["kind"] == "audio", F.ceil(part["millis"] / FRAME_MS))
        .when(part["kind"] == "document", part["pages"].cast("long") * PAGE_TOKENS),
        F.lit(0),
    ).cast("long")


def visit(content: Column) -> tuple[Column, Column]:
    """The parts of a turn as one text with placeholders in order, and the references of the attachments."""
    content = F.coalesce(content, F.array().cast(f"array<{PART}>"))
    body = F.array_join(F.transform(content, _written), "")
    listed = F.transform(
        content,
        lambda p, i: F.struct(i.cast("int").alias("part"), p["kind"].alias("kind"), p["ref"].alias("ref"), _tokens(p).alias("tokens")),
    )
    return body, F.filter(listed, lambda a: a["kind"].isin("image", "audio", "document"))


def format_chats(turns: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """Conversations as text: blocks of whole turns, in the order of `block` within a conversation.

    `turns` needs `conv_id`, `turn`, `role` and `content`, an array of parts (`PART`); other columns are ignored. Turns
    stand in the order of `turn`, nulls first, and rows of the same turn in the order of role and written body. A null
    role or text is empty; a null `conv_id` is a conversation. A turn is written as the opening marker, its role on one
    line, its parts and the closing marker; texts are escaped, so markers in them are text. `loss` has the places, in
    code points of the block, of what the `loss_role` says. `attachments` has the turn, the part's place in it, kind,
    reference and expanded tokens of each image, audio or document.

    Rows are dealt by ranges of conversation and turn, so even one conversation with a third of all turns is
    formatted by many tasks; a block ends at `BLOCK_CHARS`. No rows give no blocks.
    """
    body, attached = visit(F.col("content"))
    head = F.concat(F.lit(OPEN), escape_role(F.col("role")), F.lit("\n"))
    rows = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), head.alias("head"),
        body.alias("text"), attached.alias("attached"), F.coalesce(F.col("role") == loss_role, F.lit(False)).alias("loss"),
    )
    keys = [F.col("conv_id"), F.col("turn"), F.xxhash64("head", "text")]
    dealt = rows.repartitionByRange(*keys).sortWithinPartitions("conv_id", "turn", "head", "text")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, conv, size, pieces, loss, attachments = TaskContext.get().partitionId() << 33, None, 0, [], [], []
        schema = pa.schema(
            [
                ("conv_id", pa.int64()), ("block", pa.int64()), ("formatted", pa.string()),
                ("loss", pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))),
                ("attachments", pa.list_(pa.struct([("turn", pa.int64()), ("part", pa.int32()), ("kind", pa.string()), ("ref", pa.string()), ("tokens", pa.int64())]))),
            ]
        )

        def block() -> pa.RecordBatch:
            row = [conv], [number], ["".join(pieces)], [list(loss)], [list(attachments)]
            for x in (pieces, loss, attachments):
                x.clear()
            return pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(row, schema)], schema=schema)

        for batch in text_slices(batches):
            for row in batch.to_pylist():
                if pieces and (row["conv_id"] != conv or size >= BLOCK_CHARS):
                    yield block()
                    number, size = number + 1, 0
                conv = row["conv_id"]
                start = size + len(row["head"])
                stop = start + len(row["text"])
                if row["loss"]:
                    loss.append({"start": start, "stop": stop})
                attachments += [{"turn": row["turn"], **a} for a in row["attached"]]
                pieces += [row["head"], row["text"], CLOSE + "\n"]
                size = stop + len(CLOSE) + 1
        if pieces:
            yield block()

    return dealt.mapInArrow(run, _BLOCKS)


def read_chats(blocks: DataFrame) -> DataFrame:
    """What the formatted blocks say, per conversation: turns and their digest, the text under the loss mask and its digest.

    A digest runs over a conversation from its first turn to its last, so the blocks of one meet in one task; it reads
    them one after the other and holds one at a time.
    """
    sorted_blocks = blocks.select("conv_id", "block", F.col("formatted").alias("text"), "loss").repartition("conv_id")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, state = None, None

        def closed() -> pa.RecordBatch:
            turns, said, counts = state
            row = conv, counts[0], turns.hexdigest(), counts[1], said.hexdigest(), counts[2]
            names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds)], names=names)

        for batch in text_slices(batches):
            for row in batch.to_pylist():
                if state and row["conv_id"] != conv:
                    yield closed()
                    state = None
                if state is None:
                    conv, state = row["conv_id"], (hashlib.sha256(), hashlib.sha256(), [0, 0, 0])
                turns, said, counts = state
                text = row["text"]
                for role, body in _TURN.findall(text):
                    turns.update(f"{unescape_role(role)}\n{unescape(body)}\n".encode())
                    counts[0] += 1
                for span in row["loss"]:
                    answer = unescape(text[span["start"] : span["stop"]])
                    said.update(answer.encode())
                    counts[1] += len(answer)
                counts[2] += len(text)
        if state:
            yield closed()

    return sorted_blocks.sortWithinPartitions("conv_id", "block").mapInArrow(run, _DIGEST)


def _sql_escape(column: str) -> str:
    out = f"replace(coalesce({column}, ''), '\\', '\\\\')"
    for control in CONTROL:
        out = f"replace({out}, '{control}', '{control[0]}\\{control[1:]}')"
    return out


#: The digests from the table itself; the length is that of the template.
CHAT_SQL = f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]')
SELECT conv_id, count(*)::BIGINT AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(length({_sql_escape("role")}) + length({_sql_escape("text")}) + {len(OPEN) + len(CLOSE) + 2})::BIGINT AS formatted_chars
FROM turns GROUP BY conv_id
"""
