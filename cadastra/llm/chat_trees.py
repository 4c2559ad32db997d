"""Chat formatting of reply trees: root-to-leaf paths by self-joins, ranked, each one conversation.

*Trees.* Nodes are (conv_id, node, parent, role, text, score); a node without a parent, or whose
parent is not in the table, is a root. ``paths`` joins the tree with itself: step k knows every
node's ancestor 2**k replies up, so a chain of n replies takes log2(n) joins. It gives each leaf the
score of its path; the ``branches`` best leaves of a conversation are chosen (score, then node) and
walked back by the same tables, longest jump first. Joins are on single nodes, so a conversation of
any size is spread over all tasks.

*Format.* A turn is ``<|im_start|>role\\ntext<|im_end|>\\n``. Control strings inside texts (this
template's and other common ones) get a backslash after their first character, backslashes are
doubled; ``unescape`` is the exact inverse. Turns are rendered one row each (``path``, ``seq``,
``chunk``); the conversation is its chunks in order. The loss mask covers the texts of assistants.

*Reading back.* Chunks of a path arrive sorted and are parsed as a stream: a task holds one turn, not
one conversation.

Defined results: null role and null text count as empty; empty texts are turns; repeated rows are
turns of their own; an empty table gives no rows; a cycle of replies raises an error; a very long text is one
turn and held by one task. Other columns, whatever their names, are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise, ordered_ids, previous_ids, shuffle_partitions

START, END = "<|im_start|>", "<|im_end|>"
#: fixed values: control strings that are escaped inside texts
CONTROL = ["<|im_start|>", "<|im_end|>", "<|endoftext|>", "<|system|>", "<|user|>", "<|assistant|>",
           "<|begin_of_text|>", "<|end_of_text|>", "<|start_header_id|>", "<|end_header_id|>", "<|eot_id|>",
           "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>"]
_CONTROL = re.compile("|".join(re.escape(c) for c in sorted(CONTROL, key=len, reverse=True)))
_ESCAPED = re.compile(r"\\(\\|n)?")


def escape(text: str) -> str:
    return _CONTROL.sub(lambda m: m[0][0] + "\\" + m[0][1:], text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    """Inverse of ``escape``: a doubled backslash is one, a single one was put in and goes."""
    return re.sub(r"\\(\\?)", r"\1", text)


def escape_role(role: str) -> str:
    return escape(role).replace("\n", "\\n")


def unescape_role(role: str) -> str:
    return _ESCAPED.sub(lambda m: "\n" if m[1] == "n" else m[1] or "", role)


def render(role: str, text: str) -> str:
    return f"{START}{escape_role(role)}\n{escape(text)}{END}\n"


_TURN = re.compile(re.escape(START) + r"([^\n]*)\n(.*?)" + re.escape(END) + r"\n", re.S)


def reply_chains(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                 text_col: str = "text") -> DataFrame:
    """Linear conversations as trees: each row replies to the row before it by turn (ties by role, text).

    The score of a node is the length of an assistant's text.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    role = F.coalesce(F.col(role_col), F.lit(""))
    rows = turns.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"), role.alias("role"),
                        text.alias("text"), F.xxhash64(text).alias("tie"))
    nodes = ordered_ids(rows, ["conv_id", "turn", "role", "tie"], "chat-nodes", "node")
    prev = previous_ids(nodes, "node")
    above = nodes.select(F.col("node").alias("prev"), F.col("conv_id").alias("prev_conv"))
    linked = prev.join(above, "prev", "left").select("node", "prev", "prev_conv")
    return (nodes.join(linked, "node")
            .withColumn("parent", F.when(F.col("conv_id").eqNullSafe(F.col("prev_conv"))
                                         & F.col("prev").isNotNull(), F.col("prev")))
            .withColumn("score", F.when(F.col("role") == "assistant", F.char_length("text")).otherwise(0).cast("double"))
            .select("conv_id", "node", "parent", "role", "text", "score"))


def paths(nodes: DataFrame, branches: int = 1, max_steps: int = 40) -> DataFrame:
    """(path, rank, depth, last, node) of the ``branches`` best root-to-leaf paths of each conversation.

    ``path`` is the leaf's node id; depth counts from the leaf (0) up to the root, whose depth is ``last``.
    """
    known = nodes.select(F.col("node").alias("parent")).distinct()
    slim = nodes.select("conv_id", "node", "parent", "score")
    replies, no_parent = slim.where("parent IS NOT NULL"), F.lit(None).cast("long")
    # roots are joined with nothing: as one group they would be one task's
    base = (slim.where("parent IS NULL").unionByName(replies.join(known, "parent", "left_semi"))
            .unionByName(replies.join(known, "parent", "left_anti").withColumn("parent", no_parent)))
    level = materialise(base.select("conv_id", "node", F.col("parent").alias("up"), "score",
                                    F.when(F.col("parent").isNull(), 0).otherwise(1).cast("long").alias("above")), "chat-jump")
    leaves = level.join(level.select(F.col("up").alias("node")).where("node IS NOT NULL").distinct(), "node", "left_anti")
    leaves = materialise(leaves.select("conv_id", "node"), "chat-leaves")
    jumps = []
    for _ in range(max_steps):
        open_nodes = level.where("up IS NOT NULL")
        if open_nodes.isEmpty():
            break
        jumps.append(open_nodes.select("node", "up"))
        upper = level.select(F.col("node").alias("up"), F.col("up").alias("up2"), F.col("score").alias("more"),
                             F.col("above").alias("more_above"))
        level = materialise(
            open_nodes.join(upper, "up").select("conv_id", "node", F.col("up2").alias("up"),
                                                (F.col("score") + F.col("more")).alias("score"),
                                                (F.col("above") + F.col("more_above")).alias("above"))
            .unionByName(level.where("up IS NULL")), "chat-jump")
    else:
        raise ValueError("the replies of a conversation form a cycle")
    scored = leaves.join(level.select("node", "score", "above"), "node")
    best = Window.partitionBy("conv_id").orderBy(F.desc("score"), "node")
    chosen = (scored.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= branches)
              .select(F.col("node").alias("path"), "rank", "node", F.lit(0).cast("long").alias("depth"), F.col("above").alias("last")))
    for k in range(len(jumps) - 1, -1, -1):
        chosen = materialise(chosen, "chat-paths")
        up = chosen.join(jumps[k], "node").select("path", "rank", F.col("up").alias("node"),
                                                  (F.col("depth") + (1 << k)).alias("depth"), "last")
        chosen = chosen.unionByName(up)
    return chosen


def format_paths(nodes: DataFrame, branches: int = 1) -> DataFrame:
    """The formatted conversations: conv_id, path, rank, seq (from 0 at the root), chunk."""
    found = materialise(paths(nodes, branches), "chat-chosen")
    rows = (found.join(nodes.select("node", "conv_id", "role", "text"), "node")
            .select("conv_id", "path", "rank", (F.col("last") - F.col("depth")).alias("seq"), "role", "text"))
    schema = "conv_id long, path long, rank int, seq long, chunk string"

    def rendered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            chunk = [render(r, t) for r, t in zip(b.column("role").to_pylist(), b.column("text").to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [b.column("conv_id"), b.column("path"), b.column("rank"), b.column("seq"), pa.array(chunk, pa.string())],
                names=["conv_id", "path", "rank", "seq", "chunk"])

    return rows.mapInArrow(rendered, schema)


DIGEST_SCHEMA = ("conv_id long, path long, rank int, n_turns long, turns_sha256 string, loss_chars long, "
                 "loss_sha256 string, formatted_chars long")


class _Reader:
    """Parses the chunks of one path; keeps digests and the unfinished turn only."""

    def __init__(self, key):
        self.key, self.rest, self.turns, self.loss_chars, self.chars = key, "", 0, 0, 0
        self.all, self.loss = hashlib.sha256(), hashlib.sha256()

    def feed(self, chunk: str) -> None:
        self.chars += len(chunk)
        self.rest += chunk
        at = 0
        while m := _TURN.match(self.rest, at):
            role, text = unescape_role(m[1]), unescape(m[2])
            self.turns += 1
            self.all.update(f"{role}\n{text}\n".encode())
            if role == "assistant":
                self.loss_chars += len(text)
                self.loss.update(text.encode())
            at = m.end()
        self.rest = self.rest[at:]

    def row(self) -> tuple:
        if self.rest:
            raise ValueError(f"conversation {self.key[0]}: text after the last turn")
        return (*self.key, self.turns, self.all.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars)


def read_back(formatted: DataFrame) -> DataFrame:
    """One row per formatted conversation with the digests of ``DIGEST_SCHEMA``, parsed from its text."""
    n = shuffle_partitions(formatted.sparkSession)
    ordered = formatted.repartition(n, "path").sortWithinPartitions("path", "seq")
    names = [x.split()[0] for x in DIGEST_SCHEMA.split(", ")]
    types = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]

    def parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, done = None, []
        for b in batches:
            for conv, path, rank, chunk in zip(*(b.column(c).to_pylist() for c in ("conv_id", "path", "rank", "chunk"))):
                if reader is None or reader.key[1] != path:
                    if reader:
                        done.append(reader.row())
                    reader = _Reader((conv, path, rank))
                reader.feed(chunk)
            if len(done) >= 5000:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), types)], names=names)
                done = []
        if reader:
            done.append(reader.row())
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), types)], names=names)

    return ordered.mapInArrow(parsed, DIGEST_SCHEMA)
