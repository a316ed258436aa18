"""Reply trees to conversations: root-to-leaf paths, the best ones formatted with a loss mask."""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import small_batches, written

START, END = "<|im_start|>", "<|im_end|>"
LEARNED_ROLE = "assistant"

_OPENING = re.compile(r"<(\\*)\|")
_ESCAPED = re.compile(r"<\\(\\*)\|")
_TURN = re.compile(re.escape(START) + r"([^\n]*)\n(.*?)" + re.escape(END) + "\n", re.DOTALL)


def escape(text: str) -> str:
    """No control string is left: each "<|", with backslashes between or not, gets one more."""
    return _OPENING.sub(r"<\1\\|", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


def _escape_role(role: str) -> str:
    return escape(role).replace("\\", "\\\\").replace("\n", "\\n")


def _unescape_role(role: str) -> str:
    return unescape(re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], role))


def parse(formatted: str) -> list[tuple[str, str]]:
    """The turns of a formatted conversation, as they were."""
    return [(_unescape_role(role), unescape(text)) for role, text in _TURN.findall(formatted)]


def thread(rows: DataFrame, conversation: str = "conv_id", turn: str = "turn") -> DataFrame:
    """Rows of linear conversations as messages: (conv, node, parent, role, text, score).

    Rows are numbered along (conversation, turn, role, text) over range partitions, so a
    conversation with very many rows is spread over tasks. Each answers the row before it;
    repeated rows answer one another. Null conversation ids form one conversation.
    """
    order = ["conv", "turn", "role", "text"]
    picked = rows.select(F.col(conversation).cast("long").alias("conv"), F.col(turn).cast("long").alias("turn"),
                         F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    numbered = written(picked.repartitionByRange(n, *order).sortWithinPartitions(*order)
                       .withColumn("node", F.monotonically_increasing_id())
                       .withColumn("part", F.shiftright("node", 33)), "turns")
    # Both keys below are unique: a first row per conversation, a last row per partition.
    first = numbered.groupBy("conv").agg(F.min("node").alias("node")).select("node", F.lit(True).alias("opens"))
    last = numbered.groupBy("part").agg(F.max("node").alias("last"))
    last = last.select("part", F.lag("last").over(Window.orderBy("part")).alias("before"))
    parent = F.when(F.col("opens"), None).when(
        F.col("node") != F.shiftleft("part", 33), F.col("node") - 1).otherwise(F.col("before"))
    return numbered.join(first, "node", "left").join(last, "part", "left").select(
        "conv", "node", parent.alias("parent"), "role", "text", F.lit(0.0).alias("score"))


def ancestors(messages: DataFrame) -> list[DataFrame]:
    """Iterative self-joins: round k has, per node, the node 2^k above it (``at``, null beyond
    the root), the steps and scores up to there. The last round has the whole way to the root.

    A parent that is no node counts as none. Nodes on a cycle have no root and are left out of
    the last round. Only ids and scores take part; finished rows do not go through the join.
    """
    nodes = messages.select("node", "parent", F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score"))
    known = nodes.select(F.col("node").alias("parent"), F.lit(True).alias("known"))
    asked, none = nodes.where("parent is not null"), nodes.where("parent is null")
    linked = asked.join(known, "parent", "left").select(
        "node", F.when(F.col("known"), F.col("parent")).alias("at"), "score").unionAll(
        none.select("node", F.col("parent").alias("at"), "score"))
    rounds = [written(linked.select("node", "at", F.lit(1).cast("long").alias("steps"),
                                    F.col("score").alias("total"), F.col("node").alias("top")), "paths")]
    total = rounds[0].count()
    while (2 ** (len(rounds) - 1) <= 2 * total) and rounds[-1].where("at is not null").limit(1).count():
        now = rounds[-1]
        above = now.select(F.col("node").alias("at"), F.col("at").alias("next"), F.col("steps").alias("more"),
                           F.col("total").alias("add"), F.col("top").alias("top_above"))
        moved = now.where("at is not null").drop("top").join(above, "at").select(
            "node", F.col("next").alias("at"), (F.col("steps") + F.col("more")).alias("steps"),
            (F.col("total") + F.col("add")).alias("total"), F.col("top_above").alias("top"))
        rounds.append(written(now.where("at is null").select("node", "at", "steps", "total", "top")
                              .unionAll(moved), "paths"))
    rounds[-1] = rounds[-1].where("at is null")
    return rounds


def best_paths(messages: DataFrame, paths_per_tree: int = 1) -> DataFrame:
    """(leaf, rank, node, place, learn) for the nodes of the chosen root-to-leaf paths.

    Branches of a tree are ranked by mean score, then by the leaf's number. ``learn`` marks a
    node in the best-ranked path that has it, so no turn is learned twice.
    """
    rounds = ancestors(messages)
    inner = messages.where("parent is not null").select(F.col("parent").alias("node")).distinct()
    leaves = rounds[-1].join(inner, "node", "left_anti")
    best = Window.partitionBy("top").orderBy(F.desc(F.col("total") / F.col("steps")), "node")
    chosen = leaves.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= paths_per_tree)
    # A stretch of n nodes ending at ``node`` is cut in two at each power of two.
    stretch = chosen.select(F.col("node").alias("leaf"), "rank", "node", F.col("steps").alias("n"),
                            (F.col("steps") - 1).alias("place"))
    for k in reversed(range(len(rounds) - 1)):
        step = F.lit(2 ** k).cast("long")
        above = rounds[k].where("at is not null").select("node", "at")
        lower = F.struct("node", F.least("n", step).alias("n"), "place")
        upper = F.struct(F.col("at").alias("node"), (F.col("n") - step).alias("n"), (F.col("place") - step).alias("place"))
        halves = F.when(F.col("n") > step, F.array(lower, upper)).otherwise(F.array(lower))
        stretch = stretch.join(above, "node", "left").select("leaf", "rank", F.explode(halves).alias("s")) \
            .select("leaf", "rank", "s.*")
    nodes = stretch.drop("n")
    if paths_per_tree == 1:
        return nodes.withColumn("learn", F.lit(True))
    nodes = written(nodes, "path-nodes")
    first = nodes.groupBy("node").agg(F.min("rank").alias("first"))
    return nodes.join(first, "node").withColumn("learn", F.col("rank") == F.col("first")).drop("first")


FORMATTED = "conv long, leaf long, text string, loss array<struct<start:long,end:long>>"


def format_paths(messages: DataFrame, paths_per_tree: int = 1) -> DataFrame:
    """One formatted conversation per chosen path: (conv, leaf, text, loss).

    ``loss`` has the code-point spans of learned assistant texts. Control strings inside texts
    and roles are escaped reversibly; null role or text is empty. Rows of a path are sorted into
    one task and formatted as they come, one conversation at a time. An empty table gives no rows.
    """
    small_batches(messages.sparkSession)
    texts = messages.select("node", "conv", F.coalesce("role", F.lit("")).alias("role"),
                            F.coalesce("text", F.lit("")).alias("text"))
    lines = best_paths(messages, paths_per_tree).join(texts, "node").select(
        "leaf", "place", "conv", "learn", "role", "text")

    def build(batches):
        leaf, conv, parts, spans, at = None, None, [], [], 0

        def whole():
            return pa.RecordBatch.from_pylist(
                [{"conv": conv, "leaf": leaf, "text": "".join(parts), "loss": spans}], schema=_ARROW)

        for batch in batches:
            for row in batch.to_pylist():
                if row["leaf"] != leaf:
                    if parts:
                        yield whole()
                    leaf, conv, parts, spans, at = row["leaf"], row["conv"], [], [], 0
                head, body = f"{START}{_escape_role(row['role'])}\n", escape(row["text"])
                at += len(head)
                if row["role"] == LEARNED_ROLE and row["learn"]:
                    spans.append({"start": at, "end": at + len(body)})
                parts += (head, body, f"{END}\n")
                at += len(body) + len(END) + 1
        if parts:
            yield whole()

    return lines.repartition("leaf").sortWithinPartitions("leaf", "place").mapInArrow(build, FORMATTED)


_ARROW = pa.schema([("conv", pa.int64()), ("leaf", pa.int64()), ("text", pa.string()),
                    ("loss", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))])


def digests(formatted: DataFrame) -> DataFrame:
    """Lengths and hashes of formatted conversations, read back from their text and mask."""
    def read(batches):
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                text, turns, learned = row["text"], hashlib.sha256(), hashlib.sha256()
                parsed = parse(text)
                for role, said in parsed:
                    turns.update(f"{role}\n{said}\n".encode("utf-8", "surrogatepass"))
                n = 0
                for span in row["loss"]:
                    said = unescape(text[span["start"]:span["end"]])
                    n += len(said)
                    learned.update(said.encode("utf-8", "surrogatepass"))
                rows.append((row["conv"], len(parsed), turns.hexdigest(), n, learned.hexdigest(), len(text)))
            names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c) if k in (2, 4) else pa.array(c, pa.int64())
                                                  for k, c in enumerate(zip(*rows))], names=names)

    return formatted.select("conv", "text", "loss").mapInArrow(
        read, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
              "formatted_chars long")
