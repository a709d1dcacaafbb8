"""Chat formatting over a prefix tree.

Template.  A turn is its role's opening mark, its text, its closing mark; a role without
marks of its own is written between marks, too.  In texts and roles a backslash is
doubled and each control string gets one after its first character, so that no control
string is left in them and the text can be read back.

Tree.  Conversations that begin with the same turns share these as nodes: a node
is the digest of its parent's digest, its role and its text.  Sorted by their lists
of digests, conversations come in depth-first order, and so do the nodes by (the first
conversation that holds them, depth).  Running totals of token numbers in this order, taken
within range partitions and shifted by the totals of those before, give each node its place
in one long sequence in which each shared turn is written once.  A node's tokens have the
position ids that they have in its conversations, and attend to their own node up to
themselves and to the intervals of its ancestors (intervals that touch are one).

Nothing is collected by tree, root or node: conversations are streamed through
tasks that hold one turn, or one formatted conversation, at a time.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common

#: Opening and closing marks of the roles that have their own.
MARKS = {"system": ("[SYS]", "[/SYS]"), "user": ("[INST]", "[/INST]"), "assistant": ("[OUT]", "</s>")}
OTHER = ("[ROLE]", "[/ROLE]", "[/TURN]")
CONTROL = ("<s>", *(m for pair in MARKS.values() for m in pair), *OTHER)
#: The role whose texts are learned from.
LEARNED = "assistant"

_CONTROL = re.compile("|".join(re.escape(c) for c in CONTROL))
_ESCAPED = re.compile(r"\\(.)", re.S)
DIGEST = 16


def escape(text: str) -> str:
    return _CONTROL.sub(lambda m: m.group()[0] + "\\" + m.group()[1:], text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def segment(role: str, text: str) -> tuple[str, int, int]:
    """A formatted turn, and where in it the (escaped) text begins and ends."""
    if role in MARKS:
        head, tail = MARKS[role]
    else:
        head, tail = OTHER[0] + escape(role) + OTHER[1], OTHER[2]
    body = escape(text)
    return head + body + tail, len(head), len(head) + len(body)


def parse(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of each turn of a formatted conversation."""
    of_mark = {head: role for role, (head, _) in MARKS.items()}
    marks = _CONTROL.findall(formatted)
    texts = _CONTROL.split(formatted)
    out, k = [], 0  # texts[k + 1] follows marks[k]
    while k < len(marks):
        if marks[k] == OTHER[0]:
            out.append((unescape(texts[k + 1]), unescape(texts[k + 2])))
            k += 3
        else:
            out.append((of_mark[marks[k]], unescape(texts[k + 1])))
            k += 2
    return out


@dataclass
class Tree:
    """``nodes``: node (number in depth-first order), parent (null: none), depth, role,
    segment, ids, start (place of its first token), n_tokens, position (id of its
    first token's position), ancestors (intervals [start, end) that its tokens attend to).

    ``conversations``: conv_id, n_turns, n_tokens, path (intervals of its tokens),
    formatted (its segments, joined), loss ([start, end) in code points of ``formatted``)."""

    nodes: DataFrame
    conversations: DataFrame


INTERVALS = "array<struct<start:long,end:long>>"
_INTERVAL = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def _chain(turns: DataFrame) -> DataFrame:
    """cid, lone, depth, node, parent, role, text of each turn; and for each
    conversation a row of depth -1 with its key, the digests of its turns in a row."""
    ordered = turns.repartition("cid", "lone").sortWithinPartitions("cid", "lone", "turn", "role", "text")
    schema = pa.schema([("cid", pa.int64()), ("lone", pa.int64()), ("depth", pa.int32()), ("node", pa.binary()),
                        ("parent", pa.binary()), ("role", pa.string()), ("text", pa.string()), ("key", pa.binary())])

    def run(batches):
        here, key, depth = None, [], 0
        for b in common.row_slices(batches):
            rows = []
            for c, l, role, text in zip(*(b.column(x).to_pylist() for x in ("cid", "lone", "role", "text"))):
                if (c, l) != here:
                    if here:
                        rows.append((*here, -1, None, None, None, None, b"".join(key)))
                    here, key, depth = (c, l), [], 0
                parent = key[-1] if key else None
                r, t = role.encode(), text.encode()
                node = hashlib.blake2b((parent or b"") + len(r).to_bytes(8, "big") + r + t, digest_size=DIGEST).digest()
                rows.append((c, l, depth, node, parent, role, text, None))
                key.append(node)
                depth += 1
            yield common.table_batch(schema, **{f.name: [r[k] for r in rows] for k, f in enumerate(schema)})
        if here:
            last = (*here, -1, None, None, None, None, b"".join(key))
            yield common.table_batch(schema, **{f.name: [last[k]] for k, f in enumerate(schema)})

    return ordered.mapInArrow(run, "cid long, lone long, depth int, node binary, parent binary, role string, "
                                   "text string, key binary")


def running(df: DataFrame, order: list[str], value: str, name: str) -> DataFrame:
    """Adds number (from 0) and start (sum of ``value`` of the rows before) in the
    order of ``order``, whose values are distinct.  Each range partition counts for
    itself; the totals of those before, one row a partition, are added after."""
    schema = T.StructType([*df.schema, *(T.StructField(c, T.LongType()) for c in ("_part", "_number", "_start"))])

    def run(batches):
        part, n, total = TaskContext.get().partitionId(), 0, 0
        for b in batches:
            number, start = [], []
            for v in b.column(value).to_pylist():
                number.append(n)
                start.append(total)
                n, total = n + 1, total + v
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array([part] * len(number), pa.int64()), pa.array(number, pa.int64()),
                 pa.array(start, pa.int64())], names=schema.names)

    done = common.cut(df.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(run, schema), name)
    before, n, total = [], 0, 0
    for r in done.groupBy("_part").agg(F.count("*").alias("n"), F.sum(value).alias("s")).orderBy("_part").collect():
        before.append((r["_part"], n, total))
        n, total = n + r.n, total + r.s
    shift = df.sparkSession.createDataFrame(before, "_part long, _n long, _s long")
    return (done.join(F.broadcast(shift), "_part").withColumn("number", F.col("_number") + F.col("_n"))
            .withColumn("start", F.col("_start") + F.col("_s")).select(*df.columns, "number", "start"))


def _encoded(nodes: DataFrame, tokenizer: str) -> DataFrame:
    """Adds segment, ids and n_tokens; each segment is encoded for itself."""
    schema = T.StructType([*nodes.schema, T.StructField("segment", T.StringType()),
                           T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("n_tokens", T.LongType())])

    def run(batches):
        from tokenizers import Tokenizer

        model = Tokenizer.from_file(tokenizer)
        for b in common.row_slices(batches):
            texts = [segment(r, t)[0] for r, t in zip(b.column("role").to_pylist(), b.column("text").to_pylist())]
            ids = [e.ids for e in model.encode_batch(texts, add_special_tokens=False)]
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(texts, pa.string()), pa.array(ids, pa.list_(pa.int32())),
                 pa.array([len(i) for i in ids], pa.int64())], names=schema.names)

    return nodes.mapInArrow(run, schema)


def _walk(steps: DataFrame) -> DataFrame:
    """Conversations and, where a conversation is the first that holds a node, the
    node's position and ancestors: one row each, told apart by ``number`` (null: conversation)."""
    ordered = steps.repartition("cid", "lone").sortWithinPartitions("cid", "lone", "depth")
    schema = pa.schema([("number", pa.int64()), ("parent", pa.int64()), ("position", pa.int64()),
                        ("path", _INTERVAL), ("cid", pa.int64()), ("lone", pa.int64()), ("n_turns", pa.int64()),
                        ("n_tokens", pa.int64()), ("formatted", pa.string()), ("loss", _INTERVAL)])

    def run(batches):
        here, turns, path, loss = None, [], [], []
        parent, n_tokens, chars = None, 0, 0

        def whole():
            return (None, None, None, path, *here, len(turns), n_tokens, "".join(turns), loss)

        names = ("cid", "lone", "rank", "first", "number", "start", "n_tokens", "role", "text")
        for b in common.row_slices(batches):
            rows = []
            for c, l, rank, first, number, start, n, role, text in zip(*(b.column(x).to_pylist() for x in names)):
                if (c, l) != here:
                    if here:
                        rows.append(whole())
                    here, turns, path, loss = (c, l), [], [], []
                    parent, n_tokens, chars = None, 0, 0
                if rank == first:
                    rows.append((number, parent, n_tokens, list(path), None, None, None, None, None, None))
                part, a, z = segment(role, text)
                if role == LEARNED:
                    loss.append({"start": chars + a, "end": chars + z})
                if path and path[-1]["end"] == start:
                    path[-1] = {"start": path[-1]["start"], "end": start + n}
                elif n:
                    path.append({"start": start, "end": start + n})
                turns.append(part)
                parent, n_tokens, chars = number, n_tokens + n, chars + len(part)
            yield common.table_batch(schema, **{f.name: [r[k] for r in rows] for k, f in enumerate(schema)})
        if here:
            last = whole()
            yield common.table_batch(schema, **{f.name: [last[k]] for k, f in enumerate(schema)})

    return ordered.mapInArrow(run, f"number long, parent long, position long, path {INTERVALS}, cid long, lone long, "
                                   f"n_turns long, n_tokens long, formatted string, loss {INTERVALS}")


def chat_tree(df: DataFrame, tokenizer: str, conv_col: str = "conv_id", turn_col: str = "turn",
              role_col: str = "role", text_col: str = "text") -> Tree:
    """The prefix tree of all conversations; ``tokenizer``: file of the tokenizers library.

    Turns are ordered by turn (null first), then role, then text; rows that repeat all
    three stay as turns of their own.  Null roles and texts are empty.  Each row without a
    conversation id is a conversation of its own, with a null id.  Further columns are not
    read.  An empty table gives two empty results.
    """
    common.ship(df.sparkSession)
    conv = F.col(conv_col).cast("long")
    turns = df.select(F.coalesce(conv, F.lit(0)).alias("cid"),
                      F.when(conv.isNull(), F.monotonically_increasing_id()).otherwise(F.lit(-1)).alias("lone"),
                      F.col(turn_col).cast("long").alias("turn"),
                      F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"),
                      F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    chain = common.cut(_chain(turns), "turns")
    nodes = (chain.where("depth >= 0").select("node", "depth", "role", "text").dropDuplicates(["node"]))
    nodes = common.cut(_encoded(nodes, tokenizer), "tokens")

    keys = chain.where("depth = -1").select("cid", "lone", "key", F.lit(1).cast("long").alias("one"))
    ranked = running(keys, ["key", "cid", "lone"], "one", "conversations").withColumnRenamed("number", "rank")
    step = F.transform(F.sequence(F.lit(0), (F.length("key") / DIGEST).cast("int") - 1),
                       lambda i: F.substring(F.col("key"), i * DIGEST + 1, F.lit(DIGEST)))
    paths = ranked.select("cid", "lone", "rank", F.posexplode(step).alias("depth", "node"))
    first = paths.groupBy("node").agg(F.min("rank").alias("first"))
    placed = running(nodes.join(first, "node"), ["first", "depth"], "n_tokens", "nodes")

    steps = paths.join(placed.select("node", "first", "number", "start", "n_tokens", "role", "text"), "node")
    walked = common.cut(_walk(steps), "walk")
    of_node = walked.where("number is not null").select("number", "parent", "position", F.col("path").alias("ancestors"))
    return Tree(
        placed.join(of_node, "number").select(F.col("number").alias("node"), "parent", "depth", "role", "segment", "ids",
                                              "start", "n_tokens", "position", "ancestors"),
        walked.where("number is null").select(F.when(F.col("lone") == -1, F.col("cid")).alias("conv_id"), "n_turns",
                                              "n_tokens", "path", "formatted", "loss"))


def read_back(conversations: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256 and formatted_chars, all read
    from ``formatted`` and ``loss``."""
    schema = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
                        ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])

    def run(batches):
        for b in common.row_slices(batches, "formatted"):
            out = {f.name: [] for f in schema}
            for formatted, loss in zip(b.column("formatted").to_pylist(), b.column("loss").to_pylist()):
                turns = parse(formatted)
                learned = "".join(unescape(formatted[s["start"]:s["end"]]) for s in loss)
                out["n_turns"].append(len(turns))
                out["turns_sha256"].append(hashlib.sha256(
                    "".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest())
                out["loss_chars"].append(len(learned))
                out["loss_sha256"].append(hashlib.sha256(learned.encode()).hexdigest())
                out["formatted_chars"].append(len(formatted))
            out["conv_id"] = b.column("conv_id")
            yield common.table_batch(schema, **out)

    return conversations.select("conv_id", "formatted", "loss").mapInArrow(
        run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
             "formatted_chars long")
