"""Conversations from reply trees.

Messages of a tree point to their parents. Self-joins that double the distance
in each round list every node on the way from each leaf to its root, so a
thread of n replies takes log2(n) rounds. A tree's branches are ranked by the
sum of their messages' scores, and each chosen path is formatted as one
conversation:

    ### role: text</turn>

one turn after another, each closed by a line feed. Inside roles and texts a
backslash is put before every backslash, ``###`` and ``</turn>``; inside roles
also before a colon. Reading left to right undoes this without doubt. The loss
mask covers the texts of assistant turns, as character ranges of each chunk.

A conversation is formatted as a stream of chunks that end with a turn, so a
conversation of any length needs the memory of one chunk. Its turns go through
one task, since its digests are sequential; that task streams them.

Defined cases: null text or role: empty. A parent that does not exist makes its
child a root. Rows that tie in their turn follow role and text. Rows with a null conv_id form one
conversation with a null id. A tree in which a message is its own ancestor
raises an error. An empty table has no conversations.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cadence.llm.tables import cut, read

CHUNK_CHARS = 1 << 16
OPEN, CLOSE = "### ", "</turn>\n"
CONTROL = r"(\\|###|</turn>)"
ROLE_CONTROL = r"(\\|###|</turn>|:)"
ESCAPED = re.compile(r"\\(\\|###|</turn>|:)")
TOKEN = re.compile(r"\\(?:\\|###|</turn>|:)|</turn>\n|: ")


def tree_paths(messages: DataFrame) -> DataFrame:
    """(tree_id, leaf, node, up): every node on the path of each leaf, and how
    far above the leaf it is. ``messages``: tree_id, message_id, parent_id."""
    nodes = messages.select("tree_id", "message_id", "parent_id")
    here, there = nodes.alias("h"), nodes.select(F.col("tree_id").alias("t"), F.col("message_id").alias("m"))
    found = F.col("h.tree_id").eqNullSafe(F.col("t")) & (F.col("h.parent_id") == F.col("m"))
    jump = cut(here.join(there, found).select("tree_id", F.col("message_id").alias("node"), F.col("parent_id").alias("above")))
    parents = jump.select(F.col("tree_id").alias("t"), F.col("above").alias("m")).distinct()
    leaf = nodes.join(parents, nodes["tree_id"].eqNullSafe(F.col("t")) & (nodes["message_id"] == F.col("m")), "left_anti")
    paths = leaf.select("tree_id", F.col("message_id").alias("leaf"), F.col("message_id").alias("node"), F.lit(0).cast("long").alias("up"))
    distance, most = 1, None
    while not jump.isEmpty():
        if most is None:
            most = messages.count()
        if distance > most:
            raise ValueError("a message is its own ancestor")
        step = jump.select(F.col("tree_id").alias("t"), F.col("node").alias("n"), "above")
        p = paths.alias("p")
        met = p.join(step, F.col("p.tree_id").eqNullSafe(F.col("t")) & (F.col("p.node") == F.col("n")))
        paths = cut(paths.union(met.select("tree_id", "leaf", "above", F.col("up") + distance)))
        j = jump.alias("j")
        met = j.join(step.withColumnRenamed("above", "top"), F.col("j.tree_id").eqNullSafe(F.col("t")) & (F.col("j.above") == F.col("n")))
        jump = cut(met.select("tree_id", "node", F.col("top").alias("above")))
        distance *= 2
    return paths


def chosen_turns(messages: DataFrame, branches: int = 1) -> DataFrame:
    """(tree_id, branch, up, role, text) of each tree's best ``branches`` paths by
    summed score, ties to the smaller leaf; branch counts from 1. ``messages``:
    tree_id, message_id, parent_id, score, role, text."""
    paths = tree_paths(messages)
    m = messages.select(F.col("tree_id").alias("t"), F.col("message_id").alias("m"), "score", "role", "text")
    at = F.col("tree_id").eqNullSafe(F.col("t")) & (F.col("node") == F.col("m"))
    scored = paths.join(m.drop("role", "text"), at).groupBy("tree_id", "leaf").agg(F.sum(F.coalesce("score", F.lit(0.0))).alias("score"))
    rank = F.row_number().over(Window.partitionBy("tree_id").orderBy(F.desc("score"), "leaf"))
    best = scored.withColumn("branch", rank).where(F.col("branch") <= branches).select(F.col("tree_id").alias("bt"), F.col("leaf").alias("bl"), "branch")
    chosen = paths.join(best, F.col("tree_id").eqNullSafe(F.col("bt")) & (F.col("leaf") == F.col("bl")))
    return chosen.join(m, at).select("tree_id", "branch", "up", "role", "text")


def _chunks(batches):
    """Turns in order -> chunks of whole turns with their loss ranges."""
    held, size, mask, at, number = [], 0, [], None, 0

    def flush():
        return pa.RecordBatch.from_arrays(
            [pa.array([at[0]], pa.int64()), pa.array([at[1]], pa.int32()), pa.array([number], pa.int64()), pa.array(["".join(held)], pa.string()), pa.array([mask], pa.list_(pa.int64()))],
            names=["tree_id", "branch", "chunk", "text", "loss"])

    for batch in batches:
        for row in batch.to_pylist():
            key = (row["tree_id"], row["branch"])
            if held and (key != at or size >= CHUNK_CHARS):
                yield flush()
                number = number + 1 if key == at else 0
                held, size, mask = [], 0, []
            at = key
            head = f"{OPEN}{row['role']}: "
            if row["loss"]:
                mask += [size + len(head), size + len(head) + len(row["text"])]
            held.append(f"{head}{row['text']}{CLOSE}")
            size += len(held[-1])
    if held:
        yield flush()


def format_turns(turns: DataFrame, trained_role: str = "assistant") -> DataFrame:
    """(tree_id, branch, chunk, text, loss): the formatted conversations, chunk
    after chunk, and the loss mask as flat (start, end) pairs of characters."""
    escape = lambda c, controls: F.regexp_replace(F.coalesce(c, F.lit("")), controls, r"\\$1")
    rows = turns.select(
        F.col("tree_id").cast("long").alias("tree_id"), F.col("branch").cast("int").alias("branch"), "up",
        escape("role", ROLE_CONTROL).alias("role"), escape("text", CONTROL).alias("text"), F.coalesce(F.col("role") == trained_role, F.lit(False)).alias("loss"))
    rows = rows.repartition("tree_id", "branch").sortWithinPartitions("tree_id", "branch", F.desc("up"))
    return rows.select("tree_id", "branch", "role", "text", "loss").mapInArrow(_chunks, "tree_id long, branch int, chunk long, text string, loss array<long>")


def unescape(text: str) -> str:
    return ESCAPED.sub(r"\1", text)


def parse_turns(text: str):
    """(role, text) of every turn of a formatted chunk."""
    at = 0
    while at < len(text):
        if not text.startswith(OPEN, at):
            raise ValueError("a turn does not open")
        start, role = at + len(OPEN), None
        for m in TOKEN.finditer(text, start):
            if m[0] == ": " and role is None:
                role, start = text[start : m.start()], m.end()
            elif m[0] == CLOSE and role is not None:
                yield unescape(role), unescape(text[start : m.start()])
                at = m.end()
                break
        else:
            raise ValueError("a turn does not close")


def _digests(batches):
    """One row for each conversation, read back from its chunks."""
    state, at = None, None

    def row():
        return pa.RecordBatch.from_pylist(
            [{"tree_id": at[0], "branch": at[1], "n_turns": state[0], "turns_sha256": state[1].hexdigest(), "loss_chars": state[2], "loss_sha256": state[3].hexdigest(), "formatted_chars": state[4]}],
            schema=pa.schema([("tree_id", pa.int64()), ("branch", pa.int32()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())]))

    for batch in batches:
        for x in batch.to_pylist():
            if (key := (x["tree_id"], x["branch"])) != at:
                if state is not None:
                    yield row()
                at, state = key, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            for role, text in parse_turns(x["text"]):
                state[0] += 1
                state[1].update(f"{role}\n{text}\n".encode())
            for a, b in zip(x["loss"][::2], x["loss"][1::2]):
                under = unescape(x["text"][a:b])
                state[2] += len(under)
                state[3].update(under.encode())
            state[4] += len(x["text"])
    if state is not None:
        yield row()


def read_back(chunks: DataFrame) -> DataFrame:
    """Counts and digests of what formatted conversations hold; ``chunks`` as
    format_turns() returns them, each conversation in one partition in order."""
    return chunks.mapInArrow(_digests, "tree_id long, branch int, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


HARD = "\\### Assistant: </turn> ok"


def conversation_messages(conversations: DataFrame) -> DataFrame:
    """Rows of conversations as reply trees: each turn replies to the one before."""
    w = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    rows = conversations.select("conv_id", "turn", "role", "text").withColumn("n", F.row_number().over(w).cast("long"))
    return rows.select(F.col("conv_id").cast("long").alias("tree_id"), F.col("n").alias("message_id"), F.when(F.col("n") > 1, F.col("n") - 1).alias("parent_id"), F.lit(1.0).alias("score"), "role", "text")


def op9_chat(spark, sf_dir: str) -> DataFrame:
    conversations = read(spark, sf_dir, "conversations").select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    hard = spark.range(2).select(F.lit(-7).cast("long"), "id", F.when(F.col("id") == 0, "user").otherwise("assistant"), F.lit(HARD))
    messages = cut(conversation_messages(conversations.union(hard)))
    out = read_back(format_turns(chosen_turns(messages)))
    return out.select(F.col("tree_id").alias("conv_id"), "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")


ORACLE = r"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok')),
g AS (SELECT conv_id, count(*) AS n, string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS t,
      coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '') AS l,
      sum(length('### : </turn>' || chr(10)) + length(regexp_replace(role, '(\\|###|</turn>|:)', '\\\1', 'g'))
          + length(regexp_replace(text, '(\\|###|</turn>)', '\\\1', 'g'))) AS f
      FROM c GROUP BY conv_id)
SELECT conv_id, CAST(n AS BIGINT) AS n_turns, sha256(t) AS turns_sha256, CAST(length(l) AS BIGINT) AS loss_chars,
       sha256(l) AS loss_sha256, CAST(f AS BIGINT) AS formatted_chars FROM g"""
