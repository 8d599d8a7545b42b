"""Reply trees: root-to-leaf paths by iterative self-joins, ranked by score,
each chosen path formatted as one conversation.

Messages point at their parent. Joining the table with itself doubles the reach
of every pointer, so a path of n messages takes log2(n) joins and no path is
gathered in one row. Path scores are summed on the way; per tree the best
leaves are chosen; their paths are spelled out from the stored jumps, one row
per message. Formatting streams over rows sorted by path and place, a message
at a time.
"""

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tierlake.llm.common import bounded_batches, in_order, stored

# Template: header, escaped text, end mark, newline; one turn after another.
HEAD, SEP, END = "### ", ": ", "</turn>\n"
CHUNK_CHARS = 1 << 20  # a conversation beyond this goes on in another row
BLOCK_TURNS = 4096     # and so it does behind so many turns: a long conversation is formatted by many tasks

_ESCAPE = re.compile(r"\\|(?<=#)#|(?<=<)/(?=turn>)")
_UNESCAPE = re.compile(r"\\(.)", re.S)


def escape(text: str) -> str:
    """No '##' and no '</turn>' is left; backslashes are doubled; see ``unescape``."""
    return _ESCAPE.sub(lambda m: "\\" + m[0], text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(lambda m: m[1], text)


def _role_out(role: str) -> str:
    return escape(role).replace(":", "\\:")


def paths(messages: DataFrame, top: int = 1, max_rounds: int = 40) -> DataFrame:
    """Messages (tree, id, parent, score) -> (tree, leaf, rank, place, id).

    ``top`` best leaves per tree by the sum of scores along their path, ties by
    the smaller leaf id; place counts from the root. Ids are unique; a parent
    that is null or unknown makes a root. A null score counts 0. Messages on a
    cycle reach no root and give no path (rounds end after 2**max_rounds).
    """
    known = messages.select("tree", F.col("id").alias("p"))
    base = messages.select("tree", "id", F.col("parent").alias("p"),
                           F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score"))
    base = base.join(known.withColumn("up", F.col("p")), ["tree", "p"], "left").select("tree", "id", "up", "score")
    state = stored(base.select("tree", "id", "up", "score", F.lit(1).cast("long").alias("length")), "tree-jumps")
    # only messages that have not reached their root go on; the others wait as they are
    settled, going, jumps = state.where("up is null"), state.where("up is not null"), []
    while not going.isEmpty():
        if len(jumps) >= max_rounds:
            break  # only a cycle is that long: its messages have no root
        jumps.append(going.select("tree", "id", "up"))
        above = settled.union(going).select("tree", F.col("id").alias("up"), F.col("up").alias("up2"),
                                            F.col("score").alias("s2"), F.col("length").alias("l2"))
        moved = stored(going.join(above, ["tree", "up"]).select(
            "tree", "id", F.col("up2").alias("up"), (F.col("score") + F.col("s2")).alias("score"),
            (F.col("length") + F.col("l2")).alias("length")), "tree-jumps")
        settled, going = settled.union(moved.where("up is null")), moved.where("up is not null")
    parents = base.where("up is not null").select("tree", F.col("up").alias("id")).distinct()
    leaves = settled.join(parents, ["tree", "id"], "left_anti")
    # the best leaf of a tree is a grouped maximum (combined map-side); more need a window over leaves
    if top == 1:
        best = leaves.groupBy("tree").agg(F.min(F.struct((-F.col("score")).alias("s"), "id", "length")).alias("b")).select(
            "tree", F.col("b.id").alias("leaf"), F.lit(1).alias("rank"), F.col("b.length").alias("length"))
    else:
        best = leaves.withColumn("rank", F.row_number().over(
            Window.partitionBy("tree").orderBy(F.desc("score"), "id"))).where(F.col("rank") <= top).select(
            "tree", F.col("id").alias("leaf"), "rank", "length")
    # every distance from the leaf is one sum of powers of two: take each jump or not
    out = best.select("tree", "leaf", "rank", F.col("leaf").alias("id"), (F.col("length") - 1).alias("place"))
    for k in range(len(jumps) - 1, -1, -1):
        up = jumps[k]
        moved = out.join(up, ["tree", "id"]).select(
            "tree", "leaf", "rank", F.col("up").alias("id"), (F.col("place") - (1 << k)).alias("place"))
        # ``out`` stands twice in its union: unstored, the plan would double with every level
        out = stored(out.union(moved), "tree-paths")
    return out


def format_paths(turns: DataFrame) -> DataFrame:
    """(conv, place, role, text) -> formatted conversations.

    Rows: conv, chunk, formatted, spans (start, end of the assistant texts in
    ``formatted``, escaped). One row per conversation up to ``CHUNK_CHARS``
    characters and ``BLOCK_TURNS`` turns, more rows of it beyond, cut between
    turns; chunk is the place of a row's first turn. Null role and text count as
    empty.
    """
    bounded_batches(turns.sparkSession)

    def run(batches):
        at, chunk, text, size, spans = None, 0, [], 0, []
        out = []

        def flush():
            nonlocal text, size, spans
            if text:
                out.append((at[0], chunk, "".join(text), spans))
            text, size, spans = [], 0, []

        def drain():
            rows, out[:] = list(out), []
            c = list(zip(*rows)) if rows else [[]] * 4
            return pa.RecordBatch.from_arrays(
                [pa.array(c[0], pa.int64()), pa.array(c[1], pa.int64()), pa.array(c[2], pa.string()),
                 pa.array([[{"s": a, "e": b} for a, b in x] for x in c[3]],
                          pa.list_(pa.struct([("s", pa.int64()), ("e", pa.int64())])))],
                ["conv", "chunk", "formatted", "spans"])

        for batch in batches:
            for row in batch.to_pylist():
                if (row["conv"], row["block"]) != at or size >= CHUNK_CHARS:
                    flush()
                    at, chunk = (row["conv"], row["block"]), row["place"]
                head = HEAD + _role_out(row["role"] or "") + SEP
                body = escape(row["text"] or "")
                if row["role"] == "assistant":
                    spans.append((size + len(head), size + len(head) + len(body)))
                text.append(head + body + END)
                size += len(text[-1])
            if out:
                yield drain()
        flush()
        if out:
            yield drain()

    return (turns.select(F.col("conv").cast("long").alias("conv"), "place", "role", "text",
                         F.floor(F.col("place") / BLOCK_TURNS).alias("block"))
            .repartition("conv", "block").sortWithinPartitions("conv", "place")
            .mapInArrow(run, "conv long, chunk long, formatted string, spans array<struct<s:long,e:long>>"))


_TURN = re.compile(r"### ((?:[^\\:]|\\.)*): (.*?)</turn>\n", re.S)


def parse(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of every turn of a formatted conversation."""
    return [(unescape(m[1]), unescape(m[2])) for m in _TURN.finditer(formatted)]


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of formatted conversations, from the output alone."""
    bounded_batches(formatted.sparkSession)

    def run(batches):
        conv, state, out = None, None, []

        def close():
            if state is not None:
                n, turns, loss_n, loss, chars = state
                out.append((conv, n, turns.hexdigest(), loss_n, loss.hexdigest(), chars))

        def drain():
            c = list(zip(*out)) if out else [[]] * 6
            out.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(x, k) for x, k in zip(c, (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()))],
                ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

        for batch in batches:
            for row in batch.to_pylist():
                if state is None or row["conv"] != conv:
                    close()
                    conv, state = row["conv"], [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, text in parse(row["formatted"]):
                    state[0] += 1
                    state[1].update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
                for s in row["spans"]:
                    text = unescape(row["formatted"][s["s"]:s["e"]])
                    state[2] += len(text)
                    state[3].update(text.encode("utf-8", "surrogatepass"))
                state[4] += len(row["formatted"])
            if out:
                yield drain()
        close()
        if out:
            yield drain()

    return (formatted.repartition("conv").sortWithinPartitions("conv", "chunk")
            .mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
                             "formatted_chars long"))


def conversations_as_trees(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                           text: str = "text") -> DataFrame:
    """Rows by turn as reply trees: each turn answers the turn before it.

    Turns follow the order (turn, role, text), nulls first, so gaps, ties and
    repeated rows keep all rows in one chain. Rows without a conversation id
    belong to none and are left out. A conversation of any length is spread over
    the ranges of the sort; see ``in_order``.
    """
    named = rows.where(F.col(conv).isNotNull()).select(
        F.col(conv).alias("tree"), F.col(turn).alias("t"), F.col(role).alias("role"), F.col(text).alias("text"))
    return in_order(named, "tree", ["t", "role", "text"]).select(
        "tree", "t", "role", "text", F.col("row").alias("id"), F.col("before").alias("parent"), F.lit(0.0).alias("score"))


def format_best_paths(messages: DataFrame) -> DataFrame:
    """The best path of every tree of (tree, id, parent, score, role, text), formatted."""
    messages = stored(messages.select("tree", "id", "parent", "score", "role", "text"), "tree-messages")
    chosen = paths(messages.select("tree", "id", "parent", "score"))
    turns = chosen.join(messages.select("tree", "id", "role", "text"), ["tree", "id"])
    return stored(format_paths(turns.select(F.col("tree").alias("conv"), "place", "role", "text")), "tree-formatted")
