"""Conversation prefix trie by whole-sequence collapse.

1. Every turn becomes a 128-bit mark of (role, text); texts go no further.
2. A conversation's key is the XOR of its marks, each mixed with its place, and
   its length. Equal conversations collapse into one weighted sequence: weight,
   smallest conversation, end list. Whatever share of the table repeats one
   conversation, it is one sequence from here on.
3. Only distinct sequences are spelled out as prefixes (running XOR over blocks
   of turns, so a long conversation is spread over tasks).
4. Sequences whose key is a proper prefix of another are dropped by an anti
   join: what is left are the leaves.
5. Prefixes are aggregated by key, with the weights of their sequences (sums and
   minima, combined before the shuffle). A node's subtree is never gathered:
   sums over a subtree are sums, over the sequences through the node, of what
   lies behind it.

Two sequences count as equal when length and 128-bit key are equal.
"""

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierlake.llm.common import bounded_batches, in_order, stored

WORD = r"[^\x20\x09-\x0D]+"  # fixed value of the contract
BLOCK = 4096                 # turns of a conversation whose prefixes one task spells out
CHUNK_CHARS = 1 << 16        # of an end list, written by one task and hashed in order by the next


def _halves(hex_digest: Column) -> tuple[Column, Column]:
    """The first 128 bits of a hex digest as two longs."""
    return tuple(F.conv(F.substring(hex_digest, at, 16), 16, -10).cast("long") for at in (1, 17))


def marked_turns(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                 text: str = "text") -> DataFrame:
    """Rows of turns -> (conv, nth, a, b, words): order, mark and words of every turn.

    Turns follow (turn, role, text), a null turn first; null role or text counts as
    empty. Repeated rows are turns of their own. Rows without a conversation id
    belong to none. An empty table gives an empty result.
    """
    named = rows.where(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("conv"), F.col(turn).alias("t"), F.coalesce(role, F.lit("")).alias("role"),
        F.coalesce(text, F.lit("")).alias("text"))
    mark = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)
    a, b = _halves(mark)
    return stored(in_order(named, "conv", ["t", "role", "text"]).select(
        "conv", "nth", a.alias("a"), b.alias("b"), F.regexp_count("text", F.lit(WORD)).cast("long").alias("words")),
        "trie-marks")


def rebuilt(marks: DataFrame, group: int = 20, heads: int = 4) -> tuple[DataFrame, DataFrame]:
    """Conversations that share the opening of their group's first one.

    Conversation c gets the first h turns of conversation ``c - c % group`` (all
    it has, none if there is no such one), then its own turns after its first h;
    h = crc32(c in decimal) % heads. Returns (turns, conversations); the latter
    also name those that are left without a turn.
    """
    openings = (marks.where((F.col("conv") % group == 0) & (F.col("nth") < heads)).groupBy(F.col("conv").alias("base"))
                .agg(F.array_sort(F.collect_list(F.struct("nth", "a", "b", "words"))).alias("opening")))  # < heads each
    h = (F.crc32(F.col("conv").cast("string")) % heads).cast("int")
    convs = marks.groupBy("conv").agg(F.count(F.lit(1)).alias("n")).select(
        "conv", h.alias("h"), (F.col("conv") - F.col("conv") % group).alias("base"))
    got = F.coalesce(F.slice("opening", 1, F.greatest("h", F.lit(1))), F.array())
    plan = stored(convs.join(openings, "base", "left").select(
        "conv", "h", F.when(F.col("h") > 0, got).otherwise(F.array().cast(_OPENING)).alias("opening")), "trie-plan")
    first = plan.select("conv", F.explode("opening").alias("o")).select("conv", "o.*")
    own = marks.join(plan.select("conv", "h", F.size("opening").alias("k")), "conv").where("nth > h").select(
        "conv", (F.col("nth") - F.col("h") + F.col("k")).alias("nth"), "a", "b", "words")
    return stored(first.union(own), "trie-rebuilt"), plan.select("conv")


_OPENING = "array<struct<nth:bigint,a:bigint,b:bigint,words:bigint>>"


def prefix_trie(turns: DataFrame, conversations: DataFrame) -> DataFrame:
    """Turns (conv, nth from 1 without gaps, a, b, words) -> one row per trie node.

    ``conversations`` (conv, distinct) names all of them, those without a turn too.
    Columns: conv_id (smallest member), depth, parent_conv_id (null at the root),
    n_convs, n_children, n_leaves, saved_tokens (over the subtree, words of a
    node's last turn for every member but one), ends_sha256 (of the decimal ids of
    the members that end here, ascending, comma-joined). No conversation, no node.
    """
    place_a, place_b = _halves(F.md5(F.concat_ws(",", "nth", "a", "b")))
    mixed = turns.select("conv", "nth", "words", place_a.alias("ma"), place_b.alias("mb"))
    keys = mixed.groupBy("conv").agg(F.count(F.lit(1)).alias("n"), F.bit_xor("ma").alias("ka"),
                                     F.bit_xor("mb").alias("kb"), F.sum("words").alias("all_words"))
    zero = F.lit(0).cast("long")
    keys = stored(conversations.join(keys, "conv", "left").select(
        "conv", *[F.coalesce(c, zero).alias(c) for c in ("n", "ka", "kb", "all_words")]), "trie-keys")
    sequences = stored(keys.groupBy("n", "ka", "kb").agg(
        F.count(F.lit(1)).alias("weight"), F.min("conv").alias("seq"), F.min("all_words").alias("all_words")), "trie-sequences")

    prefixes = stored(_prefixes(mixed, sequences), "trie-prefixes")
    node = ["depth", "pa", "pb"]
    nodes = stored(prefixes.groupBy(*node).agg(
        F.sum("weight").alias("n_convs"), F.min("seq").alias("conv_id"), F.min("before").alias("before"),
        F.min("up_a").alias("up_a"), F.min("up_b").alias("up_b")), "trie-nodes")

    proper = prefixes.where("depth < n").select(*node).distinct()
    leaves = sequences.join(proper, [F.col("n") == F.col("depth"), F.col("ka") == F.col("pa"), F.col("kb") == F.col("pb")],
                            "left_anti").select("seq", F.lit(1).cast("long").alias("leaf"))
    # the nodes named by a sequence are its own deepest ones, from one depth on
    tops = nodes.groupBy(F.col("conv_id").alias("seq")).agg(F.min(F.struct("depth", "before")).alias("top"))
    facts = sequences.select("seq", "all_words").join(leaves, "seq", "left").join(tops, "seq", "left").select(
        "seq", "all_words", F.coalesce("leaf", zero).alias("leaf"), "top")
    behind = F.col("all_words") - F.col("before")  # words of the sequence from this turn on
    owned = F.when(F.col("top").isNull(), zero).otherwise(
        F.col("all_words") - F.greatest(F.col("before"), F.col("top.before")))
    subtree = prefixes.drop("all_words").join(facts, "seq").groupBy(*node).agg(
        F.sum("leaf").alias("n_leaves"), F.sum(F.col("weight") * behind - owned).alias("saved_tokens"))

    children = nodes.where("depth > 0").groupBy(
        (F.col("depth") - 1).alias("depth"), F.col("up_a").alias("pa"), F.col("up_b").alias("pb")).agg(
        F.count(F.lit(1)).alias("n_children"))
    above = nodes.select((F.col("depth") + 1).alias("depth"), F.col("pa").alias("up_a"), F.col("pb").alias("up_b"),
                         F.col("conv_id").alias("parent_conv_id"))
    ends = _end_digests(keys).select(F.col("n").alias("depth"), F.col("ka").alias("pa"), F.col("kb").alias("pb"), "ends_sha256")
    return (nodes.join(subtree, node).join(children, node, "left").join(ends, node, "left")
            .join(above, ["depth", "up_a", "up_b"], "left").select(
                "conv_id", F.col("depth").cast("long").alias("depth"), "parent_conv_id", "n_convs",
                F.coalesce("n_children", zero).alias("n_children"), "n_leaves", "saved_tokens",
                F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256")))


def _prefixes(mixed: DataFrame, sequences: DataFrame) -> DataFrame:
    """Every prefix of every sequence: (seq, weight, n, depth, pa, pb, up_a, up_b, before)."""
    own = mixed.join(sequences.select(F.col("seq").alias("conv"), "weight", "n"), "conv").withColumn(
        "block", F.floor((F.col("nth") - 1) / BLOCK))
    ahead = Window.partitionBy("conv").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carry = (own.where(F.col("n") > BLOCK).groupBy("conv", "block")
             .agg(F.bit_xor("ma").alias("ca"), F.bit_xor("mb").alias("cb"), F.sum("words").alias("cw"))
             .select("conv", "block", *[f(c).over(ahead).alias(c) for f, c in ((F.bit_xor, "ca"), (F.bit_xor, "cb"), (F.sum, "cw"))]))
    upto = Window.partitionBy("conv", "block").orderBy("nth").rowsBetween(Window.unboundedPreceding, 0)
    zero = F.lit(0).cast("long")
    run = own.select("*", F.bit_xor("ma").over(upto).alias("ra"), F.bit_xor("mb").over(upto).alias("rb"),
                     F.sum("words").over(upto).alias("rw")).join(carry, ["conv", "block"], "left")
    pa_, pb_ = (F.col(r).bitwiseXOR(F.coalesce(c, zero)) for r, c in (("ra", "ca"), ("rb", "cb")))
    spelled = run.select(
        F.col("conv").alias("seq"), "weight", "n", F.col("nth").alias("depth"), pa_.alias("pa"), pb_.alias("pb"),
        pa_.bitwiseXOR(F.col("ma")).alias("up_a"), pb_.bitwiseXOR(F.col("mb")).alias("up_b"),
        (F.col("rw") + F.coalesce("cw", zero) - F.col("words")).alias("before"))
    root = sequences.select("seq", "weight", "n", zero.alias("depth"), zero.alias("pa"), zero.alias("pb"),
                            F.lit(None).cast("long").alias("up_a"), F.lit(None).cast("long").alias("up_b"), zero.alias("before"))
    return spelled.union(root)


def _end_digests(keys: DataFrame) -> DataFrame:
    """(conv, n, ka, kb) -> (n, ka, kb, ends_sha256): digest of the ids that share a key.

    Ids are sorted by ranges of (key, id), so one key may span many tasks; each
    writes its ids as text chunks, and only chunks meet in the task that hashes
    them in order. No list is held whole.
    """
    bounded_batches(keys.sparkSession)
    key = ["n", "ka", "kb"]
    longs = [pa.int64()] * 3

    def batch(rows, names, kinds):
        cols = list(zip(*rows)) if rows else [[]] * len(kinds)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names)

    def chunks(batches):
        held, ids, first, size, out = None, [], None, 0, []
        for x in batches:
            for k in zip(*(x.column(i).to_pylist() for i in range(4))):
                if k[:3] != held or size >= CHUNK_CHARS:
                    if ids:
                        out.append((*held, first, ",".join(ids)))
                    held, ids, first, size = k[:3], [], k[3], 0
                ids.append(str(k[3]))
                size += len(ids[-1]) + 1
            yield batch(out, [*key, "first", "ids"], [*longs, pa.int64(), pa.string()])
            out = []
        if ids:
            out.append((*held, first, ",".join(ids)))
        yield batch(out, [*key, "first", "ids"], [*longs, pa.int64(), pa.string()])

    def digests(batches):
        held, state, out = None, None, []
        for x in batches:
            for k in zip(*(x.column(i).to_pylist() for i in range(5))):
                if k[:3] != held:
                    if state is not None:
                        out.append((*held, state.hexdigest()))
                    held, state = k[:3], hashlib.sha256(k[4].encode())
                else:
                    state.update(b"," + k[4].encode())
            yield batch(out, [*key, "ends_sha256"], [*longs, pa.string()])
            out = []
        if state is not None:
            out.append((*held, state.hexdigest()))
        yield batch(out, [*key, "ends_sha256"], [*longs, pa.string()])

    texts = (keys.select(*key, "conv").repartitionByRange(*key, "conv").sortWithinPartitions(*key, "conv")
             .mapInArrow(chunks, "n long, ka long, kb long, first long, ids string"))
    return (texts.repartition(*key).sortWithinPartitions(*key, "first")
            .mapInArrow(digests, "n long, ka long, kb long, ends_sha256 string"))
