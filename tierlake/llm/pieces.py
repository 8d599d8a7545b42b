"""SentencePiece encoding by forward-filtering backward-sampling; decoding.

The lattice of a text has an edge for every vocabulary piece that matches a
stretch of it. No piece goes on after a word has ended (the space mark stands
only at the start of pieces), so the lattice falls into words that are sampled
independently with the same joint distribution:

* forward: per distinct word, the total weight of all segmentations up to each
  position, and from it the chance of each last piece at that position;
* backward: from each word's end, a last piece is drawn, then the one before.

A piece weighs ``exp(-alpha * log(2 + rank))``, rank being its place in the
vocabulary (a BPE vocabulary carries merge ranks, not probabilities). Draws
come from a counter: a mix of the seed, the row key and the position, so a
row's segmentation does not depend on partitioning, batch or retry. Characters
without a piece become byte pieces, also the space mark itself when it occurs
in a text; so decoding gives back every text.
"""

import re
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierlake.llm.common import bounded_batches, room_for, spare

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
ALPHA = 1.0
SEED = 20240607
CACHE_NODES = 300_000   # lattice positions kept per task; then the cache starts anew
BATCH_CHARS = 125_000    # characters encoded at once in a task
SHORT = 48               # longer words are filtered one by one, rescaled as they go
LOOSE = 1e-6             # weight of the byte pieces of a character without a piece

_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_SPACE = "▁"


class Vocabulary:
    """Pieces, weights and byte pieces of a SentencePiece model file's bytes."""

    def __init__(self, model: bytes, alpha: float = ALPHA):
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.size = sp.get_piece_size()
        self.edge = {}
        self.byte_id = [0] * 256
        self.spelling = [b""] * self.size
        for i in range(self.size):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.byte_id[int(piece[3:5], 16)] = i
                self.spelling[i] = bytes([int(piece[3:5], 16)])
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                if _SPACE in piece.lstrip(_SPACE):
                    raise ValueError("a piece goes on behind a space mark; words can't be sampled apart")
                self.edge[piece.replace(_SPACE, " ")] = (i, float(np.exp(-alpha * np.log(2.0 + i))))
                self.spelling[i] = piece.replace(_SPACE, " ").encode()
        self.longest = max(map(len, self.edge))
        self._trie()

    def _trie(self):
        """Transitions (state, character) -> state as sorted arrays, for many words at once."""
        step, ends = {}, [(-1, 0.0)]
        for piece, hit in self.edge.items():
            state = 0
            for c in piece:
                key = (state << 21) | ord(c)
                state = step.get(key)
                if state is None:
                    state = step[key] = len(ends)
                    ends.append((-1, 0.0))
            ends[state] = hit
        # open addressing: 2**20 slots, so that most lookups end at the first
        keys, states = np.array(list(step), np.int64), np.array(list(step.values()), np.int32)
        self.slot_key, self.slot_state = np.full(1 << 20, -1, np.int64), np.zeros(1 << 20, np.int32)
        slot = _slot(keys)
        while len(keys):
            free = self.slot_key[slot] < 0
            at, first = np.unique(slot[free], return_index=True)
            put = np.flatnonzero(free)[first]
            self.slot_key[at], self.slot_state[at] = keys[put], states[put]
            rest = np.ones(len(keys), bool)
            rest[put] = False
            keys, states, slot = keys[rest], states[rest], (slot[rest] + 1) & _SLOTS
        self.state_piece = np.array([e[0] for e in ends], np.int64)
        self.state_weight = np.array([e[1] for e in ends])

    def follow(self, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(places of the keys that have a transition, their next states)."""
        slot = _slot(key)
        seen = self.slot_key[slot]
        state = np.where(seen == key, self.slot_state[slot], -1)
        open_ = np.flatnonzero((seen != key) & (seen >= 0))
        while len(open_):
            slot[open_] = (slot[open_] + 1) & _SLOTS
            seen = self.slot_key[slot[open_]]
            hit = seen == key[open_]
            state[open_[hit]] = self.slot_state[slot[open_[hit]]]
            open_ = open_[~hit & (seen >= 0)]
        ok = np.flatnonzero(state >= 0)
        return ok, state[ok].astype(np.int64)


_SLOTS = (1 << 20) - 1


def _slot(key: np.ndarray) -> np.ndarray:
    return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(44)).astype(np.int64)


class Lattices:
    """Forward-filtered words: for each position the last pieces and chances."""

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.clear()

    def clear(self):
        self.word = {}   # word -> its first node
        self.nodes = 0
        self.edges = 0
        self.chunks = []  # node -> first edge; edge -> summed chance at its node, characters, piece
        self.loose = {}   # character without a piece -> pseudo id

    def add_many(self, words: list[str]) -> None:
        """Forward-filter new words: short ones together, position by position."""
        for w in words:
            if len(w) > SHORT:
                self.add(w)
        short = [w for w in words if len(w) <= SHORT]
        if not short:
            return
        v = self.v
        codes = np.frombuffer("".join(short).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        size = np.array(list(map(len, short)), np.int64)
        off = np.cumsum(size) - size
        word = np.repeat(np.arange(len(short)), size)
        stop = (off + size)[word]
        starts, sizes, ids, weights = [], [], [], []
        at, state = np.arange(len(codes)), np.zeros(len(codes), np.int64)
        single = np.zeros(len(codes), bool)
        for k in range(v.longest):  # all matches from every position, one more character a turn
            ok, state = v.follow((state << 21) | codes[at + k])
            at = at[ok]
            hit = v.state_piece[state] >= 0
            if k == 0:
                single[at[hit]] = True
            starts.append(at[hit])
            sizes.append(np.full(int(hit.sum()), k + 1, np.int64))
            ids.append(v.state_piece[state[hit]])
            weights.append(v.state_weight[state[hit]])
            more = at + k + 1 < stop[at]
            at, state = at[more], state[more]
            if not len(at):
                break
        rest = np.flatnonzero(~single)
        if len(rest):
            pseudo = [self.loose.setdefault(chr(c), v.size + len(self.loose)) for c in codes[rest].tolist()]
            starts.append(rest)
            sizes.append(np.ones(len(rest), np.int64))
            ids.append(np.array(pseudo, np.int64))
            weights.append(np.full(len(rest), LOOSE))
        start, step, piece, weight = map(np.concatenate, (starts, sizes, ids, weights))
        begin = start + word[start]  # node of a character's start, this call's nodes from 0
        end = begin + step
        place = start - off[word[start]] + step
        order = np.argsort((place << 50) | (end << 5) | step)  # all keys differ: one order, whatever the batch
        begin, end, step, piece, weight, place = (x[order] for x in (begin, end, step, piece, weight, place))
        total = np.zeros(len(codes) + len(short))
        total[off + np.arange(len(short))] = 1.0
        cut = np.flatnonzero(np.diff(place)) + 1
        part = np.empty(len(end))
        for a, b in zip([0, *cut.tolist()], [*cut.tolist(), len(end)]):
            part[a:b] = total[begin[a:b]] * weight[a:b]
            first = np.concatenate(([0], np.flatnonzero(np.diff(end[a:b])) + 1))
            total[end[a:b][first]] = np.add.reduceat(part[a:b], first)
        share = part / total[end]
        # likely pieces first: most draws end at the first edge
        order = np.argsort((end << 34) | ((1.0 - share) * (1 << 28)).astype(np.int64) << 5 | step)
        self._put(len(total), end[order], share[order], step[order], piece[order])
        self.word.update(zip(short, (self.nodes + off + np.arange(len(short))).tolist()))
        self.nodes += len(total)

    def _put(self, nodes: int, end: np.ndarray, share: np.ndarray, step: np.ndarray, piece: np.ndarray) -> None:
        """Append edges, sorted by end node, of ``nodes`` new nodes."""
        first = np.searchsorted(end, np.arange(nodes))
        run = np.cumsum(share)
        heads = np.concatenate(([0], np.flatnonzero(np.diff(end)) + 1))
        run -= np.repeat(run[heads] - share[heads], np.diff(np.concatenate((heads, [len(end)]))))
        run[np.concatenate((heads[1:], [len(end)])) - 1] = 1.0
        self.chunks.append(((first + self.edges).astype(np.int32), run.astype(np.float32), step.astype(np.int8),
                            piece.astype(np.int32)))
        self.edges += len(end)

    def add(self, word: str) -> int:
        """Node of the word's start; node + p is the position after p characters."""
        edge, longest = self.v.edge, self.v.longest
        n = len(word)
        total = [0.0] * (n + 1)
        total[0] = 1.0
        base = self.nodes
        end, share, step, piece = array("q"), array("d"), array("q"), array("q")
        for p in range(1, n + 1):
            found = []
            for size in range(1, min(p, longest) + 1):
                at = total[p - size]
                if at:
                    hit = edge.get(word[p - size:p])
                    if hit:
                        found.append((size, hit[0], at * hit[1]))
            if word[p - 1] not in edge:
                pseudo = self.loose.setdefault(word[p - 1], self.v.size + len(self.loose))
                found.append((1, pseudo, total[p - 1] * LOOSE))
            whole = sum(f[2] for f in found)
            for size, i, w in sorted(found, key=lambda f: (-f[2], f[0])):
                end.append(p)
                share.append(w / whole)
                step.append(size)
                piece.append(i)
            total[p] = whole
            if whole < 1e-200:  # keep the window of live totals in range
                for k in range(max(0, p - longest), p + 1):
                    total[k] *= 1e200
        self._put(n + 1, *map(np.array, (end, share, step, piece)))
        self.nodes += n + 1
        self.word[word] = base
        return base

    def arrays(self):
        if len(self.chunks) > 1:
            self.chunks = [tuple(map(np.concatenate, zip(*self.chunks)))]
        return self.chunks[0]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def words_of(text: str) -> list[str]:
    """Words of the text with its leading mark: a run of spaces and what follows
    it. Spaces stand for space marks, so a mark of the text itself is a character
    without a piece. Newlines are in no piece and stand alone."""
    return re.findall(r" *[^ \n]+| +|\n", " " + text)


def encode_texts(texts: list[str], keys: list, lattices: Lattices,
                 seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """Sampled piece ids of all texts, and how many each has. A row's draws depend on seed, key and text position alone."""
    v = lattices.v
    if lattices.nodes > CACHE_NODES:
        lattices.clear()
    words, counts = [], []
    for t in texts:
        own = words_of(t) if t else []
        counts.append(len(own))
        words.extend(own)
    lattices.add_many(sorted({w for w in words if w not in lattices.word}))
    sizes = list(map(len, words))
    starts = list(map(lattices.word.__getitem__, words))
    counts = np.array(counts, np.int64)
    if not len(sizes):
        return np.empty(0, np.int32), np.zeros(len(texts), np.int64)
    first, upto, step, piece = lattices.arrays()
    size = np.array(sizes, np.int64)
    node = np.array(starts, np.int64)
    ends = np.cumsum(size)                       # character position after each word, in the batch
    row = np.repeat(np.arange(len(texts)), counts)
    chars = np.bincount(row, weights=size, minlength=len(texts)).astype(np.int64)
    row_at = np.cumsum(chars) - chars            # where each row starts in the batch
    row_seed = np.array([xxhash.xxh64_intdigest(repr(k).encode(), seed) for k in keys], np.uint64)
    chosen = np.full(int(ends[-1]) + 1, -1, np.int64)  # piece ending at each position
    left, pos, base, who = size.copy(), ends, node, row
    while len(left):
        count = (pos - row_at[who]).astype(np.uint64)
        u = ((_mix(row_seed[who] + count * _GOLDEN) >> np.uint64(40)).astype(np.float32) + np.float32(0.5)) / np.float32(1 << 24)
        e = first[base + left]
        late = np.flatnonzero(upto[e] < u)
        while len(late):
            e[late] += 1
            late = late[upto[e[late]] < u[late]]
        chosen[pos] = piece[e]
        left = left - step[e]
        pos = pos - step[e]
        go = left > 0
        left, pos, base, who = left[go], pos[go], base[go], who[go]
    filled = np.flatnonzero(chosen >= 0)
    ids = chosen[filled]
    per_row = np.searchsorted(filled, row_at + chars, side="right") - np.searchsorted(filled, row_at, side="right")
    loose = ids >= v.size
    if loose.any():
        spelled = {i: [v.byte_id[b] for b in c.encode("utf-8", "surrogatepass")] for c, i in lattices.loose.items()}
        width = np.ones(len(ids), np.int64)
        width[loose] = [len(spelled[i]) for i in ids[loose].tolist()]
        row_of = np.repeat(np.arange(len(texts)), per_row)
        per_row = np.bincount(row_of, weights=width, minlength=len(texts)).astype(np.int64)
        out = np.repeat(ids, width)
        at = np.cumsum(width) - width
        for i, seq in spelled.items():
            places = at[ids == i]
            for k, b in enumerate(seq):
                out[places + k] = b
        ids = out
    return ids.astype(np.int32), per_row


def decode_ids(ids: np.ndarray, counts: np.ndarray, vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all piece sequences, and how many each has. The first space
    mark of a sequence was added by the encoder and goes."""
    blob = np.frombuffer(b"".join(vocabulary.spelling), np.uint8)
    width = np.array(list(map(len, vocabulary.spelling)), np.int64)
    first = np.cumsum(width) - width
    size = width[ids]
    ends = np.cumsum(size)
    raw = blob[np.repeat(first[ids] - (ends - size), size) + np.arange(int(size.sum()))]
    upto = np.concatenate(([0], ends))[np.cumsum(counts)]
    starts = np.concatenate(([0], upto[:-1]))
    some = upto > starts
    keep = np.ones(len(raw), bool)
    keep[starts[some]] = False
    return raw[keep], upto - starts - some


def _model_bytes(df: DataFrame, model: str) -> bytes:
    """The model file through Spark's reader: a few hundred KB, fixed by the vocabulary."""
    path = model if "://" in model else f"file://{model}"
    return bytes(df.sparkSession.read.format("binaryFile").load(path).select("content").first()[0])


def encode(df: DataFrame, key: str = "doc_id", text: str = "text", ids: str = "ids", model: str = MODEL,
           alpha: float = ALPHA, seed: int = SEED, lossless: str | None = None) -> DataFrame:
    """Add the sampled piece ids as array<int>; with ``lossless`` also a column of
    that name: whether decoding them gave back the text (in the same task).

    Null text gives null, empty text no pieces. Rows with equal key and text
    get equal segmentations, rows that differ in the key other draws; a null
    key is a key of its own. Any other column is kept untouched; one named like
    an added column is kept under its name with a leading underscore.
    """
    bounded_batches(df.sparkSession)
    df, key, text = room_for(df, [ids, *([lossless] if lossless else [])], key, text)
    proto = _model_bytes(df, model)

    # id and text travel under names of their own, whatever else the table holds
    k, t = spare(df, "key"), spare(df, "text")
    fields = [*df.schema.fields, T.StructField(ids, T.ArrayType(T.IntegerType()))]
    if lossless:
        fields.append(T.StructField(lossless, T.BooleanType()))
    schema = T.StructType(fields)
    own = len(df.columns)

    def run(batches):
        lattices = Lattices(Vocabulary(proto, alpha))
        for batch in batches:
            size = pc.fill_null(pc.utf8_length(batch.column(own + 1)), 0).to_numpy(zero_copy_only=False)
            at = 0
            while at < batch.num_rows:  # bounded number of characters at once
                n = max(1, int(np.searchsorted(np.cumsum(size[at:]), BATCH_CHARS, side="right")))
                part = batch.slice(at, n)
                texts = part.column(own + 1).to_pylist()
                flat, counts = encode_texts(texts, part.column(own).to_pylist(), lattices, seed)
                offsets = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
                missing = np.array([x is None for x in texts] + [False])
                coded = pa.ListArray.from_arrays(pa.array(offsets, mask=missing), pa.array(flat))
                more = [coded]
                if lossless:
                    raw, size_ = decode_ids(flat, counts, lattices.v)
                    ends = np.cumsum(size_).tolist()
                    more.append(pa.array([(x or "").encode("utf-8", "surrogatepass") == raw[b - c:b].tobytes()
                                          for x, b, c in zip(texts, ends, size_.tolist())]))
                yield pa.RecordBatch.from_arrays([*part.columns[:own], *more], [f.name for f in schema.fields])
                at += n

    return df.withColumns({k: F.col(key).cast("string"), t: F.col(text)}).mapInArrow(run, schema)


def decode(df: DataFrame, ids: str = "ids", out: str = "decoded", model: str = MODEL) -> DataFrame:
    """Add the text of each piece sequence; null stays null, no pieces give ''.

    A column of the input named like ``out`` is kept with a leading underscore.
    """
    bounded_batches(df.sparkSession)
    df, ids = room_for(df, [out], ids)
    proto = _model_bytes(df, model)
    schema = T.StructType([*df.schema.fields, T.StructField(out, T.StringType())])
    at = df.columns.index(ids)

    def run(batches):
        vocabulary = Vocabulary(proto)
        for batch in batches:
            col = batch.column(at)
            counts = pc.fill_null(pc.list_value_length(col), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            raw, size = decode_ids(pc.list_flatten(col).to_numpy(zero_copy_only=False), counts, vocabulary)
            offsets = np.concatenate(([0], np.cumsum(size)))
            text = pa.LargeStringArray.from_buffers(
                len(col), pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(raw))
            text = pc.if_else(pc.is_null(col), None, text).cast(pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, text], [f.name for f in schema.fields])

    return df.mapInArrow(run, schema)
