"""Cross-tokenizer alignment: lockstep vectorised merging.

Two tokenizers cut the same bytes at different places. A token of A and a token
of B are linked where their byte ranges overlap; where tokens of both end, the
document falls into groups.

1. A task encodes a batch of documents with both tokenizers and lays the token
   ends of all of them out in two arrays. One state vector holds a pair of
   pointers per lane; a lane is a document, or a stretch of ``LANE`` A tokens of
   a longer one. Every step links the tokens under all pointers at once, cuts
   where both end, advances the pointer whose token ends first (both on a cut)
   and compacts the lanes that are done.
2. A batch writes each document's links as places in the batch's list of distinct
   id pairs, and that list once, with how many of its documents hold each pair.
3. Corpus-wide counts are sums over those lists, so what is shuffled is the
   distinct pairs of batches, not the links of documents.
4. The counts go back to each batch as one list, and its documents are settled
   against it, a batch at a time.

Texts are cut for the tokenizers only where both certainly start a new token: at
a space behind anything but a space and before anything but white space. A task
encodes each distinct stretch once, as long as its cache holds it, and lays the
documents out from there; texts of any length are whole.
"""

import hashlib
import re
import sys
from array import array
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierlake.llm.common import bounded_batches, stored

A_FILE = "/opt/tokenizers/byte_bpe_50k.json"
B_FILE = "/opt/tokenizers/piece_bpe_32k.model"
LANE = 512               # A tokens of a document that one lane walks
BATCH_CHARS = 1_000_000  # of the documents merged at once; a longer one is a batch of its own
ENCODE_CHARS = 100_000   # given to a tokenizer at once
CACHE = 200_000          # distinct stretches a task remembers; then it starts anew
CACHE_CHARS = 4_000_000  # and so it does beyond that many characters of them

_BLANK = re.compile(r" (?:\s|$)")


class Tokenizers:
    """Both tokenizers from their files' bytes, with the bytes of every token."""

    def __init__(self, a: bytes, b: bytes):
        import sentencepiece
        from tokenizers import Tokenizer
        self.a = Tokenizer.from_str(a.decode("utf-8"))
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b)
        char = _byte_characters()
        pieces = map(self.a.id_to_token, range(self.a.get_vocab_size()))
        self.bytes_a = [bytes(char.get(c, 0) for c in piece or "") for piece in pieces]
        self.bytes_b, joins = [], False
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            if self.b.is_byte(i):
                self.bytes_b.append(bytes([int(piece[3:5], 16)]))
            else:
                self.bytes_b.append(piece.replace("▁", " ").encode())
                joins |= "▁" in piece.lstrip("▁")
        if joins:
            raise ValueError("a piece of B goes on behind a space; texts can't be cut there")
        self.size_a = np.array(list(map(len, self.bytes_a)), np.int64)
        self.size_b = np.array(list(map(len, self.bytes_b)), np.int64)
        self.spell_a = np.array([f"{i}{s}" for i in range(len(self.bytes_a)) for s in ",|"], object)
        self.spell_b = np.array([f"{i}{s}" for i in range(len(self.bytes_b)) for s in ",;"], object)

        self.clear()

    def clear(self):
        self.place, self.chars = {}, 0
        self.ids_a, self.ids_b = array("i"), array("i")
        self.count_a, self.count_b, self.whole = array("i"), array("i"), array("b")

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(A ids, B ids, A ids per text, B ids per text) of all texts, each behind one space.

        A text whose token bytes are not its own has none.
        """
        if len(self.place) > CACHE or self.chars > CACHE_CHARS:
            self.clear()
        flat, per_text = [], []
        for t in texts:
            own = stretches(" " + t) if t else []
            flat += own
            per_text.append(len(own))
        held, size = [], 0
        for s in set(flat).difference(self.place):
            held.append(s)
            size += len(s)
            if size >= ENCODE_CHARS:
                self._learn(held)
                held, size = [], 0
        if held:
            self._learn(held)
        place = np.fromiter(map(self.place.__getitem__, flat), np.int64, len(flat))
        text = np.repeat(np.arange(len(texts)), per_text)
        lost = np.zeros(len(texts), bool)
        lost[text[np.array(self.whole, np.int8)[place] == 0]] = True
        if lost.any():
            place, text = place[~lost[text]], text[~lost[text]]
        (a, n_a), (b, n_b) = (_gathered(ids, counts, place, text, len(texts)) for ids, counts in
                              ((self.ids_a, self.count_a), (self.ids_b, self.count_b)))
        return a, b, n_a, n_b

    def _learn(self, held: list[str]) -> None:
        raws = [s.encode("utf-8", "surrogatepass") for s in held]
        raw_size, raw = list(map(len, raws)), b"".join(raws)
        whole = np.ones(len(held), bool)
        for coded, ids, counts, size, spelled in (
                ([e.ids for e in self.a.encode_batch_fast(held, add_special_tokens=False)],
                 self.ids_a, self.count_a, self.size_a, self.bytes_a),
                (self.b.encode([s[1:] for s in held], num_threads=1), self.ids_b, self.count_b, self.size_b, self.bytes_b)):
            flat, count = list(chain.from_iterable(coded)), list(map(len, coded))
            byte_size = np.bincount(np.repeat(np.arange(len(held)), count), weights=size[flat], minlength=len(held))
            if (byte_size != raw_size).any() or b"".join(map(spelled.__getitem__, flat)) != raw:
                whole &= [b"".join(map(spelled.__getitem__, x)) == r for x, r in zip(coded, raws)]
            ids.extend(flat)
            counts.extend(count)
        self.place.update(zip(held, range(len(self.whole), len(self.whole) + len(held))))
        self.whole.frombytes(whole.astype(np.int8).tobytes())
        self.chars += sum(map(len, held))


def stretches(text: str) -> list[str]:
    """``text``, which starts with a space, cut at every space that both tokenizers start a token at."""
    parts = text.split(" ")[1:]
    if not _BLANK.search(text):
        return [" " + p for p in parts]
    out = []
    for i, p in enumerate(parts):
        if i and parts[i - 1] and p and not p[0].isspace():
            out.append(" " + p)
        elif out:
            out[-1] += " " + p
        else:
            out.append(" " + p)
    return out


def _gathered(ids: array, counts: array, place: np.ndarray, text: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The remembered ids at the places, in order, and how many each text has."""
    count = np.array(counts, np.int64)
    first = np.cumsum(count) - count
    size = count[place]
    at = np.repeat(first[place] - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
    return np.array(ids, np.int32)[at], np.bincount(text, weights=size, minlength=n).astype(np.int64)


def _byte_characters() -> dict[str, int]:
    """Byte-level alphabet: printable Latin-1 bytes stand for themselves, the others follow from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


def lockstep(ends_a: np.ndarray, ends_b: np.ndarray, first_a: np.ndarray, first_b: np.ndarray,
             stop_a: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Merge all lanes at once: (A place, B place, both end) of every link.

    ``ends_*``: byte ends of the tokens, rising over all documents, which end at
    equal bytes on both sides. Lanes start at ``first_*`` and go until A's
    pointer reaches ``stop_a``.
    """
    a, b, stop = (np.asarray(x, np.int64) for x in (first_a, first_b, stop_a))
    open_ = a < stop
    a, b, stop = a[open_], b[open_], stop[open_]
    links_a, links_b, cuts = [], [], []
    while len(a):
        at_a, at_b = ends_a[a], ends_b[b]
        links_a.append(a)
        links_b.append(b)
        cuts.append(at_a == at_b)
        a, b = a + (at_a <= at_b), b + (at_b <= at_a)
        open_ = a < stop
        if not open_.all():
            a, b, stop = a[open_], b[open_], stop[open_]
    if not links_a:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool)
    return np.concatenate(links_a), np.concatenate(links_b), np.concatenate(cuts)


class Merged:
    """A batch of encoded documents, linked and cut."""

    def __init__(self, texts: list[str], tokenizers: Tokenizers):
        self.n = len(texts)
        self.a, self.b, self.n_a, self.n_b = tokenizers.encode(texts)
        ends_a, ends_b = np.cumsum(tokenizers.size_a[self.a]), np.cumsum(tokenizers.size_b[self.b])
        last = np.cumsum(self.n_a)
        lanes = -(-self.n_a // LANE)
        nth = np.arange(int(lanes.sum())) - np.repeat(np.cumsum(lanes) - lanes, lanes)
        first = np.repeat(last - self.n_a, lanes) + nth * LANE
        stop = np.minimum(first + LANE, np.repeat(last, lanes))
        start_byte = np.concatenate(([0], ends_a))[first]
        self.link_a, self.link_b, cut = lockstep(ends_a, ends_b, first, np.searchsorted(ends_b, start_byte, side="right"), stop)
        self.doc_a = np.repeat(np.arange(self.n), self.n_a)
        self.link_doc = self.doc_a[self.link_a]
        self.cut_a, self.cut_b = np.sort(self.link_a[cut]), np.sort(self.link_b[cut])
        self.n_links = np.bincount(self.link_doc, minlength=self.n)
        self.n_groups = np.bincount(self.doc_a[self.cut_a], minlength=self.n)

    def groups(self, spell_a: np.ndarray, spell_b: np.ndarray) -> list[str]:
        """``a1,a2|b1;a3|b2,b3`` per document; '' without tokens.

        ``spell_*`` hold each id twice: with the sign inside a group and behind its last token.
        """
        ends_a, ends_b = (np.zeros(len(x), np.int64) for x in (self.a, self.b))
        ends_a[self.cut_a], ends_b[self.cut_b] = 1, 1
        # a token stands behind all tokens of its side, and behind the other side's earlier groups (B: its own group too)
        group_a = np.cumsum(ends_a) - ends_a
        group_b = np.cumsum(ends_b) - ends_b
        before_b = np.concatenate(([0], self.cut_b + 1))
        out = np.empty(len(self.a) + len(self.b), object)
        out[np.arange(len(self.a)) + before_b[group_a]] = spell_a[2 * self.a + ends_a]
        if len(self.b):
            out[np.arange(len(self.b)) + self.cut_a[group_b] + 1] = spell_b[2 * self.b + ends_b]
        stop = np.cumsum(self.n_a + self.n_b)
        return ["".join(out[e - n:e].tolist())[:-1] for e, n in zip(stop.tolist(), (self.n_a + self.n_b).tolist())]

    def pairs(self):
        """(distinct id pairs, documents holding each, place of each document's pairs, how often, pairs per document)."""
        code = (self.a[self.link_a].astype(np.int64) << 32) | self.b[self.link_b]
        distinct, place = np.unique(code, return_inverse=True)
        own, times = np.unique(self.link_doc * max(1, len(distinct)) + place, return_counts=True)
        place = own % max(1, len(distinct))
        docs = np.bincount(place, minlength=len(distinct))
        per_doc = np.bincount(own // max(1, len(distinct)), minlength=self.n)
        return distinct, docs, place, times, per_doc


def _narrow(x: np.ndarray) -> bytes:
    """Whole numbers from 0 in the fewest of 1, 2, 4 or 8 bytes each, as the largest needs."""
    top = int(x.max()) if len(x) else 0
    return x.astype(next(k for k in (np.uint8, np.uint16, np.uint32, np.uint64) if top <= np.iinfo(k).max)).tobytes()


def _wide(raw: bytes, n: int) -> np.ndarray:
    return np.frombuffer(raw, {1: np.uint8, 2: np.uint16, 4: np.uint32, 8: np.uint64}[len(raw) // n]).astype(np.int64) \
        if n else np.empty(0, np.int64)


def _loaded(a: bytes, b: bytes) -> Tokenizers:
    """The tokenizers of this Python worker: loaded once, used by all its tasks."""
    kept = sys.__dict__.setdefault("_crosswalk_tokenizers", {})
    name = hashlib.sha256(a).digest() + hashlib.sha256(b).digest()
    if name not in kept:
        kept.clear()
        kept[name] = Tokenizers(a, b)
    return kept[name]


def _file_bytes(df: DataFrame, path: str) -> bytes:
    """A tokenizer's file: a few MB, fixed by its vocabulary. A path without a scheme is read by the driver alone."""
    if "://" not in path:
        with open(path, "rb") as f:
            return f.read()
    return bytes(df.sparkSession.read.format("binaryFile").load(path).select("content").first()[0])


def link_documents(df: DataFrame, key: str = "doc_id", text: str = "text", a_file: str = A_FILE, b_file: str = B_FILE,
                   spell: bool = False) -> DataFrame:
    """One row per document: its alignment, and its links packed against its batch.

    Columns: batch, key, n_a, n_b, n_groups, n_links, groups_sha256, n_pairs,
    places and times (distinct id pairs of the document: places in the batch's list, as
    steps, and how many links each has), groups (with ``spell``, else null); on
    one row of a batch also pairs (A id << 32 | B id, rising) and docs (documents
    of the batch that hold each). Store the result before use: a batch's name
    holds for one run of its task.

    Null and empty texts, and texts whose token bytes differ from the text's, have
    no tokens: zeros and ''. Repeated rows are documents of their own.
    """
    bounded_batches(df.sparkSession)
    a, b = _file_bytes(df, a_file), _file_bytes(df, b_file)
    own = df.select(F.col(key).alias("key"), F.col(text).alias("text"))
    schema = T.StructType([
        T.StructField("batch", T.LongType()), T.StructField("key", own.schema["key"].dataType),
        *[T.StructField(c, T.LongType()) for c in ("n_a", "n_b", "n_groups", "n_links", "n_pairs")],
        T.StructField("groups_sha256", T.StringType()), T.StructField("groups", T.StringType()),
        T.StructField("places", T.BinaryType()), T.StructField("times", T.BinaryType()),
        T.StructField("pairs", T.ArrayType(T.LongType())), T.StructField("docs", T.ArrayType(T.LongType()))])

    def run(batches):
        tokenizers = _loaded(a, b)
        spell_a, spell_b = tokenizers.spell_a, tokenizers.spell_b
        name = TaskContext.get().partitionId() << 32
        for batch in batches:
            size = pc.fill_null(pc.utf8_length(batch.column(1)), 0).to_numpy(zero_copy_only=False)
            at = 0
            while at < batch.num_rows:
                n = max(1, int(np.searchsorted(np.cumsum(size[at:]), BATCH_CHARS, side="right")))
                part = batch.slice(at, n)
                at += n
                m = Merged(part.column(1).to_pylist(), tokenizers)
                groups = m.groups(spell_a, spell_b)
                distinct, docs, place, times, per_doc = m.pairs()
                edge = np.cumsum(per_doc)
                rows = list(zip((edge - per_doc).tolist(), edge.tolist()))
                one = [None] * (len(groups) - 1)
                yield pa.RecordBatch.from_arrays([
                    pa.array([name] * len(groups), pa.int64()), part.column(0),
                    *[pa.array(x, pa.int64()) for x in (m.n_a, m.n_b, m.n_groups, m.n_links, per_doc)],
                    pa.array([hashlib.sha256(g.encode()).hexdigest() if g else "" for g in groups], pa.string()),
                    pa.array(groups if spell else [None] * len(groups), pa.string()),
                    pa.array([_narrow(np.diff(place[s:e], prepend=0)) for s, e in rows], pa.binary()),
                    pa.array([_narrow(times[s:e]) for s, e in rows], pa.binary()),
                    pa.array([distinct.tolist(), *one], pa.list_(pa.int64())),
                    pa.array([docs.tolist(), *one], pa.list_(pa.int64()))], [f.name for f in schema.fields])
                name += 1

    return own.mapInArrow(run, schema)


def pair_counts(linked: DataFrame) -> DataFrame:
    """Stored ``link_documents`` -> (pair, n, best): documents corpus-wide that hold the
    pair linked, and whether no pair of the same A id has more.

    A window holds the pairs of one A id: at most as many as B has ids.
    """
    from pyspark.sql import Window
    n = _listed(linked).groupBy("pair").agg(F.sum("docs").alias("n"))
    return n.withColumn("best", F.col("n") == F.max("n").over(Window.partitionBy(F.shiftright("pair", 32))))


def _listed(linked: DataFrame) -> DataFrame:
    return linked.where("pairs IS NOT NULL").select("batch", F.posexplode(F.arrays_zip("pairs", "docs")).alias("place", "x")) \
        .select("batch", "place", F.col("x.pairs").alias("pair"), F.col("x.docs").alias("docs"))


def align(df: DataFrame, key: str = "doc_id", text: str = "text", a_file: str = A_FILE, b_file: str = B_FILE,
          spell: bool = False) -> DataFrame:
    """Every row's alignment, with its links weighed by corpus-wide pair counts.

    Columns: key, n_a, n_b, n_groups, n_links, n_best (links whose pair has the
    highest count of its A id, ties included), count_sum (counts summed over
    links), groups_sha256, with ``spell`` also groups. See ``link_documents`` for
    odd rows; an empty table gives an empty result.
    """
    linked = stored(link_documents(df, key, text, a_file, b_file, spell), "crosswalk-links")
    counts = stored(pair_counts(linked), "crosswalk-counts")
    weighed = _listed(linked).select("batch", "place", "pair").join(counts, "pair").select("batch", "place", "n", "best")
    plain = ["key", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", *["groups"] * spell]
    docs = linked.select("batch", *plain, "n_pairs", "places", "times")
    schema = T.StructType([*[linked.schema[c] for c in plain], T.StructField("n_best", T.LongType()),
                           T.StructField("count_sum", T.LongType())])

    def settle(own: pa.Table, listed: pa.Table) -> pa.Table:
        place = listed.column("place").to_numpy()
        count, best = np.zeros(len(place), np.int64), np.zeros(len(place), np.int64)
        count[place], best[place] = listed.column("n").to_numpy(), listed.column("best").to_numpy()
        sums = []
        for n, raw, times in zip(*(own.column(c).to_pylist() for c in ("n_pairs", "places", "times"))):
            at, k = np.cumsum(_wide(raw, n)), _wide(times, n)
            sums.append((int((best[at] * k).sum()), int((count[at] * k).sum())))
        more = [pa.array([s[i] for s in sums], pa.int64()) for i in (0, 1)]
        return pa.Table.from_arrays([*[own.column(c) for c in plain], *more], [f.name for f in schema.fields])

    weighed = weighed.withColumnRenamed("batch", "of")
    return (docs.groupBy("batch").cogroup(weighed.groupBy("of")).applyInArrow(settle, schema)
            .withColumnRenamed("key", key))
