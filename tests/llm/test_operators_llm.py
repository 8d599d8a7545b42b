"""The training-data operators against brute force and on awkward inputs."""

import collections
import hashlib
import itertools
import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from tierlake.llm import (leaks, licenses, passages, pieces, quality, revisits, sharding, simhash, toxicity, trees)
from tierlake.llm.common import connected_components, in_order
from tierlake.llm.ngram_index import words

DOCS = "doc_id long, text string, lang string, source string, n_chars long, _h string, fp string, c int"
LONG = " ".join(f"w{i % 977}x{i}" for i in range(30_000))


def table(spark, texts, ids=None):
    ids = ids if ids is not None else range(len(texts))
    rows = [(i, t, "en" if n % 2 else None, "s" if n % 3 else None, len(t or ""), "h", "f", n)
            for n, (i, t) in enumerate(zip(ids, texts))]
    return spark.createDataFrame(rows, DOCS).repartition(3)


ODD = [None, "", "  \n ", "one", "a b c d e f", "a b c d e f", LONG, LONG + " end", "é▁ 😀\x00 <s>", "x " * 80]


@pytest.fixture(scope="module")
def odd(spark):
    df = table(spark, ODD + ["dup row", "dup row"], [*range(len(ODD)), 50, 50]).unionByName(
        table(spark, ["no key at all"], [None]))
    return df.cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


# ------------------------------------------------------------------ sharding

def test_shards_are_near_equal_gapless_and_whole(spark):
    rng = random.Random(1)
    texts = ["hot text " * 9] * 700 + ["".join(rng.choices("abc ", k=rng.randint(0, 300))) for _ in range(1400)] + [None]
    out = sharding.shard(table(spark, texts), shards=8).select(
        "shard", "slot", "doc_id", sharding.row_bytes(F.col("text")).alias("b")).toPandas()
    assert sorted(out.doc_id) == list(range(len(texts)))
    per = out.groupby("shard").b.sum()
    assert len(per) == 8 and per.max() - per.min() <= 0.02 * per.mean() + 2 * out.b.max()
    for _, g in out.groupby("shard"):
        assert sorted(g.slot) == list(range(len(g)))


def test_shards_of_odd_and_empty_tables(odd, empty):
    out = sharding.shard(odd).select("shard", "slot").toPandas()
    assert len(out) == odd.count() and out.shard.between(0, 23).all()
    assert sharding.shard(empty).count() == 0


def test_shards_equal_a_sort_of_all_rows(spark):
    rng = random.Random(2)
    texts = ["hot text " * 30 if rng.random() < 0.4 else "w" * rng.randint(0, 300) for _ in range(900)]
    docs = table(spark, texts)
    rows = sharding.shard(docs, shards=6).withColumn("h", sharding.order_hash(F.col("text"))).collect()
    rows.sort(key=lambda r: (r["shard"], r["slot"]))
    assert [(r.h, r.doc_id) for r in rows] == sorted((r.h, r.doc_id) for r in rows)
    sizes = [len(r.text) + 8 for r in rows]
    mean, below = sum(sizes) / 6, list(itertools.accumulate(sizes, initial=0))
    for i in range(1, 6):
        cut = sum(1 for r in rows if r["shard"] < i)
        near = min(abs(b - mean * i) for b in below)
        assert abs(below[cut] - mean * i) <= max(0.01 * mean, near)


def test_clashing_columns_are_kept_under_spare_names(spark):
    """Columns named like those an operator adds, its inputs among them."""
    base = table(spark, ["a b c d e f g h i j k l", "Licensed ! text", None]).select("doc_id", "text")
    mine = F.concat(F.lit("mine "), F.col("doc_id"))

    def held(out, *names):
        assert all(r[n] == f"mine {r.doc_id}" for r in out.collect() for n in names)
        assert len(set(map(str.lower, out.columns))) == len(out.columns)

    docs = base.withColumns({c: mine for c in ("SLOT", "shard", "h", "nth", "row")})
    held(sharding.shard(docs), "_SLOT", "_shard", "h", "nth", "row")
    held(sharding.shard(docs, prefix="new_"), "SLOT", "shard")
    assert sharding.shard(base.withColumnRenamed("text", "slot"), text="slot").where("_slot is null and slot is not null").count() == 1
    docs = base.withColumns({c: mine for c in ("ids", "_ids", "decoded", "lossless")})
    coded = pieces.encode(docs, lossless="lossless")
    held(pieces.decode(coded), "__ids", "_ids", "_decoded", "_lossless")
    docs = base.withColumns({c: mine for c in ("kept", "_lang", "n_words", "_hits", "_mean_word_lo")}).withColumns(
        {"lang": F.lit("en"), "source": F.lit(None).cast("string")})
    held(quality.judge(docs), "_kept", "__lang", "_n_words", "__hits", "__mean_word_lo")
    model = toxicity.fit(base, spark.createDataFrame([(0, 1), (1, 0)], "doc_id long, toxic int"))
    held(toxicity.score(base.withColumn("score", mine), model), "_score")


# ------------------------------------------------------------------- SimHash

def fingerprint(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    s = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] if len(w) > 2 else [" ".join(w)] if w else []
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components(ids, fps, bits=3):
    up = {i: i for i in ids}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x
    for (a, x), (b, y) in itertools.combinations(zip(ids, fps), 2):
        if (x ^ y).bit_count() <= bits:
            ra, rb = root(a), root(b)
            up[max(ra, rb)] = min(ra, rb)
    return {i: root(i) for i in ids}


def test_simhash_equals_brute_force(spark):
    rng = random.Random(3)
    texts = []
    for _ in range(25):
        w = [f"W{rng.randint(0, 40)}" for _ in range(rng.randint(0, 60))]
        texts += [" ".join(w), " ".join(w[:-1] + ["x"]), "\t".join(w)]
    want = [fingerprint(t) for t in texts]
    comp = components(range(len(texts)), want)
    for r in simhash.simhash_components(table(spark, texts)).collect():
        assert r.fingerprint == format(want[r.doc_id], "016x") and r.component_id == comp[r.doc_id]


@pytest.mark.parametrize("bits", [0, 3])
@pytest.mark.parametrize("key_bits", [0, 5, 16, 17, 24, 25, 30, 50])
def test_codes_within_the_distance_agree_on_a_mask(bits, key_bits):
    rng = random.Random(key_bits)
    masks = simhash.block_masks(bits, key_bits)
    assert all(m.bit_count() >= min(key_bits, 30) for m in masks)
    for _ in range(2000):
        flip = sum(1 << b for b in rng.sample(range(64), bits))
        assert any(not flip & m for m in masks)


@pytest.mark.parametrize("split,bucket", [(2048, 256), (40, 256), (2048, 1), (16, 20)])
def test_links_of_dense_buckets_equal_brute_force(spark, split, bucket):
    rng = random.Random(split)
    base = rng.getrandbits(64)
    fps = sorted({base ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 7))) for _ in range(400)})
    df = spark.createDataFrame([(x - (1 << 64) if x >> 63 else x,) for x in fps], "fp long")
    links = simhash.links_between(df, 3, split_rows=split, bucket=bucket)
    got = {r.node % (1 << 64): r.component % (1 << 64) for r in connected_components(links).collect()}
    comp = components(fps, fps)
    groups = collections.defaultdict(set)
    for x in fps:
        groups[got.get(x, x)].add(x)
    want = collections.defaultdict(set)
    for x in fps:
        want[comp[x]].add(x)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, want.values()))


def test_upper_nodes_drop_most_codes_unseen():
    codes = np.random.default_rng(5).integers(0, 1 << 64, 4096, np.uint64)
    codes[1::2] = codes[::2] ^ np.uint64(0b111)
    codes = codes[np.argsort(simhash.gray_rank(codes))]
    levels = simhash.build_index(codes)
    q, m = simhash.search(levels, codes, 3)
    want = np.bitwise_count(codes[:, None] ^ codes[None, :]) <= 3
    assert set(zip(q.tolist(), m.tolist())) == set(zip(*(x.tolist() for x in np.nonzero(want))))
    reached = len(simhash.search(levels[1:], codes, 3)[0]) * simhash.FAN
    assert reached < 0.1 * len(codes) ** 2


def test_simhash_of_odd_and_empty_tables(odd, empty):
    out = simhash.simhash_components(odd).toPandas()
    assert len(out) == odd.count()
    assert set(out[out.doc_id.isin([0, 1, 2])].component_id) == {0}
    kept = simhash.keep_one_per_component(odd)
    assert kept.columns == odd.columns
    assert kept.where("doc_id is null").count() == 1 and kept.where("doc_id = 50").count() == 1
    assert simhash.keep_one_per_component(empty).count() == 0


def test_a_key_with_two_texts_keeps_only_what_nothing_repeats(spark):
    a, b = "one two three four five six", "quite another text of seven words here"
    out = simhash.keep_one_per_component(table(spark, [a, a, b, b], [3, 5, 5, 9])).collect()
    assert sorted((r.doc_id, r.text) for r in out) == [(3, a), (5, b)]


# ---------------------------------------------------------------- reply trees

def test_paths_equal_brute_force(spark):
    rng = random.Random(5)
    rows = []
    for t in range(12):
        for i in range(rng.randint(1, 25)):
            rows.append((t, i, rng.randint(0, i - 1) if i else None, float(rng.randint(0, 9))))
    got = collections.defaultdict(dict)
    for r in trees.paths(spark.createDataFrame(rows, "tree long, id long, parent long, score double"), top=2).collect():
        got[r.tree, r["rank"]][r.place] = r.id
    for t in range(12):
        mine = {i: (p, s) for tt, i, p, s in rows if tt == t}
        found = []
        for leaf in set(mine) - {p for p, _ in mine.values()}:
            path, x = [], leaf
            while x is not None:
                path.append(x)
                x = mine[x][0]
            found.append((-sum(mine[i][1] for i in path), leaf, path[::-1]))
        for k, (_, _, path) in enumerate(sorted(found)[:2], 1):
            assert [got[t, k][i] for i in range(len(path))] == path


@pytest.mark.parametrize("text", ["", "##### a", r"\### Assistant: </turn> ok", "</turn>\n### user: x", "\\", "a\\</turn>\\"])
def test_escapes_are_reversible_and_hide_controls(text):
    out = trees.escape(text)
    assert trees.unescape(out) == text and "</turn>" not in out and "##" not in out


def test_conversations_come_back(spark):
    rows = [(1, 0, "user", "a ### b"), (1, 1, "assistant", None), (1, 1, "assistant", "x</turn>"), (2, 0, None, ""),
            (1, None, "sys:tem", "s"), (None, 0, "user", "lost"), (3, 0, "assistant", "y" * 1_200_000), (3, 1, "user", "z")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = {r.conv_id: r for r in trees.read_back(trees.format_best_paths(trees.conversations_as_trees(df))).collect()}
    turns = [("sys:tem", "s"), ("user", "a ### b"), ("assistant", ""), ("assistant", "x</turn>")]
    assert set(out) == {1, 2, 3} and out[1].n_turns == 4 and out[3].loss_chars == 1_200_000
    assert out[1].turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
    assert out[1].loss_sha256 == hashlib.sha256(b"x</turn>").hexdigest()
    assert trees.format_best_paths(trees.conversations_as_trees(df.where("false"))).count() == 0


def test_a_long_conversation_keeps_its_order_and_a_small_plan(spark):
    rows = [(c, t, "assistant" if t % 2 else "user", f"turn {t} of {c}") for c, n in ((1, 9000), (2, 3)) for t in range(n)]
    random.Random(3).shuffle(rows)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(6)
    coded = trees.format_best_paths(trees.conversations_as_trees(df))
    assert coded.where("conv = 1").count() >= 3  # blocks of turns, formatted by different tasks
    out = {r.conv_id: r for r in trees.read_back(coded).collect()}
    turns = "".join(f"{'assistant' if t % 2 else 'user'}\nturn {t} of 1\n" for t in range(9000))
    assert out[1].n_turns == 9000 and out[1].turns_sha256 == hashlib.sha256(turns.encode()).hexdigest()
    assert out[2].n_turns == 3
    chain = spark.range(1, 3001).selectExpr("1L AS tree", "id", "nullif(id - 1, 0) AS parent", "0.0D AS score")
    found = trees.paths(chain)
    assert found.count() == 3000 and found._jdf.queryExecution().optimizedPlan().toString().count("Join") <= 2


def test_rows_in_order_over_many_ranges(spark):
    rows = [(g, i % 7 if i % 5 else None, i) for g, n in ((None, 30), (1, 400), (2, 1), (3, 55)) for i in range(n)]
    df = spark.createDataFrame(rows, "g int, a int, b int").repartition(5)
    got = collections.defaultdict(list)
    for r in in_order(df.where("g is not null"), "g", ["a", "b"]).collect():
        got[r.g].append(r)
    for g, found in got.items():
        found.sort(key=lambda r: r.nth)
        want = sorted(((a is not None, a or 0, b) for h, a, b in rows if h == g))
        assert [(r.a is not None, r.a or 0, r.b) for r in found] == want
        assert [r.nth for r in found] == list(range(1, len(want) + 1))
        assert [r.before for r in found] == [None, *(r.row for r in found[:-1])]


# -------------------------------------------------------------- SentencePiece

@pytest.fixture(scope="module")
def vocabulary():
    return pieces.Vocabulary(open(pieces.MODEL, "rb").read())


def test_samples_follow_the_lattice(vocabulary):
    def segmentations(s):
        if not s:
            yield (), 1.0
        for k in range(1, len(s) + 1):
            if s[:k] in vocabulary.edge:
                i, w = vocabulary.edge[s[:k]]
                for rest, p in segmentations(s[k:]):
                    yield (i, *rest), w * p
    exact = dict(segmentations(" thes"))
    n = 20_000
    ids, counts = pieces.encode_texts(["thes"] * n, list(range(n)), pieces.Lattices(vocabulary))
    got = collections.Counter(tuple(x.tolist()) for x in np.split(ids, np.cumsum(counts)[:-1]))
    assert sum(abs(got[k] / n - p / sum(exact.values())) for k, p in exact.items()) < 0.03


def test_a_rows_sample_depends_on_its_key_alone(vocabulary):
    text = "the thing and the other thing " * 9 + "z" * 90
    alone, _ = pieces.encode_texts([text], ["7"], pieces.Lattices(vocabulary))
    ids, counts = pieces.encode_texts(["some words first", text, text], ["1", "7", "8"], pieces.Lattices(vocabulary))
    parts = np.split(ids, np.cumsum(counts)[:-1])
    assert parts[1].tolist() == alone.tolist() != parts[2].tolist()


def test_encoding_is_lossless(odd, empty):
    out = pieces.decode(pieces.encode(odd, lossless="ok"))
    assert out.where("ok and decoded <=> text").count() == odd.count()
    assert out.where("text is null and ids is null").count() == 1 and out.columns[:8] == odd.columns
    assert pieces.decode(pieces.encode(empty)).count() == 0


# -------------------------------------------------------------- quality rules

def test_text_measures_equal_brute_force(spark):
    rng = random.Random(8)
    texts = ODD + [" ".join(rng.choices("a b c d# e|".split(), k=rng.randint(0, 60))) + "\nx y\nx y\n" for _ in range(30)]

    def brute(t):
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        at = collections.defaultdict(list)
        for i in range(len(w) - 4):
            at[tuple(w[i:i + 5])].append(i)
        hit = {i + k for v in at.values() if len(v) > 1 for i in v for k in range(5)}
        return len(w), sum(map(len, w)), sum(t.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(hit)

    for r in quality.text_measures(table(spark, texts)).collect():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute(texts[r.doc_id])


def test_sketch_quartiles_are_within_a_bucket(spark):
    rng = random.Random(2)
    v = [int(rng.lognormvariate(6, 1)) for _ in range(4000)]
    df = spark.createDataFrame([("g", x) for x in v], "g string, m long")
    r = quality.quartiles(quality.sketch(df, ["g"], [("m", "m")]), ["g"]).first()
    for got, q in ((r.q1, 0.25), (r.q3, 0.75)):
        true = sorted(v)[int(q * len(v)) - 1]
        assert true * 31 / 32 - 1 <= got <= true


def test_quality_judges_by_group(spark, odd, empty):
    clean = [" ".join(f"word{100 + (i * 37 + j) % 800}" for j in range(40)) for i in range(40)]
    junk = [" ".join(f"w{j}%%%" for j in range(40))]
    out = quality.judge(table(spark, clean + junk)).toPandas().set_index("doc_id")
    assert {i for i in out.index if not out.kept[i]} == {len(clean)}
    assert quality.judge(odd).count() == odd.count() and quality.keep_good(odd).columns == odd.columns
    assert quality.keep_good(empty).count() == 0


# -------------------------------------------------------------- decontamination

def test_smith_waterman_equals_the_plain_recurrence():
    rng = np.random.default_rng(4)
    for _ in range(60):
        a, b = rng.integers(0, 4, rng.integers(1, 9)), rng.integers(-1, 4, rng.integers(1, 15))
        h = np.zeros((len(a) + 1, len(b) + 1), int)
        for i, j in itertools.product(range(1, len(a) + 1), range(1, len(b) + 1)):
            h[i, j] = max(0, h[i - 1, j - 1] + (1 if a[i - 1] == b[j - 1] else -1), h[i - 1, j] - 1, h[i, j - 1] - 1)
        assert leaks.smith_waterman(a, b)[0] == h.max()


def test_leaks_are_found_when_edited_and_frequent(spark, odd, empty):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron"
    edited = item.replace("delta", "changed").replace("kappa", "kappa extra").replace("nu ", "")
    filler = " ".join(f"f{i}" for i in range(300))
    texts = [filler] + [f"{filler} {item.upper()}! {filler}"] * 30 + [f"{filler} {edited}", "alpha beta gamma " + filler]
    bench = spark.createDataFrame([(1, item, 0), (2, "too short", 0), (3, None, 0), (None, item, 0)],
                                  "item_id long, text string, doc_id int")
    got = {r.doc_id for r in leaks.find_leaks(table(spark, texts), bench).collect()}
    assert got == set(range(1, 32))
    kept = leaks.drop_leaked(table(spark, texts), bench)
    assert {r.doc_id for r in kept.collect()} == {0, 32}
    assert leaks.drop_leaked(odd, bench).count() == odd.count() and leaks.find_leaks(empty, bench).count() == 0
    assert leaks.find_leaks(odd, bench.where("false")).count() == 0


@pytest.mark.parametrize("copies", [1, 3, 1000])
@pytest.mark.parametrize("kept", ["edited", "half"])
def test_leaks_are_found_where_every_copy_is_the_same_edited_one(spark, copies, kept):
    item = [f"i{i}" for i in range(20)]
    leak = [w if i % 5 else f"e{i}" for i, w in enumerate(item, 1)] if kept == "edited" else item[:10]
    texts = [" ".join([f"a{n}", *leak, f"b{n}"]) for n in range(copies)]
    bench = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    got = leaks.find_leaks(table(spark, texts), bench).collect()
    # words 5, 10 and 15 of 20 replaced inside the best alignment, the last one left off; or ten words verbatim
    assert sorted(r.doc_id for r in got) == list(range(copies))
    assert {r.score for r in got} == {(16 - 3) / 20 if kept == "edited" else 0.5}
    assert leaks.drop_leaked(table(spark, texts), bench).count() == 0


def test_stretches_passed_over_hold_no_leak():
    rng = np.random.default_rng(7)
    passed = 0
    for _ in range(2000):
        item, text = rng.integers(0, 6, rng.integers(3, 12)), rng.integers(-1, 9, rng.integers(1, 40))
        if not leaks.reachable(item, text, 0.5 * len(item)):
            passed += 1
            assert leaks.smith_waterman(item, text)[0] < 0.5 * len(item)
    assert passed > 100


def test_items_are_read_one_block_at_a_time(spark, monkeypatch):
    monkeypatch.setattr(leaks, "BLOCK_BYTES", 100)
    items = [" ".join(f"i{n}w{i}" for i in range(12)) for n in range(6)]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    built = []
    monkeypatch.setattr(leaks, "Items", lambda rows, make=leaks.Items: built.append(1) or make(rows))
    blocks = iter(leaks._blocks(bench, "item_id", "text"))
    next(blocks)
    assert len(built) == 1
    assert sum(len(b.ids) for b in blocks) <= 6 and len(built) > 2
    assert {(r.doc_id, r.item_id) for r in leaks.find_leaks(table(spark, items), bench).collect()} == {(i, i) for i in range(6)}


# -------------------------------------------------------------------- toxicity

def test_toxicity_learns_and_holds_out(spark, odd, empty):
    rng = random.Random(6)
    texts, y = [], []
    for i in range(400):
        w = ["".join(rng.choices("abcdefgh", k=5)) for _ in range(40)]
        if i % 4 == 0:
            w[rng.randrange(40)] = rng.choice(["zounds", "knavery"])
        texts.append(" ".join(w))
        y.append(int(i % 4 == 0))
    labels = spark.createDataFrame([*((i, v, 1) for i, v in enumerate(y)), (None, 1, 1), (7, None, 1)],
                                   "doc_id long, toxic int, text int")
    out = toxicity.classify(table(spark, texts), labels).toPandas().set_index("doc_id")
    held = [i for i in range(400) if out.held_out[i]]
    assert sum((out.score[i] >= 0.5) == y[i] for i in held) >= 0.95 * len(held)
    assert toxicity.classify(odd, labels).count() == odd.count()
    assert toxicity.classify(odd, labels.where("false")).where("score = 0").count() == odd.count()
    assert toxicity.classify(empty, labels).count() == 0


def plain_alignment(item, text):
    """The same alignment on the whole matrix, cell by cell."""
    h = np.zeros((len(item) + 1, len(text) + 1), int)
    for i, j in itertools.product(range(1, len(item) + 1), range(1, len(text) + 1)):
        same = item[i - 1] == text[j - 1] >= 0
        h[i, j] = max(0, h[i - 1, j - 1] + (1 if same else -1), h[i - 1, j] - 1, h[i, j - 1] - 1)
    i, j = (int(x) for x in np.unravel_index(int(h.argmax()), h.shape))
    score, end, hit = int(h[i, j]), (i, j), 0
    while i > 0 and j > 0 and h[i, j] > 0:
        same = item[i - 1] == text[j - 1] >= 0
        if h[i, j] == h[i - 1, j - 1] + (1 if same else -1):
            hit, i, j = hit + same, i - 1, j - 1
        elif h[i, j] == h[i - 1, j] - 1:
            i -= 1
        else:
            j -= 1
    return score, i, end[0], j, end[1], hit


def test_alignment_in_bounded_memory_equals_the_whole_matrix():
    rng = np.random.default_rng(6)
    for _ in range(150):
        item, text = rng.integers(0, 4, rng.integers(1, 40)), rng.integers(-1, 4, rng.integers(0, 50))
        assert leaks.smith_waterman(item, text) == plain_alignment(item, text)


def test_alignment_of_a_very_long_item():
    import tracemalloc
    rng = np.random.default_rng(7)
    item = rng.integers(0, 5000, 6000)
    text = np.concatenate([rng.integers(0, 5000, 900), np.delete(item, [50, 3000]), rng.integers(0, 5000, 900)])
    tracemalloc.start()
    score, i, ie, j, je, hit = leaks.smith_waterman(item, text)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert (i, ie, j, je, hit, score) == (0, 6000, 900, 6898, 5998, 5996) and peak < 20 << 20


# -------------------------------------------------------------------- licenses

def test_winnowing_keeps_its_guarantee():
    rng = np.random.default_rng(1)
    for _ in range(50):
        h = rng.integers(0, 50, rng.integers(1, 60)).astype(np.uint64)
        at = set(licenses.winnow(h).tolist())
        assert all(at & set(range(i, i + licenses.WINDOW)) for i in range(len(h) - licenses.WINDOW + 1)) and at


def test_a_band_over_all_diagonals_equals_the_full_alignment():
    rng = np.random.default_rng(8)
    for _ in range(60):
        t, x = rng.integers(0, 5, rng.integers(1, 12)), rng.integers(-1, 5, rng.integers(1, 25))
        full = leaks.smith_waterman(t, x)
        assert licenses.banded_alignment(t, x, -len(t), len(x))[0] == full[0]


def test_every_copy_of_a_notice_is_found():
    notice, short = dict(licenses.TEMPLATES[:5])["MIT"], "Released under the MIT License"
    own = licenses.Templates(licenses.TEMPLATES)
    assert [x[0] for x in own.scan(" ".join([notice] * 400), 0.8)] == ["MIT"] * 400
    assert [x[0] for x in own.scan(" ".join([short] * 300), 0.8)] == ["MIT"] * 300
    assert [x[0] for x in own.scan("words Released under the new MIT License, Licensed under the very MIT License", 0.8)] == ["MIT"] * 2


def test_licenses_of_short_texts_equal_brute_force():
    """Every template against the whole text by full alignment, best first."""
    rng = random.Random(11)
    own = licenses.Templates(licenses.TEMPLATES)
    fill = "alpha beta gamma the of license under software and public".split()
    for _ in range(80):
        w = rng.choice(licenses.TEMPLATES)[1].split()
        for _ in range(rng.randint(0, max(1, len(w) // 8))):
            w[rng.randrange(len(w))] = rng.choice(fill)
        text = " ".join(rng.choices(fill, k=rng.randint(0, 30)) + w + rng.choices(fill, k=rng.randint(0, 30)))
        codes = own.codes.encode(licenses.words(text))
        best = max((leaks.smith_waterman(t, codes)[5] for t in own.words
                    if leaks.smith_waterman(t, codes)[5] >= 0.8 * len(t)), default=0)
        found = own.scan(text, 0.8)
        assert max((x[3] for x in found), default=0) == best


def test_licenses_with_spans(spark, odd, empty):
    notice = dict(licenses.TEMPLATES)["MIT"]
    edited = notice.replace("free of charge", "at no charge").replace("any person", "each person")
    texts = [f"Intro text.\n{edited}\nmore words here. {notice}", "Licensed under CC BY-NC 4.0.", "the license of the work"]
    out = licenses.scan_licenses(table(spark, texts)).toPandas()
    assert sorted(out[out.doc_id == 0].license) == ["MIT", "MIT"] and 2 not in set(out.doc_id)
    row = out[out.doc_id == 1].iloc[0]
    assert row.license == "CC-BY-NC-4.0" and texts[1][row.span_start:row.span_end] == "Licensed under CC BY-NC 4.0"
    assert licenses.scan_licenses(odd).count() == 0 and licenses.scan_licenses(empty).count() == 0


# -------------------------------------------------------------------- passages

def test_chains_equal_the_quadratic_recurrence():
    rng = random.Random(9)
    for _ in range(30):
        m = sorted({(rng.randint(0, 60), rng.randint(0, 60)) for _ in range(30)})
        score = {}
        for p, q in m:
            before = [score[x] - passages.GAP_COST * (p - x[0] + q - x[1]) for x in m if x[0] < p and x[1] < q]
            score[p, q] = passages.K + max([0.0, *before])
        best = passages.chain(m)[0]
        total = passages.K
        for (a, b), (c, d) in zip(best, best[1:]):
            total += passages.K - passages.GAP_COST * (c - a + d - b)
        assert abs(total - max(score.values())) < 1e-6


def test_passages_exact_fuzzy_and_copied(spark, odd, empty):
    rng = random.Random(10)
    fresh = lambda n: [f"v{rng.randrange(10**9)}" for _ in range(n)]
    p = fresh(70)
    fuzzy = list(p)
    for i in (11, 30, 52):
        fuzzy[i] = "edit"
    texts = [fresh(90) + p + fresh(50), fresh(20) + p + fresh(20), fuzzy + fresh(40), fresh(200), p[:30] + fresh(50)]
    texts = [" ".join(t) for t in texts] + [" ".join(texts[3])]
    got = {r.doc_id: r for r in passages.find_passages(table(spark, texts)).collect()}
    assert set(got) == {1, 2, 5} and {r.source_doc_id for r in got.values()} == {0, 3}
    assert (got[1].start_word, got[1].end_word, got[1].source_start) == (20, 90, 90) and got[5].kind == "copy"
    cut = {r.doc_id: r.text for r in passages.cut_passages(table(spark, texts)).collect()}
    assert cut[1].split() == texts[1].split()[:20] + texts[1].split()[90:] and 5 not in cut and cut[0] == texts[0]
    assert passages.cut_passages(odd).columns == odd.columns and passages.cut_passages(empty).count() == 0
    assert passages.cut_passages(odd).where("doc_id is null").count() == 1


def fresh_words(rng, n):
    return [f"v{rng.randrange(10**9)}" for _ in range(n)]


def test_fuzzy_passages_of_one_short_exact_run_are_aligned(spark):
    rng = random.Random(11)
    texts, planted = [], set()
    for n in range(40):
        p = fresh_words(rng, 60)
        copy = [w if 22 <= i < 38 or i % 6 else "edit" for i, w in enumerate(p)]  # 16 words exact, the rest one in six
        texts += [fresh_words(rng, 30) + p + fresh_words(rng, 30), fresh_words(rng, 20) + copy + fresh_words(rng, 40)]
        planted.add(2 * n + 1)
    got = passages.find_passages(table(spark, [" ".join(t) for t in texts])).collect()
    assert {r.doc_id for r in got} == planted and min(r.identity for r in got) >= 0.8


def test_passages_whose_seeds_have_scattered_owners_are_linked(spark):
    rng = random.Random(13)
    texts, planted = [], []
    for _ in range(20):
        p = fresh_words(rng, 50)
        planted.append(len(texts) + 3)
        texts += [p[:25] + fresh_words(rng, 40), fresh_words(rng, 40) + p[25:], fresh_words(rng, 20) + p, p + fresh_words(rng, 20)]
    got = passages.find_passages(table(spark, [" ".join(t) for t in texts])).collect()
    assert {(r.doc_id, r.source_doc_id) for r in got} == {(d, d - 1) for d in planted}


def test_passages_go_on_past_the_words_first_fetched(spark):
    rng = random.Random(12)
    line, p = fresh_words(rng, 7), fresh_words(rng, 5000)
    texts = [fresh_words(rng, 40) + line * 100 + fresh_words(rng, 40), fresh_words(rng, 60) + line * 100 + fresh_words(rng, 60),
             fresh_words(rng, 9) + p + fresh_words(rng, 9), p + fresh_words(rng, 9)]
    # an early document owns every seed but those of 13 words in the middle of the long passage
    texts = [w for i in range(0, 5000, 20) for w in [p[i:i + 20] + fresh_words(rng, 30)] if i != 2500] + texts
    n = len(texts)
    got = {(r.doc_id, r.source_doc_id): r for r in passages.find_passages(table(spark, [" ".join(t) for t in texts])).collect()}
    row = got[n - 3, n - 4]
    assert (row.start_word, row.end_word, row.source_start, row.source_end) == (60, 760, 40, 740)
    row = got[n - 1, n - 2]
    assert (row.start_word, row.end_word, row.source_start, row.source_end) == (0, 5000, 9, 5009)


# -------------------------------------------------------------------- revisits

def test_revisits_equal_brute_force(spark):
    rng = random.Random(11)
    rows = [(i, rng.choice(["http://www.A.com/x/", "https://a.com/x?utm_source=q", "http://b.org/y#t", None]),
             rng.choice([None, *range(0, 20_000, 700)]), rng.choice(["response", "revisit", "request"]),
             {"ETag": rng.choice(['"1"', 'W/"1"', '"2"']), "Content-Length": str(i), "X": str(i)}) for i in range(300)]
    df = spark.createDataFrame(rows, "record_id long, url string, ts long, kind string, headers map<string,string>")
    canon = lambda u: None if u is None else "a.com/x" if "a.com" in u.lower() else "b.org/y"
    out = {r.record_id: r for r in revisits.resolve_revisits(df).collect()}
    assert set(out) == {r[0] for r in rows if r[3] == "revisit"}
    for i, u, t, kind, h in rows:
        if kind != "revisit":
            continue
        earlier = [r for r in rows if r[3] == "response" and None not in (u, t, r[1], r[2]) and canon(r[1]) == canon(u) and r[2] < t]
        if not earlier:
            assert out[i].status == "orphan"
            continue
        best = max(earlier, key=lambda r: (r[2], r[0]))
        same = best[4]["ETag"].removeprefix("W/") == h["ETag"].removeprefix("W/")
        assert (out[i].response_id, out[i].status) == (best[0], "resolved" if same else "changed")
        assert out[i].headers["content-length"] == str(best[0] if same else i) and out[i].headers["x"] == str(i)
    assert revisits.resolve_revisits(df.where("false")).count() == 0


# -------------------------------------------------------------------- pipeline

def test_pipeline_stages_take_odd_tables(spark, odd, empty):
    sf = "/root/testdata/sf0.001"
    for docs in (odd, empty):
        for n, (_, stage) in enumerate(corpus_pipeline.STAGES):
            out = stage(spark, docs.select("doc_id", "text", "lang", "source", "n_chars"), sf)
            assert out.count() <= docs.count()
            if n < len(corpus_pipeline.STAGES) - 1:
                assert out.columns == ["doc_id", "text", "lang", "source", "n_chars"]


def test_words_ignore_case_and_marks():
    assert words("A b,C—d") == ["a", "b", "c", "d"] and words(None) == []


def test_leaks_equal_all_pairs(spark):
    """Every (document, item) with a 3-gram in common, aligned in full by the plain recurrence."""
    rng = random.Random(12)
    vocabulary = [f"w{i}" for i in range(500)]
    items = [rng.choices(vocabulary, k=rng.randint(3, 40)) for _ in range(25)]
    docs = []
    for _ in range(60):
        body = rng.choices(vocabulary, k=rng.randint(0, 120))
        for item in rng.sample(items, rng.choice((0, 1, 2))):
            copy = [w for w in item if rng.random() > 0.1]
            copy = [w if rng.random() > rng.choice((0, 0.1, 0.3)) else "other" for w in copy]
            at = rng.randint(0, len(body))
            body = body[:at] + copy + body[at:]
        docs.append(" ".join(body))
    docs += docs[:5]

    def best(item, text):
        h, top = [[0] * (len(text) + 1) for _ in range(len(item) + 1)], 0
        for i in range(1, len(item) + 1):
            for j in range(1, len(text) + 1):
                h[i][j] = max(0, h[i - 1][j - 1] + (1 if item[i - 1] == text[j - 1] else -1), h[i - 1][j] - 1, h[i][j - 1] - 1)
                top = max(top, h[i][j])
        return top

    def grams(ws):
        return {tuple(ws[i:i + 3]) for i in range(len(ws) - 2)}

    want = {}
    for d, text in enumerate(docs):
        ws = text.split()
        for k, item in enumerate(items):
            if grams(item) & grams(ws) and 2 * best(item, ws) >= len(item):
                want[d, k] = best(item, ws) / len(item)
    bench = spark.createDataFrame([(k, " ".join(item)) for k, item in enumerate(items)], "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.score for r in leaks.find_leaks(table(spark, docs), bench).collect()}
    assert len(want) > 30 and got == pytest.approx(want)
    kept = {r.doc_id for r in leaks.drop_leaked(table(spark, docs), bench).collect()}
    assert kept == set(range(len(docs))) - {d for d, _ in want}
