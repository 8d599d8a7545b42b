"""Cross-tokenizer alignment against token-by-token overlap."""

import collections
import hashlib
import random

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tierlake.llm import crosswalk

DOCS = "doc_id long, text string, batch string, key int, pair string, n int"
LONG = " ".join(f"word{i % 977} X{i}" for i in range(60_000))


@pytest.fixture(scope="module")
def both():
    a = Tokenizer.from_file(crosswalk.A_FILE)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=crosswalk.B_FILE)


def spans(sizes):
    at, out = 0, []
    for n in sizes:
        out.append((at, at + n))
        at += n
    return out


def brute(texts, both):
    """Per text (n_a, n_b, groups, links as id pairs) by the definition."""
    a, b = both
    char = crosswalk._byte_characters()
    out = []
    for t in texts:
        out.append((0, 0, "", []))
        if not t:
            continue
        ia, ib = a.encode(" " + t, add_special_tokens=False).ids, b.encode(t)
        ba = [bytes(char[c] for c in a.id_to_token(i)) for i in ia]
        bb = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ib]
        if b"".join(ba) != (" " + t).encode() or b"".join(bb) != (" " + t).encode():
            continue
        sa, sb = spans(map(len, ba)), spans(map(len, bb))
        cuts = sorted({e for _, e in sa} & {e for _, e in sb})
        groups, links, fa, fb = [], [], 0, 0
        for c in cuts:
            la = next(k for k in range(fa, len(sa)) if sa[k][1] == c) + 1
            lb = next(k for k in range(fb, len(sb)) if sb[k][1] == c) + 1
            groups.append(",".join(map(str, ia[fa:la])) + "|" + ",".join(map(str, ib[fb:lb])))
            links += [(ia[x], ib[y]) for x in range(fa, la) for y in range(fb, lb) if sa[x][0] < sb[y][1] and sb[y][0] < sa[x][1]]
            fa, fb = la, lb
        out[-1] = (len(ia), len(ib), ";".join(groups), links)
    return out


def odd_texts():
    rng = random.Random(2)
    texts = [None, "", " ", "  a", "\n", "one", "x" * 3000, "▁ mark", "a ▁b", "<s> </s> <|endoftext|>", "\x00 nul", "é à ÿ 😀 日本語 ", LONG,
             "a b c", "trailing  ", "tab\tand\r\nline", "don't we'll 've",
             "a  \n b", "x \u00a0y \u180ez \u2003 w", "  \u3000 a", "a \x1c b", "\u0085 a \u200b b", "ﬁ ﬀ ① Å", "e\u0301 a \u0301"]
    alphabet = "abc  \n.,éß日😀1A'\t\u00a0"
    texts += ["".join(rng.choices(alphabet, k=rng.randint(0, 200))) for _ in range(150)]
    return texts + texts[:40]


def test_alignment_equals_brute_force(spark, both, monkeypatch):
    monkeypatch.setattr(crosswalk, "LANE", 64)
    monkeypatch.setattr(crosswalk, "BATCH_CHARS", 5000)
    monkeypatch.setattr(crosswalk, "ENCODE_CHARS", 2_000)
    monkeypatch.setattr(crosswalk, "CACHE", 20)
    texts = odd_texts()
    df = spark.createDataFrame([(i, t, "x", 3, "p", 9) for i, t in enumerate(texts)], DOCS).repartition(4)
    got = {r.doc_id: r for r in crosswalk.align(df, spell=True).collect()}
    want = brute(texts, both)
    holds = collections.Counter(p for *_, links in want for p in set(links))
    top = {}
    for (a, _), n in holds.items():
        top[a] = max(n, top.get(a, 0))
    assert len(got) == len(texts)
    for i, (n_a, n_b, groups, links) in enumerate(want):
        r = got[i]
        assert (r.n_a, r.n_b, r.groups or "", r.n_links) == (n_a, n_b, groups, len(links)), texts[i]
        assert r.n_groups == (groups.count(";") + 1 if groups else 0)
        assert r.groups_sha256 == (hashlib.sha256(groups.encode()).hexdigest() if groups else "")
        assert r.count_sum == sum(holds[p] for p in links)
        assert r.n_best == sum(holds[p] == top[p[0]] for p in links)
    assert sum(1 for w in want if not w[0]) > 3 and sum(1 for w in want if w[0]) > 100


def test_lanes_and_an_empty_table(spark):
    rng = np.random.default_rng(1)
    ends_a = np.sort(rng.choice(np.arange(1, 5000), 1500, replace=False))
    ends_b = np.sort(rng.choice(np.arange(1, 5000), 900, replace=False))
    ends_a[-1] = ends_b[-1] = 5000
    whole = crosswalk.lockstep(ends_a, ends_b, [0], [0], [1500])
    first = np.arange(0, 1500, 7)
    lanes = crosswalk.lockstep(ends_a, ends_b, first, np.searchsorted(ends_b, np.concatenate(([0], ends_a))[first], side="right"),
                               np.minimum(first + 7, 1500))
    assert sorted(zip(*map(np.ndarray.tolist, whole))) == sorted(zip(*map(np.ndarray.tolist, lanes)))
    assert len(crosswalk.lockstep(ends_a, ends_b, [], [], [])[0]) == 0
    assert crosswalk.align(spark.createDataFrame([], DOCS)).collect() == []
