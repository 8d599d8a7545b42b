"""The prefix trie against a trie built turn by turn."""

import collections
import hashlib
import random
import re
import zlib

from tierlake.llm import prefixes
from tierlake.llm.prefixes import marked_turns, prefix_trie, rebuilt

ROWS = "conv_id long, turn long, role string, text string, nth int, words string, a string"


def brute(rows, rebuild=True):
    """conv_id, depth -> the whole node, by the definition."""
    own = collections.defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            own[c].append((t is not None, t or 0, r or "", x or ""))
    own = {c: [(r, x) for _, _, r, x in sorted(v)] for c, v in own.items()}
    seqs = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4 if rebuild else 0
        seqs[c] = own.get(c - c % 20, [])[:h] + turns[h:]
    members = collections.defaultdict(list)
    for c, s in seqs.items():
        for d in range(len(s) + 1):
            members[tuple(s[:d])].append(c)
    children = collections.Counter(p[:-1] for p in members if p)

    def subtree(p):
        return [q for q in members if q[:len(p)] == p]

    def words(p):
        return len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0

    out = []
    for p, m in members.items():
        under = subtree(p)
        ends = ",".join(str(c) for c in sorted(c for c in m if len(seqs[c]) == len(p)))
        out.append((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), children[p],
                    sum(not children[q] for q in under), sum((len(members[q]) - 1) * words(q) for q in under),
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def trie(spark, rows, rebuild=True, parts=3):
    df = spark.createDataFrame([(*r, 7, "w", "a") for r in rows], ROWS).repartition(parts)
    marks = marked_turns(df)
    turns, convs = rebuilt(marks) if rebuild else (marks, marks.select("conv").distinct())
    return sorted((tuple(r) for r in prefix_trie(turns, convs).collect()), key=str)


def test_nodes_equal_brute_force_on_odd_rows(spark):
    rng = random.Random(4)
    rows = []
    for c in range(120):
        for t in range(rng.choice((1, 1, 2, 3, 5, 8))):
            rows.append((c, t if rng.random() < 0.9 else None, rng.choice(("user", "assistant", None)),
                         rng.choice((None, "", "a b", "a  b", "x\ty z", " "))))
    rows += rows[:40] + [(None, 0, "user", "lost"), (999, 1, "user", "w " * 50_000), (999, 1, "user", "w " * 50_000)]
    rows += [(c, 0, "user", "the same first turn") for c in range(200, 260)]
    assert trie(spark, rows) == brute(rows)


def test_long_and_equal_conversations(spark, monkeypatch):
    monkeypatch.setattr(prefixes, "BLOCK", 8)
    monkeypatch.setattr(prefixes, "CHUNK_CHARS", 16)
    rows = [(c, t, "user", f"t{min(t, 40)} word") for c in range(6) for t in range(60 - 7 * (c % 3))]
    rows += [(c, 0, "user", "copy") for c in range(100, 400)]
    assert trie(spark, rows, rebuild=False, parts=7) == brute(rows, rebuild=False)


def test_conversations_left_without_a_turn_and_no_rows(spark):
    gone = [c for c in range(21, 40) if zlib.crc32(str(c).encode()) % 4 == 3][:2]
    rows = [(c, t, "user", "x") for c in gone for t in range(2)]  # 2 turns, base absent, h = 3
    assert trie(spark, rows) == brute(rows) == [(gone[0], 0, None, 2, 0, 1, 0, hashlib.sha256(
        f"{gone[0]},{gone[1]}".encode()).hexdigest())]
    assert trie(spark, []) == []
