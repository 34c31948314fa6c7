"""The conversation trie against brute force."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from pricegrain.llm import trie

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def brute(rows):
    convs = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            convs[conv].append(((turn is not None, turn or 0), role, hashlib.sha256(text.encode()).hexdigest(), text))
    turns = {c: [(r, t) for _, r, _, t in sorted(v)] for c, v in convs.items()}
    rebuilt = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 4
        rebuilt[c] = turns.get(c - c % 20, [])[:h] + own[h:]
    members, children = defaultdict(list), defaultdict(set)
    for c, seq in rebuilt.items():
        for d in range(len(seq) + 1):
            members[tuple(seq[:d])].append(c)
            if d:
                children[tuple(seq[: d - 1])].add(tuple(seq[:d]))
    out = []
    for node, convs_ in members.items():
        below = [k for k in members if k[: len(node)] == node]
        ends = sorted(c for c in convs_ if len(rebuilt[c]) == len(node))
        saved = sum((len(members[k]) - 1) * len(k[-1][1].split()) for k in below if k)
        out.append((min(convs_), len(node), min(members[node[:-1]]) if node else None, len(convs_), len(children[node]), sum(not children[k] for k in below), saved, hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return sorted(out, key=str)


def found(spark, rows):
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "conv_id long, turn long, role string, text string, length int, node string").repartition(3)
    return sorted((tuple(r[c] for c in COLUMNS) for r in trie.conversation_trie(df).collect()), key=str)


def made(seed, n, longest):
    rng = random.Random(seed)
    return [(c, t, rng.choice(["user", "assistant"]) if rng.random() < 0.2 else "user", rng.choice(["", "a", "b c"])) for c in rng.sample(range(200), n) for t in range(rng.randint(1, longest))]


@pytest.mark.parametrize("piece,longest", [(16, 6), (2, 9), (4, 40), (1, 5)])
def test_brute_force(spark, monkeypatch, piece, longest):
    monkeypatch.setattr(trie, "PIECE", piece)
    monkeypatch.setattr(trie, "ENDS_PER_RANGE", 2)
    rows = made(piece, 40, longest)
    assert found(spark, rows) == brute(rows)


def test_odd_rows(spark):
    rows = [(None, 1, "user", "no id"), (0, None, None, None), (0, None, "z", None), (0, 2, "user", "b"), (0, 1, "user", "a b"), (0, 1, "user", "a b"), (1, 0, "ab", "c"), (2, 0, "a", "bc"), (3, None, "", ""), (25, 5, "user", "c"), (47, 1, "user", "w " * 20_000), (2**40, 1, "user", "far")]
    rows += [(60, 0, "user", "same")] + [(60 + k, t, "user", "same") for k in range(1, 20) for t in range(k % 3 + 1)]
    assert found(spark, rows) == brute(rows)


def test_one_common_conversation(spark, monkeypatch):
    monkeypatch.setattr(trie, "ENDS_PER_RANGE", 8)
    rows = [(c, t, "user", f"turn {t}") for c in range(300) for t in range(3)]
    assert found(spark, rows) == brute(rows)


def test_conversation_without_turns(spark):
    alone = next(c for c in range(21, 40) if zlib.crc32(str(c).encode()) % 4)
    assert found(spark, [(alone, 0, "user", "x")]) == brute([(alone, 0, "user", "x")])


def test_empty_table(spark):
    assert found(spark, []) == []


def test_names_depend_on_the_prefix_alone():
    turns = [bytes([k]) for k in range(16)]
    for n in range(17):
        assert trie.before_each(b"r", turns[:n], 16) == trie.before_each(b"r", turns, 16)[:n]
    assert len(set(trie.before_each(b"r", turns, 16))) == 16
