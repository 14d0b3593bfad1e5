"""The prefix trie of conversations beside brute force."""

import hashlib
import random
import zlib

import pytest

from laddermill.llm import conversation_trie as trie

SCHEMA = "conv_id bigint, turn bigint, role string, text string, depth int, n int, ids array<int>, shard string"


def rebuilt(rows):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(t)] for c, t in own.items()}
    out = {}
    for c, t in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        of = c - (c % 20 if c >= 0 else -(-c % 20))
        out[c] = own.get(of, [])[:h] + t[h:]
    return out


def want(convs):
    members = {}
    for c, t in convs.items():
        for d in range(len(t) + 1):
            members.setdefault(tuple(t[:d]), []).append(c)
    kids, leaves, saved = dict.fromkeys(members, 0), dict.fromkeys(members, 0), dict.fromkeys(members, 0)
    for k in members:
        if k:
            kids[k[:-1]] += 1
    for k, m in members.items():
        for d in range(len(k) + 1):
            leaves[k[:d]] += not kids[k]
            saved[k[:d]] += (len(m) - 1) * (len(k[-1][1].split()) if k else 0)
    ends = {k: hashlib.sha256(",".join(map(str, sorted(c for c in m if len(convs[c]) == len(k)))).encode()).hexdigest() for k, m in members.items()}
    return sorted(((min(m), len(k), min(members[k[:-1]]) if k else None, len(m), kids[k], leaves[k], saved[k], ends[k]) for k, m in members.items()), key=str)


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(13)
    out = []
    for c in [*range(-25, 90), *range(200, 260)]:
        if c % 7 == 3 and c % 20:
            continue
        if c % 20 == 0 and c % 3 == 0:
            continue  # no leader
        for turn in range(rnd.choice([1, 1, 2, 3, 6, 12])):
            text = "same opening words" if turn == 0 and c % 3 == 0 else rnd.choice(["a", "a b", "a b c", "", None, "x " * 50, "é\tü"])
            out.append((c, turn, rnd.choice(["user", "user", "assistant", None]), text))
    out += [(c, None, "user", rnd.choice(["n", "m m"])) for c in range(0, 90, 9)]  # a null turn goes first
    out += [(c, 0, r, t) for c in range(0, 90, 5) for r, t in (("user", "tie"), (None, "tie"), ("user", None))]  # ties
    out += [(c, t, "user", f"copy {t}") for c in range(1001, 1120) if c % 20 for t in range(5)]  # copies
    return [*out, *out[30:60], (None, 0, "user", "nobody"), (None, None, None, None)]  # rows that repeat, rows of no conversation


@pytest.mark.parametrize("shard_turns", [1 << 16, 300, 40])
def test_trie(spark, rows, shard_turns):
    table = spark.createDataFrame([(*r, 1, 2, [3], "clash") for r in rows], SCHEMA).repartition(3)
    got = trie.prefix_trie(trie.with_shared_openings(trie.conversations_of(table)), shard_turns)
    assert sorted((tuple(r) for r in got.collect()), key=str) == want(rebuilt(rows))


def test_trie_of_few(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert trie.prefix_trie(trie.with_shared_openings(trie.conversations_of(empty))).count() == 0
    for rows in ([(20, 1, "user", "a")], [(c, 0, "user", "a") for c in range(60)], [(c, t, "user", "w") for c in (1, 2, 3) for t in range(c)], [(7, t, "r", f"t{t % 3}") for t in range(150)]):
        table = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").coalesce(1)
        got = trie.prefix_trie(trie.with_shared_openings(trie.conversations_of(table)), 20)
        assert sorted((tuple(r) for r in got.collect()), key=str) == want(rebuilt(rows))


def test_turnless_members(spark):
    """A conversation that loses all its turns to an absent leader is a member of the root and of nothing else."""
    short = [c for c in range(1, 400) if c % 20 and zlib.crc32(str(c).encode()) % 4 == 3][:4]
    rows = [(c, 0, "user", "gone") for c in short] + [(401, t, "user", "kept") for t in range(9)]
    table = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    got = trie.prefix_trie(trie.with_shared_openings(trie.conversations_of(table)), 2)
    found = sorted((tuple(r) for r in got.collect()), key=str)
    assert found == want(rebuilt(rows)) and (short[0], 0, None, 5) in {r[:4] for r in found}


def test_middles_and_balance():
    for n in (0, 1, 2, 7, 100):
        assert sorted(trie.middles(n)) == [*range(n)]
    tree = trie.Tree()
    for i in trie.middles(1000):
        tree.insert([i], [1])
    depth, level = 0, [tree.eq[0]]
    while level := [c for x in level for c in (tree.lo[x], tree.hi[x]) if c >= 0]:
        depth += 1
    assert depth <= 10
