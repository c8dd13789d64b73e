import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from gridtide.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, depth long, weight string"


def table(spark, rows):
    return spark.createDataFrame([(*row, 1, "x") for row in rows], SCHEMA).repartition(3)


def expected(rows):
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()
            turns[conv].append((turn is not None, turn or 0, digest, (role, text)))
    own = {conv: [turn[-1] for turn in sorted(found)] for conv, found in turns.items()}
    rebuilt = {}
    for conv, seq in own.items():
        h = zlib.crc32(str(conv).encode()) % 9
        base = conv - (conv % 5 if conv >= 0 else -(-conv % 5))
        rebuilt[conv] = tuple(own.get(base, [])[:h] + seq[h:])
    members = defaultdict(list)
    for conv, seq in rebuilt.items():
        for depth in range(len(seq) + 1):
            members[seq[:depth]].append(conv)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    totals = {}
    for node in sorted(members, key=len, reverse=True):
        below = [totals[child] for child in children[node]]
        saved = (len(members[node]) - 1) * (len(node[-1][1].encode()) if node else 0)
        totals[node] = (sum(leaves for leaves, _ in below) or 1, saved + sum(saved for _, saved in below))
    out = []
    for node, convs in members.items():
        ends = ",".join(map(str, sorted(conv for conv in convs if rebuilt[conv] == node)))
        parent = min(members[node[:-1]]) if node else None
        out.append((min(convs), len(node), parent, len(convs), len(children[node]), *totals[node], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out)


def found_in(spark, rows, **settings):
    return sorted(tuple(row) for row in prefix_trie.prefix_trie(table(spark, rows), **settings).collect())


def made_rows(seed, convs):
    rng = random.Random(seed)
    rows = []
    for conv in convs:
        for turn in range(rng.choice([1, 2, 3, 5, 9, 14])):
            text = rng.choice(["hi", "hi", "yes", None, "", "ünï", "long " * 30])
            rows.append((conv, turn if turn else rng.choice([None, 0]), rng.choice(["user", "user", None]), text))
    return rows


# Small chunks and blocks cut every conversation, as very long ones are cut otherwise.
@pytest.mark.parametrize("settings", [{}, {"chunk": 3, "rows_per_block": 7}])
def test_equals_brute_force(spark, settings):
    rows = made_rows(1, [*range(60), -7, -5, -1, 10**12, 10**12 + 3])
    assert found_in(spark, rows, **settings) == expected(rows)


def test_odd_rows(spark):
    tied = [(0, 1, "a", "x"), (0, 1, "a", "y"), (0, None, "b", "z"), (0, 2, "ab", "c"), (0, 2, "a", "bc")]
    copies = [(3, 1, "r", "same")] * 40 + [(3, 2, None, None)]
    rows = tied + copies + [(None, 1, "r", "no id"), (4, 1, "u", "w " * 50_000), (11, 1, "u", "only own")]
    assert found_in(spark, rows, rows_per_block=5, chunk=4) == expected(rows)


def test_one_turnless_conversation_and_an_empty_table(spark):
    conv = next(c for c in range(1, 100) if c % 5 and zlib.crc32(str(c).encode()) % 9 > 0)
    assert found_in(spark, [(conv, 1, "u", "gone")]) == expected([(conv, 1, "u", "gone")])
    assert found_in(spark, []) == []


def test_many_alike_conversations_with_one_long_one(spark):
    rows = [(5 * i, turn, "u", "common") for i in range(200) for turn in range(2)]
    rows += [(1, turn, "u", f"t{turn % 3}") for turn in range(500)]
    assert found_in(spark, rows, rows_per_block=50, chunk=16) == expected(rows)
