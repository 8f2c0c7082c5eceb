"""The trie of conversation prefixes against brute force, in one shard and in many."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from sievemark.llm import prefix_trie


def rebuilt_by_hand(rows):
    conversations = defaultdict(list)
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()
            conversations[conv_id].append((turn is not None, turn or 0, digest, role, text))
    own = {c: [t[3:] for t in sorted(turns)] for c, turns in conversations.items()}
    made = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        first = (abs(c) // 5 * 5) * (-1 if c < 0 else 1)
        made[c] = own.get(first, [])[:h] + turns[h:]
    return made


def trie_by_hand(sequences):
    members = defaultdict(list)
    for c, turns in sequences.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = defaultdict(int)
    for node in members:
        if node:
            children[node[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for node, of in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += not children[node]
            saved[node[:d]] += (len(of) - 1) * len(node[-1][1].encode()) if node else 0
    rows = []
    for node, of in members.items():
        ends = sorted(c for c in of if len(sequences[c]) == len(node))
        digest = hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()
        parent = min(members[node[:-1]]) if node else None
        rows.append((min(of), len(node), parent, len(of), children[node], leaves[node], saved[node], digest))
    return sorted(rows, key=repr)


def conversations():
    random.seed(51)
    says = ["hi", "Hi", "é", "", None, "x" * 50, "a b", "日本"]
    rows = []
    for c in [*range(-12, 130), 10**15, 10**15 + 1]:
        if c % 11 == 3 and c % 5 == 0:
            continue  # a group without its first conversation
        # A third are copies of one conversation, and most begin alike.
        size = 4 if c % 3 == 0 else random.choice([1, 2, 3, 9, 12])
        for turn in range(size):
            text = "the same" if c % 3 == 0 or turn == 0 else random.choice(says)
            rows.append((c, turn, random.choice(["user", "assistant", None]) if c % 3 else "user", text))
    rows += [(130, i, "user", random.choice(says[:2])) for i in range(150)]  # longer than a block of columns
    rows += [(131, i, "user", r[3]) for i, r in enumerate(rows[-150:])]
    rows += [(7, None, "user", "first"), (7, None, "user", "also first"), (8, 0, "user", "again"), (8, 0, "user", "again")]
    rows += [(None, 0, "user", "nobody's"), (200, 1, None, None)]
    return rows


@pytest.mark.parametrize("shard_turns", [10**6, 60, 7])
def test_trie_equals_brute_force(spark, shard_turns):
    rows = conversations()
    table = spark.createDataFrame(
        [(*r, 1, "x") for r in rows], "conv_id long, turn long, role string, text string, depth int, path string"
    )
    made = prefix_trie.with_group_heads(prefix_trie.sequences(table))
    wanted = rebuilt_by_hand(rows)
    assert {r.conv_id: len(r.turns) for r in made.collect()} == {c: len(t) for c, t in wanted.items()}
    found = prefix_trie.trie(made, shard_turns)
    assert sorted(map(tuple, found.collect()), key=repr) == trie_by_hand(wanted)


@pytest.mark.parametrize("shard_turns", [10**6, 3])
@pytest.mark.parametrize("seed", range(3))
def test_small_tries_in_shards_of_any_size(spark, shard_turns, seed):
    random.seed(seed)
    rows = [
        (c, turn, "user", random.choice("ab"))
        for c in range(1, 60)
        for turn in range(random.choice([0, 0, 1, 2, 3]))
    ] + [(c, 0, "user", "") for c in (60, 61, 62)]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    found = prefix_trie.trie(prefix_trie.sequences(table), shard_turns)
    by = defaultdict(list)
    for c, _, role, text in rows:
        by[c].append((role, text))
    assert sorted(map(tuple, found.collect()), key=repr) == trie_by_hand(by)


def test_trie_of_turnless_conversations_and_of_none(spark):
    # Conversation 3 keeps none of its turns: its first 8 give way to those of 0, which is not there.
    assert zlib.crc32(b"3") % 9 > 1
    schema = "conv_id long, turn long, role string, text string"
    table = spark.createDataFrame([(3, 0, "user", "a"), (3, 1, "user", "b")], schema)
    found = prefix_trie.trie(prefix_trie.with_group_heads(prefix_trie.sequences(table))).collect()
    assert [tuple(r) for r in found] == [(3, 0, None, 1, 0, 1, 0, hashlib.sha256(b"3").hexdigest())]
    empty = spark.createDataFrame([], schema)
    assert prefix_trie.trie(prefix_trie.sequences(empty)).collect() == []
