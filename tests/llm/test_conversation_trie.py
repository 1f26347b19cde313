"""The trie of conversations against a dictionary of prefixes."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from shelfpulse.llm import conversation_trie, skew
from shelfpulse.llm.common import Scratch

SCHEMA = "conv_id bigint, turn bigint, role string, text string, depth string, parent string"


def name(role, text):
    return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()


def brute_force(rows):
    original = defaultdict(list)
    for c, turn, role, text, *_ in rows:
        if c is not None:
            role, text = role or "", text or ""
            original[c].append((turn is not None, turn or 0, name(role, text), (role, text)))
    turns = {c: [t[3] for t in sorted(own)] for c, own in original.items()}
    whole = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (abs(c) % 20) * (1 if c >= 0 else -1)
        whole[c] = tuple(turns.get(base, [])[:h] + own[h:])
    members, below = defaultdict(list), defaultdict(set)
    for c, path in whole.items():
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
            if d:
                below[path[: d - 1]].add(path[:d])

    def totals(path):
        saved = (len(members[path]) - 1) * len(path[-1][1].split()) if path else 0
        leaves = 0 if below[path] else 1
        for child in below[path]:
            more = totals(child)
            leaves, saved = leaves + more[0], saved + more[1]
        return leaves, saved

    found = []
    for path, own in list(members.items()):
        ends = ",".join(str(c) for c in sorted(own) if whole[c] == path)
        parent = min(members[path[:-1]]) if path else None
        sha = hashlib.sha256(ends.encode()).hexdigest()
        found.append((min(own), len(path), parent, len(own), len(below[path]), *totals(path), sha))
    return sorted(found, key=str)


def trie(spark, rows):
    frame = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)
    return sorted((tuple(r) for r in conversation_trie.conversation_trie(frame, Scratch(spark)).collect()), key=str)


@pytest.mark.parametrize("seed", range(2))
def test_equals_brute_force(spark, seed, monkeypatch):
    monkeypatch.setattr(skew, "LEAST", 5)  # salts the parents of many
    monkeypatch.setattr(conversation_trie, "ID_BITS", 3)
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(-50, 400), 200):
        for turn in range(rng.choice([1, 2, 3, 4, 9, 17 if seed else 1])):
            rows.append((c, turn * 3 - 1, rng.choice(["user", "assistant"]), rng.choice(["a b", "c", "d  e\nf"])))
    rng.shuffle(rows)
    assert trie(spark, rows) == brute_force(rows)


def test_awkward_rows(spark):
    long = " ".join(f"w{i}" for i in range(50_000))
    rows = [
        (None, 0, "user", "no conversation"), (0, None, None, None), (0, 0, "", ""), (0, 0, "", ""), (0, 1, "user", long),
        (20, 5, "b", "tie"), (20, 5, "a", "tie"), (21, 0, "user", "x"), (21, 1, "user", "x"), (7, 0, "ab", "c"), (8, 0, "a", "bc"),
    ]
    rows += [(c, 0, "u", "first of its family is missing") for c in range(61, 80)]  # some have no turn left
    assert trie(spark, rows) == brute_force(rows)
    assert trie(spark, []) == []
    turnless = [(c, 0, "u", "t") for c in range(61, 80) if zlib.crc32(str(c).encode()) % 4]
    found = trie(spark, turnless)
    assert found == brute_force(turnless) and len(found) == 1 and found[0][5] == 1


def test_long_and_crowded(spark):
    """A conversation with a third of all turns, and one that a third of all conversations repeat."""
    rows = [(1, t, "u", f"t{t % 5}") for t in range(130)]
    rows += [(c, t, "u", "same") for c in range(100, 400) for t in range(2)]
    rows += [(c, t, "u", f"{c}") for c in range(400, 900) for t in range(2)]
    assert trie(spark, rows) == brute_force(rows)
