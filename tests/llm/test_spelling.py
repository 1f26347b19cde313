"""Spelling variants against all pairs of words."""

from __future__ import annotations

import itertools
import random
import re
import zlib
from collections import Counter

import pytest

from shelfpulse.llm import skew, spelling
from shelfpulse.llm.common import Scratch

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_force(docs):
    counts = Counter()
    for d, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if d is None else d}:{run}".encode())
            counts[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 97 == 0 else run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}
    beside = {w: [] for w in words}
    for a, b in itertools.combinations(words, 2):
        if near(a, b):
            beside[a].append(b)
            beside[b].append(a)
    form = {}
    for w, found in beside.items():
        best = min(found, key=lambda x: (-words[x], x), default=None)
        form[w] = best if best and words[best] >= 2 * words[w] else None
    rows = []
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        rows.append((w, form[w], root, n, len(beside[w]), words.get(form[w])))
    return sorted(rows)


def found(spark, docs):
    frame = spark.createDataFrame([(d, t, "x", 1) for d, t in docs], "doc_id bigint, text string, word string, n int")
    return sorted(tuple(r) for r in spelling.variants(frame, Scratch(spark)).collect())


@pytest.mark.parametrize("letters", ["ab", "abcÀé", "abcdefghijklmnop÷ÿ"])
def test_equals_brute_force(spark, letters, monkeypatch):
    monkeypatch.setattr(skew, "LEAST", 30)
    monkeypatch.setattr(spelling, "HELD", 50)
    rng = random.Random(len(letters))
    words = ["".join(rng.choices(letters, k=rng.randint(4, 9))) for _ in range(150)]
    for w in words[:60]:
        at = rng.randrange(len(w))
        words += [w[:at] + w[at + 1 :], w[:at] + rng.choice(letters) + w[at:], w[:at] + rng.choice(letters) + w[at + 1 :]]
    words += [letters[0] * n for n in range(4, 40)]  # one bigram at every place
    weights = [rng.choice([1, 2, 5, 20]) for _ in words]
    docs = []
    for d in range(120):
        picked = rng.choices(words, weights, k=60)
        picked = [w.upper() if rng.random() < 0.1 and w.isascii() else w for w in picked]
        docs.append((d, rng.choice([" ", ", ", "1"]).join(picked)))
    want = brute_force(docs)
    assert sum(r[4] for r in want) > 100 and any(r[2] not in (r[0], r[1]) for r in want)
    assert found(spark, docs) == want


def test_awkward_rows(spark):
    long = "x" * 300_000
    docs = [
        (1, None), (2, ""), (3, " 1 2 "), (None, "Zebras zebras ZEBRAS"), (4, "zebra zebra zebra"), (5, f"{long} {long} {long}"),
        (5, f"{long} {long} {long}"), (6, "ÉCOLE École école ecole ecole ecole"), (7, "×÷×÷×ß ×÷×÷×ß ×÷×÷×ß"),
        (8, "一二三四五 " * 5), (None, None),
    ]
    assert found(spark, docs) == brute_force(docs)
    assert found(spark, []) == []


def test_one_edit():
    for a, b in itertools.product(["".join(x) for n in range(5) for x in itertools.product("ab", repeat=n)], repeat=2):
        assert spelling.one_edit(a, b) == (a != b and near(a, b))


def test_pieces_end_between_runs():
    text = ("één-Word ÀÿÖ÷ 一二wörds3" * 200).encode()
    want = re.findall("[A-Za-zÀ-ÿ]+", text.decode())
    for size in (1, 7, 50, 1 << 20):
        pieces = list(spelling._pieces(memoryview(text), size))
        assert "".join(pieces) == text.lower().decode()
        assert [x for p in pieces for x in re.findall("[A-Za-zÀ-ÿ]+", p)] == [w.translate(LOWER) for w in want]


def test_cheapest_pivots():
    rng = random.Random(8)
    for _ in range(500):
        places = rng.sample(range(9), rng.randint(3, 6))
        weight = [rng.randint(0, 9) for _ in places]
        grams = list(enumerate(places))
        options = [
            sum(weight[g] for g, _ in pair)
            for pair in itertools.combinations(grams, 2)
            if abs(pair[0][1] - pair[1][1]) >= 2
        ]
        chosen = spelling.pivots(grams, weight)
        assert sum(weight[g] for g, _ in chosen) == min(options)
        assert abs(chosen[0][1] - chosen[1][1]) >= 2
