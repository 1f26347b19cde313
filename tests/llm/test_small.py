"""Hand-made rows: awkward input, method pieces against brute force, recall, and persistence."""

from __future__ import annotations

import itertools
import math
import random
import resource
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from shelfpulse.llm import (
    components,
    embedding_dedup,
    exact_dedup,
    language_model,
    line_dedup,
    naming,
    packing,
    pieces,
    quality,
    sieve,
    simhash_dedup,
    skew,
    substring_dedup,
    suffix_dedup,
)
from shelfpulse.llm import repeats as repeats_module
from shelfpulse.llm.common import Scratch, word_bounds

LONG = " ".join(f"w{i}" for i in range(30_000))
PASSAGE = " ".join(f"p{i}" for i in range(60))
DOCS = "doc_id bigint, text string, n_units string, component_id string, kept string, _statistics int, score int"


@pytest.fixture(scope="module")
def awkward(spark):
    """Nulls, empty and long texts, repeated rows, ties, and columns with names of results."""
    texts = [
        (1, None), (2, ""), (3, " \t\n"), (4, LONG), (5, LONG), (6, f"a {PASSAGE} b"), (6, f"a {PASSAGE} b"),
        (7, f"c\n{PASSAGE}  d"), (None, f"e {PASSAGE} f"), (8, "one"), (9, "one"), (10, "ünï▁ \U0001f600 <|endoftext|>"),
        (None, None),
    ]
    return spark.createDataFrame([(d, t, "x", "y", "z", 1, 2) for d, t in texts], DOCS)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture()
def scratch(spark):
    return Scratch(spark)


def by_id(frame):
    return {r.doc_id: r for r in frame.collect() if r.doc_id is not None}


def test_exact_dedup(awkward, empty, scratch):
    found = exact_dedup.deduplicate(awkward, scratch, 4).collect()
    assert len(found) == awkward.count()
    got = {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in found if r.doc_id is not None}
    assert got[1] == (1, 3, True) and got[2] == (1, 3, False)  # null is empty; the null id too
    assert got[5] == (4, 2, False) and got[9] == (8, 2, False)
    assert [r.kept for r in found if r.doc_id == 6] == [True, True]
    assert exact_dedup.deduplicate(empty, Scratch(empty.sparkSession), 4).count() == 0


def test_exact_index_persists(spark, scratch):
    first = spark.createDataFrame([(5, "a b"), (6, "c")], "doc_id bigint, text string")
    second = spark.createDataFrame([(1, "a  b"), (2, "d"), (3, "d")], "doc_id bigint, text string")
    path = scratch.folder("kept")
    exact_dedup.DigestIndex(spark, path, 4).add(first, scratch).collect()
    again = exact_dedup.DigestIndex(spark, path, 4)
    got = {r.doc_id: (r.keep_id, r.kept) for r in again.add(second, scratch).collect()}
    assert got == {1: (5, False), 2: (2, True), 3: (2, False)}
    again.add(second, scratch)
    assert again.table().count() == 3
    plan = again.table().hint("merge").join(again.table(), "digest", "left_anti")
    assert "Exchange" not in plan._jdf.queryExecution().executedPlan().toString()


def repeats(texts, split, window):
    """Brute force: which units of each document a window of an earlier document covers."""
    first = {}
    for d, text in texts:
        units = split(text)
        for i in range(len(units) - window + 1):
            key = tuple(units[i : i + window])
            first[key] = min(first.get(key, d), d)
    gone = {}
    for d, text in texts:
        units, mask = split(text), set()
        for i in range(len(units) - window + 1):
            if first[tuple(units[i : i + window])] < d:
                mask.update(range(i, i + window))
        gone[d] = (units, mask)
    return gone


@pytest.mark.parametrize("seed", range(4))
def test_repeats_equal_brute_force(spark, seed):
    rng = random.Random(seed)
    vocabulary = [chr(97 + i) for i in range(3 + 20 * (seed % 2))]
    shared = [" ".join(rng.choices(vocabulary, k=12)) for _ in range(4)]
    texts = []
    for d in range(60):
        parts = [" ".join(rng.choices(vocabulary, k=rng.randint(0, 15)))]
        parts += rng.choices(shared, k=rng.randint(0, 3)) + parts[: rng.randint(0, 1)]
        rng.shuffle(parts)
        texts.append((d, rng.choice([" ", "\n "]).join(parts)))
    docs = spark.createDataFrame(texts, "doc_id bigint, text string")
    found = by_id(substring_dedup.remove_repeats(docs, Scratch(spark), window=8, seed=3))
    for d, (units, gone) in repeats(texts, str.split, 8).items():
        assert found[d].text.split() == [u for i, u in enumerate(units) if i not in gone]
        assert (found[d].n_units, found[d].n_removed) == (len(units), len(gone))
    found = by_id(suffix_dedup.remove_repeats(docs, Scratch(spark), window=20, depth=6))
    for d, (units, gone) in repeats(texts, str.encode, 20).items():
        assert bytes(found[d].text) == bytes(u for i, u in enumerate(units) if i not in gone)
        assert found[d].n_spans == sum(i in gone and i - 1 not in gone for i in range(len(units)))


@pytest.mark.parametrize("few, crowded", [(1.0, 1 << 13), (1.0, 2), (0.0, 1 << 13), (0.0, 0)])
def test_every_way_of_comparing_windows_equals_brute_force(spark, monkeypatch, few, crowded):
    monkeypatch.setattr(repeats_module, "FEW", few)
    monkeypatch.setattr(repeats_module, "CROWDED", crowded)
    rng = random.Random(7)
    shared = ["".join(rng.choices("abcd", k=60)) for _ in range(5)]
    texts = []
    for d in range(90):
        parts = [rng.choice(shared)[rng.randint(0, 20) : rng.randint(40, 60)] for _ in range(rng.randint(0, 4))]
        texts.append((d // 2 if d < 10 else d, "".join(x + rng.choice(["", "é", "y" * 40]) for x in parts)))
    docs = spark.createDataFrame([*texts, (None, shared[0]), (95, None)], "doc_id bigint, text string")
    found = suffix_dedup.remove_repeats(docs, Scratch(spark), window=20, depth=8).collect()
    first = {}
    for d, text in texts:
        for i in range(len(text.encode()) - 19):
            key = text.encode()[i : i + 20]
            first[key] = min(first.get(key, d), d)
    want = [(95, b""), (None, shared[0].encode())]
    for d, text in texts:
        data = text.encode()
        gone = {j for i in range(len(data) - 19) if first[data[i : i + 20]] < d for j in range(i, i + 20)}
        want.append((d, bytes(u for i, u in enumerate(data) if i not in gone)))
    assert sorted(((r.doc_id, bytes(r.text)) for r in found), key=str) == sorted(want, key=str)


def test_open_runs_stay_one_row_each(spark):
    rng = random.Random(3)
    passage = "".join(rng.choices("abcdefgh", k=400))
    texts = [(d, "".join(rng.choices("ijklmnop", k=50)) + passage[d : 300 + d]) for d in range(40)]
    docs, rows = spark.createDataFrame(texts, "doc_id bigint, text string"), []

    class Counted(Scratch):
        def table(self, df, name):
            written = super().table(df, name)
            rows.append((name, written.count()))
            return written

    suffix_dedup.remove_repeats(docs, Counted(spark)).collect()
    written = {n: [k for name, k in rows if name == n] for n in ("shared", "found", "windows")}
    # Runs are named and written in one pass, and windows are not rows of their own.
    assert len(written["shared"]) == 1
    assert 0 < written["windows"][0] <= written["found"][0]


def test_same_windows_go_on_over_batches():
    names = ["doc_id", "text_key", "anchor", "crowded", "place", "names"]
    runs = [(1, 0, 5, False, 3 << 16 | 2, [7, 8, 9]), (2, 0, 5, False, 10 << 16 | 3, [6, 7, 8, 4]), (3, 0, 5, False, 0, [9]),
            (1, 0, 6, False, 9 << 16, [7]), (1, 0, 6, False, 20 << 16, [7])]
    for size in (1, 2, 5):
        parts = [runs[i : i + size] for i in range(0, len(runs), size)]
        batches = [pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*part, strict=True)], names) for part in parts]
        found = [row for out in repeats_module._same_windows(iter(batches)) for row in out.to_pylist()]
        assert [(r["doc_id"], r["place"]) for r in found] == [(2, 11 << 16 | 1), (3, 0)]
    assert list(repeats_module._same_windows(iter([]))) == []


def test_repeats_of_awkward_rows(awkward, empty, scratch):
    found = substring_dedup.remove_repeats(awkward, scratch)
    assert set(found.columns) == {*awkward.columns, "n_removed", "n_spans"}
    rows = found.collect()
    assert sorted((r.doc_id or 0, r.n_removed) for r in rows if r.n_removed) == [(5, 30_000), (7, 60)]
    assert by_id(found)[7].text == "c\nd" and by_id(found)[1].text == ""
    rows = suffix_dedup.remove_repeats(awkward, Scratch(awkward.sparkSession)).collect()
    assert len(rows) == awkward.count() and bytes({r.doc_id: r for r in rows}[5].text) == b""
    for module in (substring_dedup, suffix_dedup):
        assert module.remove_repeats(empty, Scratch(empty.sparkSession)).count() == 0


def test_components(spark, scratch):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(200, 260)] + [(rng.randrange(100), rng.randrange(100)) for _ in range(60)]
    frame = spark.createDataFrame([*edges, (5, 5), (None, 3)], "a bigint, b bigint")
    found = {r.node: r.component for r in components.components(frame, scratch).collect()}
    parent = {x: x for e in edges for x in e}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    linked = {x for a, b in edges if a != b for x in (a, b)}
    assert found == {x: root(x) for x in linked if x != root(x)}


def test_simhash_cells_meet_within_four_bits():
    rng = np.random.default_rng(1)
    for _ in range(300):
        a = rng.integers(0, 1 << 64, dtype=np.uint64)
        bits = rng.choice(64, size=rng.integers(0, 5), replace=False)
        b = a ^ np.bitwise_or.reduce(np.uint64(1) << bits.astype(np.uint64), initial=np.uint64(0))
        cells = [set(simhash_dedup.cells(np.array([x]))[1].tolist()) for x in (a, b)]
        assert cells[0] & cells[1]


def test_simhash_links(spark, scratch):
    rng = np.random.default_rng(2)
    centres = rng.integers(0, 1 << 64, 40, dtype=np.uint64)
    prints = set(centres.tolist())
    for c in centres[:4].tolist():  # crowded neighbourhoods, dealt to blocks
        for _ in range(120):
            prints.add(c ^ sum(1 << int(b) for b in rng.choice(64, rng.integers(1, 4), replace=False)))
    values = np.array(sorted(prints), dtype=np.uint64)
    place = {int(v): i for i, v in enumerate(values.view(np.int64))}
    frame = spark.createDataFrame([(v,) for v in place], "print bigint")
    edges = simhash_dedup.link(frame, block=32)
    edges = spark.createDataFrame([(place[r.a], place[r.b]) for r in edges.collect()], "a bigint, b bigint")
    found = {r.node: r.component for r in components.components(edges, scratch).collect()}
    near = np.bitwise_count(values[:, None] ^ values[None, :]) <= 4
    label = np.arange(len(values))
    for _ in range(len(values)):
        new = np.where(near, label[None, :], len(values)).min(axis=1)
        if (new == label).all():
            break
        label = new
    assert [found.get(i, i) for i in range(len(values))] == label.tolist()


def test_simhash_entries_are_not_shuffled_for_few_crowded_cells(spark, scratch):
    limit = "spark.sql.autoBroadcastJoinThreshold"
    prints = scratch.table(spark.range(4000).select(F.xxhash64("id").alias("print")), "prints")
    usual = spark.conf.get(limit)
    spark.conf.set(limit, "8k")  # less than the prints
    try:
        plan = simhash_dedup.link(prints, scratch=scratch)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(limit, usual)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_simhash_of_awkward_rows(awkward, empty, scratch):
    found = simhash_dedup.near_duplicates(awkward, scratch)
    rows = by_id(found)
    assert found.count() == awkward.count()
    assert {rows[d].component_id for d in (1, 2, 3)} == {1} and rows[1].print == 0
    assert rows[5].component_id == 4 and rows[9].component_id == 8
    assert simhash_dedup.near_duplicates(empty, Scratch(empty.sparkSession)).count() == 0


def test_simhash_links_through_rows_without_id(spark, scratch):
    prints = [(1, 0), (None, 15), (2, 255), (3, 4095), (4, 255 << 40), (4, 0)]
    rows = spark.createDataFrame(prints, "doc_id bigint, print bigint")
    found = simhash_dedup.classified(scratch.table(rows, "prints"), scratch).collect()
    assert {(r.doc_id, r.print): r.component_id for r in found} == {
        (1, 0): 1, (None, 15): 1, (2, 255): 1, (3, 4095): 1, (4, 0): 1, (4, 255 << 40): 4
    }


def test_one_of_each_simhash_group_stays(spark, awkward, empty):
    left = simhash_dedup.keep_one(awkward, Scratch(spark))
    assert left.columns == awkward.columns
    assert sorted((r.doc_id or 0 for r in left.collect())) == [0, 0, 1, 4, 6, 6, 8, 10]  # 7 shares nearly all shingles with 6
    assert simhash_dedup.keep_one(empty, Scratch(spark)).count() == 0
    # An id that repeats with another text: only the row that is a copy goes.
    words = [" ".join(f"{c}{i}" for i in range(20)) for c in "ab"]
    docs = spark.createDataFrame([(1, words[0]), (2, words[0]), (2, words[1])], "doc_id bigint, text string")
    assert sorted(simhash_dedup.keep_one(docs, Scratch(spark)).collect()) == [(1, words[0]), (2, words[1])]


PRIVATE = ("_text_key", "_drop", "_repeats", "_statistics", "n_lines", "N_DROPPED", "print", "score", "a.b", "text_key")


def test_stages_keep_clashing_columns(spark):
    from corpus_pipeline import STAGES

    rng = random.Random(5)
    texts = [f"{' '.join(own_lines(rng, d))}\n{FOOTER}\n{PASSAGE}" for d in range(12)]
    rows = [(d, t, *(f"{n}{d}" for n in PRIVATE)) for d, t in enumerate([*texts, texts[0]])]
    schema = ", ".join(["doc_id bigint", "text string", *(f"`{n}` string" for n in PRIVATE)])
    docs = spark.createDataFrame(rows, schema)
    labels = spark.createDataFrame([(d, 1, 0) for d in range(13)], "doc_id bigint, quality int, toxic int")
    stages = [(name, stage(spark, docs, "")) for name, stage in STAGES[1:4]]
    for name, done in [*stages, ("quality classifier", quality.keep_good(docs, labels, Scratch(spark)))]:
        assert done.columns == docs.columns, name
        for row in done.collect():
            assert list(row)[2:] == [f"{n}{row.doc_id}" for n in PRIVATE], name


def thue_morse(n):
    return "".join("ab"[i.bit_count() % 2] for i in range(n))


@pytest.mark.parametrize("size", [1024, 2048])
def test_names_of_thue_morse_words_differ(spark, scratch, size):
    words = [thue_morse(size), thue_morse(size).translate(str.maketrans("ab", "ba"))]
    head = " ".join(f"w{i}" for i in range(49))
    texts = [f"{head} {w}" for w in words]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    assert docs.count() == substring_dedup.remove_repeats(docs, scratch).filter("n_removed = 0").count()
    data = np.frombuffer(" ".join(words).encode(), dtype=np.uint8)
    starts, ends, _ = word_bounds(data, np.array([0, len(data)]))
    assert len(set(naming.word_names(data, starts, ends).tolist())) == 2
    assert quality.measure(data, np.array([0, len(data)]))[0][quality.STATISTICS.index("distinct")] == 1.0
    # Runs of single letters in the same order, as words, are told apart as well.
    spelled = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(words)], docs.schema)
    want = repeats([(i, " ".join(w)) for i, w in enumerate(words)], str.split, 50)
    found = by_id(substring_dedup.remove_repeats(spelled, Scratch(spark)))
    assert [found[i].n_removed for i in range(2)] == [len(want[i][1]) for i in range(2)]
    model = language_model.train(docs, Scratch(spark))
    assert model.words == 52


def test_word_names():
    rng = np.random.default_rng(3)
    words = {rng.integers(33, 36, n).astype(np.uint8).tobytes() for n in rng.integers(1, 90, 4000)}
    words |= {w + b"!" for w in words} | {b"", b"\0", b"\0\0"}
    words = sorted(words)
    data = np.frombuffer(b"".join(words) * 2, dtype=np.uint8)
    ends = np.cumsum([len(w) for w in words] * 2)
    starts = ends - [len(w) for w in words] * 2
    names = naming.word_names(data, starts, ends)
    assert (names[: len(words)] == names[len(words) :]).all()
    assert len(set(names.tolist())) == len(words)


def test_span_names():
    values = np.random.default_rng(4).integers(0, 3, 300).astype(np.uint64)
    spans = naming.Spans(values)
    starts, ends = (x.ravel() for x in np.meshgrid(np.arange(200), np.arange(200)))
    keep = starts <= ends
    named = {}
    for a, b, name in zip(starts[keep], ends[keep], spans.of(starts[keep], ends[keep]).tolist(), strict=True):
        assert named.setdefault(tuple(values[a:b]), name) == name
    assert len(set(named.values())) == len(named)
    for n in (1, 2, 7, 50):
        at = np.arange(300 - n + 1)
        assert (spans.all_of(n) == spans.of(at, at + n)).all()


@pytest.mark.parametrize("how", ["inner", "left", "left_semi"])
def test_salted_join_equals_join(spark, scratch, how):
    rows = [(i % 7 if i < 300 else 0, i) for i in range(6000)] + [(None, -1)]
    many = spark.createDataFrame(rows, "key bigint, i bigint")
    few = spark.createDataFrame([(0, "a"), (3, "b"), (9, "c"), (None, "d")], "key bigint, value string")
    counts = scratch.table(many.groupBy("key").agg(F.count("*").alias("n")), "counts")
    heavy = skew.heavy_keys(counts, ["key"])
    assert heavy == [r[0] for r in spark.range(1).select(F.xxhash64(F.lit(0).cast("bigint"))).collect()]
    assert skew.heavy_keys(counts.filter("key > 0"), ["key"]) == []
    found = skew.salted_join(many, few, ["key"], heavy, F.xxhash64("i"), how)
    plain = many.join(few, ["key"], how)
    assert found.columns == plain.columns
    assert sorted(found.collect(), key=str) == sorted(plain.collect(), key=str)


@pytest.mark.parametrize("most", [1, 1 << 20])
def test_sieve_joins_as_a_plain_join(spark, scratch, most):
    ids = F.when(F.col("id") % 50 != 0, F.col("id") % 2000)
    rows = spark.range(10_000).select(ids.alias("key"), F.col("id").alias("row"))
    few = spark.range(500).select(F.when(F.col("id") > 0, F.col("id") * 7).alias("few"), F.array("id").alias("list"))
    few = scratch.table(few.unionByName(few.limit(20)), "few")
    held = sieve.Sieve(few.select(F.col("few").alias("key")), ["key"], scratch, most=most)
    same = F.col("key") == F.col("few")
    want, found = rows.join(few, same, "left"), held.left_join(rows, few, same)
    assert found.dtypes == want.dtypes and found.count() == want.count()
    assert found.exceptAll(want).count() == 0
    short = rows.withColumn("key", F.col("key").cast("int"))
    assert held.left_join(short, few, same).filter("list IS NOT NULL").count() == want.filter("list IS NOT NULL").count()
    passed, matching = held.passed(rows), rows.join(few, same, "left_semi")
    assert passed.columns == rows.columns and matching.exceptAll(passed).count() == 0
    assert passed.count() < (1.2 * matching.count() if most > 1 else rows.count() + 1)


def test_texts_that_stay_whole_are_not_shuffled(spark, scratch):
    limit = "spark.sql.autoBroadcastJoinThreshold"
    usual = spark.conf.get(limit)
    spark.conf.set(limit, "-1")
    pages = [(d, f"word{d} {'x' * d}\n{FOOTER}" if d < 20 else f"whole text {d} {PASSAGE[d:]} end") for d in range(200)]
    docs = scratch.table(spark.createDataFrame(pages, "doc_id bigint, text string"), "docs")
    try:
        for done in (line_dedup.drop_recurring(docs, scratch), substring_dedup.remove_repeats(docs, scratch)):
            plan = done._jdf.queryExecution().optimizedPlan().toString()
            assert "Union" in plan and "_sieve_mask" in plan
    finally:
        spark.conf.set(limit, usual)


def test_equal_lines_get_their_template_once(spark, scratch):
    tables = {}

    class Kept(Scratch):
        def table(self, df, name):
            tables[name] = super().table(df, name)
            return tables[name]

    rng = random.Random(13)
    texts = ["\n".join([*own_lines(rng, d), LICENCE]) for d in range(40)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    found = line_dedup.drop_recurring(docs, Kept(spark))
    assert found.agg(F.sum("n_dropped")).first()[0] == 39
    assert tables["lines"].count() == 40 and tables["made"].count() == 1


def test_vectors(spark, scratch, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "BLOCK", 40)
    rng = np.random.default_rng(4)
    x = rng.normal(size=(300, 16))
    x[100:150] = x[:50] + 0.12 * rng.normal(size=(50, 16))
    x[200:260] = x[3]  # copies
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    rows += [(900, None), (901, [0.0] * 16), (902, [float("nan")] * 16), (903, [float("inf")] * 16), (904, []), (905, [1.0, None]), (906, (x[0] * 7).tolist()), (907, [1.0, 2.0])]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    found = {r.vec_id: r for r in embedding_dedup.near_duplicates(frame, scratch).collect()}
    assert len(found) == len(rows)
    assert all((found[i].n_links, found[i].component_id, found[i].kept) == (0, i, True) for i in (900, 901, 902, 903, 904, 905, 907))
    assert found[906].component_id == 0
    u = np.vstack([x, x[0] * 7])
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    near = (u @ u.T >= 0.9).sum(axis=1) - 1
    got = [found[i].n_links for i in [*range(300), 906]]
    assert sum(got) >= 0.98 * near.sum() and all(g <= n for g, n in zip(got, near, strict=True))
    assert found[259].component_id == 3 and not found[259].kept
    none = spark.createDataFrame([], "vec_id bigint, embedding array<float>")
    assert embedding_dedup.near_duplicates(none, Scratch(spark)).count() == 0


def test_recall_of_the_threshold():
    """Pairs exactly at the threshold, the hardest ones."""
    rng = np.random.default_rng(5)
    x = embedding_dedup.unit(rng.normal(size=(2000, 64)))
    y = rng.normal(size=x.shape)
    y -= (y * x).sum(axis=1, keepdims=True) * x
    y = 0.901 * x + math.sqrt(1 - 0.901**2) * embedding_dedup.unit(y)
    i, j = embedding_dedup.near_pairs(x, y, 0.9)
    assert (i == j).sum() >= 0.99 * len(x)


def test_pieces_best_paths():
    found = pieces._pieces(pieces.model_file())

    def brute(text):
        edges, paths = found.edges(" " + text), []

        def walk(at, score, path):
            if at == len(text) + 1:
                paths.append(score)
            for i, j, own, piece in edges:
                if i == at:
                    walk(j, score + own, [*path, piece])

        walk(0, 0.0, [])
        return sorted(paths, reverse=True)[:5]

    for text in ("hello wor", "the cat\n", "naïve été", "日本 \U0001f600x", "  a  b ", "▁x y"):
        best = found.encode(text, 5)
        assert [s for s, _ in best] == pytest.approx(brute(text))
        assert all(found.decode(ids) == text for _, ids in best)
        assert found.encode(text)[0] == best[0]


def test_pieces_of_awkward_rows(awkward, empty):
    encoded = pieces.encode(awkward, 2)
    assert encoded.count() == awkward.count() and encoded.filter("NOT decoded").count() == 0
    back = by_id(pieces.decode(encoded.select("doc_id", F.col("ids")[0].alias("ids"))))
    assert {d: r.text for d, r in back.items()} == {d: r.text or "" for d, r in by_id(awkward).items()}
    assert pieces.encode(empty).count() == 0


def test_model_probabilities_sum_to_one(spark, scratch):
    rng = random.Random(6)
    vocabulary = [f"v{i}" for i in range(12)]
    texts = [(i, " ".join(rng.choices(vocabulary, range(1, 13), k=rng.randint(0, 30)))) for i in range(80)]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string")
    model = language_model.train(docs, scratch)
    data = np.frombuffer(" ".join(vocabulary).encode(), dtype=np.uint8)
    known, _ = language_model.tokens(data, np.array([0, len(data)]))  # all words and the end
    unknown = np.array([12345], dtype=np.uint64)
    after = np.concatenate((known, unknown))
    for before in (*known[:-1], unknown[0], language_model.START):
        _, score = language_model.token_scores(model, after, np.full(len(after), before))
        assert (10**score).sum() == pytest.approx(1)


def kneser_ney(texts, before, word):
    """The model written out: pairs seen once are left to the lower order."""
    pairs = {}
    for text in texts:
        line = ["<", *text.lower().split(), ">"]
        for p in itertools.pairwise(line):
            pairs[p] = pairs.get(p, 0) + 1
    follows, after = {}, {}
    for (a, b), n in pairs.items():
        follows[b] = follows.get(b, 0) + 1
        after.setdefault(a, []).append(n)

    def d_of(counts):
        return language_model.discounts(*(sum(c == k for c in counts) for k in (1, 2, 3, 4)))

    low, high = d_of(follows.values()), d_of(pairs.values())
    off = lambda n, d: d[min(n, 3) - 1] if n else 0.0
    rest = sum(off(n, low) for n in follows.values()) / len(pairs)
    n = follows.get(word, 0)
    lower = (n - off(n, low)) / len(pairs) + rest / (len(follows) + 1)
    seen = after.get(before)
    if not seen:
        return lower
    left = sum(1 if c == 1 else off(c, high) for c in seen)
    n = pairs.get((before, word), 0)
    return ((n - off(n, high) if n > 1 else 0) + left * lower) / sum(seen)


def test_model_equals_formula(spark, scratch):
    rng = random.Random(7)
    texts = [" ".join(rng.choices("aBcdefgh", range(1, 9), k=rng.randint(0, 25))) for _ in range(50)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    model = language_model.train(docs, scratch, min_pair=2)  # what kneser_ney computes
    rows = [(1, False, "a b h new c"), (2, True, ""), (3, False, None), (None, None, "a")]
    frame = spark.createDataFrame(rows, "doc_id bigint, held_out boolean, text string")
    got = {r.doc_id: r for r in language_model.score(frame, model).collect()}
    for d, _, text in rows:
        line = ["<", *(text or "").split(), ">"]
        want = sum(math.log10(kneser_ney(texts, a, b)) for a, b in itertools.pairwise(line))
        assert got[d].score == pytest.approx(want) and got[d].n_tokens == len(line) - 1


def full_kneser_ney(texts):
    """Modified Kneser-Ney of order 2 with nothing left out, as a function of (before, word)."""
    pairs = Counter(p for t in texts for p in itertools.pairwise(["<", *t.lower().split(), ">"]))
    follows, after = Counter(b for _, b in pairs), {}
    for (a, _), n in pairs.items():
        after.setdefault(a, []).append(n)
    low, high = (
        language_model.discounts(*(sum(c == k for c in counts.values()) for k in (1, 2, 3, 4)))
        for counts in (follows, pairs)
    )
    off = lambda n, d: d[min(n, 3) - 1] if n else 0.0
    rest = sum(off(n, low) for n in follows.values()) / len(pairs) / (len(follows) + 1)

    def probability(before, word):
        lower = (follows[word] - off(follows[word], low)) / len(pairs) + rest
        if before not in after:
            return lower
        n, counts = pairs[before, word], after[before]
        return (n - off(n, high) + sum(off(c, high) for c in counts) * lower) / sum(counts)

    return probability


@pytest.mark.parametrize("repeated", [True, False])
def test_scores_equal_full_formula(spark, scratch, repeated):
    rng = random.Random(10)
    if repeated:
        texts = [" ".join(rng.choices("aBcdefghijklmnop", range(1, 17), k=rng.randint(0, 25))) for _ in range(70)]
    else:  # no pair occurs twice
        texts = [f"s{d} a{d} b e{d}" for d in range(70)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r.doc_id: r for r in language_model.score_held_out(docs, scratch).collect()}
    held = {d for d in range(70) if zlib.crc32(str(d).encode()) % 7 == 2}
    probability = full_kneser_ney([t for d, t in enumerate(texts) if d not in held])
    for d, text in enumerate(texts):
        line = ["<", *text.lower().split(), ">"]
        want = sum(math.log10(probability(a, b)) for a, b in itertools.pairwise(line))
        assert got[d].held_out == (d in held) and got[d].score == pytest.approx(want)


def test_files_of_many_buckets_need_few_handles(tmp_path):
    buckets = 5000
    (table,) = (t for t in language_model.stored_tables(str(tmp_path), buckets) if t.kind == "contexts")
    names = np.unique(np.random.default_rng(5).integers(0, 1 << 40, 20_000, dtype=np.uint64))
    values = [(names % np.uint64(k)).astype(np.int64) + 1 for k in (3, 5, 7, 11)]
    values[2][77] = 1 << 40  # a count that four bytes cannot hold
    limits = np.searchsorted(language_model.bucket_of(names, buckets, 40), np.arange(buckets + 1))
    for b in np.flatnonzero(np.diff(limits)):
        cut = slice(limits[b], limits[b + 1])
        for part, v in zip(table.parts(), (names, *map(language_model._narrow, (v[cut] for v in values)))):
            language_model.save_array(str(tmp_path), f"contexts-{b:06d}-{part}", v[cut] if part == "names" else v)
    for f in range(table.files):
        table.join_file(f)
    before = {p.name: p.read_bytes() for p in tmp_path.iterdir()}
    assert len(before) == 5 * table.files <= 5 * math.sqrt(buckets)
    table.join_file(3)  # a second attempt
    assert before == {p.name: p.read_bytes() for p in tmp_path.iterdir()}
    soft, hard = resource.getrlimit(resource.RLIMIT_NOFILE)
    resource.setrlimit(resource.RLIMIT_NOFILE, (256, hard))
    try:
        asked = np.unique(np.concatenate((names, names + np.uint64(1))))
        found = table.find(asked, 40)
    finally:
        resource.setrlimit(resource.RLIMIT_NOFILE, (soft, hard))
    known = np.isin(asked, names)
    for got, want in zip(found, values, strict=True):
        assert (got[known] == want).all() and (got[~known] == 0).all()


def test_model_of_many_files_scores_as_one_of_few(spark, scratch, monkeypatch):
    rng = random.Random(12)
    texts = [" ".join(f"w{rng.randint(0, 400)}" for _ in range(60)) for _ in range(80)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    few = {r.doc_id: r.score for r in language_model.score_held_out(docs, scratch).collect()}
    monkeypatch.setattr(language_model, "BUCKET_BYTES", 600)
    many = {r.doc_id: r.score for r in language_model.score_held_out(docs, scratch).collect()}
    assert few.keys() == many.keys() and all(many[d] == pytest.approx(few[d]) for d in few)


def test_large_counts_keep_their_value(tmp_path):
    keys = np.array([3, 1 << 39], dtype=np.uint64)
    sent = [list(language_model._send_sums("words", 1, keys, np.array([n, 2]))) for n in (1 << 32, 5)]
    batches = [language_model._sent_batch(rows) for rows in sent]
    language_model._store_sums(str(tmp_path), "words")(pa.Table.from_batches(batches))
    assert np.load(tmp_path / "words-000000-0.npy").tolist() == [(1 << 32) + 5, 4]


def test_model_of_awkward_rows(awkward, empty, scratch):
    assert language_model.score_held_out(awkward, scratch).count() == awkward.count()
    assert language_model.score_held_out(empty, scratch).count() == 0
    model = language_model.train(empty, scratch)
    rows = language_model.score(awkward.withColumn("held_out", F.lit(True)), model).collect()
    assert all(r.n_known == 0 and r.score == pytest.approx(0) for r in rows)


def test_cheapest_cuts():
    rng = np.random.default_rng(8)
    for _ in range(100):
        n = rng.integers(2, 9)
        at = np.concatenate(([0], np.cumsum(rng.integers(1, 8, n)))).tolist()
        cost = rng.integers(0, 6, n + 1).tolist()

        def price(cuts, at=at, cost=cost):
            edges = [0, *cuts]
            if any(at[b] - at[a] > 10 for a, b in itertools.pairwise(edges)):
                return math.inf
            return sum(10 - at[b] + at[a] + cost[b] for a, b in itertools.pairwise(edges))

        best = min(price((*c, n)) for r in range(n) for c in itertools.combinations(range(1, n), r))
        chosen = [at.index(c) for c in packing.plan_cuts(at, cost, 10)]
        assert price(chosen) == best


def test_packing_of_awkward_rows(awkward, empty, monkeypatch):
    monkeypatch.setattr(packing, "PLAN", 3000)
    rows = packing.pack(awkward.filter("doc_id IS NOT NULL AND doc_id <> 6"))
    from tests.llm.test_contract import check_packing

    check_packing(rows.collect(), {d: r.text for d, r in by_id(awkward).items() if d != 6})
    assert packing.pack(awkward).count() >= awkward.count()
    assert packing.pack(empty).count() == 0
    held = packing.pack(awkward).filter("doc_id = 8").first()
    assert len(held.ids) == held.length


def test_template_lines(spark, scratch):
    rng = random.Random(9)
    own = [" ".join("".join(rng.choices("abcdefgh", k=5)) for _ in range(9)) for _ in range(30)]
    texts = [(d, f"{own[d]}\nVisit page {d} of our site now\n\nend{d}") for d in range(30)]
    texts += [(100 + d, f"a long line of a document that was copied thirty times over\nsame tail\nx{d}y") for d in range(30)]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string")
    found = by_id(line_dedup.drop_recurring(docs, scratch))
    assert found[0].n_dropped == 0 and "Visit" in found[0].text
    assert all(found[d].text == f"{own[d]}\n\nend{d}" for d in range(1, 30))
    assert all(found[100 + d].n_dropped == 0 for d in range(30))  # copies of one document


def dropped_lines(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    found = by_id(line_dedup.drop_recurring(docs, Scratch(spark)))
    gone = {}
    for d, text in enumerate(texts):
        kept = found[d].text.split("\n") if found[d].n_dropped < len(text.split("\n")) else []
        gone[d] = [x for x in text.split("\n") if x not in kept]
        assert found[d].n_dropped == len(gone[d])
    return gone


def recurring_lines(texts, least=10):
    """Brute force for constant lines: those that least documents with different others hold."""
    lines = [set(t.split("\n")) for t in texts]
    gone = {d: [] for d in range(len(texts))}
    for line in set().union(*lines):
        holders = [d for d, own in enumerate(lines) if line in own]
        if len({frozenset(lines[d] - {line}) for d in holders}) >= least:
            for d in holders[1:]:
                gone[d].append(line)
    return {d: sorted(x, key=texts[d].split("\n").index) for d, x in gone.items()}


LICENCE = "permission is hereby granted to any person to use this text for every lawful purpose"
COOKIES = "we and our many partners keep small files on your device so that pages load faster"
FOOTER = "read more on our site"


def own_lines(rng, d, n=3):
    word = lambda: "".join(rng.choices("abcdefghijk", k=7))
    return [" ".join(word() for _ in range(i + 2)) for i in range(n)]


@pytest.mark.parametrize("case", ["every document three times", "one document copied", "long lines", "all"])
def test_template_lines_equal_brute_force(spark, case):
    rng = random.Random(11)
    pages = [[*own_lines(rng, d, 5), FOOTER] for d in range(20)]
    long = [[LICENCE, *own_lines(rng, d), COOKIES] for d in range(20)]
    copies = [[*own_lines(rng, 0, 5), FOOTER]] * 150
    texts = {
        "every document three times": pages * 3,
        "one document copied": pages + copies,
        "long lines": long,
        "all": pages * 2 + long + copies,
    }[case]
    texts = ["\n".join(t) for t in texts]
    want = recurring_lines(texts)
    assert sum(map(len, want.values())) > 15
    assert dropped_lines(spark, texts) == want


def test_template_lines_without_others(spark):
    single = [f"{LICENCE} {d}" for d in range(20)]
    gone = dropped_lines(spark, single + [COOKIES] * 30)
    assert [len(gone[d]) for d in range(50)] == [0] + [1] * 19 + [0] * 30  # copies stay
    rng = random.Random(12)
    log = lambda: f"2024-01-{rng.randint(10, 28)} 10:{rng.randint(10, 59)}:07 INFO request served in {rng.randint(1, 99)} ms"
    start = "2024-01-10 10:00:00 INFO service has started and listens"
    logs = ["\n".join([start, log(), log()]) for _ in range(20)]
    gone = dropped_lines(spark, logs)
    assert not gone[0] and all(start in gone[d] for d in range(1, 20))


def test_template_lines_of_awkward_rows(awkward, empty, scratch):
    found = line_dedup.drop_recurring(awkward, scratch)
    assert found.count() == awkward.count() and found.agg(F.sum("n_dropped")).first()[0] == 0
    assert line_dedup.drop_recurring(empty, Scratch(empty.sparkSession)).count() == 0


def test_tree_paths_become_rules():
    printed = """RandomForestClassificationModel
  Tree 0 (weight 1.0):
    If (feature 2 <= 0.5)
     If (feature 2 <= 0.25)
      Predict: 0.0
     Else (feature 2 > 0.25)
      Predict: 1.0
    Else (feature 2 > 0.5)
     Predict: 1.0
  Tree 1 (weight 1.0):
    Predict: 1.0
"""
    low, high = (2, True, 0.25), (2, False, 0.25)
    assert quality.tree_rules(printed) == [((2, True, 0.5),), (low,), (high, (2, True, 0.5)), ((2, False, 0.5),)]


def test_quality_of_awkward_rows(spark, awkward, empty, scratch):
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    found = quality.classify(awkward, labels, scratch)
    assert found.count() == awkward.count() and found.filter("score <> 0.5").count() == 0
    labels = spark.createDataFrame([(d, 1, 0) for d in range(1, 11)] + [(4, None, 0), (None, 0, 0)], labels.schema)
    assert quality.classify(awkward, labels, scratch).filter("score < 0.99").count() == 0
    assert quality.classify(empty, labels, scratch).count() == 0
    assert quality.keep_good(awkward, labels, scratch).columns == awkward.columns


def test_model_uses_the_shared_folder(spark, scratch):
    assert scratch.staging.path.startswith(spark.conf.get("spark.checkpoint.dir"))
