"""Registered queries against SQL, brute force or properties of their results, on the test data."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from tokenizers import Tokenizer

from shelfpulse.llm.packing import tokenizer_folder
from shelfpulse.llm.queries import ORACLE_SQL, QUERIES

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def documents(duck):
    return dict(duck.execute("SELECT doc_id, text FROM documents").fetchall())


def rows(spark, sf_dir, name):
    return QUERIES[name](spark, sf_dir).collect()


def test_one_query_per_operator():
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", list(ORACLE_SQL))
def test_equals_sql(name, spark, duck, sf_dir):
    found = QUERIES[name](spark, sf_dir)
    result = duck.execute(ORACLE_SQL[name])
    names = [c[0] for c in result.description]
    assert sorted(names) == sorted(found.columns)
    assert sorted(map(str, map(tuple, found.select(*names).collect()))) == sorted(map(str, result.fetchall()))


def test_quality_separates_held_out_labels(spark, duck, sf_dir, documents):
    found = {r.doc_id: r for r in rows(spark, sf_dir, "op1_quality_classifier")}
    assert set(found) == set(documents)
    for r in found.values():
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    labels = duck.execute("SELECT doc_id, quality FROM labels").fetchall()
    held = [(found[d].score, q) for d, q in labels if found[d].held_out]
    good = [s for s, q in held if q == 1]
    bad = [s for s, q in held if q == 0]
    auc = np.mean([(g > b) + 0.5 * (g == b) for g in good for b in bad])
    assert auc >= 0.9
    assert np.mean([s >= 0.3 for s in good]) >= 0.95


def test_vectors_equal_brute_force(spark, duck, sf_dir):
    table = duck.execute("SELECT vec_id, embedding FROM embeddings ORDER BY vec_id").fetchall()
    ids = np.array([i for i, _ in table])
    x = np.array([v for _, v in table], dtype=np.float64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = x @ x.T >= 0.9
    np.fill_diagonal(near, False)
    found = {r.vec_id: r for r in rows(spark, sf_dir, "op2_embedding_dedup")}
    links = np.array([found[i].n_links for i in ids])
    assert (links <= near.sum(axis=1)).all()
    assert links.sum() >= 0.99 * near.sum()
    component = smallest_reachable(ids.tolist(), [(ids[i], ids[j]) for i, j in np.argwhere(near)])
    assert np.mean([found[i].component_id == component[i] for i in ids]) >= 0.99
    assert all(r.kept == (r.vec_id == r.component_id) for r in found.values())


def smallest_reachable(nodes, edges):
    beside = defaultdict(set)
    for a, b in edges:
        beside[a].add(b)
        beside[b].add(a)
    found = {}
    for node in sorted(nodes):
        todo = [node]
        while todo:
            at = todo.pop()
            if at not in found:
                found[at] = node
                todo.extend(beside[at])
    return found


def test_pieces_give_back_every_text(spark, sf_dir, documents):
    found = rows(spark, sf_dir, "op5_piece_encoding")
    assert {r.doc_id for r in found} == set(documents)
    for r in found:
        assert r.decoded
        assert list(r.scores) == sorted(r.scores, reverse=True)
        assert len(set(r.ids_crc32)) == len(r.ids_crc32)


def test_model_scores(spark, sf_dir, documents):
    found = {r.doc_id: r for r in rows(spark, sf_dir, "op6_lm_scoring")}
    assert set(found) == set(documents)
    tokens = {d: [*WORD.findall((t or "").encode().lower()), None] for d, t in documents.items()}
    held = {d for d in tokens if zlib.crc32(str(d).encode()) % 7 == 2}
    counts = Counter(w for d, ws in tokens.items() if d not in held for w in ws)
    total, kinds = sum(counts.values()), len(counts)
    better = 0
    for d, ws in tokens.items():
        r = found[d]
        assert (r.held_out, r.n_tokens, r.train_tokens) == (d in held, len(ws), total)
        assert r.n_known == sum(w in counts for w in ws)
        base = sum(math.log10((counts[w] + 1) / (total + kinds + 1)) for w in ws)
        assert r.base_score == pytest.approx(base, rel=1e-9)
        better += r.score > r.base_score
    assert sum(found[d].score for d in held) > sum(found[d].base_score for d in held)
    assert better > 0.9 * len(tokens)


def simhash(text):
    words = text.encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(len(words) - 3, 1))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def test_fingerprints_equal_brute_force(spark, sf_dir, documents):
    found = {r.doc_id: r for r in rows(spark, sf_dir, "op7_simhash_dedup")}
    prints = {d: simhash(t or "") for d, t in documents.items()}
    assert {d: r.fingerprint for d, r in found.items()} == {d: f"{p:016x}" for d, p in prints.items()}
    ids = list(prints)
    values = np.array([prints[d] for d in ids], dtype=np.uint64)
    near = np.argwhere(np.bitwise_count(values[:, None] ^ values[None, :]) <= 4)
    component = smallest_reachable(ids, [(ids[i], ids[j]) for i, j in near])
    assert {d: r.component_id for d, r in found.items()} == component


def check_packing(found, documents, id_column="doc_id"):
    reference = Tokenizer.from_file(f"{tokenizer_folder()}/byte_bpe_50k.json")
    pieces = defaultdict(list)
    sequences = defaultdict(list)
    for r in found:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    assert set(pieces) == set(documents)
    for d, text in documents.items():
        ids = np.array([*reference.encode(text or "", add_special_tokens=False).ids, 1], dtype="<u4")
        at = 0
        for r in sorted(pieces[d], key=lambda r: r.start):
            assert r.start == at and r.length > 0 and r.doc_tokens == len(ids)
            assert r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    for parts in sequences.values():
        at = 0
        for r in sorted(parts, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 2048
    return sum(r.length for r in found) / (2048 * len(sequences))


def test_packing_is_whole_and_tight(spark, sf_dir, documents):
    assert check_packing(rows(spark, sf_dir, "op8_packing"), documents) > 0.985


def test_lines_of_templates_go(spark, sf_dir, documents):
    found = {r.doc_id: r for r in rows(spark, sf_dir, "op9_line_dedup")}
    assert set(found) == set(documents)
    for d, text in documents.items():
        if not found[d].n_dropped:
            assert found[d].kept_sha256 == hashlib.sha256((text or "").encode()).hexdigest()
    assert 0 < sum(r.n_dropped for r in found.values()) < 0.1 * sum(r.n_lines for r in found.values())


def test_pipeline(spark, sf_dir, documents):
    import corpus_pipeline

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, left = docs.columns, set(documents)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf_dir)
        assert docs.columns == columns
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        ids = {r.doc_id for r in docs.select("doc_id").collect()}
        assert ids <= left, name
        if name in ("line dedup", "substring dedup"):
            assert ids == left
        else:
            assert len(ids) < len(left)
        left = ids
    texts = {r.doc_id: r.text for r in docs.collect()}
    check_packing(corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).collect(), texts)
    assert {r.doc_id for r in corpus_pipeline.run(spark, sf_dir).select("doc_id").collect()} == left
