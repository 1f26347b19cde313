"""Packing of tokenised documents into sequences, by order-preserving dynamic programming.

The tokens of a partition are one stream in the order of its rows. Cuts divide it into windows of
at most `CAPACITY` tokens, one sequence each. A cut costs nothing at the end of a document, a
little at the end of a sentence, more inside one; a window costs its padding. The cheapest cuts
come from f(j) = cost of cut j + min over i of (f(i) + padding of the window i..j), whose i form
a sliding window: a monotone queue gives each minimum in constant time.

Every partition is packed by itself, so nothing is shuffled and no state leaves a task; that
leaves at most one partly filled sequence per partition. The reader's partitions do not change
when a task is repeated, so neither do sequence ids.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections import deque
from collections.abc import Callable, Iterator
from functools import cache
from pathlib import Path

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

CAPACITY = 2048
END_ID = 1
#: Costs of a cut, in tokens of padding that it is worth.
SENTENCE_COST = 2
INSIDE_COST = 24
#: Where no document or sentence ends within so many tokens, a cut inside is offered.
GAP = 32
#: Tokens that are planned at once; plans end at documents or full windows.
PLAN = 1 << 20

VOCABULARY = "byte_bpe_50k"
#: Texts of these characters alone go through the faster of two encoders with equal results.
_PLAIN = re.compile(r"[\n\r\t\x20-\x7e\xa1-ɏ]*")


@cache
def _encoder(folder: str) -> Callable[[str], np.ndarray]:
    import public_tokenizers

    reference = Tokenizer.from_file(f"{folder}/{VOCABULARY}.json")
    ranks = {
        base64.b64decode(token): int(rank)
        for token, rank in (
            line.split() for line in Path(folder, f"{VOCABULARY}.tiktoken").read_bytes().splitlines()
        )
    }
    fast = tiktoken.Encoding(
        VOCABULARY, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )

    def encode(text: str) -> np.ndarray:
        if "<|" not in text and _PLAIN.fullmatch(text):
            return fast.encode_to_numpy(text).astype(np.uint32)
        ids = reference.encode(text, add_special_tokens=False).ids
        return np.array(ids, dtype=np.uint32)

    return encode


@cache
def _sentence_ends(folder: str) -> np.ndarray:
    """Whether a token ends a sentence: its last character but blanks is . ! or ?, or a new line."""
    tokenizer = Tokenizer.from_file(f"{folder}/{VOCABULARY}.json")
    ends = np.zeros(tokenizer.get_vocab_size() + 1, dtype=bool)
    for i in range(tokenizer.get_vocab_size()):
        text = tokenizer.decode([i])
        ends[i] = "\n" in text or text.rstrip(" ").endswith((".", "!", "?"))
    return ends


def tokenizer_folder() -> str:
    """Where the public vocabularies of this machine lie."""
    import public_tokenizers

    return str(Path(public_tokenizers.path(f"{VOCABULARY}.json")).parent)


def plan_cuts(
    positions: list[int], costs: list[int], capacity: int = CAPACITY
) -> list[int]:
    """The cheapest cuts. positions: rising, the first is the start and the last the end of the
    stream, neighbours at most `capacity` apart. Returns the chosen positions but the first.
    Of equally cheap plans, the one with the latest cuts is taken."""
    best = [0] * len(positions)
    come = [0] * len(positions)
    queue: deque[tuple[int, int]] = deque([(positions[0], 0)])  # f(i) + position, index
    for j in range(1, len(positions)):
        at = positions[j]
        while at - positions[queue[0][1]] > capacity:
            queue.popleft()
        value, i = queue[0]
        best[j] = value + capacity - at + costs[j]
        come[j] = i
        value = best[j] + at
        while queue and queue[-1][0] >= value:
            queue.pop()
        queue.append((value, j))
    cuts, j = [], len(positions) - 1
    while j:
        cuts.append(positions[j])
        j = come[j]
    return cuts[::-1]


def candidates(ids: np.ndarray, ends: np.ndarray, sentence: np.ndarray) -> tuple[list, list]:
    """Positions where a stream may be cut, and the cost of each. ends: ends of documents."""
    cost = np.full(len(ids) + 1, -1, dtype=np.int64)
    cost[1:][sentence[ids]] = SENTENCE_COST
    cost[ends] = 0
    cost[0] = 0
    cost[len(ids)] = max(cost[len(ids)], 0)
    at = np.flatnonzero(cost >= 0)
    wide = np.flatnonzero(np.diff(at) > GAP)
    extra = [np.arange(at[i] + GAP, at[i + 1], GAP) for i in wide]
    if extra:
        extra = np.concatenate(extra)
        cost[extra] = INSIDE_COST
        at = np.union1d(at, extra)
    return at.tolist(), cost[at].tolist()


class _Plan:
    """Documents of one stream that wait to be packed."""

    def __init__(self):
        self.ids: list[np.ndarray] = []
        self.row: list[tuple[int, int, int]] = []  # row, tokens before, all tokens of the row
        self.size = 0

    def add(self, row: int, ids: np.ndarray, before: int, total: int) -> None:
        self.ids.append(ids)
        self.row.append((row, before, total))
        self.size += len(ids)


def _packed(plan: _Plan, sentence: np.ndarray, capacity: int, last: bool, first_id: int):
    """Pieces of the planned windows. Unless it is the last, the final window stays open and is
    given back as the start of the next plan."""
    ids = np.concatenate(plan.ids)
    lengths = np.array([len(x) for x in plan.ids])
    ends = np.cumsum(lengths)
    cuts = plan_cuts(*candidates(ids, ends, sentence), capacity)
    stop = len(ids) if last or len(cuts) < 2 else cuts[-2]
    windows = np.array([c for c in cuts if c <= stop])
    edges = np.union1d(windows, ends[ends <= stop])
    starts = np.concatenate(([0], edges[:-1]))
    doc = np.searchsorted(ends, starts, side="right")
    window = np.searchsorted(windows, starts, side="right")
    begin = np.concatenate(([0], windows))
    pieces = []
    for a, b, d, w in zip(starts.tolist(), edges.tolist(), doc.tolist(), window.tolist(), strict=True):
        row, before, total = plan.row[d]
        start = before + a - int(ends[d] - lengths[d])
        crc = zlib.crc32(ids[a:b].astype("<u4").tobytes())
        pieces.append((row, start, b - a, crc, total, first_id + w, a - int(begin[w])))
    rest = _Plan()
    if stop < len(ids):
        d = int(np.searchsorted(ends, stop, side="right"))
        for k in range(d, len(lengths)):
            row, before, total = plan.row[k]
            skip = max(stop - int(ends[k] - lengths[k]), 0)
            rest.add(row, plan.ids[k][skip:], before + skip, total)
    tokens = pa.ListArray.from_arrays(
        np.append(starts, stop).astype(np.int32), pa.array(ids[:stop].astype(np.int32))
    )
    return pieces, tokens, len(windows), rest


PIECES = (
    ("start", pa.int64()),
    ("length", pa.int64()),
    ("ids_crc32", pa.int64()),
    ("doc_tokens", pa.int64()),
    ("sequence_id", pa.int64()),
    ("offset", pa.int64()),
)


def _pack(folder: str, capacity: int, end_id: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, sentence = _encoder(folder), _sentence_ends(folder)
        number = TaskContext.get().partitionId() << 40
        plan, doc_ids = _Plan(), []

        def flush(last: bool) -> pa.RecordBatch:
            nonlocal plan, doc_ids, number
            pieces, tokens, used, rest = _packed(plan, sentence, capacity, last, number)
            number += used
            columns = list(zip(*pieces, strict=True))
            arrays = [pa.array([doc_ids[i] for i in columns[0]], pa.int64())]
            arrays += [pa.array(c, t) for c, (_, t) in zip(columns[1:], PIECES, strict=True)]
            names = ["doc_id", *(n for n, _ in PIECES)]
            if with_ids:
                arrays.append(tokens)
                names.append("ids")
            low = min((row for row, _, _ in rest.row), default=len(doc_ids))
            rest.row = [(row - low, before, total) for row, before, total in rest.row]
            plan, doc_ids = rest, doc_ids[low:]
            return pa.RecordBatch.from_arrays(arrays, names)

        for batch in batches:
            texts = batch.column("text")
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts, strict=True):
                ids = np.append(encode(text.as_py() or ""), np.uint32(end_id))
                doc_ids.append(doc_id)
                plan.add(len(doc_ids) - 1, ids, 0, len(ids))
                if plan.size >= PLAN:
                    yield flush(last=False)
        if plan.size:
            yield flush(last=True)

    return run


def pack(
    docs: DataFrame,
    folder: str | None = None,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    with_ids: bool = True,
) -> DataFrame:
    """Pieces of documents: doc_id, start (tokens of the document before it), length, ids_crc32,
    doc_tokens (with the end id), sequence_id, offset (in its sequence) and, with_ids, the ids.

    Every row becomes its tokens and one end id; null text is empty. Rows with equal or null
    doc_id are packed like any other. Equal tables in equal partitions give equal results.
    """
    schema = (
        "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
        "sequence_id bigint, offset bigint"
    )
    if with_ids:
        schema += ", ids array<int>"
    return docs.select("doc_id", "text").mapInArrow(
        _pack(folder or tokenizer_folder(), capacity, end_id, with_ids), schema
    )
