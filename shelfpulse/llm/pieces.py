"""N-best segmentation into the pieces of a SentencePiece model, and its inverse.

The lattice of a text has a node between any two characters and an edge for each piece; its
score is the sum of the pieces' scores. No piece holds a blank behind another character, so the
lattice falls apart at blanks and line feeds, and each distinct chunk is worked on once per task:

- forward: the Viterbi score of every node, with the score of the second best path to it, and
  so the gap between the best and the second best path of the chunk;
- backward: A-star from the end, with the forward scores as exact estimates of what is left, so
  that paths complete in order of their scores and no other path is finished.

The best N of a text differ from its best only in the N - 1 chunks with the smallest gaps, since
changing any other chunk is worse than N - 1 plans already found; A-star runs for these alone.
"""

from __future__ import annotations

import heapq
import re
import zlib
from collections.abc import Iterator
from functools import cache
from struct import pack

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

NBEST = 4
MODEL = "piece_bpe_32k.model"
#: Chunks that a task remembers.
REMEMBERED = 500_000
_CHUNK = re.compile(r"\n| *[^ \n]+| +")
_BLANK = "▁"

Path = tuple[float, bytes]  # score and ids, as little-endian 32-bit numbers


def model_file() -> str:
    """The public model of this machine."""
    import public_tokenizers

    return public_tokenizers.path(MODEL)


class Pieces:
    """Pieces of a model by text, blanks as blanks."""

    def __init__(self, file: str):
        model = sentencepiece.SentencePieceProcessor(model_file=file)
        self.table: dict[str, tuple[int, float]] = {}
        self.bytes_of: list[bytes] = []
        self.byte_ids = [0] * 256
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.byte_ids[int(piece[3:5], 16)] = i
                self.bytes_of.append(bytes([int(piece[3:5], 16)]))
            elif model.is_control(i) or model.is_unknown(i):
                self.bytes_of.append(b"")
            else:
                text = piece.replace(_BLANK, " ")
                self.table[text] = (i, model.get_score(i))
                self.bytes_of.append(text.encode())
        #: A character that is no piece is spelt in bytes, at a score below every piece.
        self.spelt = min(score for _, score in self.table.values()) - 10
        # A tree of characters; a node is (nodes below, id or -1, score).
        below: dict[str, dict] = {"": {}}
        for text in sorted(self.table):
            for end in range(1, len(text) + 1):
                if text[:end] not in below:
                    number, score = self.table.get(text[:end], (-1, 0.0))
                    below[text[:end]] = {}
                    below[text[: end - 1]][text[end - 1]] = (below[text[:end]], number, score)
        self.tree = below[""]
        self.known: dict[str, tuple[float, bytes, float]] = {}
        self.others: dict[str, tuple[int, list[Path]]] = {}

    def edges(self, chunk: str) -> list[tuple[int, int, float, int]]:
        """(from, to, score, id) by start; id -1 is a character spelt in bytes."""
        found, n = [], len(chunk)
        for i in range(n):
            node = self.tree.get(chunk[i])
            if node is None or node[1] < 0:
                found.append((i, i + 1, self.spelt, -1))
            j = i + 1
            while node is not None:
                below, number, score = node
                if number >= 0:
                    found.append((i, j, score, number))
                node = below.get(chunk[j]) if j < n else None
                j += 1
        return found

    def ids(self, chunk: str, path: list[tuple[int, int, int]]) -> bytes:
        found: list[int] = []
        for i, j, piece in path:
            if piece >= 0:
                found.append(piece)
            else:
                found.extend(self.byte_ids[b] for b in chunk[i:j].encode())
        return pack(f"<{len(found)}i", *found)

    def best(self, chunk: str) -> tuple[float, bytes, float]:
        """Score and ids of the best path, and how far behind the second is (infinite if none)."""
        found = self.known.get(chunk)
        if found is not None:
            return found
        n, none, root = len(chunk), -np.inf, self.tree
        ahead, second = [none] * (n + 1), [none] * (n + 1)
        start, piece = [0] * (n + 1), [-1] * (n + 1)  # of the best edge into a node
        ahead[0] = 0.0
        for i in range(n):  # the same edges, used at once
            here, other, node = ahead[i], second[i], root.get(chunk[i])
            j = i + 1
            if node is None or node[1] < 0:
                reached = here + self.spelt
                if reached > ahead[j]:
                    second[j] = max(ahead[j], other + self.spelt)
                    ahead[j] = reached
                    start[j] = i
                    piece[j] = -1
                elif reached > second[j]:
                    second[j] = reached
            while node is not None:
                below, number, score = node
                if number >= 0:
                    reached = here + score
                    if reached > ahead[j]:
                        runner = other + score
                        second[j] = runner if runner > ahead[j] else ahead[j]
                        ahead[j] = reached
                        start[j] = i
                        piece[j] = number
                    elif reached > second[j]:
                        second[j] = reached
                if j == n:
                    break
                node = below.get(chunk[j])
                j += 1
        numbers, at = [], n
        while at:
            numbers.append(piece[at])
            at = start[at]
        if -1 in numbers:
            path, at = [], n
            while at:
                path.append((start[at], at, piece[at]))
                at = start[at]
            ids = self.ids(chunk, path[::-1])
        else:
            numbers.reverse()
            ids = pack(f"<{len(numbers)}i", *numbers)
        found = (ahead[n], ids, ahead[n] - second[n])
        if len(self.known) >= REMEMBERED:
            self.known.clear()
        self.known[chunk] = found
        return found

    def nbest(self, chunk: str, n: int) -> list[Path]:
        """The n best paths of a chunk, best first; fewer if there are no more. All of them
        spell the chunk."""
        asked, found = self.others.get(chunk, (0, []))
        if asked >= n:
            return found[:n]
        found = []
        edges, size = self.edges(chunk), len(chunk)
        ahead = [0.0] + [-np.inf] * size
        into: list[list] = [[] for _ in range(size + 1)]
        for edge in edges:
            ahead[edge[1]] = max(ahead[edge[1]], ahead[edge[0]] + edge[2])
            into[edge[1]].append(edge)
        heap = [(-ahead[size], 0, size, 0.0, None)]
        order = 0
        while heap and len(found) < n:
            _, _, at, score, path = heapq.heappop(heap)
            if at == 0:
                steps = []
                while path is not None:
                    step, path = path
                    steps.append(step)
                found.append((score, self.ids(chunk, steps)))
                continue
            for i, j, own, piece in into[at]:
                order += 1
                total = score + own
                heapq.heappush(heap, (-(total + ahead[i]), order, i, total, ((i, j, piece), path)))
        if any(self.spelling(ids) != chunk.encode() for _, ids in found):
            raise ValueError(f"a segmentation does not spell {chunk!r}")
        if len(self.others) >= REMEMBERED // 10:
            self.others.clear()
        self.others[chunk] = (n, found)
        return found

    def encode(self, text: str, n: int = 1) -> list[Path]:
        """The n best segmentations of a text, best first. Like the model, it is read with a
        blank before it; an empty text has one, empty segmentation."""
        if not text:
            return [(0.0, b"")]
        chunks = _CHUNK.findall(" " + text)
        best = list(map(self.best, chunks))
        total = sum(b[0] for b in best)
        ids = [b[1] for b in best]
        if n == 1:
            return [(total, b"".join(ids))]
        gaps = [b[2] for b in best]
        close = np.argsort(np.array(gaps), kind="stable")[: n - 1].tolist()
        close = sorted(k for k in close if gaps[k] < np.inf)
        # Combinations of the alternatives of these chunks, the best n so far.
        plans: list[tuple[float, tuple[tuple[int, bytes], ...]]] = [(0.0, ())]
        for k in close:
            options = self.nbest(chunks[k], n)
            plans = heapq.nlargest(
                n,
                (
                    (lost + score - options[0][0], (*changes, (k, own)))
                    for lost, changes in plans
                    for score, own in options
                ),
                key=lambda plan: plan[0],
            )
        found = []
        for lost, changes in plans:
            own = list(ids)
            for k, other in changes:
                own[k] = other
            found.append((total + lost, b"".join(own)))
        return found

    def decode(self, ids: bytes) -> str:
        """The text that `encode` was given, from any of its segmentations."""
        return self.spelling(ids)[1:].decode()

    def spelling(self, ids: bytes) -> bytes:
        parts = self.bytes_of
        return b"".join([parts[i] for i in np.frombuffer(ids, dtype="<i4").tolist()])


@cache
def _pieces(file: str) -> Pieces:
    return Pieces(file)


def _encoded(file: str, n: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _pieces(file)
        for batch in batches:
            for low in range(0, batch.num_rows, 64):
                part = batch.slice(low, 64)
                texts = [t or "" for t in part.column("text").to_pylist()]
                found = [pieces.encode(t, n) for t in texts]
                columns = {
                    "doc_id": part.column("doc_id"),
                    "n_pieces": pa.array([len(f[0][1]) // 4 for f in found], pa.int64()),
                    "ids_crc32": pa.array([[zlib.crc32(ids) for _, ids in f] for f in found], pa.list_(pa.int64())),
                    "scores": pa.array([[s for s, _ in f] for f in found], pa.list_(pa.float64())),
                    "decoded": pa.array(
                        [pieces.decode(f[0][1]) == t for t, f in zip(texts, found, strict=True)]
                    ),
                }
                if with_ids:
                    columns["ids"] = pa.array(
                        [[np.frombuffer(ids, dtype="<i4") for _, ids in f] for f in found],
                        pa.list_(pa.list_(pa.int32())),
                    )
                yield pa.RecordBatch.from_pydict(columns)

    return run


def encode(docs: DataFrame, n: int = NBEST, file: str | None = None, with_ids: bool = True) -> DataFrame:
    """The n best segmentations of every text: doc_id, n_pieces (of the best), ids_crc32 and
    scores (best first), decoded (whether the best gives back the text; the others are compared
    with it chunk by chunk when they are found) and, with_ids, ids.

    Null text is empty; an empty text has one segmentation without pieces. Equal scores keep
    the order in which the search meets them, which depends on the text alone."""
    schema = (
        "doc_id bigint, n_pieces bigint, ids_crc32 array<bigint>, scores array<double>, decoded boolean"
    )
    if with_ids:
        schema += ", ids array<array<int>>"
    return docs.select("doc_id", "text").mapInArrow(
        _encoded(file or model_file(), n, with_ids), schema
    )


def decode(encoded: DataFrame, file: str | None = None) -> DataFrame:
    """doc_id and text of rows (doc_id, ids array<int>); null ids give a null text."""
    file = file or model_file()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _pieces(file)
        for batch in batches:
            texts = [
                None if ids is None else pieces.decode(np.array(ids, dtype="<i4").tobytes())
                for ids in batch.column("ids").to_pylist()
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"]
            )

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id bigint, text string")
