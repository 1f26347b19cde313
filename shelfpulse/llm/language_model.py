"""Scores of texts under an interpolated, modified Kneser-Ney bigram model.

Counting. Tasks count the tokens and pairs of their texts in NumPy and send sorted arrays of
names and counts, dealt out by leading bits of the name; one bucket of names meets in one task.
The number of buckets follows the size of the text, and a frequent name is one entry per chunk
of text, so a bucket has a bounded size whatever the words are.

Storage. Each bucket becomes sorted arrays in the shared folder:
words (64-bit name, count), continuations (name, number of distinct words before it), contexts
(name, tokens after it, numbers of successors seen once, twice, more often) and pairs (name,
count). Buckets hold rising ranges of names, so that neighbours can be appended: when all are
there, their arrays are joined to about as many files as the square root of their number. An
array is moved into place as a whole, so a repeated task leaves the same files.

Scoring. Workers memory-map the files, which the page cache of a machine shares between them,
and look sorted names up by bisection. A map holds no file handle (from Python 3.13 on), and a
worker has eleven for every file range: 700 with 30 GB of text, 39,000 with 100 TB. The shared
folder has to be mounted on the workers. `score_held_out` stores every pair. A caller of `train`
may store only pairs seen `min_pair` times: the others are counted everywhere, and their
probability goes to the lower order, so all sum to one.

Names of words are 64 bits, those within the pair model 40 bits (leading ones).
"""

from __future__ import annotations

import io
import mmap
import sys
import uuid
from collections.abc import Iterator
from dataclasses import asdict, dataclass
from functools import lru_cache
from math import isqrt

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfpulse.llm.common import Scratch, text_parts, word_bounds
from shelfpulse.llm.naming import pair, word_names

MIN_PAIR = 1
#: Text bytes per bucket of names, and tokens that a task counts at once.
BUCKET_BYTES = 8 << 20
CHUNK = 1 << 19
#: Names outside the words: the end of a document, and what stands before its first word.
END = np.uint64(0x1F0E5D8C3B7A6991)
START = np.uint64(0x7E3C9A5B1D2F4867)
_SHORT = np.uint64(24)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


# --- arrays in the shared folder -------------------------------------------------------


def save_array(folder: str, name: str, array: np.ndarray) -> None:
    system, root = fs.FileSystem.from_uri(folder)
    system.create_dir(root, recursive=True)
    path, part = f"{root}/{name}.npy", f"{root}/{name}-{uuid.uuid4().hex}.part"
    out = io.BytesIO()
    np.save(out, array)
    with system.open_output_stream(part) as stream:
        stream.write(out.getbuffer())
    if system.get_file_info(path).type == fs.FileType.NotFound:
        system.move(part, path)
    else:  # another attempt of the same task was first
        system.delete_file(part)


def _header(stream) -> tuple[np.dtype, int]:
    """Type and length of a stored array; the stream is left at its first value."""
    np.lib.format.read_magic(stream)
    (length,), _, kind = np.lib.format.read_array_header_1_0(stream)
    return kind, length


def join_arrays(folder: str, sources: list[str], name: str) -> None:
    """Append the stored arrays `sources`, those that there are, under `name`, one at a time,
    and delete them. A repeated or second attempt finds the result and is content with it."""
    system, root = fs.FileSystem.from_uri(folder)
    path, part = f"{root}/{name}.npy", f"{root}/{name}-{uuid.uuid4().hex}.part"
    paths = [f"{root}/{source}.npy" for source in sources]
    paths = [i.path for i in system.get_file_info(paths) if i.type == fs.FileType.File]
    if paths and system.get_file_info(path).type == fs.FileType.NotFound:
        heads = []
        for source in paths:
            with system.open_input_stream(source) as stream:
                heads.append(_header(stream))
        kind = np.result_type(*(k for k, _ in heads))
        head = {"descr": kind.str, "fortran_order": False, "shape": (sum(n for _, n in heads),)}
        with system.open_output_stream(part) as out:
            np.lib.format.write_array_header_1_0(out, head)
            for source in paths:
                with system.open_input_stream(source) as stream:
                    own, _ = _header(stream)
                    out.write(np.frombuffer(stream.read(), dtype=own).astype(kind).tobytes())
        system.move(part, path)
    for source in paths:
        if system.get_file_info(source).type == fs.FileType.File:
            system.delete_file(source)


#: Maps that a worker keeps, below the usual limit of 65,530 per process.
MAPS = 48_000


@lru_cache(MAPS)
def _mapped(folder: str, name: str) -> np.ndarray:
    """The array, mapped from the shared folder without keeping a file handle."""
    system, root = fs.FileSystem.from_uri(folder)
    if not isinstance(system, fs.LocalFileSystem):
        raise ValueError(f"{folder} is not mounted on the workers, which map the model's files")
    path = f"{root}/{name}.npy"
    if system.get_file_info(path).type == fs.FileType.NotFound:  # no name fell into this range
        return np.zeros(0, dtype=np.uint64)
    with open(path, "rb") as stream:
        kind, length = _header(stream)
        if not length:
            return np.zeros(0, dtype=kind)
        handles = {"trackfd": False} if sys.version_info >= (3, 13) else {}
        data = mmap.mmap(stream.fileno(), 0, access=mmap.ACCESS_READ, **handles)
        return np.frombuffer(data, dtype=kind, count=length, offset=stream.tell())


class Table:
    """One sorted table of names over all its files, with its value columns."""

    def __init__(self, folder: str, kind: str, columns: int, buckets: int):
        self.folder, self.kind, self.columns, self.buckets = folder, kind, columns, buckets
        self.files = isqrt(buckets)

    def parts(self) -> list[str]:
        return ["names", *map(str, range(self.columns))]

    def join_file(self, file: int) -> None:
        """Append the arrays of the buckets that belong to a file."""
        first, end = (-(-f * self.buckets // self.files) for f in (file, file + 1))
        for part in self.parts():
            sources = [f"{self.kind}-{b:06d}-{part}" for b in range(first, end)]
            join_arrays(self.folder, sources, f"{self.kind}-file-{file:06d}-{part}")

    def find(self, names: np.ndarray, bits: int) -> list[np.ndarray]:
        """The values of sorted names; absent names have zeros."""
        found = [np.zeros(len(names), dtype=np.int64) for _ in range(self.columns)]
        file = bucket_of(names, self.buckets, bits) * np.uint64(self.files) // np.uint64(self.buckets)
        limits = np.searchsorted(file, np.arange(self.files + 1))
        for f in np.flatnonzero(np.diff(limits)):
            keys = _mapped(self.folder, f"{self.kind}-file-{f:06d}-names")
            if not len(keys):
                continue
            part = names[limits[f] : limits[f + 1]]
            at = np.minimum(np.searchsorted(keys, part), len(keys) - 1)
            hit = np.flatnonzero(keys[at] == part)
            for i in range(self.columns):
                values = _mapped(self.folder, f"{self.kind}-file-{f:06d}-{i}")
                found[i][limits[f] + hit] = values[at[hit]]
        return found


def bucket_of(names: np.ndarray, buckets: int, bits: int) -> np.ndarray:
    """Rises with the name, so that buckets are ranges of names."""
    high = names >> np.uint64(bits - 32) if bits > 32 else names
    return (high * np.uint64(buckets)) >> np.uint64(32)


# --- tokens ----------------------------------------------------------------------------


def tokens(data: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Names of the tokens of all texts, each ended by END, and where each text begins."""
    data = _LOWER[data]
    starts, ends, begin = word_bounds(data, begins)
    texts = len(begins) - 1
    begin = begin + np.arange(texts + 1)
    names = np.full(len(starts) + texts, END, dtype=np.uint64)
    is_word = np.ones(len(names), dtype=bool)
    is_word[begin[1:] - 1] = False
    names[is_word] = word_names(data, starts, ends)
    return names, begin


def _before(names: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """The token before each token, START at the head of a text."""
    before = np.empty_like(names)
    before[1:] = names[:-1]
    before[begin[:-1]] = START
    return before


def _summed(keys: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """Sorted distinct keys, with the sums of the values of equal ones."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    new = np.flatnonzero(np.concatenate((np.ones(min(len(keys), 1), bool), keys[1:] != keys[:-1])))
    return (keys[new], *(np.add.reduceat(v[order], new) if len(new) else v for v in values))


# --- counting --------------------------------------------------------------------------

_SENT = "kind string, bucket int, parts array<binary>"


def _send(kind: str, buckets: int, bits: int, by: np.ndarray, *arrays: np.ndarray) -> Iterator:
    """Arrays sorted by `by`, cut into their buckets."""
    limits = np.searchsorted(bucket_of(by, buckets, bits), np.arange(buckets + 1))
    for b in np.flatnonzero(np.diff(limits)):
        cut = slice(limits[b], limits[b + 1])
        yield kind, int(b), [np.ascontiguousarray(a[cut]).tobytes() for a in arrays]


def _sent_batch(rows: list) -> pa.RecordBatch:
    kind, bucket, parts = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(kind), pa.array(bucket, pa.int32()), pa.array(parts, pa.list_(pa.binary()))],
        ["kind", "bucket", "parts"],
    )


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Tokens of about CHUNK at a time, with the token before each."""
    held, size = [], 0
    for batch in batches:
        for _, _, data, begins in text_parts(batch, "text"):
            names, begin = tokens(data, begins)
            held.append((names, _before(names, begin)))
            size += len(names)
            if size >= CHUNK:
                yield tuple(np.concatenate(x) for x in zip(*held, strict=True))
                held, size = [], 0
    if size:
        yield tuple(np.concatenate(x) for x in zip(*held, strict=True))


def _low_byte(names: np.ndarray) -> np.ndarray:
    return (names & np.uint64(255)).astype(np.uint8)


def _count_words(buckets: int):
    def run(batches):
        for names, _ in _chunks(batches):
            keys, counts = _summed(names, np.ones(len(names), dtype=np.int64))
            rows = list(_send("words", buckets, 64, keys, keys, counts.astype(np.uint32)))
            yield _sent_batch(rows)

    return run


def _count_pairs(buckets: int):
    """Pairs as (bucket of the pair's name; context and word in 5 bytes each, count)."""

    def run(batches):
        for names, before in _chunks(batches):
            word, context = names >> _SHORT, before >> _SHORT
            keys = pair(context, word)
            order = np.argsort(keys)
            keys = keys[order]
            new = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
            counts = np.diff(np.append(new, len(keys))).astype(np.uint32)
            at = order[new]
            word, context = word[at], context[at]
            rows = []
            limits = np.searchsorted(bucket_of(keys[new], buckets, 64), np.arange(buckets + 1))
            for b in np.flatnonzero(np.diff(limits)):
                cut = slice(limits[b], limits[b + 1])
                by = np.argsort(context[cut], kind="stable")  # equal neighbours compress
                c, w, n = context[cut][by], word[cut][by], counts[cut][by]
                halves = [(x >> np.uint64(8)).astype(np.uint32) for x in (c, w)]
                parts = [halves[0], _low_byte(c), halves[1], _low_byte(w), n]
                rows.append(("pairs", int(b), [p.tobytes() for p in parts]))
            yield _sent_batch(rows)

    return run


def _narrow(counts: np.ndarray) -> np.ndarray:
    """In four bytes where they suffice, as nearly always."""
    return counts.astype(np.uint32 if counts.max(initial=0) < 1 << 32 else np.int64)


def _gather_sums(table: pa.Table) -> list[np.ndarray]:
    """Names, and their counts of four or eight bytes."""
    columns = []
    for names, *values in table.column("parts").to_pylist():
        names = np.frombuffer(names, dtype=np.uint64)
        short = [len(v) == 4 * len(names) for v in values]
        counts = [np.frombuffer(v, np.uint32 if s else np.int64) for v, s in zip(values, short, strict=True)]
        columns.append([names, *(c.astype(np.int64) for c in counts)])
    return [np.concatenate(c) for c in zip(*columns, strict=True)]


def _gather(table: pa.Table, types: tuple) -> list[np.ndarray]:
    rows = table.column("parts").to_pylist()
    return [
        np.concatenate([np.frombuffer(r[i], dtype=t) for r in rows]) for i, t in enumerate(types)
    ]


def _counts_of_counts(counts: np.ndarray) -> list[int]:
    """How many there are, their sum, and how many are 1, 2, 3, 4."""
    exact = [int((counts == k).sum()) for k in (1, 2, 3, 4)]
    return [len(counts), int(counts.sum()), *exact]


_STATS = "kind string, stats array<bigint>"


def _stats_table(kind: str, stats: list[int]) -> pa.Table:
    return pa.table({"kind": [kind], "stats": pa.array([stats], pa.list_(pa.int64()))})


def _bucket(table: pa.Table) -> int:
    return table.column("bucket")[0].as_py()


def _store_sums(folder: str, kind: str):
    """Adds up the arrays of one bucket and stores them."""

    def run(table: pa.Table) -> pa.Table:
        b = _bucket(table)
        keys, *values = _summed(*_gather_sums(table))
        save_array(folder, f"{kind}-{b:06d}-names", keys)
        for i, v in enumerate(values):
            save_array(folder, f"{kind}-{b:06d}-{i}", _narrow(v))
        return _stats_table(kind, _counts_of_counts(values[0]))

    return run


def _store_pairs(folder: str, buckets: int, min_pair: int):
    """Adds up the pairs of one bucket, stores the frequent ones, and sends on what they say
    about their contexts and words."""

    def run(table: pa.Table) -> pa.Table:
        b = _bucket(table)
        c4, c1, w4, w1, counts = _gather(table, (np.uint32, np.uint8, np.uint32, np.uint8, np.uint32))
        context = c4.astype(np.uint64) << np.uint64(8) | c1
        word = w4.astype(np.uint64) << np.uint64(8) | w1
        del c4, c1, w4, w1
        keys = pair(context, word)
        order = np.argsort(keys)
        keys, context, word = keys[order], context[order], word[order]
        counts = counts[order].astype(np.int64)
        del order
        new = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
        keys, context, word = keys[new], context[new], word[new]
        counts = np.add.reduceat(counts, new)
        often = counts >= min_pair
        save_array(folder, f"pairs-{b:06d}-names", keys[often])
        save_array(folder, f"pairs-{b:06d}-0", _narrow(counts[often]))
        once, twice = (counts == 1).astype(np.int64), (counts == 2).astype(np.int64)
        rows = list(_send_sums("contexts", buckets, context, counts, once, twice, 1 - once - twice))
        rows += _send_sums("continuations", buckets, word, np.ones(len(word), dtype=np.int64))
        stats = pa.table(
            {
                "kind": ["pairs"],
                "bucket": pa.array([b], pa.int32()),
                "parts": pa.array([[np.array(_counts_of_counts(counts)).tobytes()]], pa.list_(pa.binary())),
            }
        )
        return pa.concat_tables([stats, pa.Table.from_batches([_sent_batch(rows)])])

    return run


def _send_sums(kind: str, buckets: int, keys: np.ndarray, *values: np.ndarray) -> Iterator:
    keys, *values = _summed(keys, *values)
    yield from _send(kind, buckets, 40, keys, keys, *map(_narrow, values))


# --- the model -------------------------------------------------------------------------


def discounts(ones: int, twos: int, threes: int, fours: int) -> tuple[float, float, float]:
    """Discounts of counts 1, 2 and more; 0.5, 1, 1.5 where counts of counts are missing."""
    if not (ones and twos and threes and fours):
        return 0.5, 1.0, 1.5
    y = ones / (ones + 2 * twos)
    raw = (1 - 2 * y * twos / ones, 2 - 3 * y * threes / twos, 3 - 4 * y * fours / threes)
    return tuple(min(max(d, 0.0), float(k)) for k, d in zip((1, 2, 3), raw, strict=True))


@dataclass(frozen=True)
class Model:
    """Where the arrays of a model are, and its totals."""

    folder: str
    buckets: int
    tokens: int  # in training
    words: int  # distinct
    pairs: int  # distinct
    word_discounts: tuple[float, float, float]
    pair_discounts: tuple[float, float, float]
    word_rest: float  # what discounting leaves for words never seen
    min_pair: int

    def tables(self) -> tuple[Table, Table, Table, Table]:
        return stored_tables(self.folder, self.buckets)


def stored_tables(folder: str, buckets: int) -> tuple[Table, Table, Table, Table]:
    kinds = (("words", 1), ("continuations", 1), ("contexts", 4), ("pairs", 1))
    return tuple(Table(folder, kind, n, buckets) for kind, n in kinds)


def _join_files(folder: str, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = stored_tables(folder, buckets)
        for batch in batches:
            for i in batch.column("id").to_pylist():
                tables[i % len(tables)].join_file(i // len(tables))
            yield batch

    return run


def train(docs: DataFrame, scratch: Scratch, min_pair: int = MIN_PAIR) -> Model:
    """Count `text` of all rows and store the arrays in the shared folder. No rows: a model
    that knows no word."""
    folder = scratch.folder(f"model-{uuid.uuid4().hex[:8]}")
    texts = docs.select("text")
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(4, -(-size // BUCKET_BYTES))

    def stored(sent: DataFrame, kind: str) -> DataFrame:
        return (
            sent.filter(F.col("kind") == kind).groupBy("bucket")
            .applyInArrow(_store_sums(folder, kind), _STATS)
        )

    words = stored(texts.mapInArrow(_count_words(buckets), _SENT), "words")
    words = scratch.table(words, "words")
    pairs = texts.mapInArrow(_count_pairs(buckets), _SENT).groupBy("bucket")
    pairs = scratch.table(pairs.applyInArrow(_store_pairs(folder, buckets, min_pair), _SENT), "pairs")
    contexts = stored(pairs, "contexts")
    continuations = stored(pairs, "continuations")
    # Six numbers per bucket and kind, added up to one row before the driver sees them.
    stats = scratch.table(words.unionByName(contexts).unionByName(continuations), "stats")
    sums = stats.agg(
        *(
            F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col("stats")[i])), F.lit(0)).alias(f"{kind}{i}")
            for kind in ("words", "continuations")
            for i in range(6)
        )
    ).first()
    total = {kind: [sums[f"{kind}{i}"] for i in range(6)] for kind in ("words", "continuations")}
    n, tokens, *_ = total["words"]
    kinds, types, *counted = total["continuations"]
    own = pairs.filter("kind = 'pairs'").select(F.element_at("parts", 1).alias("p"))
    sums = own.mapInArrow(_read_stats, "s array<bigint>").agg(
        *(F.sum(F.col("s")[i]).alias(f"s{i}") for i in range(6))
    ).first()
    pair_counts = [x or 0 for x in sums][2:]
    scratch.discard(words, pairs, stats)
    # One task per file; neighbouring buckets are read one at a time.
    files = isqrt(buckets) * 4
    each = texts.sparkSession.range(0, files, 1, files)
    each.mapInArrow(_join_files(folder, buckets), "id bigint").write.format("noop").mode("overwrite").save()
    word_d = discounts(*counted)
    pair_d = discounts(*pair_counts)
    ones, twos = counted[:2]
    kept = word_d[0] * ones + word_d[1] * twos + word_d[2] * (kinds - ones - twos)
    return Model(folder, buckets, tokens, n, types, word_d, pair_d, kept / types if types else 1.0, min_pair)


def _read_stats(batches):
    for batch in batches:
        rows = [np.frombuffer(p, dtype=np.int64) for p in batch.column("p").to_pylist()]
        yield pa.RecordBatch.from_arrays([pa.array(rows, pa.list_(pa.int64()))], ["s"])


def _discount(counts: np.ndarray, d: tuple[float, float, float]) -> np.ndarray:
    return np.array([0.0, *d])[np.minimum(counts, 3)]


def token_scores(model: Model, names: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Training count of each token, and its log10 probability after the token before it."""
    words, continuations, contexts, pairs = model.tables()

    def look_up(table: Table, keys: np.ndarray, bits: int) -> list[np.ndarray]:
        distinct, back = np.unique(keys, return_inverse=True)
        return [v[back] for v in table.find(distinct, bits)]

    (count,) = look_up(words, names, 64)
    short, context = names >> _SHORT, before >> _SHORT
    (follows,) = look_up(continuations, short, 40)
    after, once, twice, more = look_up(contexts, context, 40)
    (together,) = look_up(pairs, pair(context, short), 64)
    types = max(model.pairs, 1)
    lower = (follows - _discount(follows, model.word_discounts)) / types
    lower += model.word_rest / (model.words + 1)
    d1, d2, d3 = model.pair_discounts
    # Pairs that are not stored give all of their count to the lower order.
    given = [k if k < model.min_pair else d for k, d in ((1, d1), (2, d2))]
    rest = np.where(after > 0, given[0] * once + given[1] * twice + d3 * more, 1)
    own = np.where(together > 0, together - _discount(together, model.pair_discounts), 0)
    return count, np.log10((own + rest * lower) / np.maximum(after, 1))


def _score(model: dict):
    model = Model(**model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, data, begins in text_parts(batch, "text", 1 << 19):
                names, begin = tokens(data, begins)
                count, score = token_scores(model, names, _before(names, begin))
                base = np.log10((count + 1) / (model.tokens + model.words + 1))
                sums = [np.add.reduceat(x, begin[:-1]) for x in (count > 0, base, score)]
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(i).slice(low, high - low) for i in range(2)),
                        pa.array(np.diff(begin)),
                        pa.array(sums[0].astype(np.int64)),
                        pa.array(np.full(high - low, model.tokens)),
                        pa.array(sums[1]),
                        pa.array(sums[2]),
                    ],
                    ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
                )

    return run


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out (as given), n_tokens, n_known (seen in training), train_tokens,
    base_score (add-one unigrams) and score of every row; the last two are log10 of the
    probability of the text. Perplexity is 10 ** (-score / n_tokens). Null text is empty: its
    only token is the end."""
    schema = (
        "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, "
        "base_score double, score double"
    )
    return docs.select("doc_id", "held_out", "text").mapInArrow(_score(asdict(model)), schema)


def held_out(doc_id: str = "doc_id", folds: int = 7, fold: int = 2) -> Column:
    """Whether a row is kept from training; a null id is not."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % folds == fold, F.lit(False))


def score_held_out(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """Train on all rows that are not held out, every pair stored, and score every row."""
    docs = docs.select("doc_id", "text", held_out().alias("held_out"))
    return score(docs, train(docs.filter("NOT held_out"), scratch, min_pair=1))
