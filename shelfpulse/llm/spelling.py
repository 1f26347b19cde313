"""Spelling variants: words at one edit from each other, found through pivotal grams.

The bigrams of a word are ordered from rare to frequent. Its prefix are the first three; one edit
changes two neighbouring bigrams at most. Of the prefix, dynamic programming chooses two bigrams
that do not overlap and are rarest together: the pivots. One edit can only touch one of them, so
of two words at one edit the one whose prefix ends earlier has a pivot that the other has
unchanged, and, as it comes early in the order, has in its prefix (`prefix` takes in one
more bigram where a repeated one could be shifted out of it). So pivots are indexed against
prefixes, which misses no pair.

Position limits: the edit lies on one side of the shared bigram, so the bigram keeps its place
counted from the other end, and so does everything up to that end. The index key is the bigram, its place
counted from the start or from the end, and a hash of the text on that side, and with it the
length: a pivot is entered under the three lengths that one edit allows. Words that meet are
then verified.
"""

from __future__ import annotations

import heapq
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfpulse.llm.common import Scratch
from shelfpulse.llm.skew import heavy_keys, salted_join

MIN_LENGTH = 5
MIN_COUNT = 3
#: A word's form has at least so many times its occurrences.
RATIO = 2
#: Of so many (document, run) pairs one loses a character.
DAMAGE = 97
#: Longer words are verified in time in proportion to their length.
LONG = 256
#: Distinct words that a task holds before it passes their counts on.
HELD = 1 << 18

_GRAM = 2
_PREFIX = _GRAM + 1
#: Bytes in front of which a run of letters cannot go on.
_BREAK = re.compile(rb"[^A-Za-z\x80-\xBF\xC3]")


def _pieces(text: memoryview, size: int = 1 << 20) -> Iterator[str]:
    """The text in lower case A-Z, cut where no run is."""
    low = 0
    while low < len(text):
        cut = _BREAK.search(text, min(low + size, len(text)))
        high = cut.start() if cut else len(text)
        yield bytes(text[low:high]).lower().decode("utf-8", "replace")
        low = high


def _words(min_length: int):
    runs = re.compile("[a-zÀ-ÿ]{%d,}" % min_length)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()

        def counts() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays(
                [pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "n"]
            )
            held.clear()
            return batch

        for batch in batches:
            texts = batch.column("text").cast(pa.large_binary())
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts, strict=True):
                if not text.is_valid:
                    continue
                start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
                for piece in _pieces(memoryview(text.as_buffer())):
                    for word, n in Counter(runs.findall(piece)).items():
                        h = zlib.crc32(word.encode(), start)
                        if h % DAMAGE == 0:
                            at = h % len(word)
                            word = word[:at] + word[at + 1 :]
                            if len(word) < min_length:
                                continue
                        held[word] += n
                    if len(held) > HELD:
                        yield counts()
        if held:
            yield counts()

    return run


def words(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """Words of all whole texts and how often they occur: runs of letters, damaged now and then
    as the contract says; a null doc_id counts as an empty one."""
    found = docs.select("doc_id", "text").mapInArrow(_words(min_length), "word string, n bigint")
    return found.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count)


def _gram_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: Counter[str] = Counter()
    for batch in batches:
        for word in batch.column("word").to_pylist():
            held.update(map(str.__add__, word, word[1:]))
    yield pa.RecordBatch.from_arrays(
        [pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], ["gram", "n"]
    )


def prefix(word: str, rank: dict[str, int]) -> tuple[list[tuple[int, int]], tuple[int, int]]:
    """The rarest bigrams as (rank, place) in order, and the last of the first three. One more
    is given where it repeats the last one right behind it."""
    grams = [(rank[word[i : i + _GRAM]], i) for i in range(len(word) - _GRAM + 1)]
    first = heapq.nsmallest(_PREFIX + 1, grams)
    last = first[:_PREFIX][-1]
    if len(first) > _PREFIX and first[_PREFIX] != (last[0], last[1] + 1):
        first.pop()
    return first, last


def pivots(grams: list[tuple[int, int]], weight: list[int], k: int = 2) -> list[tuple[int, int]]:
    """The `k` bigrams (rank, place) that do not overlap with the least weight in all, by
    dynamic programming over places; fewer where the word is too short."""
    grams = sorted(grams, key=lambda g: g[1])
    best: list[list[tuple[int, list]]] = [[(0, [])] for _ in range(len(grams) + 1)]
    for i, gram in enumerate(grams):
        before = i
        while before and grams[before - 1][1] > gram[1] - _GRAM:
            before -= 1
        choices = list(best[i])
        for j, (cost, chosen) in enumerate(best[before][:k]):
            taken = (cost + weight[gram[0]], [*chosen, gram])
            if j + 1 == len(choices):
                choices.append(taken)
            elif taken[0] < choices[j + 1][0]:
                choices[j + 1] = taken
        best[i + 1] = choices
    return best[-1][-1][1]


def _entries(rank: dict[str, int], weight: list[int]):
    names = ["key", "pivot", "last", "word", "n"]
    digest = xxhash.xxh64_intdigest

    def sides(word: str, place: int) -> tuple[int, int]:
        head, tail = word[: place + _GRAM].encode(), word[place:].encode()
        # Text up to the bigram and the bigram itself fix its place as well.
        return digest(head, 1) - (1 << 63), digest(tail, 2) - (1 << 63)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 4096):
                part = batch.slice(low, 4096)
                rows: tuple[list, ...] = ([], [], [], [])
                for at, word in enumerate(part.column("word").to_pylist()):
                    grams, last = prefix(word, rank)
                    end = last[0] << 40 | last[1]
                    chosen = pivots(grams[:_PREFIX], weight)
                    for is_pivot, entered in ((True, chosen), (False, grams)):
                        for _, place in entered:
                            for key in sides(word, place):
                                for column, value in zip(rows, (key, is_pivot, end, at), strict=True):
                                    column.append(value)
                key, is_pivot, end, at = rows
                columns = [
                    pa.array(key, pa.int64()), pa.array(is_pivot), pa.array(end, pa.int64()),
                    part.column("word").cast(pa.string()).take(pa.array(at, pa.int64())),
                    part.column("n").take(pa.array(at, pa.int64())),
                ]
                yield pa.RecordBatch.from_arrays(columns, names)

    return run


def one_edit(a: str, b: str) -> bool:
    """Whether one insertion, deletion or replacement makes one word of the other. The first
    difference is found by halving."""
    if len(a) > len(b):
        a, b = b, a
    if a == b or len(b) - len(a) > 1:
        return False
    low, high = 0, len(a)
    while low < high:
        middle = (low + high + 1) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle - 1
    return a[low + (len(a) == len(b)) :] == b[low + 1 :]


def _one_edit_apart(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        words = zip(batch.column("word").to_pylist(), batch.column("near").to_pylist(), strict=True)
        yield batch.filter(pa.array([one_edit(a, b) for a, b in words], pa.bool_()))


def near_words(vocabulary: DataFrame, scratch: Scratch) -> DataFrame:
    """Every pair of words at exactly one insertion, deletion or replacement, once in each
    direction: word, n, near, near_n. vocabulary: word and n, each word once and of at least
    four characters."""
    grams = vocabulary.select("word").mapInArrow(_gram_counts, "gram string, n bigint")
    # Two letters out of 90 each: at most 8,100 rows reach the driver.
    counted = sorted((n, gram) for gram, n in grams.groupBy("gram").agg(F.sum("n")).collect())
    rank = {gram: i for i, (_, gram) in enumerate(counted)}
    weight = [n for n, _ in counted]
    entries = vocabulary.select("word", "n").mapInArrow(
        _entries(rank, weight), "key bigint, pivot boolean, last bigint, word string, n bigint"
    )
    entries = scratch.table(entries, "grams")
    keys, length = ["key", "length"], F.char_length("word")
    lengths = F.explode(F.array(length - 1, length, length + 1))
    index = entries.filter("pivot").select("key", lengths.alias("length"), "last", "word", "n")
    others = entries.filter("NOT pivot").select(
        "key", length.alias("length"), F.col("last").alias("end"), F.col("word").alias("near"), F.col("n").alias("near_n")
    )
    counts = scratch.table(others.groupBy(*keys).agg(F.count("*").alias("n")), "gram-counts")
    heavy = heavy_keys(counts, keys)

    def met(kept: str) -> DataFrame:
        both = salted_join(others.filter(kept), index.filter(kept), keys, heavy, F.xxhash64("near"))
        return both.filter("last <= end").select("word", "n", "near", "near_n")

    found = met(f"length <= {LONG}").filter(F.levenshtein("word", "near", 1) == 1)
    if not counts.filter(f"length > {LONG}").isEmpty():
        kinds = "word string, n bigint, near string, near_n bigint"
        found = found.unionByName(met(f"length > {LONG}").mapInArrow(_one_edit_apart, kinds))
    ordered = F.col("word") < F.col("near")
    a, b = F.struct("word", "n"), F.struct(F.col("near").alias("word"), F.col("near_n").alias("n"))
    pairs = found.select(F.when(ordered, a).otherwise(b).alias("a"), F.when(ordered, b).otherwise(a).alias("b"))
    both = pairs.distinct().select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("p"))
    return both.select("p.a.word", "p.a.n", F.col("p.b.word").alias("near"), F.col("p.b.n").alias("near_n"))


def _roots(forms: DataFrame, scratch: Scratch) -> DataFrame:
    """word and root, by following forms from the roots outwards. A form occurs at least twice
    as often, so there are no circles and the rounds are at most the binary logarithm of the
    largest count; a word is the form of no more words than can be near it."""
    settled = [forms.filter("form IS NULL").select("word", F.col("word").alias("root"))]
    left = forms.filter("form IS NOT NULL").select("word", "form")
    while not left.isEmpty():
        last = settled[-1].select(F.col("word").alias("form"), "root")
        joined = scratch.table(left.join(last, "form", "left").select("word", "form", "root"), "roots")
        settled.append(joined.filter("root IS NOT NULL").select("word", "root"))
        left = joined.filter("root IS NULL").select("word", "form")
    found = settled[0]
    for more in settled[1:]:
        found = found.unionByName(more)
    return found


def variants(
    docs: DataFrame, scratch: Scratch, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, ratio: int = RATIO
) -> DataFrame:
    """One row per distinct word of at least `min_length` (four or more) characters and
    `min_count` occurrences in all texts: word, form (its near word with most occurrences, the
    first in code-point order of equals, if it has at least `ratio` times the word's), root (the
    last of the chain of forms, the word itself without one), n, n_near, form_n.

    Null texts have no words, a null doc_id counts as an empty one, repeated rows count again and
    further columns are left out.
    """
    if min_length < _GRAM * 2:
        raise ValueError("two bigrams that do not overlap need words of four characters or more")
    vocabulary = scratch.table(words(docs, min_length, min_count), "words")
    pairs = near_words(vocabulary, scratch)
    best = F.min(F.struct((-F.col("near_n")).alias("n"), F.col("near").alias("word")))
    near = pairs.groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    enough = -F.col("best.n") >= ratio * F.col("n")
    forms = vocabulary.join(near, "word", "left").select(
        "word",
        F.when(enough, F.col("best.word")).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(enough, -F.col("best.n")).alias("form_n"),
    )
    forms = scratch.table(forms, "forms")
    roots = _roots(forms, scratch)
    return forms.join(roots, "word").select("word", "form", "root", "n", "n_near", "form_n")
