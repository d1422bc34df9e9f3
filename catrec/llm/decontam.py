"""Benchmark decontamination by pigeonhole edit matching.

Texts and test items are compared as lower-case letters and digits with single
spaces.  An item of up to 30 words, and each window of 20 words (one at every word)
of an item of more than 20, may be met with one edit per 16 characters.  An item is
cut into one piece more than that, the item of windows into a grid of pieces so short
that each window holds one piece more than its edits; so some piece must stand exactly
in any text that holds it.  An automaton finds all pieces in one pass over a text.  Of an
item's or window's grams of four characters each edit destroys four at most; hits whose
surroundings lack more are left out, and Myers' bit-parallel distance verifies the others,
so that the distance reported is the least of the item or its windows in the text.  In scripts without
spaces two characters count as a word.

The test items are taken in blocks of bounded bytes, each broadcast and run
over all documents, so their number has no limit.

Cases: a null or letterless text holds nothing; an item without letters or
digits is never found; an item below five words is found only in a text equal
to it; repeated rows and items repeat; texts are read whole.
"""

from __future__ import annotations

import functools
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catrec.llm.common import text_chunks, widened

EDIT_CHARS = 16
LEAST_WORDS = 5
WHOLE_WORDS = 30
WINDOW_WORDS = 20
#: Characters of a grid piece, at most.
PIECE_CHARS = 13
#: Characters of the grams that are counted before a hit's surroundings are verified.
GRAM = 4
#: Windows that a task holds ready.
READY = 4096
# Thai and Lao, Tibetan, Burmese, Khmer, Kana and Han stand without spaces.
UNSPACED = "\u0E00-\u0FFF\u1000-\u109F\u1780-\u17FF\u3040-\u30FF\u3400-\u9FFF\uF900-\uFAFF\U00020000-\U0003FFFF"
find_words = re.compile(f"[{UNSPACED}]{{1,2}}|[^ {UNSPACED}]+").finditer
#: Bytes of test items that are broadcast at a time.
BLOCK_BYTES = 4 << 20


def plain(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+", " "))


def grams(text: str) -> set[str]:
    return {text[i:i + GRAM] for i in range(len(text) - GRAM + 1)}


class Grid:
    """An item's windows (starts, ends) and the pieces that they share."""

    def __init__(self, item: int, text: str, spans: list[tuple[int, int]]):
        self.item, self.text = item, text
        self.starts = [start for start, _ in spans[:len(spans) - WINDOW_WORDS + 1]]
        self.ends = [end for _, end in spans[WINDOW_WORDS - 1:]]
        lengths = {b - a for a, b in zip(self.starts, self.ends, strict=True)}
        # A window of n characters holds (n - size + 1) // size whole pieces wherever it starts.
        self.size = next(size for size in range(PIECE_CHARS, 0, -1)
                         if all((n - size + 1) // size > n // EDIT_CHARS for n in lengths))

    def near(self, text: str, start: int, offset: int) -> list[int]:
        """The windows on this diagonal that hold the piece and keep enough grams for their budget."""
        held = self.holding(offset)
        if not held:
            return []
        first, last = self.starts[held[0]], self.ends[held[-1]]
        most = (last - first) // EDIT_CHARS
        present = grams(text[max(0, start + first - most):start + last + most])
        lost = list(accumulate((self.text[i:i + GRAM] not in present for i in range(first, last - GRAM + 1)), initial=0))
        return [at for at in held if lost[self.ends[at] - GRAM + 1 - first] - lost[self.starts[at] - first]
                <= GRAM * ((self.ends[at] - self.starts[at]) // EDIT_CHARS)]

    def pieces(self) -> list[tuple[int, str]]:
        return [(i, self.text[i:i + self.size]) for i in range(0, len(self.text) - self.size + 1, self.size)]

    def holding(self, offset: int) -> range:
        """The windows that hold the piece at ``offset``."""
        return range(bisect_left(self.ends, offset + self.size), bisect_right(self.starts, offset))


class Pattern:
    """One item or window, ready for Myers' distance."""

    def __init__(self, item: int, text: str):
        self.item, self.text, self.length = item, text, len(text)
        self.budget = len(text) // EDIT_CHARS
        self.masks: dict[str, int] = {}
        for i, c in enumerate(text):
            self.masks[c] = self.masks.get(c, 0) | 1 << i

    def pieces(self) -> list[tuple[int, str]]:
        n = self.budget + 1
        cuts = [self.length * i // n for i in range(n + 1)]
        return [(a, self.text[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]

    def lost(self, text: str, start: int) -> int:
        """Grams of the pattern that its surroundings in a text don't hold; each edit destroys at most GRAM of them."""
        present = grams(text[max(0, start - self.budget):start + self.length + self.budget])
        return sum(gram not in present for gram in self.grams)

    @functools.cached_property
    def grams(self) -> list[str]:
        return [self.text[i:i + GRAM] for i in range(self.length - GRAM + 1)]

    def distance(self, region: str) -> int:
        """Least edits between the pattern and any part of the region."""
        if self.text in region:
            return 0
        full, high, masks = (1 << self.length) - 1, 1 << (self.length - 1), self.masks.get
        up, down, score = full, 0, self.length
        best = score
        for c in region:
            same = masks(c, 0)
            vertical = same | down
            across = (((same & up) + up) ^ up) | same
            plus = down | (~(across | up) & full)
            minus = up & across
            if plus & high:
                score += 1
            elif minus & high:
                score -= 1
                if score < best:
                    best = score
            plus = plus << 1 & full
            up = (minus << 1 & full) | (~(vertical | plus) & full)
            down = plus & vertical
        return best


class Matcher:
    """Finds the test items (id, plain text) of a block in plain texts."""

    def __init__(self, items: list[tuple[int, str]]):
        import ahocorasick

        self.short: dict[str, list[int]] = {}
        self.sources: list[Pattern | Grid] = []
        hits: dict[str, list[tuple[int, int]]] = {}
        for item, text in items:
            spans = [m.span() for m in find_words(text)]
            if len(spans) < LEAST_WORDS:
                if text:
                    self.short.setdefault(text, []).append(item)
                continue
            sources = [Pattern(item, text)] if len(spans) <= WHOLE_WORDS else []
            for source in sources + ([Grid(item, text, spans)] if len(spans) > WINDOW_WORDS else []):
                for offset, piece in source.pieces():
                    hits.setdefault(piece, []).append((len(self.sources), offset))
                self.sources.append(source)
        self.window = functools.lru_cache(READY)(self._window)
        self.automaton = ahocorasick.Automaton()
        for piece, places in hits.items():
            self.automaton.add_word(piece, (len(piece), places))
        if hits:
            self.automaton.make_automaton()

    def find(self, text: str) -> dict[int, int]:
        """Least distance of each item that the text holds."""
        found = dict.fromkeys(self.short.get(text, ()), 0)
        if not len(self.automaton):
            return found
        tried, verified = set(), set()
        for end, (length, places) in self.automaton.iter(text):
            for number, offset in places:
                source = self.sources[number]
                if found.get(source.item) == 0:
                    continue
                whole = isinstance(source, Pattern)
                # Where the item begins in the text if nothing before the piece differs.
                start = end - length + 1 - offset
                if (number, start, 0 if whole else offset) in tried:
                    continue
                tried.add((number, start, 0 if whole else offset))
                for at in (0,) if whole else source.near(text, start, offset):
                    pattern = source if whole else self.window(number, at)
                    first = start + (0 if whole else source.starts[at])
                    if not whole:
                        if (number, at, first) in verified:
                            continue
                        verified.add((number, at, first))
                    best = min(pattern.budget, found.get(source.item, pattern.length) - 1)
                    if whole and source.lost(text, start) > GRAM * best:
                        continue
                    distance = pattern.distance(text[max(0, first - pattern.budget):first + pattern.length + pattern.budget])
                    if distance <= best:
                        found[source.item] = distance
                        if distance == 0:
                            break
        return found

    def _window(self, number: int, at: int) -> Pattern:
        grid = self.sources[number]
        return Pattern(grid.item, grid.text[grid.starts[at]:grid.ends[at]])


@functools.lru_cache(maxsize=2)
def matcher_of(items: tuple[tuple[int, str], ...]) -> Matcher:
    return Matcher(list(items))


def null_first(found: tuple[int | None, int]) -> tuple[bool, int]:
    """Order of (item, distance); items without an id count as one."""
    return found[0] is not None, found[0] or 0


def find_items(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(row_, contaminated, items, distances): each row of ``docs`` as a struct, and the items (by id) that it holds."""
    spark = docs.sparkSession
    items = benchmark.select(F.col("item_id").alias("item"), plain(F.col("text")).alias("text"))
    held = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-held // BLOCK_BYTES))
    source = docs.select(F.struct("*").alias("row_"), plain(F.col("text")).alias("plain_"))
    found = None
    for block in range(blocks):
        part = items.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == block).orderBy("item", "text")
        shipped = spark.sparkContext.broadcast(tuple((r["item"], r["text"]) for r in part.toLocalIterator()))
        found = match_block(source if found is None else found, shipped, first=found is None)
    return found.withColumn("contaminated", F.size("items") > 0).drop("plain_")


def match_block(source: DataFrame, shipped, first: bool) -> DataFrame:
    """Adds (or extends) ``items`` and ``distances`` by the items of one block, in the same pass order of rows."""
    names = source.columns
    schema = widened(source.schema, "items array<long>, distances array<int>") if first else source.schema

    def matched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = matcher_of(shipped.value)
        for chunk in text_chunks(batches, "plain_"):
            before = ([{}] * chunk.num_rows if first else
                      [dict(zip(a, b, strict=True)) for a, b in zip(chunk.column("items").to_pylist(),
                                                                    chunk.column("distances").to_pylist(), strict=True)])
            all_found = [sorted({**old, **matcher.find(text)}.items(), key=null_first)
                         for old, text in zip(before, chunk.column("plain_").to_pylist(), strict=True)]
            added = [pa.array([[i for i, _ in f] for f in all_found], pa.list_(pa.int64())),
                     pa.array([[d for _, d in f] for f in all_found], pa.list_(pa.int32()))]
            kept = names if first else names[:-2]
            yield pa.RecordBatch.from_arrays([*(chunk.column(c) for c in kept), *added],
                                             names=[*kept, "items", "distances"])

    return source.mapInArrow(matched, schema)
