"""Best-fit packing of token sequences by a grouping genetic algorithm on islands.

Documents become token pieces of at most ``capacity``; full pieces fill a
sequence each.  The others are dealt by a hash into problems of about
``PROBLEM`` pieces.  Every problem is worked on by ``ISLANDS`` islands, one row
each, with own random seeds.  A chromosome is a grouping of the pieces into
bins; crossover injects whole well-filled bins of one parent into the other,
removes that parent's bins which hold the same pieces, and best-fits the pieces
so displaced.  After each epoch the best grouping of an island migrates to the
next one of its problem; a problem whose grouping meets a lower bound rests.
Bins left loose are dissolved, and their pieces form the problems of the next
round until one problem holds them all, so the loss doesn't grow with the number
of problems.

States are stored between epochs and every seed is a function of (round, problem,
island, epoch), so a lost executor's rows are worked out again alike.

Cases: a null text is an empty one, which is a piece of the end token alone;
texts are read whole; repeated ids and equal rows are documents of their own;
an empty table gives no rows; other columns, whatever their names, are left out.
"""

from __future__ import annotations

import functools
import json
import os
import random
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catrec.llm.common import stored, text_chunks, widened

#: Pieces of one problem, about.
PROBLEM = 2048
ISLANDS, EPOCHS, GENERATIONS, POPULATION = 3, 3, 12, 6
#: Bins filled below this share of the capacity are packed anew in the next round.
WELL_FILLED = 0.98
#: Words whose ids a worker remembers (the memory is emptied when full), and the length of the longest.
REMEMBERED, REMEMBERED_LENGTH = 1_000_000, 64


# ---------------------------------------------------------------- pieces

def breaks_at_space(spec: dict) -> bool:
    """White space only parts words in this vocabulary: a text's ids are those of its words in a row."""
    pre = spec.get("pre_tokenizer") or {}
    first = (pre.get("pretokenizers") or [pre])[0]
    dropped = first.get("type") == "Split" and first.get("behavior") == "Removed" and first.get("invert") and \
        "[^\\s" in str((first.get("pattern") or {}).get("Regex"))
    kinds = {x.get("type") for x in [spec.get("normalizer") or {}, *(spec.get("normalizer") or {}).get("normalizers", [])]}
    added = all(not (x["lstrip"] or x["rstrip"] or x["single_word"] or x["content"].split() != [x["content"]])
                for x in spec.get("added_tokens", []))
    return bool(dropped and added and not spec.get("post_processor") and
                kinds <= {"Sequence", "NFC", "Replace", "Lowercase", None})


#: The word pattern for which plain chunks can be cut here (a fixed value of the vocabulary files).
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: A text without these is lower-cased letter by letter, has one normal form and falls into PLAIN_WORDS.
NOT_PLAIN = re.compile("[^\t-\r -~À-ÖØ-öø-ÿ]|<[|]").search
PLAIN_WORDS = re.compile("[a-zß-öø-ÿ]+|'(?:s|t|re|ve|m|ll|d)|[0-9]|[^\t-\r a-z0-9ß-öø-ÿ]+").findall
CHUNKS = re.compile("[^\t-\r ]+").findall
#: Words that are encoded at a time.
ENCODED = 5_000


class SpacedEncoder:
    """Texts -> ids (little-endian unsigned 32-bit), for vocabularies in which white space only parts words.

    A plain text's ids are those of its words, any other's those of its chunks
    between spaces.  Words and chunks are remembered; new words go to the
    library many at a time, and each ends where a token ends a word.
    """

    def __init__(self, tokenizer, spec: dict):
        self.tokenizer, self.known = tokenizer, {}
        model = spec["model"]
        suffix = model.get("end_of_word_suffix")
        pre = spec["pre_tokenizer"]
        pattern = (pre.get("pretokenizers") or [pre])[0]["pattern"].get("Regex")
        self.ends = None
        if suffix and pattern == WORD_PATTERN:
            self.ends = np.zeros(1 + max([*model["vocab"].values(), *(x["id"] for x in spec["added_tokens"])]), bool)
            self.ends[[i for token, i in model["vocab"].items() if token.endswith(suffix)]] = True

    def encode(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4")

    def odd(self, text: str) -> bool:
        return self.ends is None or bool(NOT_PLAIN(text))

    def parts(self, text: str | None) -> list[str]:
        if not text:
            return []
        if not self.odd(text):
            return PLAIN_WORDS(text.lower())
        found = []
        for chunk in CHUNKS(text):
            if self.odd(chunk):
                found.append(chunk)
            else:
                found += PLAIN_WORDS(chunk.lower())
        return found

    def learn(self, new: set[str]) -> None:
        words = []
        for x in new:
            # Most are plain ASCII words, told without the pattern.
            if self.ends is None or not (x.isascii() and x.isprintable() and "<|" not in x) and self.odd(x):
                self.known[x] = self.encode(x).tobytes()
            else:
                words.append(x)
        for start in range(0, len(words), ENCODED):
            part = words[start:start + ENCODED]
            ids = self.encode(" ".join(part))
            data, low = ids.tobytes(), 0
            for word, high in zip(part, (4 * (np.flatnonzero(self.ends[ids]) + 1)).tolist(), strict=True):
                self.known[word] = data[low:high]
                low = high

    def __call__(self, texts: list[str | None]) -> Iterator[bytes]:
        known = self.known
        if len(known) > REMEMBERED:
            known.clear()
        parts = [self.parts(text) for text in texts]
        new = set().union(*parts).difference(known)
        self.learn(new)
        for words in parts:
            yield b"".join(map(known.__getitem__, words))
        for x in [x for x in new if len(x) > REMEMBERED_LENGTH]:
            del known[x]


@functools.cache
def encoder_of(spec: str):
    """Texts -> their ids; one per worker process, so that its memory of words lasts over tasks."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer, data = Tokenizer.from_str(spec), json.loads(spec)
    if breaks_at_space(data):
        return SpacedEncoder(tokenizer, data)

    def whole(texts: list[str | None]) -> Iterator[bytes]:
        for text in texts:
            ids = tokenizer.encode(text, add_special_tokens=False).ids if text else []
            yield np.array(ids, "<u4").tobytes()

    return whole


def token_pieces(docs: DataFrame, vocabulary: str, capacity: int, end_id: int, id_column: str = "doc_id",
                 text_column: str = "text", ids: bool = False) -> DataFrame:
    """(id, piece, start, length, ids_crc32[, ids]) of every document's tokens and end token, cut at ``capacity``."""
    with open(vocabulary, encoding="utf-8") as file:
        spec = docs.sparkSession.sparkContext.broadcast(file.read())
    end = np.array([end_id], "<u4").tobytes()
    step = 4 * capacity

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder_of(spec.value)
        for chunk in text_chunks(batches, "text"):
            owner, piece, size, crc, held = [], [], [], [], []
            for row, data in enumerate(encode(chunk.column("text").to_pylist())):
                data += end
                for k, at in enumerate(range(0, len(data), step)):
                    part = data[at:at + step]
                    owner.append(row)
                    piece.append(k)
                    size.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
                    if ids:
                        held.append(part)
            columns = [chunk.column("id").take(pa.array(owner, pa.int32())), pa.array(piece, pa.int32()),
                       pa.array([k * capacity for k in piece], pa.int64()), pa.array(size, pa.int64()), pa.array(crc, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns + [pa.array(held, pa.binary())] * ids, names=names)

    source = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    schema = widened(source.select("id").schema, "piece int, start long, length long, ids_crc32 long" + ", ids binary" * ids)
    names = schema.names
    return source.mapInArrow(cut, schema)


# ---------------------------------------------------------------- groupings

class Bins:
    """Open bins by free space; a bit for each free space that occurs finds the tightest fit."""

    def __init__(self, capacity: int):
        self.capacity, self.groups, self.free, self.by_free, self.mask = capacity, [], [], {}, 0

    def add(self, group: list[int], free: int) -> None:
        self.groups.append(group)
        self.free.append(free)
        self._list(len(self.free) - 1, free)

    def _list(self, b: int, free: int) -> None:
        self.by_free.setdefault(free, []).append(b)
        self.mask |= 1 << free

    def best_fit(self, item: int, size: int) -> None:
        fitting = self.mask >> size
        if not fitting:
            self.add([item], self.capacity - size)
            return
        free = size + (fitting & -fitting).bit_length() - 1
        same = self.by_free[free]
        b = same.pop()
        if not same:
            self.mask ^= 1 << free
        self.groups[b].append(item)
        self.free[b] = free - size
        self._list(b, free - size)


def packed(order: list[int], sizes: list[int], capacity: int) -> Bins:
    bins = Bins(capacity)
    for i in order:
        bins.best_fit(i, sizes[i])
    return bins


def merit(bins: Bins) -> tuple[int, int]:
    """Fewer bins, then fuller ones (sum of squared fills), are better; greater is better."""
    return -len(bins.free), sum((bins.capacity - f) ** 2 for f in bins.free)


def lower_bound(sizes: list[int], capacity: int) -> int:
    """No grouping has fewer bins: by volume, and by what can't share a bin with pieces over half."""
    s = np.sort(np.asarray(sizes, np.int64))
    ahead = np.concatenate([[0], np.cumsum(s)])
    half = np.searchsorted(s, capacity // 2, "right")
    bound = -(-int(ahead[-1]) // capacity)
    for k in np.unique(s[:half]):
        small, big = np.searchsorted(s, k, "left"), np.searchsorted(s, capacity - k, "right")
        big = max(big, half)
        room = (big - half) * capacity - (ahead[big] - ahead[half])
        over = max(0, int(ahead[half] - ahead[small] - room))
        bound = max(bound, int(len(s) - half) + -(-over // capacity))
    return bound


def crossover(a: Bins, b: Bins, sizes: list[int], rng: random.Random) -> Bins:
    """Well-filled bins of ``b`` go whole into ``a``; bins of ``a`` that hold their pieces, and one of its
    loosest, are emptied, and the displaced pieces are best-fitted, larger ones first."""
    ranked = sorted(range(len(b.free)), key=b.free.__getitem__)
    well = ranked[:max(1, len(ranked) // 2)]
    chosen = rng.sample(well, rng.randint(1, max(1, len(well) // 4)))
    injected = {i for g in chosen for i in b.groups[g]}
    loosest = max(range(len(a.free)), key=lambda g: (a.free[g], rng.random()))
    child, displaced = Bins(a.capacity), []
    for g in chosen:
        child.add(list(b.groups[g]), b.free[g])
    for g, group in enumerate(a.groups):
        if g != loosest and injected.isdisjoint(group):
            child.add(list(group), a.free[g])
        else:
            displaced += [i for i in group if i not in injected]
    jitter = 0.1 * rng.random()
    displaced.sort(key=lambda i: -sizes[i] * (1 + jitter * rng.random()))
    for i in displaced:
        child.best_fit(i, sizes[i])
    return child


def to_bytes(bins: Bins, n: int) -> bytes:
    of = np.empty(n, "<i4")
    for b, group in enumerate(bins.groups):
        of[group] = b
    return of.tobytes()


def from_bytes(data: bytes, sizes: list[int], capacity: int) -> Bins:
    groups: dict[int, list[int]] = {}
    for i, b in enumerate(np.frombuffer(data, "<i4").tolist()):
        groups.setdefault(b, []).append(i)
    bins = Bins(capacity)
    for group in groups.values():
        bins.add(group, capacity - sum(sizes[i] for i in group))
    return bins


def evolve(sizes: list[int], capacity: int, population: list[Bins], bound: int, rng: random.Random) -> list[Bins]:
    """One epoch of an island: the population, best first."""
    n = len(sizes)
    largest_first = sorted(range(n), key=lambda i: -sizes[i])
    while len(population) < POPULATION:
        jitter = 0.3 * rng.random() if population else 0
        order = sorted(largest_first, key=lambda i: -sizes[i] * (1 + jitter * rng.random())) if jitter else largest_first
        population.append(packed(order, sizes, capacity))
        if len(population[-1].free) == bound:
            break
    population.sort(key=merit, reverse=True)
    for _ in range(GENERATIONS * POPULATION):
        if len(population) < 2 or len(population[0].free) <= bound:
            break
        # The better of two drawn at random is a parent; a child takes the worst one's place if it is better.
        a, b = (min(rng.sample(range(len(population)), 2)) for _ in range(2))
        child = crossover(population[a], population[b], sizes, rng)
        if merit(child) > merit(population[-1]):
            population[-1] = child
            population.sort(key=merit, reverse=True)
    return population


# ---------------------------------------------------------------- islands

STATE = "problem long, island int, sizes array<int>, bound int, population array<binary>, bins int, spread double"


def epoch(states: DataFrame, capacity: int, number: int, round_: int, tasks: int) -> DataFrame:
    """All islands one epoch on; ``states`` (problem, island, sizes, population), immigrants among the population."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                sizes, seed = row["sizes"], f"{round_}/{row['problem']}/{row['island']}/{number}"
                bound = lower_bound(sizes, capacity)
                come = [from_bytes(x, sizes, capacity) for x in dict.fromkeys(row["population"] or [])]
                kept = evolve(sizes, capacity, come, bound, random.Random(seed))[:POPULATION]
                yield pa.RecordBatch.from_pylist([{
                    "problem": row["problem"], "island": row["island"], "sizes": sizes, "bound": bound,
                    "population": [to_bytes(x, len(sizes)) for x in kept], "bins": len(kept[0].free),
                    "spread": float(merit(kept[0])[1])}], kind)

    schema = widened(states.select().schema, STATE)
    kind = pa.schema([("problem", pa.int64()), ("island", pa.int32()), ("sizes", pa.list_(pa.int32())), ("bound", pa.int32()),
                      ("population", pa.list_(pa.binary())), ("bins", pa.int32()), ("spread", pa.float64())])
    dealt = states.select("problem", "island", "sizes", "population").repartition(tasks, "problem", "island")
    return stored(dealt.mapInArrow(work, schema))


def migrated(states: DataFrame) -> DataFrame:
    """Each island's best grouping joins the next island of its problem."""
    guests = states.select("problem", F.pmod(F.col("island") + 1, F.lit(ISLANDS)).alias("island"),
                           F.slice("population", 1, 1).alias("guest"))
    # The guest comes in front, so that a full population loses its worst.
    return states.join(guests, ["problem", "island"]).withColumn("population", F.concat("guest", "population"))


def pack_round(pieces: DataFrame, count: int, capacity: int, round_: int) -> DataFrame:
    """(pid, length, sequence, offset, fill) of ``pieces`` (pid, length): the best grouping of each problem."""
    problems = -(-count // PROBLEM)
    tasks = max(int(pieces.sparkSession.conf.get("spark.sql.shuffle.partitions")), problems * ISLANDS // 16)
    dealt = pieces.withColumn("problem", F.pmod(F.xxhash64("pid", F.lit(round_)), F.lit(problems)))
    posed = stored(dealt.groupBy("problem").agg(F.sort_array(F.collect_list(F.struct("length", "pid"))).alias("items"))
                   .select("problem", "items.pid", F.col("items.length").cast("array<int>").alias("sizes")))
    islands = F.explode(F.sequence(F.lit(0), F.lit(ISLANDS - 1))).alias("island")
    states = posed.select("problem", "sizes", islands, F.lit(None).cast("array<binary>").alias("population"))
    states, rested = epoch(states, capacity, 0, round_, tasks), None
    for number in range(1, EPOCHS):
        still = stored(states.groupBy("problem").agg((F.min("bins") > F.max("bound")).alias("open")).where("open"))
        if still.isEmpty():
            break
        closed = states.join(still, "problem", "left_anti")
        rested = closed if rested is None else rested.union(closed)
        states = epoch(migrated(states.join(still, "problem", "left_semi")), capacity, number, round_, tasks)
    states = states if rested is None else states.unionByName(rested)
    best = states.groupBy("problem").agg(F.min_by(F.col("population")[0], F.struct("bins", -F.col("spread"), "island")).alias("best"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                pid, sizes = np.array(row["pid"], np.int64), np.array(row["sizes"], np.int64)
                bins = np.frombuffer(row["best"], "<i4")
                order = np.lexsort((pid, bins))
                pid, sizes, bins = pid[order], sizes[order], bins[order]
                first = np.flatnonzero(np.r_[True, bins[1:] != bins[:-1]])
                own = np.cumsum(np.r_[True, bins[1:] != bins[:-1]]) - 1
                ends = np.cumsum(sizes)
                fill = np.add.reduceat(sizes, first)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x) for x in (pid, sizes, pid[first][own], ends - sizes - (ends - sizes)[first][own], fill[own])],
                    names=["pid", "length", "sequence_id", "offset", "fill"])

    solved = posed.join(best, "problem").repartition(tasks, "problem")
    return stored(solved.mapInArrow(place, "pid long, length long, sequence_id long, offset long, fill long"))


def pack(pieces: DataFrame, capacity: int) -> DataFrame:
    """(pid, sequence_id, offset) of ``pieces`` (pid unique, length from 1 to ``capacity``); a sequence is known by
    its least pid."""
    out = pieces.where(F.col("length") >= capacity).select("pid", F.col("pid").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    left = pieces.where(F.col("length") < capacity).select("pid", "length")
    count, round_ = left.count(), 0
    while count:
        placed = pack_round(left, count, capacity, round_)
        loose = placed.where(F.col("fill") < WELL_FILLED * capacity)
        again = loose.count() if count > PROBLEM else 0
        if again > count // 2:  # nothing is won by packing most of them anew
            again = 0
        kept = placed.where(F.col("fill") >= WELL_FILLED * capacity) if again else placed
        out = out.union(kept.select("pid", "sequence_id", "offset"))
        left, count, round_ = loose.select("pid", "length"), again, round_ + 1
    return out


def pack_documents(docs: DataFrame, vocabulary: str, capacity: int = 4096, end_id: int = 1, id_column: str = "doc_id",
                   text_column: str = "text", ids: bool = False) -> DataFrame:
    """(id, piece, start, length, ids_crc32[, ids], sequence_id, offset) of every piece of every document."""
    pieces = stored(token_pieces(docs, vocabulary, capacity, end_id, id_column, text_column, ids)
                    .withColumn("pid", F.monotonically_increasing_id()))
    return pieces.join(pack(pieces.select("pid", "length"), capacity), "pid").drop("pid").withColumnRenamed("id", id_column)


def sequences(packed_pieces: DataFrame) -> DataFrame:
    """(sequence_id, ids): the token ids of each sequence, from pieces packed with ``ids=True``."""
    parts = packed_pieces.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    joined = F.aggregate(F.col("parts.ids"), F.lit(b"").cast("binary"), lambda a, b: F.concat(a, b))
    return parts.select("sequence_id", joined.alias("ids"))
