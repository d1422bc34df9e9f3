"""Token counts by heap-and-linked-list byte-pair merging.

A word's symbols form a linked list; a heap holds its mergeable neighbours by
rank, then position.  The least is popped, stale entries are passed over, the
pair is joined and its two new neighbourhoods are pushed.  A word's count is
its symbols minus its merges; no identifier is produced.

Cases: a null text counts 0 bytes and 0 tokens, like an empty one; texts are
read whole; special strings inside a text count as one token each, as the
vocabulary file's own library does by default; repeated rows repeat.
"""

from __future__ import annotations

import functools
import heapq
import json
import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catrec.llm.common import text_chunks

#: Words whose counts a worker remembers; the memory is emptied when full (it only saves time).
REMEMBERED = 1_000_000
#: White space of the vocabulary's patterns.
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    letter = {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}
    return [letter[b] for b in range(256)]


#: What the standard library's classes sort differently (and all beyond the basic plane) takes the slower pattern.
ODD = re.compile("|".join(["[" + "".join(
    c for c in map(chr, range(0x80, 0x10000)) if unicodedata.category(c) in ("No", "Nl")) + "]",
    "[\U00010000-\U0010ffff]"])).search
CONTROLS = re.compile("[\x1c-\x1f]").search
CONTRACTIONS = "'s|'t|'re|'ve|'m|'ll|'d|"


class Remembered(dict):
    """Counts of words already merged by this worker."""

    def __init__(self, count):
        self.count = count

    def __missing__(self, word):
        if len(self) >= REMEMBERED:
            self.clear()
        n = self[word] = self.count(word)
        return n


class PairMerger:
    """Counts tokens with the merges of a word-end byte-pair vocabulary (a .json file's text)."""

    def __init__(self, spec: str):
        import regex

        data = json.loads(spec)
        model = data["model"]
        vocab, end = model["vocab"], model["end_of_word_suffix"]
        letters = byte_letters()
        self.inner = [vocab[x] for x in letters]
        self.last = [vocab[x + end] for x in letters]
        self.ranks, self.joined = {}, []
        for rank, (left, right) in enumerate(model["merges"]):
            self.ranks.setdefault(vocab[left] << 20 | vocab[right], rank)
            self.joined.append(vocab[left + right])
        specials = [x["content"] for x in data["added_tokens"]]
        self.special = re.compile("|".join(map(re.escape, specials))) if specials else None
        self.any_words = regex.compile(CONTRACTIONS + r"\p{L}+|\p{N}|[^" + SPACE + r"\p{L}\p{N}]+").findall
        self.plain_words = re.compile(CONTRACTIONS + r"[^\W\d_]+|\d|(?:[^\w\s]|_)+").findall
        self.known = Remembered(self.count_word)

    def count_word(self, word: str) -> int:
        data = word.encode()
        n = len(data)
        if n == 1:
            return 1
        inner, ranks, joined = self.inner, self.ranks.get, self.joined
        symbols = [inner[b] for b in data]
        symbols[-1] = self.last[data[-1]]
        heap, left = [], symbols[0]
        for i in range(1, n):
            right = symbols[i]
            rank = ranks(left << 20 | right)
            if rank is not None:
                heap.append(rank << 32 | i - 1)
            left = right
        if not heap:
            return n
        heapq.heapify(heap)
        pop, push = heapq.heappop, heapq.heappush
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        count = n
        while heap:
            entry = pop(heap)
            rank, i = entry >> 32, entry & 0xFFFFFFFF
            j = after[i]
            if j >= n or symbols[i] < 0 or ranks(symbols[i] << 20 | symbols[j]) != rank:
                continue
            one = joined[rank]
            symbols[i], symbols[j] = one, -1
            after[i] = k = after[j]
            count -= 1
            if k < n:
                before[k] = i
                rank = ranks(one << 20 | symbols[k])
                if rank is not None:
                    push(heap, rank << 32 | i)
            h = before[i]
            if h >= 0:
                rank = ranks(symbols[h] << 20 | one)
                if rank is not None:
                    push(heap, rank << 32 | h)
        return count

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        total, parts = 0, [text]
        if self.special and "<|" in text:
            parts = self.special.split(text)
            total = len(parts) - 1
        for part in parts:
            if not part.isascii():
                part = unicodedata.normalize("NFC", part).replace("Σ", "σ")  # lower case letter by letter
            part = part.lower()
            words = self.any_words(part) if not part.isascii() and ODD(part) or CONTROLS(part) else self.plain_words(part)
            total += sum(map(self.known.__getitem__, words))
        return total


@functools.cache
def merger_of(spec: str) -> PairMerger:
    """One per worker process, so that its memory of words lasts over tasks."""
    return PairMerger(spec)


def count_tokens(docs: DataFrame, vocabulary: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, n_bytes, n_tokens) of every document; ``vocabulary`` is the path of the .json file.

    The file (a public vocabulary of fixed size) is read once on the driver and
    broadcast; workers build the merge table from it.
    """
    with open(vocabulary, encoding="utf-8") as file:
        spec = docs.sparkSession.sparkContext.broadcast(file.read())

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merger = merger_of(spec.value)
        for chunk in text_chunks(batches, "text"):
            counts = [merger.count(x) for x in chunk.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [chunk.column("id"), chunk.column("n_bytes"), pa.array(counts, pa.int64())],
                names=["id", "n_bytes", "n_tokens"])

    source = docs.select(F.col(id_column).alias("id"),
                         F.coalesce(F.octet_length(text_column), F.lit(0)).cast("long").alias("n_bytes"),
                         F.col(text_column).alias("text"))
    kind = source.schema["id"].dataType.simpleString()
    return source.mapInArrow(counted, f"id {kind}, n_bytes long, n_tokens long").withColumnRenamed("id", id_column)
