"""MinHash near-dedup: improved consistent weighted sampling over TF-IDF shingles.

Shingles are runs of five words; a shingle weighs its count in the document
times its inverse document frequency.  Document frequencies are counted over all
documents in 2^18 hashed counters (a bounded table, broadcast).  Each document
gets 48 consistent weighted samples in 12 bands of 4; two documents of weighted
similarity 0.8 share a band with probability 0.998.  Members of a band's bucket
are verified by exact weighted Jaccard similarity: hubs first, then all pairs
between different classes, in large buckets block by block (see
``common.hub_links``).  Linked documents form classes.

Cases: equal texts are one class (also texts without a word); a null text is a
class of its own; texts of fewer than five words have one shingle, all their
words; the class is the least id in it, which stays; rows of one id
with unlike texts are documents of their own; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catrec.llm.common import class_leads, hub_links, stored, text_chunks, text_key

WORDS = 5
SIMILARITY = 0.8
BANDS, ROWS = 12, 4
FREQUENCY_BITS = 18
#: Texts of a large bucket, and their shingles (16 bytes each), that one side of a block of comparisons holds, about.
STRIPE = 256
STRIPE_SHINGLES = 1 << 20
#: Bits of a shingle's hash.
KEY_BITS = 48
#: Pairs with one hub that a verification group holds, about.
GROUP_PAIRS = 256
TABLE = 1 << 16

find_words = re.compile(r"\w+").findall
MASK = np.uint64((1 << KEY_BITS) - 1)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(owner, key, count) of the distinct shingles of each text, in order of owner and key."""
    words: list[str] = []
    counts = np.empty(len(texts), np.int64)
    for i, text in enumerate(texts):
        found = find_words(text.lower()) if text else ()
        words.extend(found)
        counts[i] = len(found)
    if not words:
        return np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, np.int64)
    codes, distinct = pd.factorize(np.array(words, dtype=object))
    hashes = pd.util.hash_array(distinct, categorize=False)[codes]
    ends = np.cumsum(counts)
    owner = np.repeat(np.arange(len(texts)), counts)
    last = np.repeat(ends, counts)
    place = np.arange(len(words))
    rolled = np.full(len(words), 5, np.uint64)
    for j in range(WORDS):
        # Past the end of a short text its words repeat nothing: a zero stands there.
        at = place + j
        own = at < last
        part = np.where(own, hashes[np.minimum(at, len(words) - 1)], np.uint64(0))
        rolled = mix(rolled * np.uint64(0x9E3779B97F4A7C15) + part)
    whole = (place + WORDS <= last) | (place == last - np.repeat(counts, counts))
    packed = np.sort(owner[whole].astype(np.uint64) << np.uint64(KEY_BITS) | rolled[whole] & MASK)
    first = np.flatnonzero(np.concatenate([[True], packed[1:] != packed[:-1]]))
    times = np.diff(np.append(first, len(packed)))
    packed = packed[first]
    return (packed >> np.uint64(KEY_BITS)).astype(np.int64), packed & MASK, times


def counter_of(keys: np.ndarray) -> np.ndarray:
    return (keys >> np.uint64(KEY_BITS - FREQUENCY_BITS)).astype(np.int64)


def count_frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(counter, n) of a partition; counter -1 has its documents with a shingle."""
    counters = np.zeros(1 << FREQUENCY_BITS, np.int64)
    documents = 0
    for chunk in text_chunks(batches, "text"):
        owner, keys, _ = shingles(chunk.column("text").to_pylist())
        counters += np.bincount(counter_of(keys), minlength=len(counters))
        documents += len(np.unique(owner))
    some = np.flatnonzero(counters)
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.append(some, -1).astype(np.int32)), pa.array(np.append(counters[some], documents))],
        names=["counter", "n"])


def inverse_frequencies(docs: DataFrame) -> np.ndarray:
    """1 + ln((1 + documents) / (1 + frequency)) by hashed counter, 1 at least; 2^18 floats."""
    counted = (docs.select("text").mapInArrow(count_frequencies, "counter int, n long")
               .groupBy("counter").agg(F.sum("n").alias("n")).toArrow())  # at most 2^18 + 1 rows
    counter, n = counted.column("counter").to_numpy(), counted.column("n").to_numpy()
    documents = int(n[counter < 0].sum())
    frequency = np.zeros(1 << FREQUENCY_BITS)
    frequency[counter[counter >= 0]] = n[counter >= 0]
    return np.maximum(1.0, 1.0 + np.log((1.0 + documents) / (1.0 + frequency))).astype(np.float32)


class Sampler:
    """Consistent weighted samples; the draws of a shingle come from tables of quantiles indexed by its hash."""

    def __init__(self, samples: int):
        draw = np.random.default_rng(20_240)
        scale, log_c = draw.gamma(2.0, 1.0, TABLE), np.log(draw.gamma(2.0, 1.0, TABLE))
        self.scale, self.inverse = scale.astype(np.float32), (1 / scale).astype(np.float32)
        self.log_c, self.shift = log_c.astype(np.float32), draw.random(TABLE).astype(np.float32)
        self.odd = draw.integers(1, 1 << 62, samples, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def bands(self, owner: np.ndarray, keys: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(owners that have shingles, their band hashes)."""
        starts = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
        counts = np.diff(np.append(starts, len(owner)))
        log_weight = np.log(weights).astype(np.float32)
        base = mix(keys + np.uint64(0x632BE59BD9B4E019))
        picked = np.empty((len(starts), len(self.odd)), np.uint64)
        for k, odd in enumerate(self.odd):
            bits = base * odd
            r = (bits >> np.uint64(48)).astype(np.int64)
            level = np.floor(log_weight * self.inverse[r] + self.shift[(bits >> np.uint64(16)).astype(np.int64) & 0xFFFF])
            value = (self.log_c[(bits >> np.uint64(32)).astype(np.int64) & 0xFFFF] - self.scale[r]
                     * (level - self.shift[(bits >> np.uint64(16)).astype(np.int64) & 0xFFFF] + np.float32(1)))
            least = np.flatnonzero(value == np.repeat(np.minimum.reduceat(value, starts), counts))
            first = least[np.searchsorted(least, starts)]
            picked[:, k] = keys[first] * np.uint64(0x9E3779B97F4A7C15) + level[first].astype(np.int64).astype(np.uint64)
        band = np.arange(BANDS, dtype=np.uint64)[None, :].repeat(len(starts), 0)
        grouped = picked.reshape(len(starts), BANDS, -1)
        for j in range(grouped.shape[2]):
            band = mix(band * np.uint64(0x9E3779B97F4A7C15) + grouped[:, :, j])
        return owner[starts], band


def similar_pairs(idf: np.ndarray):
    """A task function: rows (a, salt, lead, id, text) in order, lead first -> pairs (a, b) of enough similarity."""

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lead_of, lead_keys, lead_weights, lead_sum = None, None, None, 0.0
        for chunk in text_chunks(batches, "text"):
            owner, keys, times = shingles(chunk.column("text").to_pylist())
            weights = times * idf.value[counter_of(keys)].astype(np.float64)
            starts = np.searchsorted(owner, np.arange(chunk.num_rows + 1))
            found: tuple[list[int], list[int]] = ([], [])
            rows = zip(*(chunk.column(c).to_pylist() for c in ("a", "salt", "lead", "id")), strict=True)
            for i, (a, salt, lead, other) in enumerate(rows):
                own, own_weights = keys[starts[i]:starts[i + 1]], weights[starts[i]:starts[i + 1]]
                if lead:
                    lead_of, lead_keys, lead_weights, lead_sum = (a, salt), own, own_weights, own_weights.sum()
                elif lead_of == (a, salt):
                    at = np.minimum(np.searchsorted(lead_keys, own), len(lead_keys) - 1)
                    both = lead_keys[at] == own
                    shared = np.minimum(lead_weights[at[both]], own_weights[both]).sum()
                    if shared >= SIMILARITY * (lead_sum + own_weights.sum() - shared):
                        found[0].append(a)
                        found[1].append(other)
            yield pa.RecordBatch.from_arrays([pa.array(found[0], pa.int64()), pa.array(found[1], pa.int64())],
                                             names=["a", "b"])

    return verify


def block_links(idf):
    """A group function: pairs (a, b) of enough similarity between different classes, one of each stripe of a block."""

    def links(block: pd.DataFrame) -> pd.DataFrame:
        low = block["own"].to_numpy() == block["low"].iloc[0]
        alone = block["low"].iloc[0] == block["high"].iloc[0]
        ids, roots = block["id"].to_numpy(), block["root"].to_numpy()
        keys = np.concatenate([np.frombuffer(k, "<u8") for k in block["keys"]])
        weights = (np.concatenate([np.frombuffer(t, "<i8") for t in block["times"]])
                   * idf.value[counter_of(keys)].astype(np.float64))
        lengths = block["keys"].map(len).to_numpy() // 8
        starts = np.cumsum(lengths) - lengths
        sums = np.add.reduceat(weights, starts)
        distinct, codes = np.unique(keys, return_inverse=True)
        own = np.zeros(len(distinct))
        right = np.arange(len(ids)) if alone else np.flatnonzero(~low)
        of_right = np.repeat(alone | ~low, lengths)
        right_codes, right_weights = codes[of_right], weights[of_right]
        right_starts = np.cumsum(lengths[right]) - lengths[right]
        found: tuple[list[np.ndarray], list[np.ndarray]] = ([np.empty(0, np.int64)], [np.empty(0, np.int64)])
        for i in np.flatnonzero(low) if len(right) else ():
            mine = slice(starts[i], starts[i] + lengths[i])
            own[codes[mine]] = weights[mine]
            shared = np.add.reduceat(np.minimum(own[right_codes], right_weights), right_starts)
            own[codes[mine]] = 0.0
            near = (shared >= SIMILARITY * (sums[right] + sums[i] - shared)) & (roots[right] != roots[i])
            if alone:
                near &= ids[right] > ids[i]
            hits = ids[right[near]]
            found[0].append(np.minimum(hits, ids[i]))
            found[1].append(np.maximum(hits, ids[i]))
        return pd.DataFrame({"a": np.concatenate(found[0]), "b": np.concatenate(found[1])})

    return links


def shingle_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, keys, times, n) of rows (id, text): the shingles as 64-bit numbers in order, their counts, how many."""
    for chunk in text_chunks(batches, "text"):
        owner, keys, times = shingles(chunk.column("text").to_pylist())
        starts = np.searchsorted(owner, np.arange(chunk.num_rows + 1))
        cuts = list(zip(starts[:-1], starts[1:], strict=True))
        yield pa.RecordBatch.from_arrays(
            [chunk.column("id"), pa.array([keys[a:b].astype("<u8").tobytes() for a, b in cuts], pa.binary()),
             pa.array([times[a:b].astype("<i8").tobytes() for a, b in cuts], pa.binary()),
             pa.array(np.diff(starts), pa.int64())], names=["id", "keys", "times", "n"])


def near_classes(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, class_id, kept, class_key, key_a, key_b) of every row.

    ``class_id`` is the least id of the class; where ids repeat with unlike texts, ``class_key`` tells classes of
    one id apart.  ``kept`` marks the row of that id and the class's first text; the keys are those of the row's text.
    """
    spark = docs.sparkSession
    source = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).alias("text"))
    idf = spark.sparkContext.broadcast(inverse_frequencies(source))

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sampler = Sampler(BANDS * ROWS)
        for chunk in text_chunks(batches, "text"):
            owner, keys, times = shingles(chunk.column("text").to_pylist())
            bands: list[list[int]] = [[] for _ in range(chunk.num_rows)]
            if len(owner):
                owners, hashes = sampler.bands(owner, keys, times * idf.value[counter_of(keys)])
                for i, row in zip(owners.tolist(), hashes.view(np.int64).tolist(), strict=True):
                    bands[i] = row
            yield pa.RecordBatch.from_arrays(
                [chunk.column("id"), chunk.column("key_a"), chunk.column("key_b"), pa.array(bands, pa.list_(pa.int64()))],
                names=["id", "key_a", "key_b", "bands"])

    keyed = [F.when(F.col("text").isNotNull(), k).alias(n) for n, k in
             zip(("key_a", "key_b"), text_key(F.col("text")), strict=True)]
    signed = stored(source.select("id", *keyed, "text").mapInArrow(
        sign, "id long, key_a long, key_b long, bands array<long>"))
    # Equal texts are one group under a number of its own, whatever ids they have.
    texts = stored(signed.where("key_a is not null").groupBy("key_a", "key_b").agg(
        F.min("id").alias("lead"), F.first("bands").alias("bands")).withColumn("id", F.monotonically_increasing_id()))
    rows = texts.select("id", F.explode("bands").alias("bucket")).distinct()
    shared = rows.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1").select("bucket")
    buckets = stored(rows.join(shared, "bucket").select("bucket", "id"))
    wanted = buckets.select("id").distinct()
    # Their texts, from one row of each group: that of its least id.
    places = texts.join(wanted, "id").select("id", F.col("lead").alias("of"), "key_a", "key_b")
    keyed_texts = source.where("text is not null").select(F.col("id").alias("of"), *keyed, "text")
    alike = [keyed_texts[c].eqNullSafe(places[c]) for c in ("of", "key_a", "key_b")]
    candidates = stored(keyed_texts.join(places, alike[0] & alike[1] & alike[2]).select(
        places["id"], keyed_texts["text"]).dropDuplicates(["id"]))

    def verify(pairs: DataFrame) -> DataFrame:
        sizes = pairs.groupBy("a").agg(F.ceil(F.count("*") / GROUP_PAIRS).alias("groups"))
        dealt = pairs.join(sizes, "a").select("a", F.pmod(F.xxhash64("b"), F.col("groups")).alias("salt"),
                                              F.col("b").alias("id"))
        others = dealt.join(candidates, "id").select("a", "salt", F.lit(False).alias("lead"), "id", "text")
        leads = dealt.select("a", "salt").distinct().join(candidates.withColumnRenamed("id", "a"), "a").select(
            "a", "salt", F.lit(True).alias("lead"), F.col("a").alias("id"), "text")
        return (others.union(leads).repartition("a", "salt")
                .sortWithinPartitions("a", "salt", F.col("lead").desc()).mapInArrow(similar_pairs(idf), "a long, b long"))

    def compare(members: DataFrame) -> DataFrame:
        """Links between classes of large buckets: stripe against stripe, of at most so many texts and shingles, about."""
        own_texts = candidates.join(members.select("id").distinct(), "id", "left_semi").select("id", "text")
        sets = stored(own_texts.mapInArrow(shingle_sets, "id long, keys binary, times binary, n long"))
        rows = members.join(sets.select("id", "n"), "id")
        sizes = rows.groupBy("bucket").agg(F.ceil(F.greatest(
            F.count("*") / STRIPE, F.sum("n") / STRIPE_SHINGLES)).cast("int").alias("stripes"))
        dealt = rows.drop("n").join(sizes, "bucket").withColumn(
            "own", F.pmod(F.xxhash64("id"), F.col("stripes")).cast("int"))
        spread = (dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("stripes") - 1)))
                  .join(sets.drop("n"), "id")
                  .select("bucket", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"),
                          "own", "id", "root", "keys", "times"))
        return spread.groupBy("bucket", "low", "high").applyInPandas(block_links(idf), "a long, b long")

    roots = hub_links(buckets, verify, compare)
    # A class is told by its least id and, as one id may stand on unlike texts, the key of one of its texts.
    leads = class_leads(texts.select("key_a", "key_b", "id", F.struct("lead", "key_a", "key_b").alias("lead")), roots)
    named = signed.select("id", "key_a", "key_b").join(leads.drop("id", "lead"), ["key_a", "key_b"], "left")
    class_id = F.coalesce("class_lead.lead", "id")
    class_key = F.concat_ws("", *[F.lpad(F.hex(F.col("class_lead")[k]), 16, "0") for k in ("key_a", "key_b")])
    lead_text = F.coalesce((F.col("class_lead.key_a") == F.col("key_a")) & (F.col("class_lead.key_b") == F.col("key_b")),
                           F.lit(True))
    return named.select(
        F.col("id").alias(id_column), class_id.alias("class_id"),
        (F.col("id").eqNullSafe(class_id) & lead_text).alias("kept"), class_key.alias("class_key"), "key_a", "key_b")


def one_per_class(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay: one of each class, by id and text, and one of those that agree in both."""
    kept = near_classes(docs, id_column, text_column).where("kept").select(
        F.col(id_column).alias("kept_id"), F.col("key_a").alias("kept_a"), F.col("key_b").alias("kept_b")).distinct()
    keys = [F.when(F.col(text_column).isNotNull(), k) for k in text_key(F.col(text_column))]
    same = (F.col(id_column).cast("long").eqNullSafe(F.col("kept_id")) & keys[0].eqNullSafe(F.col("kept_a"))
            & keys[1].eqNullSafe(F.col("kept_b")))
    return docs.join(kept, same, "left_semi").dropDuplicates([id_column, text_column])
