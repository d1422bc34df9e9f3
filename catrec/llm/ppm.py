"""LM scoring by prediction by partial matching over bytes.

A trie of byte contexts up to order 4 is counted over the training texts.  A
byte's probability comes from its longest context, with escape to the next
shorter one by half the number of distinct successors (method D) and with exclusion
of the symbols that the longer context has already ruled out; below order 0 the
symbols that never occurred share the rest evenly.  A text's score is the log10
probability of its bytes and an end mark.

As the model is trained before scoring, a byte's code length depends on it and
its context only, so each distinct context-and-byte is rated once, by joins and
windows over at most 256 successors of a context, and never on one machine.
Documents are dealt into blocks of bounded bytes; a block asks for what its own
words and contexts need and gets back just that.  The same goes for the
smoothed word counts of the base score; a word counted only in its own block
needs no answer.

Cases: a null text is scored as an empty one (its end mark); without training
texts every byte costs log10 256 and the base score is 0; repeated rows repeat;
texts are read whole.  Words are told apart by 64-bit hashes.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from catrec.llm.common import stored

ORDER = 4
#: Bytes of text in a block, about; its task holds them as arrays.
BLOCK_BYTES = 8 << 20
BEGIN, END = 0xFE, 0xFF  # bytes that UTF-8 never holds
WORD_KIND, GRAM_KIND = 0, 1


def word_codes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(code of each word, words per text, hash by code)."""
    words: list[bytes] = []
    counts = np.empty(len(texts), np.int64)
    for i, text in enumerate(texts):
        found = text.split()  # ASCII white space
        words.extend(found)
        counts[i] = len(found)
    if not words:
        return np.empty(0, np.int64), counts, np.empty(0, np.int64)
    codes, distinct = pd.factorize(np.array(words, dtype=object))
    return codes, counts, pd.util.hash_array(distinct, categorize=False).view(np.int64)


def gram_codes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(code of each byte with its context, grams per text, gram by code)."""
    lead = bytes([BEGIN]) * ORDER
    joined = np.frombuffer(b"".join(lead + t + bytes([END]) for t in texts), np.uint8)
    counts = np.array([len(t) + 1 for t in texts], np.int64)
    starts = np.cumsum(counts + ORDER) - counts
    at = np.repeat(starts - np.concatenate([[0], np.cumsum(counts)[:-1]]), counts) + np.arange(counts.sum())
    gram = np.zeros(len(at), np.int64)
    for back in range(ORDER, -1, -1):
        gram = gram << 8 | joined[at - back]
    codes, distinct = pd.factorize(gram)
    return codes, counts, distinct


def encoded(column: pa.ChunkedArray) -> list[bytes]:
    return [b"" if x is None else x.lower() for x in column.cast(pa.binary()).to_pylist()]  # ASCII letters


def ask(block: pa.Table) -> pa.Table:
    """(block, kind, key, n): the words and grams of a block with their counts in its training texts."""
    texts = encoded(block.column("text"))
    train = block.column("train").to_numpy(zero_copy_only=False).astype(np.float64)
    keys, numbers, kinds = [], [], []
    for kind, (codes, counts, distinct) in ((WORD_KIND, word_codes(texts)), (GRAM_KIND, gram_codes(texts))):
        times = np.bincount(codes, weights=np.repeat(train, counts), minlength=len(distinct)).astype(np.int64)
        keys.append(distinct)
        numbers.append(times)
        kinds.append(np.full(len(distinct), kind, np.int8))
    key = np.concatenate(keys)
    return pa.table({"block": pa.array(np.full(len(key), block.column("block")[0].as_py(), np.int64)),
                     "kind": pa.array(np.concatenate(kinds)), "key": pa.array(key.astype(np.int64)),
                     "n": pa.array(np.concatenate(numbers))})


def score(block: pa.Table, answers: pa.Table) -> pa.Table:
    """Scores of a block's documents from the answers to what it asked for."""
    texts = encoded(block.column("text"))
    train = block.column("train").to_numpy(zero_copy_only=False)
    kind, key = answers.column("kind").to_numpy(), answers.column("key").to_numpy()
    value = answers.column("value").to_numpy()
    codes, counts, hashes = word_codes(texts)
    known = np.bincount(codes, weights=np.repeat(train.astype(np.float64), counts), minlength=len(hashes))
    told = np.argsort(key[kind == WORD_KIND])
    told_key, told_value = key[kind == WORD_KIND][told], value[kind == WORD_KIND][told]
    if len(told_key):
        at = np.minimum(np.searchsorted(told_key, hashes), len(told_key) - 1)
        hit = told_key[at] == hashes
        known[hit] = told_value[at[hit]]
    owner = np.repeat(np.arange(len(texts)), counts)
    part = np.bincount(owner, weights=np.log10(known + 1)[codes], minlength=len(texts))
    seen = np.bincount(owner, weights=(known > 0)[codes].astype(np.float64), minlength=len(texts))
    codes, grams, distinct = gram_codes(texts)
    told = np.argsort(key[kind == GRAM_KIND])
    told_key, told_value = key[kind == GRAM_KIND][told], value[kind == GRAM_KIND][told]
    at = np.searchsorted(told_key, distinct)
    logs = told_value[at]
    if not (told_key[at] == distinct).all():
        raise ValueError("a context of this block was not rated")
    model = np.bincount(np.repeat(np.arange(len(texts)), grams), weights=logs[codes], minlength=len(texts))
    return pa.table({"id": block.column("id"), "train": block.column("train"), "words": pa.array(counts),
                     "seen": pa.array(seen.astype(np.int64)), "part": pa.array(part), "model": pa.array(model)})


def rate_grams(totals: DataFrame) -> DataFrame:
    """(key, value): log10 probability of each gram's byte in its context; ``totals`` (key, n), zeros included.

    Row (context, byte) of order j gets ``low``: the byte's log probability from
    order j - 1 down, given that the successors of the context are excluded.
    """
    below = None
    for order in range(ORDER + 1):
        mask = (1 << 8 * (order + 1)) - 1
        rows = totals.groupBy(F.col("key").bitwiseAND(F.lit(mask)).alias("key")).agg(F.sum("n").alias("n"))
        rows = rows.withColumn("context", F.shiftright("key", 8))
        whole = Window.partitionBy("context")  # at most 256 successors
        total, kinds = F.sum("n").over(whole), F.count(F.when(F.col("n") > 0, 1)).over(whole)
        if order == 0:
            below = rows.select("key", "n", total.alias("total"), kinds.alias("kinds")).withColumn(
                "low", -F.log(F.greatest(F.lit(256) - F.col("kinds"), F.lit(1)).cast("double")))
            continue
        up = below.select(F.col("key").alias("up"), F.col("n").alias("n_up"), F.col("total").alias("total_up"),
                          F.col("kinds").alias("kinds_up"), F.col("low").alias("low_up"))
        joined = rows.join(up, F.col("key").bitwiseAND(F.lit(mask >> 8)) == F.col("up"))
        taken = F.sum(F.when(F.col("n") > 0, F.col("n_up")).otherwise(F.lit(0))).over(whole)
        ready = joined.select("key", "n", total.alias("total"), kinds.alias("kinds"), taken.alias("taken"),
                              "n_up", "total_up", "kinds_up", "low_up")
        open_kinds = (F.col("kinds_up") - F.col("kinds")).cast("double")
        room = (F.col("total_up") - F.col("taken")) * 2.0
        low = (F.when(F.col("n") > 0, F.lit(0.0))  # never asked for: the byte is found here
               .when(F.col("n_up") > 0, F.log((F.col("n_up") * 2 - 1) / room))
               .when(open_kinds > 0, F.log(open_kinds / room) + F.col("low_up"))
               .otherwise(F.col("low_up")))
        below = ready.select("key", "n", "total", "kinds", low.alias("low"))
    room = F.col("total") * 2.0
    value = (F.when(F.col("n") > 0, F.log((F.col("n") * 2 - 1) / room))
             .when(F.col("total") > 0, F.log(F.col("kinds") / room) + F.col("low")).otherwise(F.col("low")))
    return below.select("key", (value / F.log(F.lit(10.0))).alias("value"))


def score_documents(docs: DataFrame, train: Column, id_column: str = "doc_id") -> DataFrame:
    """(id, train, n_tokens, n_known, train_tokens, base_score, score) of every row."""
    sized = docs.select(F.col(id_column).alias("id"), F.coalesce(train, F.lit(False)).alias("train"), "text")
    sums = sized.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + 1).alias("bytes"),
                     F.count(F.when(F.col("train"), 1)).alias("ends")).first()
    blocks, ends = max(1, -(-(sums["bytes"] or 0) // BLOCK_BYTES)), sums["ends"]
    dealt = sized.withColumn("block", F.pmod(F.xxhash64(F.lit("block"), F.col("id")), F.lit(blocks)))
    asked = stored(dealt.groupBy("block").applyInArrow(ask, "block long, kind byte, key long, n long"))
    words = asked.where(F.col("kind") == WORD_KIND)
    seen = Observation()
    counted = words.groupBy("key").agg(F.sum("n").alias("c"), F.count("*").alias("blocks")).observe(
        seen, F.count(F.when(F.col("c") > 0, 1)).alias("distinct"), F.sum("c").alias("tokens"))
    # Only words of several blocks can differ from what a block has counted itself.
    spread = stored(counted.where("blocks > 1").select("key", "c"))
    distinct, tokens = seen.get["distinct"] + (ends > 0), (seen.get["tokens"] or 0) + ends
    grams = asked.where(F.col("kind") == GRAM_KIND)
    rated = stored(rate_grams(stored(grams.groupBy("key").agg(F.sum("n").alias("n")))))
    answers = words.join(spread, "key").where("c <> n").select("block", "kind", "key", F.col("c").cast("double").alias("value"))
    answers = answers.unionByName(grams.join(rated, "key").select("block", "kind", "key", "value"))
    scored = dealt.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        score, "id long, train boolean, words long, seen long, part double, model double")
    n_tokens = F.col("words") + 1
    return scored.select(
        F.col("id").alias(id_column), "train", n_tokens.alias("n_tokens"),
        (F.col("seen") + F.lit(int(ends > 0))).alias("n_known"), F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("part") + F.lit(float(np.log10(ends + 1))) - n_tokens * F.lit(float(np.log10(tokens + distinct + 1))))
        .alias("base_score"), F.col("model").alias("score"))
