"""Language identification of mixed-language text.

Script ranges narrow the candidate languages of each word, character n-gram
scores rate them, and Viterbi with a penalty for each switch labels spans of
words.  The document's language is the one whose spans hold most letters.

Model: counts of hashed character n-grams per language, counted by Spark over
a sample of labelled rows that :data:`TRAINING_DOCS` bounds per language (all
rows below that bound; by hash of the id above it).  Its size is bounded by
languages x 2^17 counters, and it is broadcast.

Cases: null texts and texts without a letter are ``und`` with score 0 and no
spans, and so is everything where no labelled row exists; ties go to the
language that sorts first; repeated rows repeat; texts are read whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catrec.llm.common import text_chunks, widened

#: Most labelled documents (expected number, by hash of the id) that a language is learned from.
TRAINING_DOCS = 2_000
#: Hashed n-gram counters per language.
BUCKETS = 1 << 17
GRAMS = (1, 2, 3, 4)
#: n-grams of one word overlap; their summed score is scaled by this.
GRAM_WEIGHT = 0.4
#: A word speaks for its best language against another by so much at most (nats).
WORD_LIMIT = 6.0
#: Cost of a change of language between words (nats).
SWITCH = 12.0
#: A language is a candidate for a script that holds at least this share of its letters.
SCRIPT_SHARE = 0.01
#: Languages that a model may have; more labels than this are an error, not a silent cut.
MAX_LANGUAGES = 512
UNDETERMINED = "und"

# First code points of runs of one script (Unicode blocks), Latin where nothing else is named.
SCRIPT_STARTS = [
    (0x0000, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"), (0x0590, "hebrew"),
    (0x0600, "arabic"), (0x0700, "other"), (0x0750, "arabic"), (0x0780, "other"), (0x0900, "devanagari"),
    (0x0980, "bengali"), (0x0A00, "gurmukhi"), (0x0A80, "gujarati"), (0x0B00, "oriya"), (0x0B80, "tamil"),
    (0x0C00, "telugu"), (0x0C80, "kannada"), (0x0D00, "malayalam"), (0x0D80, "sinhala"), (0x0E00, "thai"),
    (0x0E80, "lao"), (0x0F00, "tibetan"), (0x1000, "myanmar"), (0x10A0, "georgian"), (0x1100, "hangul"),
    (0x1200, "ethiopic"), (0x13A0, "other"), (0x1780, "khmer"), (0x1800, "mongolian"), (0x18B0, "other"),
    (0x1E00, "latin"), (0x1F00, "greek"), (0x2000, "other"), (0x2C60, "latin"), (0x2C80, "other"),
    (0x2E80, "han"), (0x3040, "kana"), (0x3100, "han"), (0x3130, "hangul"), (0x3190, "han"),
    (0x31F0, "kana"), (0x3200, "other"), (0x3400, "han"), (0xA000, "other"), (0xA720, "latin"),
    (0xA800, "other"), (0xAC00, "hangul"), (0xD7B0, "other"), (0xF900, "han"), (0xFB00, "latin"),
    (0xFB1D, "hebrew"), (0xFB50, "arabic"), (0xFE00, "other"), (0xFF00, "latin"), (0xFF66, "kana"),
    (0xFFA0, "hangul"), (0xFFE0, "other"), (0x20000, "han"),
]
STARTS = np.array([x[0] for x in SCRIPT_STARTS])
SCRIPTS = sorted({x[1] for x in SCRIPT_STARTS})
SCRIPT_OF_RUN = np.array([SCRIPTS.index(x[1]) for x in SCRIPT_STARTS])

find_words = re.compile(r"[^\W\d_]+").findall


def word_table(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes of all words (-1: no letter), words per text, and the distinct words."""
    words: list[str] = []
    counts = np.empty(len(texts), np.int64)
    for i, text in enumerate(texts):
        found = find_words(text.lower()) if text else ()
        words.extend(found)
        counts[i] = len(found)
    codes, distinct = pd.factorize(np.array(words, dtype=object)) if words else (np.empty(0, int), np.empty(0, object))
    letterless = [i for i, w in enumerate(distinct) if not w.isalpha() and not any(map(str.isalpha, w))]
    if letterless:
        codes = np.where(np.isin(codes, letterless), -1, codes)
    return codes, counts, distinct


def word_grams(distinct: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashed n-grams of the words, the first n-gram of each word, and each word's script."""
    joined = "\x02" + "\x02".join(distinct) + "\x02"
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    edges = np.flatnonzero(points == 2)
    word_at = np.cumsum(points == 2) - 1
    parts, owners = [], []
    mixed = points.astype(np.uint64)
    for n in GRAMS:
        if len(points) < n:
            continue
        code = np.zeros(len(points) - n + 1, np.uint64)
        for i in range(n):
            code = code * np.uint64(0x9E3779B97F4A7C15) + mixed[i:len(points) - n + 1 + i] + np.uint64(n)
        code ^= code >> np.uint64(29)
        code *= np.uint64(0xBF58476D1CE4E5B9)
        # A gram may begin or end at a boundary mark but not reach over one.
        owner = word_at[:len(code)]
        inside = word_at[n - 1:] - (points[n - 1:] == 2)
        keep = (inside == owner) & (owner < len(distinct))
        if n == 1:
            keep &= points != 2
        parts.append((code >> np.uint64(47)).astype(np.int64)[keep])
        owners.append(owner[keep])
    owner = np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    starts = np.searchsorted(owner[order], np.arange(len(distinct)))
    script = SCRIPT_OF_RUN[np.searchsorted(STARTS, points[edges[:-1] + 1], side="right") - 1]
    return np.concatenate(parts)[order], starts, script


def count_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, feature, n): n-gram counters, and letters by script as -1 - script."""
    for chunk in text_chunks(batches, "text"):
        langs = chunk.column("lang").to_pylist()
        texts = chunk.column("text").to_pylist()
        for lang in sorted(set(langs)):
            codes, _, distinct = word_table([t for t, x in zip(texts, langs, strict=True) if x == lang])
            if not len(distinct):
                continue
            times = np.bincount(codes[codes >= 0], minlength=len(distinct))
            grams, starts, script = word_grams(distinct)
            each = np.diff(np.append(starts, len(grams)))
            n = np.bincount(grams, weights=np.repeat(times, each), minlength=BUCKETS).astype(np.int64)
            some = np.flatnonzero(n)
            letters = np.bincount(script, weights=times * np.array([len(w) for w in distinct])).astype(np.int64)
            feature = np.concatenate([some, -1 - np.arange(len(letters))])
            number = np.concatenate([n[some], letters])
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(feature), pa.string()), pa.array(feature, pa.int64()),
                 pa.array(number, pa.int64())], names=["lang", "feature", "n"])


class Labeller:
    """Viterbi labelling with a learned model (languages, log probabilities, candidates by script)."""

    def __init__(self, languages: list[str], counts: np.ndarray, letters: np.ndarray):
        self.languages = languages
        smooth = counts + 0.5
        self.scores = (np.log(smooth / smooth.sum(0)) * GRAM_WEIGHT).astype(np.float32)
        share = letters / np.maximum(letters.sum(0), 1)
        self.candidates = share >= SCRIPT_SHARE
        self.candidates[~self.candidates.any(1)] = True  # a script that was never seen narrows nothing

    def word_scores(self, distinct: np.ndarray) -> np.ndarray:
        grams, starts, script = word_grams(distinct)
        total = np.add.reduceat(self.scores[grams], starts, axis=0)
        total[~self.candidates[script]] = -np.inf
        return np.maximum(total - total.max(1, keepdims=True), -WORD_LIMIT)

    def path(self, scores: np.ndarray) -> np.ndarray:
        """Best labels of one text's words.

        The best single language stays if no run of words gains more than one
        switch costs by leaving it (largest run sum); that proves the constant
        path optimal.  Otherwise the recurrence runs in full.
        """
        best = int(scores.sum(0, dtype=np.float64).argmax())
        n, k = scores.shape
        if k == 1:
            return np.zeros(n, np.int64)
        gain = np.delete(scores, best, 1).max(1).astype(np.float64) - scores[:, best]
        run = np.concatenate([[0.0], np.cumsum(gain)])
        if (run - np.minimum.accumulate(run)).max() <= SWITCH:
            return np.full(n, best)
        came = np.empty((n, k), np.int64)
        stay = np.arange(k)
        now = scores[0].astype(np.float64)
        for t in range(1, n):
            top = int(now.argmax())
            floor = now[top] - SWITCH
            came[t] = np.where(now >= floor, stay, top)
            now = np.maximum(now, floor) + scores[t]
        labels = np.empty(n, np.int64)
        labels[-1] = int(now.argmax())
        for t in range(n - 1, 0, -1):
            labels[t - 1] = came[t, labels[t]]
        return labels

    def label(self, texts: list[str | None]) -> tuple[list[str], list[float], list[list[dict]]]:
        languages, scores, spans = [], [], []
        codes, counts, distinct = word_table(texts) if self.languages else (np.empty(0, int), np.zeros(len(texts), int), [])
        table = self.word_scores(distinct) if len(distinct) else np.empty((0, 1))
        length = np.array([len(w) for w in distinct], dtype=np.int64)
        at = 0
        for n in counts:
            own = codes[at:at + n]
            at += n
            own = own[own >= 0]
            if not len(own):
                languages.append(UNDETERMINED)
                scores.append(0.0)
                spans.append([])
                continue
            rated = table[own]
            labels = self.path(rated)
            letters = np.bincount(labels, weights=length[own], minlength=len(self.languages))
            pick = int(letters.argmax())
            total = rated.sum(0, dtype=np.float64)
            sure = 1.0 / np.exp(np.minimum(total - total[pick], 50)).sum()
            languages.append(self.languages[pick])
            scores.append(float(letters[pick] / letters.sum() * min(1.0, sure)) if len(set(labels.tolist())) == 1
                          else float(letters[pick] / letters.sum()))
            cuts = np.concatenate([[0], np.flatnonzero(np.diff(labels)) + 1, [len(labels)]])
            spans.append([{"first": int(a), "words": int(b - a), "lang": self.languages[labels[a]]}
                          for a, b in zip(cuts[:-1], cuts[1:], strict=True)])
        return languages, scores, spans


def learn(labelled: DataFrame, limit: int = TRAINING_DOCS) -> Labeller:
    """A model from rows (id, text, lang); about ``limit`` documents of each language by hash of the id."""
    rows = labelled.where("lang is not null and text is not null")
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n"))
             .limit(MAX_LANGUAGES + 1).collect()}
    if len(sizes) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} language labels")
    languages = sorted(sizes)
    if not languages:
        return Labeller([], np.zeros((BUCKETS, 0)), np.zeros((len(SCRIPTS), 0)))
    share = F.create_map(*[F.lit(x) for lang in languages for x in (lang, min(1.0, limit / sizes[lang]))])
    draw = F.pmod(F.xxhash64(F.lit("train"), "id"), F.lit(1 << 20)) / F.lit(1 << 20)
    counted = (rows.where(draw < share[F.col("lang")]).select("text", "lang")
               .mapInArrow(count_features, "lang string, feature long, n long")
               .groupBy("lang", "feature").agg(F.sum("n").alias("n")))
    counts, letters = np.zeros((BUCKETS, len(languages))), np.zeros((len(SCRIPTS), len(languages)))
    found = counted.toArrow()  # at most languages x (2^17 + scripts) rows
    place = np.array([languages.index(x) for x in found.column("lang").to_pylist()], dtype=np.int64)
    feature, n = found.column("feature").to_numpy(), found.column("n").to_numpy()
    gram = feature >= 0
    counts[feature[gram], place[gram]] = n[gram]
    letters[-1 - feature[~gram], place[~gram]] = n[~gram]
    return Labeller(languages, counts, letters)


def identify(docs: DataFrame, model: Labeller, id_column: str = "doc_id", text_column: str = "text",
             keep: list[Column] | None = None) -> DataFrame:
    """(id, lang_pred, score, spans) of every row; ``keep`` adds columns of the input, carried through."""
    shipped = docs.sparkSession.sparkContext.broadcast(model)

    def labelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in text_chunks(batches, "text_"):
            languages, scores, spans = shipped.value.label(chunk.column("text_").to_pylist())
            others = chunk.drop_columns(["text_"])
            yield pa.RecordBatch.from_arrays(
                [*others.columns, pa.array(languages, pa.string()), pa.array(scores, pa.float64()),
                 pa.array(spans, pa.list_(pa.struct([("first", pa.int32()), ("words", pa.int32()),
                                                     ("lang", pa.string())])))],
                names=[*others.schema.names, "lang_pred", "score", "spans"])

    source = docs.select(F.col(id_column).alias("id_"), *(keep or []), F.col(text_column).alias("text_"))
    schema = widened(source.drop("text_").schema,
                     "lang_pred string, score double, spans array<struct<first:int,words:int,lang:string>>")
    return source.mapInArrow(labelled, schema).withColumnRenamed("id_", id_column)
