"""Ids that repeat with other content: vectors, texts, the pipeline's rows; and verdicts, distances that depend on them."""

from __future__ import annotations

import random

import numpy as np
import pytest

import corpus_pipeline
from catrec.llm import decontam, icws, linkgraph, mixing, rabitq


def words(rng, n):
    return ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 9))) for _ in range(n)]


def test_vectors_of_one_id_count_for_themselves(spark):
    rng = np.random.default_rng(8)
    u, v, w = rng.standard_normal((3, 24))
    rows = [(1, u), (1, v), (2, u), (3, 2 * v), (6, 3 * v), (7, w)]
    frame = spark.createDataFrame([(i, [float(x) for x in a]) for i, a in rows], "vec_id long, embedding array<double>")
    got = sorted(tuple(r) for r in rabitq.near_vectors(frame).collect())
    assert got == [(1, 1, 1, True), (1, 2, 1, True), (2, 1, 1, False), (3, 2, 1, False), (6, 2, 1, False), (7, 0, 7, True)]


def test_repeated_vector_ids_against_brute_force(spark):
    rng = np.random.default_rng(11)
    base = rng.standard_normal((40, 32))
    rows = [(int(rng.integers(0, 150)), base[rng.integers(0, 40)] + 0.02 * rng.standard_normal(32)) for _ in range(200)]
    frame = spark.createDataFrame([(i, a.tolist()) for i, a in rows], "vec_id long, embedding array<double>").repartition(3)
    matrix = np.array([a / np.linalg.norm(a) for _, a in rows])
    near = matrix @ matrix.T >= 0.9
    expected = []
    for n in range(len(rows)):
        reach, new = set(), {n}
        while new:
            reach |= new
            new = {int(j) for i in new for j in np.flatnonzero(near[i])} - reach
        least = min(rows[j][0] for j in reach)
        expected.append((rows[n][0], int(near[n].sum()) - 1, least, rows[n][0] == least))
    assert sorted(tuple(r) for r in rabitq.near_vectors(frame).collect()) == sorted(expected)


def test_too_many_tables_are_refused():
    with pytest.raises(ValueError, match="tables"):
        rabitq.layout(768, 10 ** 12, 0.3)


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(21)
    one, two = words(rng, 60), words(rng, 60)
    near = [*two[:58], "other", "end"]
    return " ".join(one), " ".join(two), " ".join(near)


def test_texts_of_one_id_keep_their_classes(spark, texts):
    one, two, near = texts
    rows = [(5, one), (5, two), (8, one), (9, near), (5, one), (None, two)]
    got = icws.near_classes(spark.createDataFrame(rows, "doc_id long, text string")).select(
        "doc_id", "class_id", "kept", "class_key").collect()
    for row in got:
        assert row["class_id"] == 5
    keys = {}
    for row in got:
        keys.setdefault(row["class_key"], []).append((row["doc_id"], row["kept"]))
    assert sorted(sorted(map(str, k)) for k in keys.values()) == sorted([
        sorted(map(str, [(5, True), (5, True), (8, False)])), sorted(map(str, [(5, True), (9, False), (None, False)]))])


def test_one_row_of_each_class_stays(spark, texts):
    one, two, near = texts
    rows = [(5, one, "a"), (5, two, "b"), (8, one, "c"), (9, near, "d"), (5, one, "a")]
    stay = icws.one_per_class(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    assert sorted(map(tuple, stay.collect())) == sorted([(5, one, "a"), (5, two, "b")])


def test_mixed_rows_repeat_the_rows_that_were_taken(spark):
    rng = random.Random(4)
    rows = [(rng.randrange(30), " ".join(words(rng, rng.randint(0, 30))), rng.choice([None, "s", "t"]), None) for _ in range(120)]
    rows += rows[:10]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string").repartition(4)
    taken = sum(r["taken"] for r in mixing.mix(docs, [3, 1, 2], row_key=True).collect())
    out = [tuple(r) for r in mixing.mixed_rows(docs, [3, 1, 2]).collect()]
    assert set(out) <= set(rows) and sum(len(r[1].split()) for r in out) == taken
    assert sorted(map(str, out)) == sorted(str(tuple(r)) for r in corpus_pipeline.mix_sources(spark, docs, "").collect())
    assert all(out.count(r) <= 2 * rows.count(r) for r in set(out))


def least_edits(pattern, text):
    row = list(range(len(pattern) + 1))
    best = row[-1]
    for c in text:
        new = [0]
        for i, p in enumerate(pattern, 1):
            new.append(min(row[i] + 1, new[i - 1] + 1, row[i - 1] + (p != c)))
        row = new
        best = min(best, row[-1])
    return best


def test_distances_are_the_least_of_item_or_windows():
    for seed in range(25):
        rng = random.Random(seed)
        items = [words(rng, n) for n in (6, 14, 22, 33)]
        plain = [" ".join(w) for w in items]
        text = []
        for w in items * 2:  # edited once more or less, some verbatim behind
            passage = list(" ".join(w))
            for at in range(rng.randint(3, 12), len(passage), rng.choice([17, 23, 40, 900])):
                passage[at] = rng.choice(["", "z", "zz"])
            text += words(rng, 3) + ["".join(passage)]
        text = " ".join(text)
        expected = {}
        for i, w in enumerate(items):
            parts = [plain[i]] if len(w) <= decontam.WHOLE_WORDS else []
            if len(w) > decontam.WINDOW_WORDS:
                parts += [" ".join(w[k:k + decontam.WINDOW_WORDS]) for k in range(len(w) - decontam.WINDOW_WORDS + 1)]
            found = [d for p in parts if (d := least_edits(p, text)) <= len(p) // decontam.EDIT_CHARS]
            if found:
                expected[i] = min(found)
        assert decontam.Matcher(list(enumerate(plain))).find(text) == expected


def test_one_bad_host_does_not_condemn_its_siblings(spark):
    def judged(bad, all_hosts):
        pages = [(f"http://h{i}.shared.com/{'out/' if i < bad else ''}{k}", None) for i in range(all_hosts) for k in range(3)]
        frame = spark.createDataFrame([(i, *p) for i, p in enumerate(pages)], "page_id long, url string, html string")
        out = linkgraph.judge(frame, [("block", "shared.com/out/")]).collect()
        return {r["verdict"] for r in out if r["rule"] is None}

    assert judged(1, 25) == {"allow"}
    assert judged(20, 25) == {"block"}
    linked = [("http://bad.shared.com/out/1", None), ("http://fan.other.org/", '<a href="http://bad.shared.com/">')]
    linked += [(f"http://h{i}.shared.com/", None) for i in range(24)]
    frame = spark.createDataFrame([(i, *p) for i, p in enumerate(linked)], "page_id long, url string, html string")
    got = {r["host"]: r["verdict"] for r in linkgraph.judge(frame, [("block", "shared.com/out/")]).collect()}
    assert got["fan.other.org"] == "block" and {got[f"h{i}.shared.com"] for i in range(24)} == {"allow"}
