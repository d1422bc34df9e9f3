"""Ranked search, sequence packing and the Merkle manifest against brute force."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from catrec.llm import grouping_pack, impact_search, slot_merkle
from catrec.llm.queries import vocabulary_path

WORDS = "the Of house TREE window fenêtre Straße x1 42 naïve end-of don't 日本 ÀB".split()
DOCS = "doc_id long, text string, lang string, source string, n_chars long, score string, row string, pos string, hash string"


def make_rows(seed: int, n: int) -> list[tuple]:
    rng = random.Random(seed)
    rows = [(i, rng.choice([" ", "\n", "; ", "\t"]).join(rng.choices(WORDS, k=rng.randint(0, 40))),
             rng.choice(["en", "de", "de", "de", None]), rng.choice(["a", None]), rng.randint(0, 99), "s", "r", "p", "h")
            for i in range(n)]
    rows += [rows[3]] * 5                                     # repeated rows
    rows += [(900 + i, *rows[4][1:]) for i in range(15)]      # ties
    rows += [(4, "another text of the same id", "de", "b", None, "s", "r", "p", "h"), (None, "the house", "fr", "a", 3, "s", "r", "p", "h"),
             (None, None, None, None, None, None, None, None, None), (960, "", "", "", 0, "", "", "", ""),
             (961, "!?", "zz", "a", 2, "s", "r", "p", "h"), (962, " ".join(rng.choices(WORDS, k=9000)), "en", "a", 1, "s", "r", "p", "h")]
    return rows


@pytest.fixture(scope="module")
def rows():
    return make_rows(3, 90)


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, DOCS).repartition(5)


# ---------------------------------------------------------------- ranked search

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
ASCII_LOWER = {c: c + 32 for c in range(65, 91)}


def by_id(i):
    return (i is not None, i or 0)


def search_reference(rows, items, k=10):
    texts = [(r[0], TERM.findall((r[1] or "").translate(ASCII_LOWER))) for r in rows]
    held, length = sum(bool(t) for _, t in texts), sum(len(t) for _, t in texts)
    df = {}
    for _, terms in texts:
        for t in set(terms):
            df[t] = df.get(t, 0) + 1
    out = []
    for item, text in items:
        wanted = set(TERM.findall((text or "").translate(ASCII_LOWER)))
        scored = []
        for doc, terms in texts:
            score = 0
            for t in wanted.intersection(terms):
                tf, m = terms.count(t), 10 + 90 * len(terms) * held // length
                score += math.floor(1000 * math.log((2 * held + 2) / (2 * df[t] + 1))) * (10**9 * tf // (1000 * tf + 8 * m))
            if score:
                scored.append((-score, by_id(doc), doc))
        scored.sort(key=lambda x: x[:2])
        out += [(item, rank, doc, -score) for rank, (score, _, doc) in enumerate(scored[:k], 1)]
    return sorted(out, key=str)


ITEMS = [(1, "the HOUSE of fenêtre"), (2, "tree tree tree"), (2, "x1 42 don"), (None, "STRASSE Straße ÀB"), (3, None), (4, "?!"),
         (5, "unseen"), (6, "日本 naïve àb window end of the t")]


@pytest.mark.parametrize("limits", [{}, {"BLOCK_BYTES": 12}, {"TILE_ITEMS": 3, "TILE_TERMS": 2, "TILE_DOCS": 7}])
def test_ranked_search(spark, docs, rows, monkeypatch, limits):
    for name, value in limits.items():
        monkeypatch.setattr(impact_search, name, value)
    items = spark.createDataFrame([(*x, "clash") for x in ITEMS], "item_id long, text string, score string")
    found = impact_search.best_documents(docs, items)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, found.collect()), key=str) == search_reference(rows, ITEMS)


def test_ranked_search_of_other_ids_and_nothing(spark, docs, rows):
    named = docs.select(F.concat(F.lit("d"), "doc_id").alias("doc_id"), "text")
    items = spark.createDataFrame([("q", "the house")], "item_id string, text string")
    ids = {f"d{r[0]}" if r[0] is not None else None for r in rows}
    found = impact_search.best_documents(named, items, k=4).orderBy("rank").collect()
    assert [r["rank"] for r in found] == [1, 2, 3, 4] and {r["doc_id"] for r in found} <= ids
    assert impact_search.best_documents(named.limit(0), items).collect() == []
    assert impact_search.best_documents(named, items.limit(0)).collect() == []


def test_products_stay_exact():
    """Sums beyond 2^53 come out whole, since a tile's width keeps each product below it."""
    weight = 44_361
    width = (impact_search.EXACT - 1) // (weight * impact_search.IMPACT_BOUND)
    assert width * weight * impact_search.IMPACT_BOUND < impact_search.EXACT and width > impact_search.TILE_TERMS
    best = impact_search.Best(1, 3)
    ids = np.array([5, 6, 7, 8], object)
    best.offer(0, np.array([[2**60 + 1, 2**60, 2**60 + 1, 0]]), ids)
    best.offer(0, np.array([[2**60 + 1, 3, 2**60 + 2, 0]]), ids + 10)
    assert best.ids[0].tolist() == [17, 5, 7]


# ---------------------------------------------------------------- packing

def library_pieces(rows, capacity):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(vocabulary_path())
    out = []
    for row in rows:
        ids = np.array(tokenizer.encode(row[1] or "", add_special_tokens=False).ids + [1], "<u4")
        for k, at in enumerate(range(0, len(ids), capacity)):
            part = ids[at:at + capacity]
            out.append((row[0], k, at, len(part), zlib.crc32(part.tobytes())))
    return sorted(out, key=str)


def check_packing(packed, capacity):
    bins = {}
    for r in packed:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins)


ODD_TEXTS = ["", " ", "a\x1cb\x85c d", "café ́x", "<|endoftext|> <|endoftext|>x", "don't DON'T 'S", "ΣΑΣ ς", "x" * 5000,
             "　日本 語", "１２ ½ ²", "a ̸= b"]


@pytest.mark.parametrize("problem", [2048, 20])
def test_packing(spark, docs, rows, monkeypatch, problem):
    monkeypatch.setattr(grouping_pack, "PROBLEM", problem)
    more = [(2000 + i, t, None, None, None, None, None, None, None) for i, t in enumerate(ODD_TEXTS)]
    table = docs.union(spark.createDataFrame(more, DOCS))
    packed = grouping_pack.pack_documents(table, vocabulary_path(), 300, 1, ids=True).cache()
    got = sorted([(r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in packed.collect()], key=str)
    assert got == library_pieces(rows + more, 300)
    used = check_packing(packed.collect(), 300)
    volume = -(-sum(x[3] for x in got) // 300)
    assert used <= volume + 1
    whole = {r["sequence_id"]: bytes(r["ids"]) for r in grouping_pack.sequences(packed).collect()}
    for r in packed.collect():
        part = whole[r["sequence_id"]][4 * r["offset"]:4 * (r["offset"] + r["length"])]
        assert zlib.crc32(part) == r["ids_crc32"]


def test_packing_of_nothing(docs):
    assert grouping_pack.pack_documents(docs.limit(0), vocabulary_path()).collect() == []


def test_crossover_keeps_every_piece_once():
    rng = random.Random(1)
    for _ in range(50):
        sizes = [rng.randint(1, 99) for _ in range(60)]
        a, b = (grouping_pack.packed(rng.sample(range(60), 60), sizes, 100) for _ in range(2))
        child = grouping_pack.crossover(a, b, sizes, rng)
        assert sorted(i for g in child.groups for i in g) == list(range(60))
        assert all(sum(sizes[i] for i in g) == 100 - f >= 0 for g, f in zip(child.groups, child.free))
        again = grouping_pack.from_bytes(grouping_pack.to_bytes(child, 60), sizes, 100)
        assert sorted(map(sorted, again.groups)) == sorted(map(sorted, child.groups))


def test_evolution_beats_best_fit_decreasing():
    """Triples cut from full bins: largest first can't find them, the islands come nearer to the bound."""
    rng, better = random.Random(4), 0
    for seed in range(4):
        sizes = []
        for _ in range(20):
            x, y = rng.randint(260, 400), rng.randint(260, 400)
            sizes += [x, y, 1000 - x - y]
        bound = grouping_pack.lower_bound(sizes, 1000)
        assert bound == 20
        first = grouping_pack.packed(sorted(range(60), key=lambda i: -sizes[i]), sizes, 1000)
        population = []
        for epoch in range(6):
            population = grouping_pack.evolve(sizes, 1000, population, bound, random.Random(f"{seed}/{epoch}"))
        assert grouping_pack.merit(population[0]) >= grouping_pack.merit(first)
        better += len(population[0].free) < len(first.free)
    assert better


def test_lower_bound_is_never_above_the_best():
    rng = random.Random(7)

    def least(sizes, capacity):
        best = [len(sizes)]

        def place(i, free):
            if len(free) >= best[0]:
                return
            if i == len(sizes):
                best[0] = len(free)
                return
            for b in range(len(free)):
                if free[b] >= sizes[i]:
                    place(i + 1, [f - sizes[i] * (j == b) for j, f in enumerate(free)])
            place(i + 1, [*free, capacity - sizes[i]])

        place(0, [])
        return best[0]

    for _ in range(60):
        sizes = [rng.randint(1, 20) for _ in range(rng.randint(1, 8))]
        assert grouping_pack.lower_bound(sizes, 20) <= least(sizes, 20)


# ---------------------------------------------------------------- manifest

COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row, more=0):
    values = [row[0], row[3], row[2], None if row[4] is None else row[4] + more, row[1]]
    return sha(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def tree_of(hashes, fanout):
    levels = [hashes]
    while len(levels[-1]) > 1:
        levels.append([sha(*levels[-1][i:i + fanout]) for i in range(0, len(levels[-1]), fanout)])
    return levels


def path_in(levels, i, fanout):
    path = []
    for level in levels[:-1]:
        run = i - i % fanout
        path.append(("".join(level[run:i]), "".join(level[i + 1:run + fanout])))
        i //= fanout
    return path


def manifest_reference(rows, fanout):
    groups = {}
    for row in rows:
        groups.setdefault(row[2], []).append(row)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: [(by_id(r[0]), leaf_of(r), r) for r in rs] for g, rs in groups.items()}
    for g in trees:
        trees[g].sort(key=lambda x: x[:2])
    levels = {g: tree_of([x[1] for x in trees[g]], fanout) for g in order}
    top = tree_of([levels[g][-1][0] for g in order], fanout)
    out = []
    for k, g in enumerate(order):
        for i, (_, leaf, row) in enumerate(trees[g]):
            path = path_in(levels[g], i, fanout) + path_in(top, k, fanout)
            tampered = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0
            folded = leaf_of(row, 1) if tampered else leaf
            for left, right in path:
                folded = sha(left, folded, right)
            out.append((row[0], leaf, levels[g][-1][0], top[-1][0], sha(*[x for s in path for x in s]), folded))
    return sorted(out, key=str)


def manifest_rows(docs, fanout):
    more = {"n_chars": F.col("n_chars").cast("decimal(20,0)") + 1}
    tamper = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    proofs = slot_merkle.manifest(docs, COLUMNS, "lang", "doc_id", more, tamper, fanout)
    return sorted(map(tuple, proofs.select("doc_id", "leaf", "subroot", "root", slot_merkle.proof_digest(F.col("path")),
                                           slot_merkle.fold(F.col("tampered_leaf"), F.col("path"))).collect()), key=str)


@pytest.mark.parametrize("fanout", [2, 3])
def test_manifest(docs, rows, fanout):
    assert manifest_rows(docs, fanout) == manifest_reference(rows, fanout)


def test_manifest_of_few_rows(spark, docs, rows):
    one = spark.createDataFrame(rows[:1], DOCS)
    assert manifest_rows(one, 2) == manifest_reference(rows[:1], 2)
    assert manifest_rows(docs.limit(0), 2) == []
