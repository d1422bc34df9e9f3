"""The ten operators against brute force on small tables with nulls, ties, repeats and clashing names."""

from __future__ import annotations

import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from catrec.llm import bpe_count, decontam, fuzzy_lines, hilbert, icws, langid, linkgraph, mixing, ppm, queries, rabitq

LANGS = {"aa": "the of and house tree window running", "bb": "der und das haus baum fenster laufend",
         "cc": "дом и дерево окно бег река"}
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, id string, size string"


def prose(rng: random.Random, n: int, lang: str = "aa") -> str:
    words = LANGS[lang].split()
    return " ".join(rng.choice(words) + (rng.choice("aeiou") + rng.choice("klmnrst") if rng.random() < 0.7 else "")
                    for _ in range(n))


def corpus() -> list[tuple]:
    rng = random.Random(5)
    texts = [(prose(rng, rng.randint(12, 60), lang), lang) for lang in LANGS for _ in range(25)]
    base = prose(rng, 80)
    words = base.split()
    for i in range(12):  # near copies of one text
        changed = list(words)
        changed[3 + 5 * i] = "changed"
        texts.append((" ".join(changed), "aa"))
    texts += [(base, "aa")] * 6 + [(texts[0][0], "aa")]
    texts += [(None, "aa"), ("", None), ("   ", "bb"), ("12 34 !!", "aa"), ("one", None), (prose(rng, 9000), "aa"),
              ("日本 語の\nテキスト", None)]
    return [(i, t, lang, [None, "s1", "s2", "s2"][i % 4], None, "x", "y") for i, (t, lang) in enumerate(texts)]


@pytest.fixture(scope="module")
def rows():
    return corpus()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, COLUMNS).repartition(5)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], COLUMNS)


def crc(i: int, folds: int) -> int:
    return zlib.crc32(str(i).encode()) % folds


def test_language_id(spark, docs, rows, empty):
    model = langid.learn(docs.select(F.col("doc_id").alias("id"), "text", "lang"))
    got = {r["doc_id"]: r for r in langid.identify(docs, model).collect()}
    assert len(got) == len(rows)
    for i, text, lang, *_ in rows:
        if not text or not any(map(str.isalpha, text)):
            assert (got[i]["lang_pred"], got[i]["score"], got[i]["spans"]) == ("und", 0.0, [])
        elif lang and len(text) > 40:
            assert got[i]["lang_pred"] == lang
        assert 0 <= got[i]["score"] <= 1
    nothing = langid.learn(empty.select(F.col("doc_id").alias("id"), "text", "lang"))
    assert {r["lang_pred"] for r in langid.identify(docs, nothing).collect()} == {"und"}
    assert langid.identify(empty, model).count() == 0


def test_language_spans_follow_viterbi(docs):
    model = langid.learn(docs.select(F.col("doc_id").alias("id"), "text", "lang"))
    rng = random.Random(1)
    text = prose(rng, 30, "aa") + " " + prose(rng, 50, "bb")
    _, _, (spans,) = model.label([text])
    assert [s["lang"] for s in spans] == ["aa", "bb"] and abs(spans[0]["words"] - 30) <= 1
    scores = np.random.default_rng(2).uniform(-5, 0, (200, 3)).astype(np.float32)
    assert path_score(scores, model.path(scores)) == pytest.approx(best_path_score(scores), abs=1e-4)


def path_score(scores, path):
    return scores[np.arange(len(path)), path].sum(dtype=float) - langid.SWITCH * (np.diff(path) != 0).sum()


def best_path_score(scores):
    now = scores[0].astype(float)
    for row in scores[1:]:
        now = np.array([max(now[j] - (langid.SWITCH if j != k else 0) for j in range(len(now))) + row[k]
                        for k in range(len(now))])
    return now.max()


def test_decontamination(spark, docs, empty):
    rng = random.Random(9)
    item, other = prose(rng, 24, "bb"), prose(rng, 50, "bb")
    edited = item[:30] + "X" + item[31:60] + item[62:]
    cases = [(0, f"Lead in. {item.upper()}!! More"), (1, edited), (2, prose(rng, 60)), (3, None), (4, ""),
             (5, " ".join(other.split()[5:45])), (6, "one two"), (7, "say one two three")]
    frame = spark.createDataFrame(cases, "doc_id long, text string").withColumn("items", F.lit("clash"))
    tests = spark.createDataFrame([(1, item), (2, other), (3, "One two"), (4, None), (5, "..")], "item_id long, text string")
    got = {r["row_"]["doc_id"]: r["items"] for r in decontam.find_items(frame, tests).collect()}
    assert got == {0: [1], 1: [1], 2: [], 3: [], 4: [], 5: [2], 6: [3], 7: []}
    both = spark.createDataFrame([(9, f"{item} and then {other}")], "doc_id long, text string")
    nameless = spark.createDataFrame([(None, item), (2, other), (None, prose(rng, 30))], "item_id long, text string")
    assert [r["items"] for r in decontam.find_items(both, nameless).collect()] == [[None, 2]]
    assert decontam.find_items(empty, tests).count() == 0
    assert not any(r["contaminated"] for r in decontam.find_items(docs, tests.limit(0)).collect())


def test_decontamination_in_blocks_is_the_same(spark, docs, monkeypatch):
    tests = docs.select(F.col("doc_id").alias("item_id"), "text").where("doc_id % 7 = 0")
    pick = lambda: sorted((r["row_"]["doc_id"], r["items"], r["distances"])
                          for r in decontam.find_items(docs, tests).collect())
    whole = pick()
    monkeypatch.setattr(decontam, "BLOCK_BYTES", 3000)
    assert pick() == whole


def test_myers_distance():
    rng = random.Random(3)
    for _ in range(300):
        text = "".join(rng.choice("abc") for _ in range(rng.randint(0, 25)))
        pattern = "".join(rng.choice("abc") for _ in range(rng.randint(1, 12)))
        row = list(range(len(pattern) + 1))
        best = row[-1]
        for c in text:
            new = [0]
            for i, p in enumerate(pattern, 1):
                new.append(min(row[i] + 1, new[i - 1] + 1, row[i - 1] + (p != c)))
            row = new
            best = min(best, row[-1])
        assert decontam.Pattern(0, pattern).distance(text) == best


def ppm_reference(texts, train):
    """Per-byte PPM (method D, exclusion) with plain dictionaries; and the smoothed word score."""
    counts = [{} for _ in range(ppm.ORDER + 1)]
    seq = [bytes([ppm.BEGIN]) * ppm.ORDER + (t or "").encode().lower() + bytes([ppm.END]) for t in texts]
    for s, use in zip(seq, train, strict=True):
        for i in range(ppm.ORDER, len(s) if use else 0):
            for k in range(ppm.ORDER + 1):
                counts[k].setdefault(s[i - k:i], {}).setdefault(s[i], 0)
                counts[k][s[i - k:i]][s[i]] += 1
    out = []
    for s in seq:
        total = 0.0
        for i in range(ppm.ORDER, len(s)):
            barred = set()
            for k in range(ppm.ORDER, -1, -1):
                here = {x: n for x, n in counts[k].get(s[i - k:i], {}).items() if x not in barred}
                if not here:
                    continue
                room = 2 * sum(here.values())
                if s[i] in here:
                    total += math.log10((2 * here[s[i]] - 1) / room)
                    break
                total += math.log10(len(here) / room)
                barred |= set(here)
            else:
                total -= math.log10(256 - len(barred))
        out.append(total)
    return out


def test_lm_score(spark, docs, rows, empty, monkeypatch):
    monkeypatch.setattr(ppm, "BLOCK_BYTES", 5000)
    some = [r for r in rows if len(r[1] or "") < 5000]
    frame = docs.where(F.length(F.coalesce("text", F.lit(""))) < 5000)
    train = F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % 7 != 2
    got = {r["doc_id"]: r for r in ppm.score_documents(frame, train).collect()}
    used = [crc(r[0], 7) != 2 for r in some]
    model = ppm_reference([r[1] for r in some], used)
    words = [re.findall(r"[^\x20\x09-\x0D]+", (r[1] or "").lower()) + [None] for r in some]
    counts: dict = {}
    for w, use in zip(words, used, strict=True):
        for x in w if use else ():
            counts[x] = counts.get(x, 0) + 1
    n = sum(counts.values())
    assert len(got) == len(some)
    for r, w, value in zip(some, words, model, strict=True):
        base = sum(math.log10((counts.get(x, 0) + 1) / (n + len(counts) + 1)) for x in w)
        mine = got[r[0]]
        assert (mine["n_tokens"], mine["n_known"], mine["train_tokens"]) == (len(w), sum(x in counts for x in w), n)
        assert mine["base_score"] == pytest.approx(base, abs=1e-6)
        assert mine["score"] == pytest.approx(value, abs=1e-6)
    assert ppm.score_documents(empty, train).count() == 0
    untrained = ppm.score_documents(frame.where("text = 'one'"), F.lit(False)).first()
    assert untrained["score"] == pytest.approx(-4 * math.log10(256)) and untrained["base_score"] == 0


def test_token_counts(docs, rows, empty):
    public = pytest.importorskip("public_tokenizers")
    tokenizers = pytest.importorskip("tokenizers")
    library = tokenizers.Tokenizer.from_file(str(public.path("word_bpe_49k.json")))
    rng = random.Random(1)
    texts = [r[1] for r in rows] + [
        "".join(rng.choice("aAéÉß \t\n\x1c\x85 Σσİ12½Ⅷ漢字'sT'll<|endoftext|>_!?🙂é") for _ in range(rng.randint(0, 60)))
        for _ in range(500)] + ["a<|endoftext|>b <|startoftext|>", "it's WE'LL"]
    merger = bpe_count.PairMerger(open(public.path("word_bpe_49k.json"), encoding="utf-8").read())
    for text in texts:
        assert merger.count(text) == len(library.encode(text or "", add_special_tokens=False).ids)
    got = {r["doc_id"]: (r["n_bytes"], r["n_tokens"]) for r in bpe_count.count_tokens(docs, queries.vocabulary_path()).collect()}
    assert got == {r[0]: (len((r[1] or "").encode()), merger.count(r[1])) for r in rows}
    assert bpe_count.count_tokens(empty, queries.vocabulary_path()).count() == 0


def test_hilbert_neighbours():
    bits = 3
    cells = np.array([(x, y, z) for x in range(8) for y in range(8) for z in range(8)])
    index = hilbert.hilbert_index(cells, bits)
    assert sorted(index) == list(range(512))
    walk = cells[np.argsort(index)]
    assert (np.abs(np.diff(walk, axis=0)).sum(1) == 1).all()


def test_sharding(docs, rows, empty):
    got = hilbert.shard_by_bytes(docs.where("doc_id <> 98"), 4).collect()
    size = {r[0]: len((r[1] or "").encode()) + 8 for r in rows}
    kept = [r for r in rows if r[0] != 98]
    assert {r["doc_id"]: r["size"] for r in got} == {r[0]: size[r[0]] for r in kept}
    assert {r["doc_id"]: r["text_crc32"] for r in got} == {r[0]: zlib.crc32((r[1] or "").encode()) for r in kept}
    by = [[r for r in got if r["shard"] == k] for k in range(4)]
    assert all(sorted(r["slot"] for r in s) == list(range(len(s))) for s in by)
    total, largest = sum(r["size"] for r in got), max(r["size"] for r in got)
    assert all(abs(sum(r["size"] for r in s) - total / 4) <= largest + total / 4 / 50 for s in by)
    again = hilbert.shard_by_bytes(docs.where("doc_id <> 98").repartition(2), 4).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, got)) or {(r["doc_id"], r["shard"]) for r in again} == {
        (r["doc_id"], r["shard"]) for r in got}
    assert hilbert.shard_by_bytes(empty, 4).count() == 0


def weighted_jaccard(a, b, idf):
    tables = []
    for text in (a, b):
        _, keys, times = icws.shingles([text])
        tables.append(dict(zip(keys.tolist(), (times * idf[icws.counter_of(keys)]).tolist(), strict=True)))
    keys = set(tables[0]) | set(tables[1])
    low = sum(min(tables[0].get(k, 0), tables[1].get(k, 0)) for k in keys)
    return low / max(1e-9, sum(max(tables[0].get(k, 0), tables[1].get(k, 0)) for k in keys))


def components(ids, linked):
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in linked:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def test_minhash_dedup(docs, rows, empty):
    idf = icws.inverse_frequencies(docs.select("text"))
    have = [(r[0], r[1]) for r in rows if r[1] is not None]
    linked = [(i, j) for n, (i, a) in enumerate(have) for j, b in have[:n]
              if a == b or weighted_jaccard(a, b, idf) >= icws.SIMILARITY]
    expected = components([r[0] for r in rows], linked)
    got = {r["doc_id"]: (r["class_id"], r["kept"]) for r in icws.near_classes(docs).collect()}
    assert got == {i: (c, i == c) for i, c in expected.items()}
    assert icws.near_classes(empty).count() == 0


def test_embedding_dedup(spark):
    rng = np.random.default_rng(4)
    base = rng.standard_normal((300, 24))
    near = base[:60] + 0.3 * rng.standard_normal((60, 24))
    cluster = base[100] + 0.05 * rng.standard_normal((400, 24))
    all_rows = [(int(i), v.astype(np.float32).tolist()) for i, v in enumerate(np.concatenate([base, near, cluster]))]
    all_rows += [(900, all_rows[0][1]), (901, [2 * x for x in all_rows[1][1]])]
    odd = [(902, None), (903, [0.0] * 24), (904, [None] + [1.0] * 23), (905, [float("nan")] * 24),
           (906, [float("inf")] + [1.0] * 23), (907, []), (908, all_rows[2][1][:12])]
    frame = spark.createDataFrame(all_rows + odd, "vec_id long, embedding array<float>").repartition(4)
    got = {r["vec_id"]: r for r in rabitq.near_vectors(frame).collect()}
    matrix = np.array([v for _, v in all_rows], np.float32).astype(float)
    matrix /= np.linalg.norm(matrix, axis=1)[:, None]
    ids = [i for i, _ in all_rows]
    exact = matrix @ matrix.T >= 0.9 - 1e-12
    truth = {(ids[a], ids[b]) for a, b in zip(*np.nonzero(exact), strict=True) if a < b}
    assert len(got) == len(all_rows) + len(odd)
    found = sum(got[i]["n_links"] for i in ids) / 2
    assert 0.9 * len(truth) <= found <= len(truth)
    roots = components(ids, truth)
    assert np.mean([got[i]["component_id"] == roots[i] for i in ids]) >= 0.95
    assert all((got[i]["n_links"], got[i]["component_id"], got[i]["kept"]) == (0, i, True) for i, _ in odd)
    assert rabitq.near_vectors(frame.limit(0)).count() == 0


def test_source_mixing(docs, rows, empty):
    got = mixing.mix(docs, [3, 1, 2]).collect()
    words = {r[0]: len(re.findall(r"[^\x20\x09-\x0D]+", r[1] or "")) for r in rows}
    assert {r["doc_id"]: r["size"] for r in got} == words
    sums: dict = {}
    for r in rows:
        sums[r[3]] = sums.get(r[3], 0) + words[r[0]]
    order = sorted(x for x in sums if x is not None) + [None]
    weight = dict(zip(order, [3, 1, 2], strict=True))
    budget, full, target = 1.5 * sum(sums.values()), set(), {}
    while True:
        left = budget - sum(2 * sums[s] for s in full)
        open_weight = sum(weight[s] for s in order if s not in full)
        target = {s: 2 * sums[s] if s in full else left * weight[s] / open_weight for s in order}
        more = {s for s in order if target[s] > 2 * sums[s]}
        if not more:
            break
        full |= more
    for s in order:
        own = [r for r in got if r["source"] == s]
        assert own[0]["target"] == pytest.approx(target[s])
        assert abs(sum(r["taken"] for r in own) - target[s]) <= max(r["size"] for r in own) / 2 + 1
    assert all(r["taken"] <= 2 * r["size"] for r in got)
    again = mixing.mix(docs.repartition(3), [3, 1, 2]).collect()
    assert {(r["doc_id"], r["taken"]) for r in again} == {(r["doc_id"], r["taken"]) for r in got}
    assert mixing.mix(empty, [3, 1, 2]).count() == 0


def test_url_filter(spark):
    html = '<a href="http://bad.test/x">b</a> <a href="/local">l</a> <img src=//CDN.good.test/i.png>'
    pages = [(0, "http://A.Example.NET/en/1?x#y", None), (1, "https://a.example.net/fr/2", ""), (2, "net", None),
             (3, None, None), (4, "http://x.org/fr/", html), (5, "ftp://example.com", ""), (6, "http://example.com/de/9", ""),
             (7, "http://notnet/", ""), (8, "http://evil.net/", ""), (9, "http://friend.test/", '<a href="http://evil.net/">'),
             (9, "http://friend.test/", '<a href="http://evil.net/">'), (10, "http://calm.test#a?b", "")]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("host", F.lit("clash"))
    got = {r["page_id"]: tuple(r)[1:5] for r in linkgraph.judge(frame, queries.URL_RULES).collect()}
    assert got[0] == ("a.example.net", "/en/1", "example.net/en/", "allow")
    assert got[1] == ("a.example.net", "/fr/2", "net/", "block")
    assert got[2] == got[3] == ("", "", None, "allow")
    assert got[4][2:] == ("org/fr/", "allow") and got[5] == ("example.com", "", None, "allow")
    assert got[6][2:] == ("example.com/de/", "block") and got[7][2:] == (None, "allow")
    assert got[8][2:] == ("net/", "block")
    assert got[9] == ("friend.test", "/", None, "block")  # it links to a blocked host
    assert got[10] == ("calm.test", "", None, "allow")
    assert linkgraph.judge(frame.limit(0), queries.URL_RULES).count() == 0


def line_set(spark, line):
    row = spark.createDataFrame([(line,)], "line string").select(
        fuzzy_lines.line_hashes(fuzzy_lines.normal(F.col("line"))).alias("h")).first()
    return set(row["h"])


def test_fuzzy_lines(spark, empty):
    rng = random.Random(8)
    long = prose(rng, 30)
    edited = " ".join([*long.split()[:14], "other", *long.split()[15:]])
    texts = [f"{long}\nunique {prose(rng, 12)}\n", f"{edited}\n\n{prose(rng, 15)}", f"  {long.upper()}  \n{prose(rng, 9)}",
             None, "", "\n\n", "日本語の長い文です\n日本語の長い文です", f"{long}\n{long}", prose(rng, 4000)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("at", F.lit("clash"))
    dropped = fuzzy_lines.dropped_lines(frame)
    got = {r["doc_id"]: list(r["dropped"]) for r in dropped.collect()}
    lines = [(i, at, x.strip().lower()) for i, t in enumerate(texts) if t for at, x in enumerate(t.split("\n")) if x.strip()]
    sets = {x: line_set(spark, x) for *_, x in lines}
    keys = list(range(len(lines)))
    linked = [(a, b) for b in keys for a in keys[:b] if lines[a][2] == lines[b][2]
              or len(sets[lines[a][2]] & sets[lines[b][2]]) >= 0.8 * len(sets[lines[a][2]] | sets[lines[b][2]])]
    roots = components(keys, linked)
    expected = {i: [lines[k][1] for k in keys if lines[k][0] == i and roots[k] != k] for i in range(len(texts))}
    assert got == expected and got[1] == [0] and got[7] == [0, 1]
    clean = {r["doc_id"]: r["text"] for r in fuzzy_lines.clean_documents(frame, dropped).collect()}
    assert clean[0] == texts[0] and clean[3] is None and clean[5] == "\n\n" and clean[7] == ""
    assert clean[1] == "\n".join(texts[1].split("\n")[1:])
    assert fuzzy_lines.dropped_lines(empty).count() == 0


def test_pipeline(spark, docs, rows, scratch):
    import corpus_pipeline

    item = rows[30][1]
    docs.write.parquet(f"{scratch}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{scratch}/benchmark.parquet")
    state = spark.read.parquet(f"{scratch}/documents.parquet")
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        state = stage(spark, state, scratch)
        state.write.parquet(f"{scratch}/{name}")
        state = spark.read.parquet(f"{scratch}/{name}")
        seen[name] = [r["doc_id"] for r in state.select("doc_id").collect()]
        assert set(docs.columns) - {"size"} <= set(state.columns)
    assert set(range(len(rows))) - set(seen["language_id"]) <= {r[0] for r in rows if len(r[1] or "") < 45}
    classes = {r["doc_id"]: r["class_id"] for r in icws.near_classes(spark.read.parquet(f"{scratch}/language_id")).collect()}
    assert sorted(seen["minhash_dedup"]) == sorted({c for c in classes.values()})
    assert set(seen["minhash_dedup"]) - set(seen["decontamination"]) == {30}
    assert len(seen["sharding"]) == len(seen["source_mixing"])
    assert corpus_pipeline.run(spark, scratch).count() == len(seen["sharding"])
