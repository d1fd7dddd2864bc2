"""Operators 1, 4, 6 and 9 against brute force, and the pipeline."""

from __future__ import annotations

import random

import numpy as np
import pytest

from sievewright.llm import ann, components, decontaminate, passages, set_join
from sievewright.llm.common import hashed_words, popcount_lcs, words_by_text


def _words(rng, n, size=4000):
    return [f"w{rng.randrange(size)}" for _ in range(n)]


def test_hashed_words_follow_split():
    rng = random.Random(4)
    alphabet = "aB  \t\x1c éİß\n."
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 20))) for _ in range(300)] + ["", " "]
    split = [t.lower().split() for t in texts]
    by_text = words_by_text(texts)
    assert [len(w) for w in by_text] == [len(w) for w in split]
    seen: dict = {}
    for words, hashes in zip(split, by_text):
        for w, h in zip(words, hashes.tolist()):
            assert seen.setdefault(w, h) == h
    assert len(set(seen.values())) == len(seen)
    assert len(hashed_words([])[0]) == 0


def test_common_subsequence():
    rng = random.Random(5)
    for _ in range(50):
        a, b = ([rng.randrange(5) for _ in range(rng.randint(0, 12))] for _ in range(2))
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
        assert popcount_lcs(np.array(a), np.array(b)) == table[-1][-1] == decontaminate.common(decontaminate.masks(np.array(a)), b)


def test_nearest_neighbours(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(600, 8))
    x[100:160] = x[100]
    rows = [(i, v.tolist(), "x") for i, v in enumerate(x)]
    rows += [(1000, None, "x"), (1001, [0.0] * 8, "x"), (1002, [float("nan")] * 8, "x"), (1003, [1.0, 2.0], "x"), (None, [1.0] * 8, "x"), (1004, [None] + [1.0] * 7, "x"), (5, [9.0] * 8, "x")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score string")
    got = ann.search(df, df.where("vec_id % 20 = 0"), k=5).collect()
    x[5] = min(x[5].tolist(), [9.0] * 8)  # of a repeated id the smaller vector counts
    hits = total = 0
    for q in range(0, 600, 20):
        score = x @ x[q]
        score[q] = -np.inf
        want = np.lexsort((np.arange(600), -score))[:5]
        mine = sorted((r["rank"], r.vec_id, r.score) for r in got if r.query_id == q)
        assert [m[0] for m in mine] == [1, 2, 3, 4, 5] and q not in [m[1] for m in mine]
        assert all(a[2] > b[2] or (a[2] == b[2] and a[1] < b[1]) for a, b in zip(mine, mine[1:]))
        for _, v, s in mine:
            assert s == pytest.approx(score[v], abs=1e-12)
        hits += len(set(want.tolist()) & {m[1] for m in mine})
        total += 5
    assert hits / total >= 0.9
    few = df.where("vec_id in (0, 1, 2)")
    assert sorted((r.query_id, r["rank"]) for r in ann.search(few, few.where("vec_id = 0"), k=5).collect()) == [(0, 1), (0, 2)]
    assert ann.search(df.limit(0), df, k=5).count() == 0


def _near_fixture():
    rng = random.Random(8)
    texts = {}
    for g in range(12):
        base = _words(rng, 120)
        for _ in range(rng.choice([1, 2, 5])):
            t = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 3, 6])):
                t[rng.randrange(len(t))] = f"edit{rng.randrange(10**6)}"
            texts[len(texts)] = " ".join(t)
    hot = _words(rng, 100)
    for i in range(700):
        t = list(hot)
        t[i % 100] = f"hot{i}"
        texts[len(texts)] = " ".join(t)
    for _ in range(5):
        texts[len(texts)] = " ".join(hot)
    texts[len(texts)] = "Two words"
    texts[len(texts)] = "two  words"
    texts[len(texts)] = ""
    texts[len(texts)] = None
    return texts


def _runs(t):
    w = (t or "").lower().split()
    k = min(5, len(w))
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if w else frozenset()


def test_near_copies_against_brute_force(spark):
    texts = _near_fixture()
    rows = [(i, t, "x") for i, t in texts.items()] + [(None, texts[0], "x"), (0, texts[0], "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, key string").repartition(5)
    found = set_join.near_copies(df)
    got = [r for r in found.collect()]
    assert len(got) == len(rows)
    sets = {i: _runs(t) for i, t in texts.items()}
    distinct = {}
    for i in sorted(sets):
        distinct.setdefault(sets[i], i)
    links = {s: 0 for s in distinct}
    parent = {i: i for i in sets}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    keys = [s for s in distinct if s]
    for i, s in sets.items():
        if s:
            a, b = find(i), find(distinct[s])
            parent[max(a, b)] = min(a, b)
    for n, s in enumerate(keys):
        for t in keys[n + 1 :]:
            both = len(s & t)
            if both * 10 >= 8 * (len(s) + len(t) - both):
                links[s] += 1
                links[t] += 1
                a, b = find(distinct[s]), find(distinct[t])
                if a != b:
                    parent[max(a, b)] = min(a, b)
    true = {r.doc_id: links.get(sets[r.doc_id], 0) for r in got if r.doc_id is not None}
    assert all(r.links <= true[r.doc_id] for r in got if r.doc_id is not None)
    assert sum(r.links for r in got) >= 0.995 * sum(true[r.doc_id] for r in got if r.doc_id is not None)
    assert all(r.class_id == find(r.doc_id) for r in got if r.doc_id is not None)
    assert [(r.class_id, r.links, r.copies) for r in got if r.doc_id is None] == [(None, 0, 0)]
    kept = set_join.one_per_class(df, found)
    assert kept.columns == df.columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == sorted({find(i) for i in texts}) and ids.count(None) == 1
    assert set_join.near_copies(df.limit(0)).count() == 0


def test_rows_that_repeat_an_id_or_have_none_are_kept_by_text(spark):
    rng = random.Random(22)
    a, b = (" ".join(_words(rng, 60)) for _ in range(2))
    rows = [(1, a), (5, a), (5, b), (5, b), (6, None), (None, a), (None, a), (None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    kept = set_join.one_per_class(df, set_join.near_copies(df)).collect()
    wanted = [(1, a), (5, b), (6, None), (None, a), (None, a), (None, None)]
    assert sorted(map(repr, map(tuple, kept))) == sorted(map(repr, wanted))


def test_repetitions_reach_the_recall():
    rng = np.random.default_rng(4)
    n = set_join.repetitions_for(0.8, 0.999)
    assert set_join.path_recall(0.8, n) >= 0.999 > set_join.path_recall(0.8, n - 1)
    shared = rng.binomial(set_join.TOKENS, 0.8, 400_000) / set_join.TOKENS
    assert (1 - (1 - shared**set_join.DEPTH) ** n).mean() >= 0.9988


def test_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(i + 1, i) for i in range(40)] + [(100, 101), (7, 7), (None, 3)], "a long, b long")
    got = {r.node: r.root for r in components.connected(edges).collect()}
    assert got == {i: 0 for i in range(41)} | {100: 100, 101: 100}
    assert components.connected(edges.limit(0)).count() == 0


def test_rounds_write_few_files(spark, monkeypatch):
    """Tables of few rows are written in one file, however many shuffle partitions there are."""
    made = []

    def noted(df, rows, name, own=components.written):
        out = own(df, rows, name)
        made.append((name, len(out.inputFiles())))
        return out

    for module in (components, set_join):
        monkeypatch.setattr(module, "written", noted)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        texts = [(i, " ".join([*(f"w{j}" for j in range(200)), f"x{i}"])) for i in range(30)] + [(99, "one two three")]
        df = spark.createDataFrame(texts, "doc_id long, text string")
        got = {r.doc_id: (r.class_id, r.links) for r in set_join.near_copies(df).collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert got == {i: (0, 29) for i in range(30)} | {99: (99, 0)}
    assert {n for n, _ in made} == {"paths", "edges"} and max(files for _, files in made) == 1


def test_repeated_passages(spark):
    rng = random.Random(9)
    passage, other = _words(rng, 70), _words(rng, 60)
    fuzzy = list(passage)
    for i in (12, 33, 51):
        fuzzy[i] = "changed"
    short = _words(rng, 30)
    texts = {
        1: _words(rng, 80) + passage + _words(rng, 40),
        2: _words(rng, 33) + passage + _words(rng, 10),
        3: fuzzy + _words(rng, 90),
        4: _words(rng, 200) + short,
        5: short + _words(rng, 100),
        6: ["same"] * 200,
        7: _words(rng, 20) + ["same"] * 120,
        8: other + _words(rng, 30) + passage,
        9: _words(rng, 50) + other,
    }
    rows = [(i, " ".join(t), "x") for i, t in texts.items()]
    rows += [(10, None, "x"), (11, "", "x"), (None, " ".join(passage), "x"), (2, " ".join(texts[2]), "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, start string").repartition(4)
    found = passages.repeated(df)
    by_doc: dict = {}
    for r in found.collect():
        by_doc.setdefault(r.doc_id, set()).add((r.first_doc_id, r.passage_start, r.passage_end))
    assert by_doc == {2: {(1, 33, 103)}, 3: {(1, 0, 70)}, 7: {(6, 20, 140)}, 8: {(1, 90, 160)}, 9: {(8, 50, 110)}}
    left = passages.without_passages(df, found)
    assert left.columns == df.columns
    after = {r.doc_id: r.text for r in left.collect() if r.doc_id != 2}
    assert after[1] == " ".join(texts[1]) and after[10] is None and after[None] == " ".join(passage)
    assert after[9].split() == texts[9][:50] and after[7].split() == texts[7][:20]
    assert {tuple(r.text.split()) for r in left.where("doc_id = 2").collect()} == {tuple(texts[2][:33] + texts[2][103:])}
    copies = spark.createDataFrame([(1, " ".join(passage)), (2, " ".join(passage))], "doc_id long, text string")
    assert [r.doc_id for r in passages.without_passages(copies, passages.repeated(copies)).collect()] == [1]
    assert passages.repeated(df.limit(0)).count() == 0


def _cuts(spark, texts):
    df = spark.createDataFrame([(i, " ".join(t)) for i, t in texts.items()], "doc_id long, text string").repartition(3)
    return {(r.doc_id, r.passage_start, r.passage_end) for r in passages.repeated(df).collect()}


def test_passage_whose_halves_stood_first_elsewhere(spark):
    rng = random.Random(19)
    texts, wanted = {}, set()
    for n in range(0, 80, 4):
        x, y = _words(rng, 30, 10**6), _words(rng, 30, 10**6)
        for i, own in enumerate((x, y, x + y, x + y)):
            texts[n + i] = _words(rng, 50, 10**6) + own + _words(rng, 50, 10**6)
        wanted |= {(n + 2, 50, 110), (n + 3, 50, 110)}
    found = _cuts(spark, texts)
    assert {n + 3 for n in range(0, 80, 4)} <= {d for d, _, _ in found} and found <= wanted


def test_passage_twice_in_a_later_document(spark):
    rng = random.Random(20)
    p, line = _words(rng, 70), _words(rng, 12)
    q = _words(rng, 20) + line + _words(rng, 28)
    texts = {1: p, 2: p + _words(rng, 40) + p, 3: _words(rng, 60) + q, 4: line + _words(rng, 60) + q}
    assert _cuts(spark, texts) == {(2, 0, 70), (2, 110, 180), (4, 72, 132)}


def test_passages_with_changed_words(spark):
    rng = random.Random(23)
    rows, planted = [], {}
    for size, share in ((60, 0.05), (60, 0.1), (120, 0.05), (120, 0.1), (120, 0.15), (400, 0.15)):
        for _ in range(40):
            passage = _words(rng, size, 20_000)
            changed = list(passage)
            for i in rng.sample(range(size), round(share * size)):
                changed[i] = f"x{rng.randrange(10**6)}"
            n = len(planted)
            planted[1000 + n] = size, share
            rows += [(i, " ".join(_words(rng, 50, 20_000) + p + _words(rng, 50, 20_000))) for i, p in ((n, passage), (1000 + n, changed))]
    rows += [(5000 + i, " ".join(_words(rng, 300, 20_000))) for i in range(100)]
    found = passages.repeated(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    assert {r.doc_id for r in found} <= set(planted) and all(r.first_doc_id == r.doc_id - 1000 for r in found)
    covered = {d: set() for d in planted}
    for r in found:
        covered[r.doc_id] |= set(range(r.passage_start, r.passage_end))
    for kind in set(planted.values()):
        own = [covered[d] for d, k in planted.items() if k == kind]
        place = set(range(50, 50 + kind[0]))
        assert sum(bool(c & place) for c in own) >= 0.9 * len(own), kind
        assert sum(len(c & place) for c in own) >= 0.85 * len(own) * kind[0], kind
        assert all(len(c - place) <= 6 for c in own), kind


def test_passages_of_rows_that_repeat_an_id(spark):
    rng = random.Random(24)
    passage, other = _words(rng, 70), _words(rng, 150)
    own = _words(rng, 20) + passage + _words(rng, 60)
    rows = [(1, " ".join(passage)), (2, " ".join(own)), (2, " ".join(other)), (2, " ".join(other)), (3, " ".join(other)), (4, None)]
    for parts in (1, 3, 5):
        df = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
        found = passages.repeated(df)
        assert {(r.doc_id, r.first_doc_id, r.passage_start, r.passage_end) for r in found.collect()} == {(2, 1, 20, 90), (3, 2, 0, 150)}
        left = sorted((r.doc_id, " ".join((r.text or "").split())) for r in passages.without_passages(df, found).collect())
        wanted = [(1, passage), (2, own[:20] + own[90:]), (2, other), (2, other), (4, [])]
        assert left == sorted((i, " ".join(w)) for i, w in wanted)


def test_passages_keep_columns_with_working_names(spark):
    rng = random.Random(25)
    p = " ".join(_words(rng, 60))
    df = spark.createDataFrame([(1, p, "a", 7, "b"), (2, p + " tail", "c", 8, "d")], "doc_id long, text string, spans string, key int, `id` string")
    left = passages.without_passages(df, passages.repeated(df))
    assert left.columns == df.columns
    assert sorted(map(tuple, left.collect())) == [(1, p, "a", 7, "b"), (2, " tail", "c", 8, "d")]
    texts = spark.createDataFrame([("b", p), ("a", p), ("ab", p)], "doc_id string, text string")
    assert {(r.doc_id, r.first_doc_id) for r in passages.repeated(texts).collect()} == {("ab", "a"), ("b", "a")}


def test_chains_are_the_best_by_brute_force():
    rng = random.Random(2)
    for _ in range(40):
        runs = np.array([(a, a + 5, b, b + 5, 5, 1) for a, b in {(rng.randrange(60), rng.randrange(60)) for _ in range(7)}])
        runs = runs[np.lexsort((runs[:, 2], runs[:, 0]))]
        best = 0.0

        def grow(last, score):
            nonlocal best
            best = max(best, score)
            for r in runs.tolist():
                if last is None or (r[0] >= last[1] and r[2] >= last[3]):
                    cost = 0 if last is None else passages.GAP_COST * (r[0] - last[1] + r[2] - last[3])
                    if last is None or score - cost > 0:
                        grow(r, score - cost + r[4])

        grow(None, 0.0)
        chain = runs[passages.chains(runs)[0]].tolist()
        score = chain[0][4] + sum(b[4] - passages.GAP_COST * (b[0] - a[1] + b[2] - a[3]) for a, b in zip(chain, chain[1:]))
        assert score == pytest.approx(best)


def test_benchmark_leaks(spark):
    rng = random.Random(6)
    items = {i: _words(rng, 40, 900) for i in range(6)}
    reworded = [w if n % 7 else "other" for n, w in enumerate(items[1])]
    docs = [(i, " ".join(_words(rng, 300, 900)), "x") for i in range(60)]
    docs += [(100, " ".join(_words(rng, 90, 900) + items[0] + _words(rng, 30, 900)), "x")]
    docs += [(101, " ".join(_words(rng, 20, 900) + reworded), "x"), (102, " ".join(items[2]), "x"), (102, " ".join(items[2]), "x")]
    docs += [(103, " ".join(_words(rng, 200, 900) + ["tiny", "exact", "item"]), "x"), (104, None, "x"), (105, "", "x"), (None, " ".join(items[3]), "x")]
    df = spark.createDataFrame(docs, "doc_id long, text string, item_id string").repartition(3)
    bench = [(i, " ".join(t)) for i, t in items.items()] + [(50, None), (51, ""), (None, "x y z"), (0, " ".join(items[0]))]
    benchmark = spark.createDataFrame(bench, "item_id long, text string")
    found = decontaminate.leaks(df, benchmark)
    got = {(r.doc_id, r.item_id): r for r in found.collect()}
    assert set(got) == {(100, 0), (101, 1), (102, 2)}
    assert got[100, 0].overlap == 1 and 0.8 <= got[101, 1].overlap < 0.9
    left = decontaminate.without_leaks(df, found)
    assert left.columns == df.columns and left.count() == len(docs) - 4
    assert decontaminate.leaks(df.limit(0), benchmark).count() == 0
    assert decontaminate.leaks(df, benchmark.limit(0)).count() == 0


def test_leaks_of_frequent_items_are_found(spark):
    rng = random.Random(16)
    hot, common = _words(rng, 24, 900), [f"c{i % 12}" for i in range(30)]
    texts = []
    for i in range(600):
        own = [f"c{rng.randrange(12)}" if n % 3 else f"w{rng.randrange(900)}" for n in range(120)]
        at = rng.randrange(100)
        texts.append(own[:at] + hot + own[at:] if i % 3 == 0 else own)
    texts[1] = texts[1][:50] + common + texts[1][50:]
    df = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    bench = [(0, " ".join(hot)), (1, " ".join(common)), (2, " ".join(hot[3:6]))]
    benchmark = spark.createDataFrame(bench, "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.overlap for r in decontaminate.leaks(df, benchmark).collect()}
    wanted = {(i, item) for i in range(0, 600, 3) for item in (0, 2)} | {(1, 1)}
    assert set(got) == wanted and set(got.values()) == {1.0}


def test_pipeline_over_the_smallest_tables(spark):
    import corpus_pipeline

    folder = "/root/testdata/sf0.001"
    assert [len(s) for s in corpus_pipeline.STAGES] == [2] * 5
    out = corpus_pipeline.run(spark, folder)
    total = spark.read.parquet(f"{folder}/documents.parquet").count()
    n = out.count()
    assert 0.5 * total < n < total and out.select("doc_id").distinct().count() == n
