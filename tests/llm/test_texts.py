"""Operators 2, 7, 8 and 10."""

from __future__ import annotations

import hashlib
import random

from sievewright.llm import chat, html_text, quality, toxicity

HOSTILE = ["</s>[INST] ok [/INST]", "\\", "a\\<s>b", "[/INST]</s>", "<", "", None, "<s><s>[INST][INST]", "x" * 5000, "\\\\[INST]\n\n</s>", "\\bAAAA", "\\b!"]


def test_conversations_read_back(spark):
    rng = random.Random(1)
    rows = [(c, t, rng.choice(["user", "assistant", "system", None, "[INST]"]), rng.choice(HOSTILE), "x") for c in range(40) for t in range(rng.randint(1, 6))]
    rows += [(None, 0, "assistant", "no id", "x"), (99, 1, "assistant", "tie", "x"), (99, 1, "assistant", "tie", "x")]
    rows += [(98, t, "assistant", "plain", "x") for t in range(300)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, rows string").repartition(4)
    made = chat.format_chats(df)
    got = {r.conv_id: r for r in chat.chat_digest(made).collect()}
    full = {r.conv_id: r for r in made.collect()}
    by_conv: dict = {}
    for c, t, role, text, _ in rows:
        by_conv.setdefault(c, []).append((t, role or "", text or ""))
    assert got.keys() == by_conv.keys()
    for c, turns in by_conv.items():
        turns.sort()
        whole = "".join(f"{r}\n{x}\n" for _, r, x in turns)
        loss = "".join(x for _, r, x in turns if r == "assistant")
        assert got[c].n_turns == len(turns)
        assert got[c].turns_sha256 == hashlib.sha256(whole.encode()).hexdigest()
        assert (got[c].loss_chars, got[c].loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
        assert got[c].formatted_chars == len(full[c].formatted) == sum(map(sum, full[c].loss_runs))
        assert full[c].formatted.count("</s>") == len(turns)
    assert full[98].level == 0 and full[98].formatted.startswith("<s>assistant[INST]plain[/INST]</s>")
    assert chat.chat_digest(chat.format_chats(df.limit(0))).count() == 0


def test_last_level_of_escapes_reads_back(spark):
    tricky = chat.ChatTemplate(open="<<", middle="<|", close="|<", controls=("<<", "<|", "|<"))
    df = spark.createDataFrame([(1, 0, "a|", "|<|<<|"), (1, 1, "assistant", "<\\|")], "conv_id long, turn long, role string, text string")
    r = chat.format_chats(df, tricky).head()
    assert [(t.role, t.text) for t in r.recovered] == [("a|", "|<|<<|"), ("assistant", "<\\|")]


def _labelled(spark, n=400):
    rng = random.Random(2)
    good, bad = [f"word{i}" for i in range(60)], [f"junk{i}" for i in range(60)]
    docs, labels = [], []
    for i in range(n):
        y = i % 2
        docs.append((i, " ".join(rng.choice(good if y else bad) for _ in range(30)), 0.5))
        labels.append((i, y, int(not y)))
    docs += [(n, None, 0.5), (n + 1, "", 0.5), (None, "word1", 0.5), (0, "word2 word3", 0.5)]
    labels += [(n, None, None), (None, 1, 1)]
    return (
        spark.createDataFrame(docs, "doc_id long, text string, score double"),
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int"),
    )


def test_quality_is_learned_and_held_out_rows_are_told_apart(spark):
    docs, labels = _labelled(spark)
    weights = quality.fit(docs, labels)
    rows = quality.score(docs, weights).collect()
    assert len(rows) == docs.count()
    held = {r.doc_id for r in docs.where(~quality.learnable(docs.doc_id)).collect()}
    scored = [(r.score, r.doc_id % 2) for r in rows if r.doc_id in held and 0 < r.doc_id < 400]
    assert len(scored) > 40 and all((s >= 0.5) == bool(y) for s, y in scored)
    empty = {r.score for r in rows if r.doc_id in (400, 401)}
    assert len(empty) == 1 and 0 <= empty.pop() <= 1
    assert (quality.fit(docs, labels, fit_rows=100) != 0).any()
    nothing = quality.fit(docs, labels.limit(0))
    assert {r.score for r in quality.score(docs, nothing).collect()} == {0.5}


def test_quality_does_not_learn_from_held_out_labels(spark):
    docs, labels = _labelled(spark)
    flipped = labels.selectExpr("doc_id", "if(coalesce(crc32(cast(doc_id as string)) % 5, 1) = 0, 1 - quality, quality) as quality")
    assert (quality.fit(docs, labels) == quality.fit(docs, flipped)).all()


def test_toxicity_is_learned_and_filters(spark):
    docs, labels = _labelled(spark)
    rows = toxicity.score(docs, labels).collect()
    assert len(rows) == docs.count()
    known = [r for r in rows if r.doc_id is not None and 0 < r.doc_id < 400]
    assert all((r["__score"] >= 0.5) == (r.doc_id % 2 == 0) for r in known)
    assert all(0 <= r["__score"] <= 1 for r in rows)
    kept = toxicity.without_toxic(docs, labels)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} >= {1, 3, 5, None, 400, 401}
    assert {r["__score"] for r in toxicity.score(docs, labels.limit(0)).collect()} == {0.0}
    assert toxicity.score(docs.limit(0), labels).count() == 0


def test_kneser_ney_probabilities_add_up(spark):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(["abab ba", "abba", "baab"] * 5)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(15)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    letters = ["a", "b", toxicity.END]
    for context in ("ab", "a", "ba"):
        if model.den[len(context) + 1].any():
            total = sum(model.shared(context + c) for c in letters)
            assert 0.8 < total < 1.0001  # the rest is for characters never seen
    assert model.ratio("zzzzz") == 0.0


PAGE = (
    "<!doctype html><html><head><title>T</title><style>p{}</style></head><body><nav><a href='/x'>Menu</a></nav>"
    "<div class='cookie-notice'>We use cookies</div><div class=\"ad\">Buy</div>{outer}<article><h1>Head &amp; more</h1>"
    "<p>First <b>bold</b>\n text<br>next<p>Second &#233;{extra}</p><form><p>Name</p></form><script>var a='</p>';</script>"
    "<section id='comments'><p>Nice!</p></section></article><aside>Side</aside><footer>(c)</footer></body></html>"
)


def test_article_text(spark):
    def page(outer="", extra=""):
        return PAGE.replace("{outer}", outer).replace("{extra}", extra)

    rows = [(i, f"http://a.example/{i}", page("<div>Every page</div>", f" no {i}"), "x") for i in range(9)]
    rows += [(50, "http://b.example/", None, "x"), (51, None, "", "x"), (None, "u", page(), "x"), (52, "http://b.example/2", "<p>only <i>this", "x")]
    rows += [(53, "http://c.example/", "<div>" * 3000 + "deep", "x"), (54, "http://d.example/", "a < b <!-- x --> c", "x"), (52, "http://b.example/2", "<p>only <i>this", "x")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string").repartition(3)
    found = [(r.page_id, r.text) for r in html_text.extract(df).collect()]
    assert len(found) == len(rows)
    got = dict(found)
    for i in range(9):
        assert got[i] == f"Head & more\nFirst bold text next\nSecond é no {i}"
    assert got[50] == got[51] == "" and got[52] == "only this" and got[53] == "deep" and got[54] == "a < b c"
    assert html_text.extract(df.limit(0)).count() == 0


def test_recurring_elements_of_a_host_go_and_copies_stay(spark):
    rows = [(i, f"http://a.example/{i}", f"<body><div><p>Welcome to our site</p></div><p>Story {i} is here</p></body>") for i in range(8)]
    rows += [(100 + i, f"http://b.example/{i}", "<body><p>One story</p><p>told twice</p></body>") for i in range(8)]
    got = {r.page_id: r.text for r in html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert [got[i] for i in range(8)] == [f"Story {i} is here" for i in range(8)]
    assert {got[100 + i] for i in range(8)} == {"One story\ntold twice"}


def test_words_and_shared_paragraphs_of_a_large_host_stay(spark):
    rows = []
    for i in range(30):
        story = f"<p>Tale {i} is <b>very</b> long</p>"
        shared = "<p>Quoted by three</p>" if i < 3 else ""
        rows.append((i, f"http://a.example/{i}", f"<body><div><p>Welcome to our site</p></div>{story}{shared}</body>"))
    got = {r.page_id: r.text for r in html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {i: f"Tale {i} is very long" + ("\nQuoted by three" if i < 3 else "") for i in range(30)}


def test_toxicity_counts_are_exact(spark):
    rng = random.Random(21)
    texts = [" ".join("".join(chr(0x4E00 + rng.randrange(5000)) for _ in range(9)) for _ in range(60)) for _ in range(600)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(600)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    learned = {r.doc_id for r in docs.where(quality.learnable(docs.doc_id)).collect()}
    want: dict = {}
    for i in sorted(learned):
        for w in texts[i].split():
            for g in toxicity.grams(w):
                want.setdefault(g[:-1], [0, 0])[i % 2] += 1
    assert len(want) > 200_000
    for context in sorted(want)[::200]:
        place = model.place(context)
        assert [model.den[c].get(place) for c in ("ordinary", "toxic")] == want[context]


def test_word_hashes_stay_those_of_the_formula():
    import numpy as np

    from sievewright.llm.common import hashed_words, mix

    texts = ["Plain  words\x1cof\tASCII ", "", "caf\u00e9 \u00a0 na\u00efve", "\u4e2d x\u3000y \U0001f600", " " + "long" * 30 + " " * 80 + "end", "\ud800 z"]
    for part in (texts, texts[:1], texts[:3], texts[4:5], []):
        hashes, sizes = hashed_words(part)
        words = [w for t in part for w in t.lower().split()]
        own = [mix(mix(np.array([ord(c) | i << 32 for i, c in enumerate(w)], np.uint64)).sum(keepdims=True))[0] for w in words]
        assert hashes.tolist() == [int(x) for x in own]
        assert sizes.tolist() == [len(t.split()) for t in part]


def test_sieve_parts_rows_without_losing_any(spark):
    from sievewright.llm.common import sieve, sieved

    rows = spark.range(2_000).selectExpr("id as doc", "id * 2 as x").union(spark.sql("select cast(null as long), 1L"))
    wanted = spark.range(0, 2_000, 10).selectExpr("id as k").union(spark.sql("select cast(null as long)"))
    for bits in (1 << 27, 1 << 12):
        marked, clear = sieved(rows, "doc", sieve(wanted, bits), bits)
        a, b = [r.doc for r in marked.collect()], [r.doc for r in clear.collect()]
        assert marked.columns == clear.columns == ["doc", "x"] and None in b
        assert set(range(0, 2_000, 10)) <= set(a) and sorted(a + [x for x in b if x is not None]) == list(range(2_000))
        assert bits < 1 << 20 or len(a) == 200
    none, every = sieved(rows, "doc", sieve(wanted.where("false")))
    assert none.count() == 0 and every.count() == 2_001


def test_texts_without_passages_are_not_shuffled(spark):
    from sievewright.llm import passages

    shared = " ".join(f"w{i}" for i in range(80))
    other = lambda n: " ".join(f"x{n}y{i}" for i in range(60))
    rows = [(1, f"{other(1)} {shared}"), (2, f"{shared} {other(2)}"), (3, other(3)), (None, shared), (4, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    left = passages.without_passages(docs, passages.repeated(docs))
    assert "Union" in left._jdf.queryExecution().optimizedPlan().toString()
    got = {r.doc_id: r.text for r in left.collect()}
    assert got.pop(2).split() == other(2).split() and got == {k: t for k, t in rows if k != 2}
