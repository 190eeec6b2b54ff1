import math
import random
from collections import Counter

import numpy as np
import pytest

from tallyfold.llm import language_id as lid

STEMS = {"aa": "the and ing er th ou", "bb": "der die ung ß ö sch", "cc": "que la ción ñ ado el"}


def text(lang, n, seed):
    pick = random.Random(f"{lang}{seed}")
    return " ".join("".join(pick.choices(STEMS[lang].split(), k=pick.randint(1, 3))) for _ in range(n))


def grams(texts):
    out = Counter()
    for t in texts:
        p = chr(1) * 3 + "".join(map(chr, lid.characters(t)))
        out.update(p[k : k + 4] for k in range(len(p) - 3))
    return out


def direct(own, alphabet, discount):
    """p(last character | context) by the recursive formula, for one language."""
    levels = {4: own}
    for o in (3, 2, 1):
        levels[o] = Counter(g[1:] for g in levels[o + 1])

    def p(g):
        o = len(g)
        if not o:
            return 1 / (len(alphabet) + 1)
        same = {h: n for h, n in levels[o].items() if h[:-1] == g[:-1]}
        if not same:
            return p(g[1:])
        total, d = sum(same.values()), discount[o]
        return max(levels[o].get(g, 0) - d, 0) / total + d * len(same) / total * p(g[1:])

    return p, {o: lid._discounts(c) for o, c in levels.items()}


def test_probabilities_equal_the_recursive_formula():
    by_language = {k: grams([text(k, 30, s) for s in range(2)]) for k in STEMS}
    model = lid.estimate(by_language)
    alphabet = {g[-1] for own in by_language.values() for g in own}
    probe = chr(1) * 3 + "".join(map(chr, lid.characters("the und ción xylöqua la 漢 er")))
    got = model.losses(np.array([ord(c) for c in probe], np.uint32))
    for k, lang in enumerate(model.languages):
        own = by_language[lang]
        levels = {4: own}
        for o in (3, 2, 1):
            levels[o] = Counter(g[1:] for g in levels[o + 1])
        p, _ = direct(own, alphabet, {o: lid._discounts(c) for o, c in levels.items()})
        want = [-math.log(p(probe[j : j + 4])) for j in range(len(probe) - 3)]
        assert np.allclose(got[:, k], want, atol=1e-4)


@pytest.fixture(scope="module")
def model(spark):
    rows = [(1000 * j + s, text(k, 5 + s % 60, s), k) for j, k in enumerate(STEMS) for s in range(120)] + [(None, None, "aa"), (7, "12", "bb"), (8, "x", None)]
    return lid.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))


def test_new_texts_are_recognised_and_cases_defined(spark, model):
    rows = [(lang, text(lang, 25, s)) for lang in STEMS for s in range(900, 940)]
    rows += [(None, None), (None, ""), (None, "12 !?"), ("aa", text("aa", 30000, 1)), ("aa", text("aa", 30, 1))]
    docs = spark.createDataFrame([(a, b, 1.5, False) for a, b in rows], "want string, text string, score double, kept boolean").repartition(3)
    got = lid.identify(docs, model).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.lang_pred == (r.want or "und")
        assert 0 <= r.score <= 1 and r.accepted == (r.want is not None) and r.kept is False
    gibberish = model.judge(["zqxj kwvz pfgh " * 20, text("aa", 40, 5).upper()])
    assert not gibberish[3][0]
    assert gibberish[3][1]


def test_pieces_add_up_to_the_whole_text(model):
    texts = [text("aa", 500, 1), None, text("cc", 700, 2), "é"]
    assert all(np.allclose(a, b) if k in (1, 2) else list(a) == list(b) for k, (a, b) in enumerate(zip(model.judge(texts), model.judge(texts, piece=64))))


def test_sample_is_bounded(spark):
    rows = [(s, text("aa", 40, s), "aa") for s in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    small = lid.train(docs, max_chars=3000)
    assert len(small.grams[4][0]) < len(lid.train(docs).grams[4][0])


def test_no_labelled_text(spark):
    docs = spark.createDataFrame([(1, "some words", None), (2, None, None)], "doc_id long, text string, lang string")
    for table in (docs, docs.limit(0), docs.selectExpr("doc_id", "'12' AS text", "'aa' AS lang")):
        model = lid.train(table)
        assert model.languages == []
        got = lid.identify(docs, model).collect()
        assert [(r.lang_pred, r.score, r.accepted) for r in got] == [("und", 0.0, False)] * 2
        assert lid.identify(docs.limit(0), model).collect() == []


def test_short_foreign_texts_are_rejected(spark):
    english = "the quick brown fox jumps over the lazy dog and the sun shines on a warm day while birds sing in the old trees near our house by the river".split()
    german = "der schnelle braune fuchs springt über den faulen hund und die sonne scheint an einem warmen tag während vögel in den alten bäumen singen".split()
    pick = random.Random(4)
    rows = [(1000 * j + k, " ".join(pick.choices(w, k=30 + k % 40)), name) for j, (name, w) in enumerate([("en", english), ("de", german)]) for k in range(400)]
    model = lid.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    foreign = ["wszystkie dzieci śpią", "żółta łódź płynie", "минулого року ми жили", "これは日本語の文章です", "zqxj kwvz pfgh wrtz"]
    assert not model.judge(foreign)[3].any()
    own = [" ".join(pick.choices(w, k=n)) for w in (english, german) for n in (3, 5, 8) for _ in range(100)]
    assert model.judge(own)[3].mean() > 0.98


def test_every_labelled_language_is_learned(spark):
    one, other = "the quick brown fox jumps over the lazy dog ", "der schnelle braune fuchs springt ueber den hund "
    bounds_only = spark.range(500).selectExpr("id", f"pmod(xxhash64(id, '{one}'), 1073741824L) / 1073741824 AS u").where("u >= 0.9").first().id
    rows = [(bounds_only, one, "aa"), *((1000 + k, other, "bb") for k in range(20))]
    model = lid.train(spark.createDataFrame(rows, "doc_id long, text string, lang string").coalesce(1))
    assert list(model.languages) == ["aa", "bb"]


def test_long_texts_are_drawn_in_pieces(spark, monkeypatch):
    sizes = []
    counts = lid._counts
    monkeypatch.setattr(lid, "_counts", lambda rows: (sizes.append(rows.selectExpr("sum(length(text))").first()[0]), counts(rows))[1])
    rows = [(1, "the quick brown fox jumps over the lazy dog " * 50_000, "aa"), (2, "der schnelle braune fuchs springt " * 50, "bb")]
    model = lid.train(spark.createDataFrame(rows, "doc_id long, text string, lang string").coalesce(1), max_chars=400_000)
    assert list(model.languages) == ["aa", "bb"]
    assert 100_000 < sum(s or 0 for s in sizes) < 800_000
