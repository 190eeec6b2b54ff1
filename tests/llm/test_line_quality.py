import random
import re
from collections import Counter

from tallyfold.llm import line_quality as lq

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    """The contract's base figures, straight from their definitions."""
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = {j for k in range(len(words) - 2) if windows[tuple(words[k : k + 3])] > 1 for j in (k, k + 1, k + 2)}
    lines = text.split("\n")
    dup = sum(1 for k, line in enumerate(lines) if WORD.search(line) and line in lines[:k])
    n = len(words)
    return n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered), n < 50 or 100 * len(covered) > 50 * n


def samples():
    pick = random.Random(5)
    yield from [None, "", "\n\n", "a", "a b c a b c", "x\x1cy z w", "\t\x0b\x0c", "é é é é", "\U00012000 a\r\nb"]
    for n in (3, 49, 50, 51, 400, 3000):
        for v in (2, 5, 60, 5000):
            yield "".join(f"w{pick.randrange(v)}" + pick.choice([" ", " ", "  ", "\n", ". ", "\n# ", "\x85"]) for _ in range(n))


def test_base_figures_equal_their_definitions():
    for text in samples():
        assert lq.judge(text)[:6] == plain(text)


def test_lines():
    prose = "This is a line of prose that goes on for a while and ends well."
    assert lq.failed_rule(prose) is None
    assert lq.failed_rule("prose that has no closing mark but many words in it") is None
    assert lq.failed_rule("Home | About | Contact | News") == "navigation"
    assert lq.failed_rule("word### other$$$ third%%% fourth&&&") == "punctuation"
    assert lq.failed_rule("BUY!! NOW!! CHEAP!!") == "punctuation"
    assert lq.failed_rule("All rights reserved.") == "boilerplate"
    assert lq.failed_rule("Next page") == "punctuation"
    assert lq.failed_rule("The bill of $5 & the 3% tax are 100% due.") is None


def test_documents_are_cleaned_and_judged(spark):
    good = "\n".join(" ".join(f"w{k}{c}" for c in "abcdefgh") + "." for k in range(8))
    menu = "Home | About | Contact | News"
    rows = [(1, good), (2, good + "\n" + menu), (3, "\n".join([menu + str(k) for k in range(30)]) + "\n" + good), (4, None), (5, "word " * 400), (2, good + "\n" + menu)]
    docs = spark.createDataFrame([(a, b, "x") for a, b in rows], "doc_id long, text string, kept string").repartition(2)
    got = {(r.doc_id, r.kept, r.cleaned) for r in lq.judge_documents(docs, cleaned=True).collect()}
    assert got == {(1, True, good), (2, True, good), (3, False, good), (4, False, ""), (5, False, "word " * 400)}
    assert lq.judge_documents(docs.limit(0)).collect() == []
    assert lq.judge_documents(docs).count() == len(rows)


def test_menus_of_three_entries():
    menus = ["Home | About | Contact", "Docs > API > Index", "Home » All our products » Shoes", "News · Sport · Weather", "Main page • Help • About us"]
    for line in menus:
        assert lq.failed_rule(line) == "navigation", line
    for line in ("We ask if a > b > c.", "> > They said so to me", "the first of them is long | and so is the second one | and the third", "either this | or that one there"):
        assert lq.failed_rule(line) is None, line
    text = "\n".join(f"Home {k} | About | Contact" for k in range(20))
    assert lq.judge(text)[7:10] == (20, 1.0, False)


def test_stock_phrases_have_to_make_up_half_of_a_line():
    from tallyfold.llm import line_quality as lq

    assert lq.failed_rule("Please sign up for class tomorrow at noon.") is None
    assert lq.failed_rule("SIGN UP now.") == lq.failed_rule("Click here to read more.") == lq.failed_rule("All rights reserved. 2020") == "boilerplate"
    assert lq.failed_rule("one\xa0two\x1cthree four five.") is None and lq.failed_rule("one\xa0two\x1cthree") == "punctuation"
