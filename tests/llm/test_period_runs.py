import hashlib
import random
import time
import zlib

import pytest

from tallyfold.llm import period_runs as pr


def brute(words, shortest=6, repeats=4):
    """All runs, by the definition: for each period the longest stretches that have it, without those of a smaller one."""
    n, out = len(words), []
    for q in range(1, n // repeats + 1):
        k = 0
        while k + q < n:
            if words[k] != words[k + q]:
                k += 1
                continue
            end = k
            while end + q < n and words[end] == words[end + q]:
                end += 1
            length = end - k + q
            part = words[k : k + length]
            smallest = next(p for p in range(1, length + 1) if all(part[j] == part[j + p] for j in range(length - p)))
            if smallest == q and length >= max(shortest, repeats * q):
                out.append((k, length, q))
            k = end + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def digests(doc_id, text, plant):
    words, now = [], ""
    for c in (text or "") + " ":
        if c in "\x20\x09\x0a\x0b\x0c\x0d":
            words += [now] if now else []
            now = ""
        else:
            now += c
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    if plant and doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[a + (i - a) % p] if i >= a else w for i, w in enumerate(words)]
    runs = brute(words)
    best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=None)
    dropped = {i for s, n_, q in runs for i in range(s + q, s + n_)}
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    top = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc_id, len(runs), *top, sha("".join(f"{s},{n_},{q}\n" for s, n_, q in runs)), sha(" ".join(w for i, w in enumerate(words) if i not in dropped)))


def sequences(seed, count):
    pick = random.Random(seed)
    for k in range(count):
        letters = pick.choice(["a", "ab", "ab", "abc", "abcdefgh"])
        out = []
        while len(out) < pick.choice([0, 3, 8, 30, 120]):
            part = [pick.choice(letters) for _ in range(pick.randrange(1, 7))]
            out += part * pick.choice([1, 1, 2, 4, 5, 9])
        yield [c.encode() for c in out[: pick.choice([len(out), len(out), 40])]]


@pytest.mark.parametrize("seed", range(4))
def test_equals_the_definition(seed):
    texts = list(sequences(seed, 150))
    texts += [[], [b"a"], [b"a"] * 5, [b"a"] * 6, [b"a"] * 200, [b"a", b"b"] * 4, [b"a", b"b"] * 4 + [b"a"], [b"x"] + [b"a", b"b", b"c"] * 40 + [b"y"]]
    assert [list(map(tuple, r.tolist())) for r in pr.runs_of(texts)] == [brute(t) for t in texts]
    for t in texts[:40]:  # alone as together
        assert list(map(tuple, pr.runs_of([t])[0].tolist())) == brute(t)
    assert [list(map(tuple, r.tolist())) for r in pr.runs_of(texts[:60], 2, 2)] == [brute(t, 2, 2) for t in texts[:60]]


def test_periods_within_periods():
    inner = [b"a"] * 7 + [b"b"]
    t = inner * 5 + [b"c"]
    for words in (t * 6, (t * 4 + [b"d"]) * 4, [b"q"] * 3 + t * 4):
        assert list(map(tuple, pr.runs_of([words])[0].tolist())) == brute(words)


def test_long_texts_in_time():
    pick = random.Random(5)
    began = time.time()
    period = [str(pick.randrange(300)).encode() for _ in range(30_000)]
    found = pr.runs_of([period * 5, [b"a"] * 300_000, [b"a", b"b", b"a"] * 60_000, [b"%d" % (k * k % 1009) for k in range(200_000)]])
    assert (0, 150_000, 30_000) in set(map(tuple, found[0].tolist()))
    assert found[1].tolist() == [[0, 300_000, 1]] and found[2].tolist() == [[0, 180_000, 3]] and [0, 200_000, 1009] in found[3].tolist()
    assert time.time() - began < 120


def test_documents(spark):
    pick = random.Random(8)
    rows = [(k, " ".join(w.decode() for w in s)) for k, s in enumerate(sequences(11, 120))]
    rows += [(500 + k, "\n".join(f"wé{pick.randrange(40)}" for _ in range(pick.choice([1, 20, 90])))) for k in range(120)]
    rows += [(900, None), (901, ""), (902, " \t\n"), (None, "a b " * 9), (903, "x\x0by\x0c" * 6), (904, "A a " * 4), (904, "A a " * 4), (905, "ß " * 30)]
    docs = spark.createDataFrame([(a, b, 0, "z") for a, b in rows], "doc_id long, text string, runs int, collapsed string").repartition(3)
    for plant in (False, True):
        got = pr.run_digests(pr.period_runs(docs, plant=plant))
        assert sorted(map(tuple, got.collect()), key=str) == sorted((digests(k, t, plant) for k, t in rows), key=str)
    assert [t for _, t in got.dtypes] == ["bigint"] * 6 + ["string"] * 2
    assert pr.period_runs(docs.limit(0)).collect() == []
