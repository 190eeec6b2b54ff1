import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tallyfold.llm import simhash as sh


def plain(text):
    """The fingerprint as the contract words it."""
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words, now = [], ""
    for c in lower + " ":
        if c in "\x20\x09\x0a\x0b\x0c\x0d":
            words += [now] if now else []
            now = ""
        else:
            now += c
    if not words:
        return 0
    grams = [" ".join(words[k : k + 3]) for k in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(rows):
    """(doc_id, fingerprint, component) of the rows, from all pairs."""
    prints = [plain(t) for _, t in rows]
    distinct = sorted(set(prints))
    label = {p: p for p in distinct}
    near = [(a, b) for k, a in enumerate(distinct) for b in distinct[:k] if (a ^ b).bit_count() <= 2]
    changed = True
    while changed:
        changed = False
        for a, b in near:
            least = min(label[a], label[b])
            changed |= label[a] != least or label[b] != least
            label[a] = label[b] = least
    first = {}
    for (k, _), p in zip(rows, prints):
        if k is not None:
            first[label[p]] = min(first.get(label[p], k), k)
    return sorted(((k, f"{p:016x}", first.get(label[p])) for (k, _), p in zip(rows, prints)), key=str)


def corpus(seed):
    pick = random.Random(seed)
    rows = []
    for _ in range(40):
        base = [f"W{pick.randrange(900)}é" for _ in range(pick.choice([3, 40, 400]))]
        rows.append("  ".join(base))
        for _ in range(pick.choice([0, 0, 2, 9])):
            edited = base[:]
            edited[pick.randrange(len(edited))] = f"e{pick.randrange(10**6)}"
            rows.append("\n".join(edited).upper() if pick.random() < 0.3 else " ".join(edited))
    rows += [None, "", " \t\r\n\x0b\x0c", "one", "one two", "one two", "no break here now", "w " * 70000, rows[0]]
    return [*enumerate(rows), (None, rows[1]), (None, "only here, and nowhere else"), (3, rows[5])]


def test_equals_all_pairs(spark):
    rows = corpus(1)
    docs = spark.createDataFrame([(a, b, 7, 1) for a, b in rows], "doc_id long, text string, fp int, cell int").repartition(3)
    got = sh.near_duplicates(docs)
    assert got.columns == ["doc_id", "fingerprint", "component_id"]
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows)
    assert sh.near_duplicates(docs.limit(0)).collect() == []


def test_the_built_in_hash_is_the_same(spark):
    text = "a b c"
    one = spark.range(1).select(F.xxhash64(F.lit(text))).first()[0]
    assert sh.fingerprint(text) == one % 2**64


@pytest.mark.parametrize("cell", [1, 2, 8, 1024])
def test_links_of_crowded_cells(spark, cell):
    """Fingerprints of all distances, crowded around few values, whatever cells are cut further."""
    pick = random.Random(cell)
    prints = set()
    for centre in (0, 2**64 - 1, pick.getrandbits(64), pick.getrandbits(64)):
        for _ in range(60):
            x = centre
            for _ in range(pick.randrange(5)):
                x ^= 1 << pick.choice([0, 1, 7, 8, 15, 16, 31, 32, 33, 63, pick.randrange(64)])
            prints.add(x)
    prints |= {pick.getrandbits(64) for _ in range(40)}
    signed = {int(np.uint64(p).view(np.int64)): p for p in prints}
    df = spark.createDataFrame([(s,) for s in signed], "fp long")
    links = [(signed[a], signed[b]) for a, b in sh.VariantIndex(cell).links(df).collect()]

    def parts(pairs):
        label = {p: p for p in prints}
        for _ in prints:
            moved = False
            for a, b in pairs:
                least = min(label[a], label[b])
                moved |= label[a] != label[b]
                label[a] = label[b] = least
            if not moved:
                return label

    every = sorted(prints)
    assert parts(links) == parts([(a, b) for k, a in enumerate(every) for b in every[:k] if (a ^ b).bit_count() <= 2])


@pytest.mark.parametrize("bits", [1, 2, 3])
def test_every_pair_in_reach_shares_a_variant(spark, bits):
    pick = random.Random(bits)
    pairs = []
    for _ in range(150):
        a = pick.getrandbits(64)
        b = a
        for p in pick.sample(range(64), bits):
            b ^= 1 << p
        pairs.append((a, b))
    signed = lambda x: int(np.uint64(x).view(np.int64))
    df = spark.createDataFrame([(signed(x),) for p in pairs for x in p], "fp long")
    got = {frozenset(p) for p in map(tuple, sh.VariantIndex(max_bits=bits).links(df).collect())}
    assert {frozenset(map(signed, p)) for p in pairs} == got
