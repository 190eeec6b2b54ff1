import itertools
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st

from tallyfold.llm import token_files as tf

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
TEXTS = [
    None, "", " ", "\n", "One two. THREE, four's  it's!\tx", "a\x1cb\x85c d é Éİ ΣΣ", "<|endoftext|> <|ENDOFTEXT|> a<|startoftext|>b",
    "123 4,5. ,. .", "mot Élève.", "word " * 3000, "\U00012000 漢字 ...", "foo.bar, foo., foo", "İ. क़. क़, ǰ. ŉ. ß, x\u0301. a1. 1.",
]


def whole(texts, path=TOKENIZER):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    return [[*t.encode(x or "", add_special_tokens=False).ids, 1] for x in texts]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_ids_equal_those_of_whole_texts(name):
    encoder = tf.WordEncoder(public_tokenizers.path(name), 1, max_words=8)
    assert encoder.by_word == (name == "word_bpe_49k.json")
    for texts in (TEXTS, TEXTS[::-1], [None]):
        ids, n = encoder.encode(pa.array(texts, pa.string()))
        assert [x.tolist() for x in np.split(ids, np.cumsum(n)[:-1])] == whole(texts, public_tokenizers.path(name))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1) | st.integers(0, 500), max_size=1500), st.integers(0, 100))
def test_blocks_round_trip(values, percentile):
    ids = np.array(values, np.uint32)
    raw, offsets = tf.pack(ids, percentile)
    assert np.array_equal(tf.unpack(raw, offsets, len(ids)), ids)


def test_files_hold_all_documents_in_order(spark):
    rows = [(k, t) for k, t in enumerate(TEXTS)] * 2 + [(None, "no id"), (-4, "below")]
    docs = spark.createDataFrame([(a, b, "x", 1) for a, b in rows], "doc_id long, text string, ids string, part int").repartition(3)
    got = [tuple(r) for r in tf.token_files(docs, TOKENIZER, chars_per_file=2000).collect()]
    ids = dict(zip([t for _, t in rows], whole([t for _, t in rows])))
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, str(ids[r[1]])))
    starts = [0, *itertools.accumulate(len(ids[t]) for _, t in ordered)]
    want = [(k, s, len(ids[t]), zlib.crc32(np.array(ids[t], "<u4").tobytes())) for (k, t), s in zip(ordered, starts)]
    assert sorted(got, key=lambda r: r[1]) == want


def test_frequent_and_missing_ids_fill_several_files(spark, tmp_path):
    """A third of the rows has no id, a third one id (most of them the same text), and one text is very long."""
    words = "one two three four five six seven eight nine ten".split()
    rows = [(None, f"{words[k % 10]} {k}") for k in range(300)] + [(50, "the same text again" if k % 4 else f"text {k}") for k in range(300)]
    rows += [(k, " ".join(words)) for k in range(300)] + [(200, "long " * 2000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    manifest = tf.write_token_files(docs, TOKENIZER, 1, f"file://{tmp_path}/t", chars_per_file=800)
    sizes = [r.n_docs for r in manifest.collect()]
    assert sum(sizes) == len(rows) and len(sizes) > 15 and max(sizes) < 150
    got = sorted(map(tuple, tf.read_token_files(manifest).collect()), key=lambda r: r[1])
    ids = [np.array(x, "<u4") for x in whole([t for _, t in rows])]
    assert sorted(((n, k, c) for n, _, k, c in got), key=str) == sorted(((n, len(x), zlib.crc32(x.tobytes())) for (n, _), x in zip(rows, ids)), key=str)
    assert [r[1] for r in got] == [0, *itertools.accumulate(r[2] for r in got)][:-1]
    names = [r[0] for r in got]
    assert names[:300] == [None] * 300 and names[300:] == sorted(names[300:])


def test_empty_table(spark):
    assert tf.token_files(spark.createDataFrame([], "doc_id long, text string"), TOKENIZER).collect() == []


def test_long_file_reads_in_steps(tmp_path):
    parts = [np.arange(n, dtype=np.uint32) % 70_000 for n in (1, 3 * tf.STEP + 7, 2, 0, tf.STEP, 5)]
    tf.write_file(f"file://{tmp_path}/a/x.tok", [1, 2, None, 4, 5, 6], parts)
    got = list(tf.read_file(f"file://{tmp_path}/a/x.tok"))
    assert [g[0] for g in got] == [1, 2, None, 4, 5, 6]
    assert all(np.array_equal(g[2], p) for g, p in zip(got, parts))
