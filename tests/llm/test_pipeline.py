import random

import pyarrow as pa
import pytest

import corpus_pipeline as cp
from tallyfold.llm import language_id as lid, line_quality as lq, pfair_mix as pm, piece_stream as ps, queries
from tests.llm.test_language_id import text as words
from tests.llm.test_ngram_join import brute


def rows():
    pick = random.Random(2)
    out = []
    for k in range(160):
        lang = pick.choice(["aa", "bb", "cc"])
        lines = words(lang, pick.choice([20, 70, 90, 150]), k).split()
        text = "\n".join(" ".join(lines[j : j + 12]) + "." for j in range(0, len(lines), 12))
        if k % 9 == 0:
            text += "\nHome | Shop | Cart | Help"
        if k % 17 == 0:
            text = "\n".join(f"Home | Shop{j} | Cart | Help" for j in range(40))
        out.append((k, text, lang, f"src{pick.choice([0, 0, 0, 1, 2, 9])}", len(text)))
        if k % 7 == 0:
            out.append((1000 + k, text + " tail.", None, "src1", len(text) + 6))
        if k % 11 == 0:
            out.append((2000 + k, text, lang, None, len(text)))
    out += [(5000, None, None, None, None), (5001, "", "aa", "src0", 0), (5002, "漢字 " * 80, None, "src0", 240), (None, words("aa", 100, 999) + ".", "aa", "src0", 1)]
    return out


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("sf")
    spark.createDataFrame(rows(), "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(f"{path}/documents.parquet")
    return str(path)


def test_stages_equal_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = docs.columns
    model = queries.language_model(docs)
    now = [tuple(r) for r in docs.collect()]
    accepted = model.judge([r[1] for r in now])
    now = [(a, b, c or p, d, e) for (a, b, c, d, e), p, ok in zip(now, accepted[0], accepted[3]) if ok]
    judged = [lq.judge(r[1]) for r in now]
    want = [now]
    now = [(a, j[-1], c, d, len(j[-1])) for (a, b, c, d, e), j in zip(now, judged) if j[-2]]
    want.append(now)
    classes = {k: c for k, c, *_ in brute([(r[0], r[1]) for r in now])}
    now = [r for r in now if classes[r[0]] == r[0]]
    want += [now, now]
    for (name, stage), expected in zip(cp.STAGES[:-1], want):
        found = stage(spark, docs, sf_dir)
        assert found.columns == columns, name
        found.write.parquet(f"{sf_dir}/{name}")
        docs = spark.read.parquet(f"{sf_dir}/{name}")
        assert sorted(map(tuple, docs.collect()), key=str) == sorted(expected, key=str), name
    mixed = pm.mix(docs, queries.TARGET_WEIGHTS, default_weight=2)
    order = [r.doc_id for r in sorted(mixed.collect(), key=lambda r: r.position)]
    assert [r.doc_id for r in cp.mixing(spark, docs, sf_dir).collect()] == order
    pieces = ps.PieceModel(cp.public_tokenizers.path("piece_bpe_32k.model"))
    by_id = {r[0]: r for r in now}
    last = cp.STAGES[-1][1](spark, docs, sf_dir).collect()
    assert len(last) == len(now) > 60
    assert all(r.ids == pieces.encode(pa.array([by_id[r.doc_id][1]]))[0].tolist() and r.n_ids == len(r.ids) for r in last)
    assert sorted((r.doc_id, r.n_ids) for r in cp.run(spark, sf_dir).collect() if r.doc_id is not None) == sorted((r.doc_id, r.n_ids) for r in last if r.doc_id is not None)


def test_an_empty_table_passes_all_stages(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    assert cp.run(spark, str(tmp_path)).collect() == []
