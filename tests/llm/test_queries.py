"""The registered queries over the smallest test tables: contracts, SQL, and plain recomputation."""

import os
import zlib

import numpy as np
import public_tokenizers
import pytest

from tallyfold.llm import queries
from tests.llm.test_line_quality import plain
from tests.llm.test_ngram_join import brute
from tests.llm.test_period_runs import digests
from tests.llm.test_simhash import brute as simhash_brute
from tests.llm.test_token_files import whole
from tests.llm.test_whitening import brute as whitened_brute
from tests.test_registry import rows

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def docs(spark):
    return {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_its_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.execute(f"create view {f.split('.')[0]} as select * from '{SF}/{f}'")
    assert rows(queries.QUERIES[name](spark, SF).toArrow()) == rows(con.sql(queries.ORACLES[name]).to_arrow_table())


def test_op2(spark):
    table = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    v = {r.vec_id: np.array(r.embedding, np.float64) for r in table}
    got = queries.op2_multiprobe(spark, SF)
    assert got.dtypes[:4] == [("query_id", "bigint"), ("rank", "int"), ("vec_id", "bigint"), ("score", "double")]
    want = {q: sorted((-float(v[q] @ v[i]), i) for i in v if i != q)[:20] for q in v if q % 20 == 0}
    found = {}
    for r in sorted(got.collect(), key=lambda r: (r.query_id, r.rank)):
        found.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert found.keys() == want.keys() and all(len(found[q]) == len(want[q]) for q in want)
    assert np.mean([len({i for i, _ in found[q]} & {i for _, i in want[q]}) / len(want[q]) for q in want]) >= 0.9
    for q, hits in found.items():
        assert hits == sorted(hits, key=lambda h: (-h[1], h[0])) and all(s == pytest.approx(float(v[q] @ v[i]), rel=1e-12) for i, s in hits)


def test_op2_hashes_the_larger_table(spark):
    from tallyfold.llm import multiprobe

    table = spark.read.parquet(f"{SF[:-5]}0.1/embeddings.parquet")
    v = {r.vec_id: np.array(r.embedding, np.float64) for r in table.collect()}
    search = multiprobe.NeighbourSearch(table)
    assert search.hashing.m > 0 and search.hashing.tables > 1
    found = {}
    for r in search.neighbours(table.where("vec_id % 20 = 0")).collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    names, every = list(v), np.array(list(v.values()))
    shares = []
    for q in found:
        near = sorted((-s, i) for s, i in zip((every @ v[q]).tolist(), names) if i != q)[:20]
        shares.append(len(found[q] & {i for _, i in near}) / 20)
    assert len(found) == sum(i % 20 == 0 for i in v) and np.mean(shares) >= 0.9


def test_op4(spark, docs):
    got = queries.op4_line_quality(spark, SF).collect()
    assert len(got) == len(docs)
    for r in got:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == plain(docs[r.doc_id].text)
        assert not (r.base_failed and r.kept)


def test_op6(spark, docs):
    got = queries.op6_language_id(spark, SF).collect()
    assert len(got) == len(docs)
    fold = {d: zlib.crc32(str(d).encode()) % 4 == 2 for d in docs}
    assert all(r.held_out == fold[r.doc_id] and 0 <= r.score <= 1 for r in got)
    new = [r for r in got if r.held_out]
    assert np.mean([r.lang_pred == docs[r.doc_id].lang for r in new]) > 0.97


def test_op8(spark, docs):
    got = {(r.doc_id, r.class_id, r.n_links, r.n_linked_texts) for r in queries.op8_ngram_join(spark, SF).collect()}
    assert got == brute([(d, r.text) for d, r in docs.items()])


def test_op9(spark, docs):
    got = queries.op9_pfair_mix(spark, SF).collect()
    assert sorted(r.doc_id for r in got) == sorted(docs) and sorted(r.position for r in got) == list(range(len(docs)))
    assert all(r.release <= r.slot < r.deadline for r in got)


def test_op10(spark, docs):
    start = 0
    got = {r.doc_id: r for r in queries.op10_token_files(spark, SF).collect()}
    order = sorted(docs)
    for d, ids in zip(order, whole([docs[d].text for d in order], public_tokenizers.path("word_bpe_49k.json"))):
        r = got[d]
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


def test_op5(spark, docs):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    got = queries.op5_piece_stream(spark, SF).collect()
    assert len(got) == len(docs) and all(r.round_trip for r in got)
    for r in got:
        want = library.encode(docs[r.doc_id].text or "")
        assert (r.n_ids, r.ids_crc32) == (len(want), zlib.crc32(np.array(want, "<u4").tobytes()))


def test_op11(spark, docs):
    got = queries.op11_simhash(spark, SF)
    assert got.dtypes == [("doc_id", "bigint"), ("fingerprint", "string"), ("component_id", "bigint")]
    assert sorted(map(tuple, got.collect()), key=str) == simhash_brute([(d, r.text) for d, r in docs.items()])


def test_op12(spark, docs):
    got = sorted(map(tuple, queries.op12_period_runs(spark, SF).collect()))
    assert got == sorted(digests(d, r.text, True) for d, r in docs.items())


def test_op13(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    n, want, explained = whitened_brute(rows)
    got = queries.op13_whitening(spark, SF).collect()
    assert len(got) == 4 * len(want) and {r.n for r in got} == {n} and all(r.deviation == want[r.vec_id][0] for r in got)
    for c in range(1, 5):
        pairs = np.array([(r.whitened, want[r.vec_id][1][c - 1]) for r in got if r.component == c])
        assert min(np.abs(pairs[:, 0] - pairs[:, 1]).max(), np.abs(pairs[:, 0] + pairs[:, 1]).max()) < 1e-6
    assert all(r.explained == pytest.approx(explained[r.component - 1], rel=1e-9) and r.identity_error < 1e-8 for r in got)


def test_op1_blocks_every_listed_family(spark):
    """Bad hosts that no path rule decides, at any depth, and their neighbours in name."""
    from tallyfold.llm import url_filter

    hosts = {f"http://{sub}{f}.example.{top}/x": True for sub in ("", "www.", "m.blog.") for f in queries.BLOCKED_FAMILIES for top in ("org", "net")}
    hosts |= {f"http://{h}/x": False for h in ("not-adult-x.example.net", "adult-x.example.org.evil.net", "example.org", "casino-wins.example.org", "win.example.net")}
    pages = spark.createDataFrame(list(enumerate(hosts)), "page_id long, url string")
    listed = spark.createDataFrame([(d,) for d in queries.BLOCKED_DOMAINS], "key string")
    got = {r.url: r.verdict for r in url_filter.judge_urls(pages, queries.URL_RULES, listed).collect()}
    assert got == {u: "block" if bad else "allow" for u, bad in hosts.items()}
    found = {f"{r.host}": r.verdict for r in queries.op1_url_filter(spark, SF).collect()}
    assert any(h.split(".")[-3] in queries.BLOCKED_FAMILIES and v == "block" for h, v in found.items() if h.count(".") >= 2)
