import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from tallyfold.llm import piece_stream as ps

PATH = public_tokenizers.path("piece_bpe_32k.model")
TEXTS = [
    None, "", " ", "   a  b ", "Hello  world\n\tfoo é 漢字\U00012000", "The quick brown fox, jumps!", "x" * 500, "abcab" * 400,
    "thnterononshth oning oferndenan Ungung Ciónóqueque éauxê", "word " * 300, "\x00\x01 ▁ mark", " " * 100 + "end", "$$$ 12%%% &&&",
]


def by_scores(path):
    """The same model as one that is searched by scores: the type (field 3 of field 2) set to 1."""
    raw = bytearray(open(PATH, "rb").read())
    at = next(k for k in range(len(raw) - 1) if raw[k] == 0x18 and raw[k + 1] == 2 and model_type_with(raw, k, path) == 1)
    raw[at + 1] = 1
    path.write_bytes(raw)
    return str(path)


def model_type_with(raw, at, path):
    trial = bytearray(raw)
    trial[at + 1] = 1
    path.write_bytes(trial)
    return ps.model_type(str(path))


@pytest.fixture(scope="module")
def model():
    return ps.PieceModel(PATH)


def ids(model, text):
    return model.encode(pa.array([text], pa.string()))[0].tolist()


def words(seed, n, longest, letters="etaoinshrdlué漢ßX,.$"):
    pick = random.Random(seed)
    return ["▁" * pick.randrange(0, 3) + "".join(pick.choices(letters, k=pick.randrange(1, longest))) for _ in range(n)]


def test_equals_the_models_own_encoder(model):
    assert model.merges
    pick = random.Random(3)
    long = ["".join(pick.choices("etaoinshr", k=n)) for n in (63, 64, 65, 129, 700, 3000)] + ["a" * 900, "the" * 300, "=" * 500]
    for text in [*[t for t in TEXTS if t], *words(3, 800, 14), " ".join(words(4, 50, 9)), *long]:
        assert ids(model, text) == model.processor.encode(text), text


def replayed(model, text):
    """Merges made one after the other over a whole normalised text, the lowest cost and then the leftmost first."""
    sp = model.processor
    known = {sp.id_to_piece(k): k for k in range(sp.vocab_size()) if not (sp.is_control(k) or sp.is_unknown(k) or sp.is_byte(k))}
    row = list(sp.normalize(text))
    while hits := [(-sp.get_score(known[a + b]), at) for at, (a, b) in enumerate(zip(row, row[1:])) if a + b in known]:
        at = min(hits)[1]
        row[at : at + 2] = [row[at] + row[at + 1]]
    return [k for part in row for k in ([known[part]] if part in known else [model.byte_ids[b] for b in part.encode()])]


def test_equals_merges_over_the_whole_text(model):
    for text in [*[t for t in TEXTS if t and len(t) < 300], " ".join(words(5, 12, 9)), "abcab" * 30]:
        assert ids(model, text) == replayed(model, text), text
        assert [k for run in model.stream(model.processor.normalize(text)) for k in run] == replayed(model, text)


def test_scores_decide_in_a_unigram_model(tmp_path):
    model = ps.PieceModel(by_scores(tmp_path / "unigram.model"))
    assert not model.merges

    def whole(text):
        best = [(0.0, [])] + [None] * len(text)
        for end in range(1, len(text) + 1):
            for start in range(max(0, end - model.longest), end):
                node = model.trie
                for c in text[start:end]:
                    node = node.get(c) if node is not None else None
                hit = node.get(ps._END) if node else None
                if hit is None and end - start == 1:
                    hit = model.unknown
                if hit and best[start] and (best[end] is None or best[start][0] + hit[0] > best[end][0]):
                    best[end] = best[start][0] + hit[0], [*best[start][1], (hit[1], text[start:end])]
        out = []
        for k, part in best[-1][1]:
            out += [model.byte_ids[b] for b in part.encode()] if k == model.unknown[1] else [k]
        return out

    for text in [*[t for t in TEXTS if t], *words(6, 300, 12), "".join(words(7, 1, 400))]:
        normal = model.processor.normalize(text)
        assert ids(model, text) == whole(normal)
        assert [k for run in model.stream(normal) for k in run] == whole(normal)
        score = lambda found: sum(model.unknown[0] / 9 if model.processor.is_byte(k) else model.processor.get_score(k) for k in found)
        if len(text) < 60:
            assert score(ids(model, text)) == pytest.approx(score(model.processor.nbest_encode(text, nbest_size=2)[0])), text


@pytest.mark.parametrize("few", [0, 400])
def test_words_searched_side_by_side_equal_streams(model, monkeypatch, few):
    monkeypatch.setattr(ps, "FEW", few)
    some = words(8, 700, 40) + ["▁", "▁▁", "e" * 64, "e" * 65, "thnterononshth" * 30, "é" * 200]
    for word, found in zip(some, model.search(some)):
        assert found.tolist() == [i for run in model.stream(word) for i in run]
    assert model.search([]) == []


def test_a_piece_with_a_letter_that_is_none_is_refused(model):
    with pytest.raises(ValueError):
        model._merge_tables({"ab": 300, "a": 301})


def test_ids_are_final_before_the_text_ends(model):
    text = "abcab" * 2000
    runs = list(model.stream(text))
    assert len(runs) > 100 and max(map(len, runs)) < 8 * model.longest
    assert sum(runs, []) == [k for run in model.stream(text) for k in run]


def test_documents_round_trip(spark, model):
    docs = spark.createDataFrame([(k, t, 7, "x") for k, t in enumerate(TEXTS)] * 2, "doc_id long, text string, n_ids int, extra string").repartition(3)
    rows = ps.piece_digests(docs, PATH).collect()
    assert len(rows) == 2 * len(TEXTS)
    for r in rows:
        own = np.array(ids(model, r.text), "<u4")
        assert (r.n_ids, r.ids_crc32) == (len(own), zlib.crc32(own.tobytes())) and r.extra == "x"
        assert r.round_trip == ("▁" not in (r.text or ""))
    both = ps.decode_documents(ps.encode_documents(docs, PATH), PATH).collect()
    assert all(r.decoded == (r.text or "").replace("▁", " ") for r in both)
    assert all(model.decode(np.array(r.ids, np.int32)) == model.processor.decode(r.ids) for r in both if r.ids)
    assert ps.piece_digests(docs.limit(0), PATH).collect() == []
