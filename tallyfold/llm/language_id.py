"""Language identification with interpolated Kneser-Ney character models.

One model of ``ORDER`` characters is trained per language. Probabilities of the
n-grams that any language has seen are kept in hash arrays, sorted by the
n-gram's 64-bit hash, with one column per language; backoff weights of their
contexts likewise. A text goes to the language with the lowest cross-entropy
per character, and is rejected if that is far above what the language's own
texts show (calibrated on texts set aside from the training sample).

Text is lower-cased and every run of characters that are no letters counts as
one space, so digits, marks and layout say nothing about the language.

The training sample is bounded: per language, pieces of up to ``PIECE``
characters of labelled texts are chosen by a hash of their text's id so that they
hold about ``max_chars`` characters (all of them, if they hold fewer). This bounds the n-grams that the driver turns into the
model, and so the model that is broadcast.

Defined cases: a text that is null or has no letter is ``und`` with score 0 and
not accepted; texts of any length are read whole, in pieces of bounded size;
ties go to the language first in sorted order; repeated rows are judged alike;
result columns replace input columns of the same name. Where no labelled text has
a letter (an empty table, say) no language is learned, and every text is ``und``
with score 0 and not accepted.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tallyfold.llm.common import release_memory, text_runs

ORDER = 4
UNKNOWN = "und"
MAX_CHARS = 4_000_000
#: Texts are drawn for training in pieces of up to so many characters.
PIECE = 20_000
#: Share of a language's own texts that may be rejected; texts of a language differ by this share of the mean at least.
REJECTED, LEAST_SPREAD = 0.001, 0.05
#: Besides whole, texts set aside are judged by their first so many characters.
SHORT = (10, 20, 40, 100)

_PRIME = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)
_EDGE = 1  # stands before a text's first character
_tables: dict[str, np.ndarray] = {}


def _letters() -> np.ndarray:
    """For every code point, its own number if it is a letter, else a space's."""
    if "letters" not in _tables:
        table = np.arange(0x110000, dtype=np.uint32)
        table[[k for k in range(0x110000) if not chr(k).isalpha()]] = 32
        _tables["letters"] = table
    return _tables["letters"]


def characters(text: str) -> np.ndarray:
    """The code points that count: letters, and single spaces between them."""
    raw = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    points = _letters()[raw]
    space = points == 32
    keep = ~space
    keep[1:] |= ~space[:-1]
    if len(keep):
        keep[0] = not space[0]
    return points[keep]


def _rolled(points: np.ndarray, order: int) -> np.ndarray:
    """Hash of the n-gram that ends at each place from the order-th on."""
    p = points.astype(np.uint64) + np.uint64(1)
    n = len(p) - order + 1
    h = np.full(n, order, np.uint64)
    for k in range(order):
        h = h * _PRIME + p[k : k + n]
    h ^= h >> np.uint64(29)
    h *= _MIX
    return h ^ (h >> np.uint64(32))


def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.searchsorted(keys, wanted)
    at[at == len(keys)] = 0
    return at, keys[at] == wanted


@dataclass
class Model:
    """Languages, and for each order the sorted hashes with a row of log values each."""

    languages: list[str]
    grams: dict[int, tuple[np.ndarray, np.ndarray]]
    backoff: dict[int, tuple[np.ndarray, np.ndarray]]  # by the length of the context
    floor: np.ndarray
    mean: np.ndarray
    within: np.ndarray
    between: np.ndarray
    most: np.ndarray  # deviations that are accepted

    def losses(self, points: np.ndarray) -> np.ndarray:
        """-log p of every character after the first ``ORDER - 1``, per language."""
        out = np.zeros((len(points) - ORDER + 1, len(self.languages)), np.float32)
        open_ = np.arange(len(out))
        for order in range(ORDER, 0, -1):
            tail = points[ORDER - order :]
            hashes = _rolled(tail, order)[open_] if order == ORDER else _hash_at(points, open_, order)
            at, hit = _find(self.grams[order][0], hashes)
            out[open_[hit]] -= self.grams[order][1][at[hit]]
            open_ = open_[~hit]
            if not len(open_):
                return out
            if order > 1:
                keys, values = self.backoff[order - 1]
                at, hit = _find(keys, _hash_at(points, open_ - 1, order - 1))
                out[open_[hit]] -= values[at[hit]]
        out[open_] -= self.floor
        return out

    def judge(self, texts: list[str | None], piece: int = 1 << 18):
        """(language, score, cross-entropy, accepted) of each text."""
        if not self.languages:  # nothing was learned
            return np.array([UNKNOWN] * len(texts), object), np.zeros(len(texts)), np.zeros(len(texts)), np.zeros(len(texts), bool)
        n, sums, squares, sizes = len(texts), np.zeros((len(texts), len(self.languages))), np.zeros(len(texts)), np.zeros(len(texts), np.int64)
        held: list[tuple[int, np.ndarray]] = []

        def flush() -> None:
            if held:
                edges = np.cumsum([0] + [len(p) for _, p in held])
                losses = self.losses(np.concatenate([p for _, p in held]))
                for (k, p), start in zip(held, edges):
                    sums[k] += losses[start : start + len(p) - ORDER + 1].sum(axis=0, dtype=np.float64)
                held.clear()

        edge = np.full(ORDER - 1, _EDGE, np.uint32)
        waiting = 0
        for k, text in enumerate(texts):
            points = characters(text) if text else np.zeros(0, np.uint32)
            if not (points != 32).any():
                continue
            sizes[k] = len(points)
            points = np.concatenate([edge, points])
            for start in range(0, len(points) - ORDER + 1, piece):
                part = points[start : start + piece + ORDER - 1]
                held.append((k, part))
                waiting += len(part)
                if waiting >= piece:
                    flush()
                    waiting = 0
        flush()
        known = sizes > 0
        entropy = sums / np.maximum(sizes, 1)[:, None]
        best = entropy.argmin(axis=1)
        least = entropy[np.arange(n), best]
        # the share of the best language if each were as likely as its cross-entropy says, over up to 20 characters
        scaled = np.exp(-(entropy - least[:, None]) * np.minimum(sizes, 20)[:, None])
        score = np.where(known, 1 / scaled.sum(axis=1), 0.0)
        bound = self.mean[best] + self.most[best] * (self.within[best] / np.sqrt(np.maximum(sizes, 1)) + self.between[best])
        names = [self.languages[b] if ok else UNKNOWN for b, ok in zip(best, known)]
        return np.array(names, object), score, np.where(known, least, 0.0), known & (least <= bound)


def _hash_at(points: np.ndarray, ends: np.ndarray, order: int) -> np.ndarray:
    """Hash of the n-grams of which ``ends`` are the last places, counted from ORDER - 1."""
    h = np.full(len(ends), order, np.uint64)
    for k in range(order):
        h = h * _PRIME + points[ends + (ORDER - order + k)].astype(np.uint64) + np.uint64(1)
    h ^= h >> np.uint64(29)
    h *= _MIX
    return h ^ (h >> np.uint64(32))


def _counts(labelled: DataFrame) -> dict[str, Counter]:
    """N-gram counts of each language: summed per task, then by Spark."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, Counter] = {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                points = characters(text)
                if (points != 32).any():
                    padded = chr(_EDGE) * (ORDER - 1) + points.tobytes().decode("utf-32-le", "surrogatepass")
                    own = found.setdefault(lang, Counter())
                    own.update(map("".join, zip(*(padded[k:] for k in range(ORDER)))))
        for lang, own in found.items():
            grams = [g.encode("utf-8", "surrogatepass") for g in own]
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(own), pa.string()), pa.array(grams, pa.binary()), pa.array(list(own.values()), pa.int64())], names=["lang", "gram", "n"])
        found.clear()
        release_memory()

    rows = labelled.mapInArrow(count, "lang string, gram binary, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")).toArrow()
    out: dict[str, Counter] = {}
    for lang, gram, n in zip(*(rows.column(k).to_pylist() for k in range(3))):
        out.setdefault(lang, Counter())[gram.decode("utf-8", "surrogatepass")] = n
    return out


def _discounts(counts: Counter) -> float:
    tally = Counter(counts.values())
    ones, twos = tally[1], tally[2]
    return min(max(ones / (ones + 2 * twos) if ones + twos else 0.5, 0.1), 0.95)


def estimate(by_language: dict[str, Counter]) -> Model:
    """The model of all languages from their highest-order counts."""
    if not by_language:
        nothing = np.zeros(0)
        return Model([], {}, {}, nothing, nothing, nothing, nothing, nothing)
    languages = sorted(by_language)
    alphabet = {g[-1] for own in by_language.values() for g in own}
    uniform = 1.0 / (len(alphabet) + 1)
    counts, totals, types, discount = [], [], [], []
    for lang in languages:
        own = {ORDER: by_language[lang]}
        for order in range(ORDER - 1, 0, -1):  # of lower orders, in how many contexts each occurs
            own[order] = Counter(g[1:] for g in own[order + 1])
        counts.append(own)
        totals.append({o: Counter() for o in own})
        types.append({o: Counter() for o in own})
        for o, c in own.items():
            for g, n in c.items():
                totals[-1][o][g[:-1]] += n
                types[-1][o][g[:-1]] += 1
        discount.append({o: _discounts(c) for o, c in own.items()})

    def weight(k: int, order: int, context: str) -> float:
        """What the shorter contexts share of a context's probability."""
        total = totals[k][order].get(context, 0)
        return discount[k][order] * types[k][order][context] / total if total else 1.0

    values: dict[int, dict[str, np.ndarray]] = {0: {"": np.full(len(languages), uniform)}}
    grams, backoff = {}, {}
    floor = np.log(np.array([weight(k, 1, "") * uniform for k in range(len(languages))]))
    for order in range(1, ORDER + 1):
        seen = {g for own in counts for g in own[order]}
        shares = {c: np.array([weight(k, order, c) for k in range(len(languages))]) for c in {g[:-1] for g in seen}}
        values[order] = {}
        for g in seen:
            c = g[:-1]
            direct = [max(own[order].get(g, 0) - discount[k][order], 0) / totals[k][order][c] if totals[k][order].get(c) else 0.0 for k, own in enumerate(counts)]
            values[order][g] = np.array(direct) + shares[c] * values[order - 1].get(g[1:] if order > 1 else "", np.exp(floor))
        grams[order] = _sorted_hashes({g: np.log(v) for g, v in values[order].items()}, order)
        if order > 1:
            backoff[order - 1] = _sorted_hashes({c: np.log(v) for c, v in shares.items()}, order - 1)
    zero = np.zeros(len(languages))
    return Model(languages, grams, backoff, floor.astype(np.float32), zero, zero, zero, zero)


def _sorted_hashes(rows: dict[str, np.ndarray], order: int) -> tuple[np.ndarray, np.ndarray]:
    points = np.array([list(map(ord, g)) for g in rows], np.uint32).reshape(-1)
    hashes = _rolled(points, order)[::order]
    place = np.argsort(hashes)
    return hashes[place], np.array(list(rows.values()), np.float32)[place]


def calibrate(model: Model, by_language: dict[str, list[str]]) -> Model:
    """Set the mean cross-entropy of each language's texts, its spread within and between texts, and the deviations that are accepted.

    These are as many as all but a share of ``REJECTED`` of the texts set aside
    show, whole and cut short; where they are too few to tell, twice as many as the
    largest of them.
    """
    mean, within, between, most = (np.zeros(len(model.languages)) for _ in range(4))
    for k, lang in enumerate(model.languages):
        per_text, spread, sizes, starts = [], [], [], []
        for text in by_language.get(lang, []):
            points = characters(text)
            if (points != 32).any():
                loss = model.losses(np.concatenate([np.full(ORDER - 1, _EDGE, np.uint32), points]))[:, k]
                per_text.append(loss.mean())
                spread.append(loss.var())
                sizes.append(len(points))
                starts += [(n, loss[:n].mean()) for n in (*SHORT, len(points)) if n <= len(points)]
        if sizes:
            mean[k] = np.average(per_text, weights=sizes)
            within[k] = np.sqrt(np.average(spread, weights=sizes))
            between[k] = max(np.sqrt(np.average((np.array(per_text) - mean[k]) ** 2, weights=sizes)), LEAST_SPREAD * mean[k])
            off = np.sort([(value - mean[k]) / (within[k] / math.sqrt(n) + between[k]) for n, value in starts])
            rank = math.ceil((len(off) + 1) * (1 - REJECTED))
            most[k] = max(off[rank - 1], 1.0) if rank <= len(off) else 2 * max(off[-1], 1.0)
        else:  # nothing was set aside: accept all
            mean[k] = np.inf
    model.mean, model.within, model.between, model.most = mean, within, between, most
    return model


def train(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", max_chars: int = MAX_CHARS, calibration_texts: int = 500) -> Model:
    """A model from a bounded sample of the labelled rows (text and language not null).

    About a tenth of the sample, and at most ``calibration_texts`` pieces of each
    language, is set aside for the rejection bounds. A language of which all drawn
    pieces would be set aside is trained on them, and has no bounds.
    """
    rows = labelled.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"), F.xxhash64(id_col, text_col).alias("h")).where("lang is not null and text is not null")
    sizes = {r[0]: r[1] for r in rows.groupBy("lang").agg(F.sum(F.length("text"))).collect()}
    if not sizes:
        return estimate({})
    fraction = F.create_map(*[x for lang, n in sizes.items() for x in (F.lit(lang), F.lit(min(1.0, max_chars / max(n or 1, 1))))])
    numbers = F.sequence(F.lit(0), F.greatest(F.lit(0), F.floor((F.length("text") - 1) / PIECE).cast("int")))
    hashes = lambda k: F.when(k == 0, F.col("h")).otherwise(F.xxhash64("h", k))
    share = lambda h: F.pmod(h, F.lit(1 << 30)) / F.lit(float(1 << 30)) / fraction[F.col("lang")]
    drawn = F.filter(numbers, lambda k: share(hashes(k)) < 1)
    pieces = F.transform(drawn, lambda k: F.struct(hashes(k).alias("h"), F.col("text").substr(k * PIECE + 1, F.lit(PIECE)).alias("text")))
    chosen = rows.select("lang", F.explode(pieces).alias("piece")).select("lang", "piece.text", "piece.h").withColumn("u", share(F.col("h")))
    by_language = _counts(chosen.where("u < 0.9").select("lang", "text"))
    alone = sorted(set(sizes) - set(by_language))
    if alone:
        by_language |= _counts(chosen.where(F.col("lang").isin(alone)).select("lang", "text"))
    if not by_language:
        return estimate({})
    aside: dict[str, list[str]] = {}
    first = F.row_number().over(Window.partitionBy("lang").orderBy("h"))
    some = chosen.where("u >= 0.9").withColumn("r", first).where(F.col("r") <= calibration_texts).select("lang", "text").toArrow()
    for lang, text in zip(some.column(0).to_pylist(), some.column(1).to_pylist()):
        if lang not in alone:
            aside.setdefault(lang, []).append(text)
    return calibrate(estimate(by_language), aside)


def identify(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The documents with lang_pred, score (0 to 1), cross_entropy and accepted. No shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("struct<lang_pred:string, score:double, cross_entropy:double, accepted:boolean>")
    def judged(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            parts = [shared.value.judge(some.to_pylist()) for some in text_runs(texts)]
            names, score, entropy, accepted = (np.concatenate(x) for x in zip(*parts)) if parts else [np.zeros(0)] * 4
            yield pa.StructArray.from_arrays([pa.array(names.tolist(), pa.string()), pa.array(score), pa.array(entropy), pa.array(accepted.astype(bool))], names=["lang_pred", "score", "cross_entropy", "accepted"])
        release_memory()

    mark = "__judged"
    fields = ("lang_pred", "score", "cross_entropy", "accepted")
    return docs.withColumn(mark, judged(text_col)).withColumns({f: F.col(f"{mark}.{f}") for f in fields}).drop(mark)
