"""Runs of words that repeat with a period, by Crochemore's partition refinement.

A run is a stretch of words with smallest period q and a length of at least
``max(SHORTEST, REPEATS * q)`` that no neighbouring word extends with that period.

For each length l, the places of a text fall into classes of equal factors of l
words. The classes of l + 1 follow from those of l: a class is split by the
classes of the places after its own, and only the smaller parts of the last splits
have to be looked at (all but one largest part of each). Two neighbouring places
of a class of length l at distance l are a square, and squares at successive
places with the same l are one run.

Many texts are refined together, as classes never hold places of two texts. A
place moves or ends at most log(n) times, and each length costs a fixed number of
array operations, whatever the texts hold. Classes of fewer than REPEATS - 1
places cannot have a run and end, and with them the places before theirs; a text
of n words is refined up to n / REPEATS.

Words are parts between ASCII white space, as written. The work is one narrow pass:
a task needs memory for one text or for texts of some ``RUN_BYTES`` together.

Defined cases: a null, empty or blank text has no words and no runs; repeated rows
are treated alike; a null id is an id like any other in ``period_runs``, and has no
planted period in ``with_planted_period``; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tallyfold.llm.common import release_memory, text_runs

SHORTEST, REPEATS = 6, 4
RUN_BYTES = 1_000_000


class Refinement:
    """The classes of places of a sequence by the factors that begin there, refined from one length to the next.

    ``words`` are the numbers of the words, ``text`` the number of each word's text
    and ``most`` the greatest length to refine it to.
    """

    def __init__(self, words: np.ndarray, text: np.ndarray, most: np.ndarray, least: int):
        self.n, self.least = len(words), least
        order = np.lexsort((words, text))
        new = np.ones(self.n, bool)
        new[1:] = (np.diff(words[order]) != 0) | (np.diff(text[order]) != 0)
        self.place = order  # places by class; a class is a slice
        self.slot = np.empty(self.n, np.int64)
        self.slot[order] = np.arange(self.n)
        self.start = np.flatnonzero(new)
        self.end = np.append(self.start[1:], self.n)
        self.of = np.empty(self.n, np.int64)
        self.of[order] = np.cumsum(new) - 1
        self.n_classes = len(self.start)
        self.next, self.before = np.full(self.n, -1), np.full(self.n, -1)
        inner = ~new[1:]
        self.next[order[:-1][inner]] = order[1:][inner]
        self.before[order[1:][inner]] = order[:-1][inner]
        self.since = np.ones(self.n, np.int64)  # length at which ``next`` became what it is
        self.alive = np.ones(self.n, bool)
        self.squares: list[tuple[np.ndarray, np.ndarray]] = []
        last = np.append(np.flatnonzero(np.diff(text)), self.n - 1)
        self.ends = np.ones(self.n, bool)
        self.ends[last] = False  # whether the next word is of the same text
        self.lengths = most

    def run(self) -> tuple[np.ndarray, np.ndarray]:
        """(place, half length) of the squares with a primitive half that are found in classes of enough places."""
        sizes = self.end - self.start
        small = np.flatnonzero(sizes >= self.least)
        gone = self._end(self._members(np.flatnonzero(sizes < self.least)), 1)
        stops = np.unique(self.lengths)
        length, left = 1, int(self.alive.sum())
        while left:
            if length >= stops[0]:  # texts that have been refined far enough
                done = np.flatnonzero(self.alive & (self.lengths <= length))
                stops = stops[1:]
                left -= len(self._end(done, length + 1))
                if not len(stops):
                    break
            # predecessors of what moved or ended, and of the last words
            length += 1
            moved = self._members(small)
            moved = moved[moved > 0]
            to = self.of[moved]
            moved = moved - 1
            keep = self.alive[moved] & self.ends[moved]
            moved, to = moved[keep], to[keep]
            ending = gone[gone > 0] - 1
            ending = ending[self.alive[ending] & self.ends[ending]]
            if length == 2:
                ending = np.concatenate([ending, np.flatnonzero(~self.ends & self.alive)])
            gone = self._end(np.unique(ending), length)
            left -= len(gone)
            still = self.alive[moved]
            small, fewer = self._split(moved[still], to[still], length)
            if len(fewer):
                fewer = self._end(fewer, length)
                left -= len(fewer)
                gone = np.concatenate([gone, fewer])
        if not self.squares:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate([s[0] for s in self.squares]), np.concatenate([s[1] for s in self.squares])

    def _members(self, classes: np.ndarray) -> np.ndarray:
        """All places of the classes."""
        start, size = self.start[classes], self.end[classes] - self.start[classes]
        total = int(size.sum())
        first = np.repeat(start - np.concatenate([[0], np.cumsum(size)[:-1]]), size) if len(size) else np.zeros(0, np.int64)
        return self.place[first + np.arange(total)]

    def _seen(self, places: np.ndarray, length: int) -> None:
        """Note the squares of places whose next place changes at this length: the distance was a length in between."""
        places = places[self.next[places] >= 0]
        far = self.next[places] - places
        square = (self.since[places] <= far) & (far < length)
        if square.any():
            self.squares.append((places[square], far[square]))

    def _end(self, places: np.ndarray, length: int) -> np.ndarray:
        """Take places out of their classes; classes left with too few places end with them. Returns all places that ended."""
        out = [places]
        while len(places):
            self._unlink(places, length)
            self.alive[places] = False
            classes = np.unique(self.of[places])
            self._to_back(places)
            counts = np.bincount(np.searchsorted(classes, self.of[places]), minlength=len(classes))
            self.end[classes] -= counts
            size = self.end[classes] - self.start[classes]
            places = self._members(classes[(size > 0) & (size < self.least)])
            out.append(places)
        return np.concatenate(out)

    def _unlink(self, places: np.ndarray, length: int) -> None:
        """Take places out of the lists of their classes' places."""
        self._seen(places, length)
        order = places[np.lexsort((places, self.of[places]))]
        runs = np.ones(len(order), bool)
        runs[1:] = self.before[order[1:]] != order[:-1]
        first = order[runs]
        last = order[np.append(np.flatnonzero(runs)[1:], len(order)) - 1]
        left, right = self.before[first], self.next[last]
        has = left >= 0
        self._seen(left[has], length)
        self.next[left[has]] = right[has]
        self.since[left[has]] = length
        has = right >= 0
        self.before[right[has]] = left[has]
        self.next[places] = self.before[places] = -1

    def _to_back(self, places: np.ndarray) -> np.ndarray:
        """Move places to the end of their classes' slices, in order of class; returns them in that order."""
        places = places[np.argsort(self.of[places], kind="stable")]
        classes, first, count = np.unique(self.of[places], return_index=True, return_counts=True)
        back = np.repeat(self.end[classes] - count - first, count) + np.arange(len(places))
        chosen = self.slot[places] >= np.repeat(self.end[classes] - count, count)  # at the back already
        at_back = self.place[back]
        stays = np.isin(at_back, places, assume_unique=True)
        hole = self.slot[places[~chosen]]
        shifted = at_back[~stays]
        self.place[hole] = shifted
        self.slot[shifted] = hole
        self.place[back] = places
        self.slot[places] = back
        return places

    def _split(self, moved: np.ndarray, to: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Split the classes of the moved places by ``to``; returns the classes to look at next, and places whose class is too small."""
        if not len(moved):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        order = np.lexsort((moved, to, self.of[moved]))
        moved, to, old = moved[order], to[order], self.of[moved[order]]
        new = np.ones(len(moved), bool)
        new[1:] = (old[1:] != old[:-1]) | (to[1:] != to[:-1])
        # a class that goes whole to one part stays as it is
        first = np.flatnonzero(new)
        count = np.diff(np.append(first, len(moved)))
        whole = count == (self.end - self.start)[old[first]]
        if whole.any():
            keep = np.repeat(~whole, count)
            moved, to, old, new = moved[keep], to[keep], old[keep], new[keep]
            if not len(moved):
                return np.zeros(0, np.int64), np.zeros(0, np.int64)
            first = np.flatnonzero(new)
            count = np.diff(np.append(first, len(moved)))
        self._unlink(moved, length)
        moved = self._to_back(moved)  # stays in order of (class, to, place)
        parents, at, parts = np.unique(old[first], return_index=True, return_counts=True)
        made = self.n_classes + np.arange(len(first))
        self._grow(self.n_classes + len(first))
        total = np.add.reduceat(count, at)
        begin = np.repeat(self.end[parents] - total, parts) + np.cumsum(count) - count - np.repeat((np.cumsum(count) - count)[at], parts)
        self.start[made], self.end[made] = begin, begin + count
        self.end[parents] -= total
        self.of[moved] = np.repeat(made, count)
        inner = ~new[1:]
        self.next[moved[:-1][inner]] = moved[1:][inner]
        self.before[moved[1:][inner]] = moved[:-1][inner]
        self.since[moved] = length
        self.n_classes += len(first)
        # all but one largest part of each class are looked at; a class whose places all moved has no rest
        rest = self.end[parents] - self.start[parents]
        largest = np.maximum(np.maximum.reduceat(count, at), rest)
        by_rest = rest == largest
        top = count == np.repeat(np.where(by_rest, -1, largest), parts)
        seen = np.cumsum(top)
        top &= seen - np.repeat(seen[at] - top[at], parts) == 1  # the first of several
        looked = np.concatenate([made[~top], parents[~by_rest & (rest > 0)]])
        size = self.end[looked] - self.start[looked]
        tops = np.concatenate([made[top], parents[by_rest]])
        few = np.concatenate([looked[size < self.least], tops[(self.end - self.start)[tops] < self.least]])
        return looked[size >= self.least], self._members(few)

    def _grow(self, n: int) -> None:
        if n > len(self.start):
            more = np.zeros(max(n, 2 * len(self.start)) - len(self.start), np.int64)
            self.start, self.end = np.concatenate([self.start, more]), np.concatenate([self.end, more])


def runs_of(texts: list[list[bytes]], shortest: int = SHORTEST, repeats: int = REPEATS) -> list[np.ndarray]:
    """For each sequence of words its runs as rows (start, length, period), by start and then period."""
    sizes = np.array([len(t) for t in texts], np.int64)
    numbers: dict[bytes, int] = {}
    words = np.fromiter((numbers.setdefault(w, len(numbers)) for t in texts for w in t), np.int64, int(sizes.sum()))
    out = [np.zeros((0, 3), np.int64)] * len(texts)
    if not len(words):
        return out
    text = np.repeat(np.arange(len(texts)), sizes)
    place, half = Refinement(words, text, np.repeat(np.maximum(sizes // repeats, 1), sizes), max(repeats - 1, 2)).run()
    if not len(place):
        return out
    order = np.lexsort((place, half, text[place]))
    place, half = place[order], half[order]
    new = np.ones(len(place), bool)
    new[1:] = (np.diff(half) != 0) | (np.diff(place) != 1) | (np.diff(text[place]) != 0)
    first = np.flatnonzero(new)
    start, period = place[first], half[first]
    length = place[np.append(first[1:], len(place)) - 1] - start + 2 * period
    long = length >= np.maximum(shortest, repeats * period)
    start, period, length = start[long], period[long], length[long]
    of = text[start]
    start = start - (np.cumsum(sizes) - sizes)[of]
    order = np.lexsort((period, start, of))
    rows = np.stack([start, length, period], axis=1)[order]
    cuts = np.searchsorted(of[order], np.arange(len(texts) + 1))
    return [rows[a:b] for a, b in zip(cuts[:-1], cuts[1:])]


def collapsed(words: list[bytes], runs: np.ndarray) -> list[bytes]:
    """The words without those that a run holds after its first period."""
    if not len(runs):
        return words
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    return [words[k] for k in np.flatnonzero(np.cumsum(change[:-1]) == 0)]


def strongest(runs: np.ndarray) -> tuple[int, int, int] | None:
    """The run with the greatest length / period; of equal ones the first start, then the smallest period."""
    best = None
    for start, length, period in runs.tolist():
        if best is None or length * best[2] > best[1] * period:
            best = (start, length, period)
    return best


def planted(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """The words with a period from some place on, for a tenth of the ids; what the query's contract asks for."""
    h = zlib.crc32(str(doc_id).encode())
    n, g = len(words), h // 10
    if doc_id is None or h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + k % p] for k in range(n - a)]


def period_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", plant: bool = False) -> DataFrame:
    """One row per document: doc_id, runs (start, length, period), and collapsed, the text without the repeats.

    Words of ``collapsed`` are joined by one space. With ``plant`` a tenth of the
    ids get a period first (see ``planted``).
    """

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
        for batch in batches:
            ids = batch.column(0).to_pylist()
            done = 0
            for part in text_runs(batch.column(1), RUN_BYTES):
                texts = [(t.as_py() or "").encode("utf-8", "surrogatepass").split() for t in part]
                own = ids[done : done + len(part)]
                if plant:
                    texts = [planted(w, i) for w, i in zip(texts, own)]
                runs = runs_of(texts)
                rows = [[{"start": s, "length": n, "period": p} for s, n, p in r.tolist()] for r in runs]
                less = [b" ".join(collapsed(w, r)).decode("utf-8", "surrogatepass") for w, r in zip(texts, runs)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(done, len(part)), pa.array(rows, kind), pa.array(less, pa.string())], names=["doc_id", "runs", "collapsed"])
                done += len(part)
        release_memory()

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(found, "doc_id long, runs array<struct<start: long, length: long, period: long>>, collapsed string")


def run_digests(found: DataFrame) -> DataFrame:
    """doc_id, n_runs, the strongest run, and digests of all runs and of the collapsed text."""
    best = F.aggregate(
        "runs",
        F.lit(None).cast("struct<start: long, length: long, period: long>"),
        lambda b, r: F.when(b.isNull() | (r["length"] * b["period"] > b["length"] * r["period"]), r).otherwise(b),
    )
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    digested = found.withColumns({"__best": best, "__lines": F.when(F.size("runs") > 0, F.concat(lines, F.lit("\n"))).otherwise("")})
    return digested.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("__best.start").alias("start"),
        F.col("__best.length").alias("length"),
        F.col("__best.period").alias("period"),
        F.expr("__best.length * 1000 div __best.period").alias("exponent_milli"),
        F.sha2("__lines", 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
