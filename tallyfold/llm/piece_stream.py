"""SentencePiece encoding and decoding with a streaming Viterbi search.

A text is normalised by the model's own rules and cut into pieces of the model's
vocabulary. The search runs over the characters once. It keeps the best way to
each boundary that a piece may still start at or end on (a window as long as the
longest piece), and hands out ids as soon as the backpointers of all these ways
meet in one boundary. Memory follows the window, not the text.

What a way is worth follows the kind of the model. For a unigram model it is the
sum of the pieces' scores. For a model that was made by merges, a way may put a
piece after another only if replaying the merges over the two together leaves
them apart. A sequence all of whose neighbours stay apart is the one that the
merges make of the whole text, so one way survives at every boundary, and the ids
are those of the model's own encoder.

Where no piece of the vocabulary has a space mark after another character, ways
meet before every space mark. The parts in between are searched side by side, one
character further in all of them at a time, and parts met before are looked up.
All parts, of any length, go through the same search: windows of ``WINDOW``
characters, each of which commits what its open ways agree on; a few long parts
that are left over are searched one by one. Characters outside the vocabulary
become byte pieces, or the unknown piece where the model has none.

Defined cases: a null or empty text has no ids; of equally good ways, the one
whose last piece starts first wins; all rows are kept, and result columns
replace input columns of the same name. A model made by merges in which a piece
has a character that is no piece by itself is refused with a ValueError.
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tallyfold.llm.common import release_memory, text_runs

SPACE = "▁"
#: Words that are searched together, in windows of so many characters.
STEP, WINDOW = 32768, 64
#: So few unfinished words are searched one by one.
FEW = 400
_END = ""  # key of a trie node's own (score, id)


def model_type(path: str) -> int:
    """Kind of a model file: 1 unigram, 2 merges, 3 words, 4 characters (trainer_spec.model_type, fields 2 and 3)."""
    with open(path, "rb") as source:
        raw = source.read()

    def varint(at: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            byte = raw[at]
            value, shift, at = value | (byte & 127) << shift, shift + 7, at + 1
            if byte < 128:
                return value, at

    def fields(at: int, end: int) -> Iterator[tuple[int, int, int]]:
        """(number, value or start, end) of each field."""
        while at < end:
            tag, at = varint(at)
            kind, value = tag & 7, at
            if kind == 0:
                value, at = varint(at)
            elif kind == 2:
                size, value = varint(at)
                at = value + size
            else:
                at += 8 if kind == 1 else 4
            yield tag >> 3, value, at

    for number, start, end in fields(0, len(raw)):
        if number == 2:
            return next((value for n, value, _ in fields(start, end) if n == 3), 1)
    return 1


class PieceModel:
    """A SentencePiece model file, searched by its pieces' scores."""

    def __init__(self, path: str, max_words: int = 300_000):
        import sentencepiece

        self.processor = sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.trie: dict = {}
        self.bytes_of: list[bytes] = []
        byte_ids, scores, self.longest = {}, [], 1
        ids: dict[str, int] = {}
        inner_space = False
        for k in range(sp.vocab_size()):
            piece = sp.id_to_piece(k)
            plain = not (sp.is_control(k) or sp.is_unknown(k) or sp.is_unused(k) or sp.is_byte(k))
            if sp.is_byte(k):
                byte_ids[int(piece[1:-1], 16)] = k
                self.bytes_of.append(bytes([int(piece[1:-1], 16)]))
            else:
                self.bytes_of.append(piece.replace(SPACE, " ").encode() if plain else b"" if sp.is_control(k) else " ⁇ ".encode())
            if plain:
                scores.append(sp.get_score(k))
                self.longest = max(self.longest, len(piece))
                inner_space |= SPACE in piece.lstrip(SPACE)
                ids[piece] = k
        self.merges = model_type(path) == 2
        self.unknown = (0.0 if self.merges else min(scores, default=0.0) - 10.0, sp.unk_id())
        if self.merges:
            self._merge_tables(ids)
        for piece, k in ids.items():
            node = self.trie
            for c in piece:
                node = node.setdefault(c, {})
            node[_END] = (0.0 if self.merges else sp.get_score(k), k)
        self.byte_ids = [byte_ids[b] for b in range(256)] if len(byte_ids) == 256 else None
        self.by_word = not inner_space
        self.line_ends = not any("\n" in sp.id_to_piece(k) for k in range(sp.vocab_size()))
        self.prefixed = sp.normalize("a").startswith(SPACE)
        self.max_words = max_words
        self.arrays: tuple[np.ndarray, ...] | None = None
        self._reset()

    def _merge_tables(self, ids: dict[str, int]) -> None:
        """What a merge makes of two pieces, and for each piece when it is made and from which two; pieces that merges never make go."""
        size, lowest = self.processor.vocab_size(), float("-inf")
        cost = {k: -self.processor.get_score(k) for k in ids.values()}
        made, left, right = np.full(size, lowest), np.zeros(size, np.int64), np.zeros(size, np.int64)
        pairs = {(ids[p[:c]], ids[p[c:]]): k for p, k in ids.items() for c in range(1, len(p)) if p[:c] in ids and p[c:] in ids}
        for piece, k in list(ids.items()):
            if not all(c in ids for c in piece):
                raise ValueError(f"the piece {piece!r} has a character that is no piece")
            row, last = [ids[c] for c in piece], None
            while len(row) > 1:
                hits = [(cost[pairs[x]], at) for at, x in enumerate(zip(row, row[1:])) if x in pairs]
                if not hits:
                    break
                at = min(hits)[1]
                last = row[at], row[at + 1]
                row[at : at + 2] = [pairs[last]]
            if row != [k]:
                del ids[piece]
            elif last:
                made[k], left[k], right[k] = cost[k], *last
        self.made, self.left, self.right = made, left, right
        keys = np.array([a * size + b for a, b in pairs], np.int64)
        place = np.argsort(keys)
        self.pair_keys = np.append(keys[place], np.iinfo(np.int64).max)
        self.pair_cost = np.append(np.array([cost[k] for k in pairs.values()])[place], np.inf)
        # the same for one pair at a time
        self.cost_of = {pair: cost[k] for pair, k in pairs.items()}
        self.made_at, self.halves = made.tolist(), list(zip(left.tolist(), right.tolist()))

    def apart(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Whether merges over piece x followed by piece y leave the two as they are.

        Merges are undone in turn, the last one first. Before each of them, the two
        pieces at the boundary must not have been the ones to merge next; of equal
        merges the left one comes first.
        """
        out, at, size = np.ones(len(x), bool), np.arange(len(x)), len(self.made)
        limit, tie = np.full(len(x), np.inf), np.zeros(len(x), bool)
        while len(at):
            key = x * size + y
            place = np.searchsorted(self.pair_keys, key)
            cost = np.where(self.pair_keys[place] == key, self.pair_cost[place], np.inf)
            joined = (cost < limit) | (tie & (cost == limit))
            out[at[joined]] = False
            of_x, of_y = self.made[x], self.made[y]
            tie = of_y >= of_x
            limit = np.where(tie, of_y, of_x)
            x, y = np.where(tie, x, self.right[x]), np.where(tie, self.left[y], y)
            more = ~joined & (limit > -np.inf)
            if not more.all():
                at, x, y, limit, tie = at[more], x[more], y[more], limit[more], tie[more]
        return out

    def _apart(self, x: int, y: int) -> bool:
        known = self.known_apart.get((x, y))
        if known is None:
            known, a, b, limit, tie = True, x, y, float("inf"), False
            while limit > float("-inf"):
                cost = self.cost_of.get((a, b))
                if cost is not None and (cost < limit or tie and cost == limit):
                    known = False
                    break
                tie = self.made_at[b] >= self.made_at[a]
                limit = self.made_at[b] if tie else self.made_at[a]
                a, b = (a, self.halves[b][0]) if tie else (self.halves[a][1], b)
            self.known_apart[x, y] = known
        return known

    def stream(self, text: str, last: int = -1) -> Iterator[list[int]]:
        """Ids of a normalised text that follows the piece ``last``, in runs that are final when they are handed out."""
        trie, lowest, merges = self.trie, float("-inf"), self.merges
        base, best, back, piece = 0, [0.0], [0], [last]
        n = len(text)
        for i in range(n):
            k, so_far, node, j = i - base, best[i - base], trie, i
            before = piece[k]
            single = False
            while j < n:
                node = node.get(text[j])
                if node is None:
                    break
                j += 1
                found = node.get(_END)
                if found is not None:
                    at, score = j - base, so_far + found[0]
                    single |= j == i + 1
                    if merges and before >= 0 and not self._apart(before, found[1]):
                        score = lowest
                    while len(best) <= at:
                        best.append(lowest)
                        back.append(0)
                        piece.append(-1)
                    if score > best[at]:
                        best[at], back[at], piece[at] = score, k, found[1]
            if not single:
                score = so_far + self.unknown[0]
                if len(best) == k + 1:
                    best.append(lowest)
                    back.append(0)
                    piece.append(-1)
                if score > best[k + 1]:
                    best[k + 1], back[k + 1], piece[k + 1] = score, k, self.unknown[1]
            if len(best) == k + 2:  # nothing reaches over the next boundary
                meet = k + 1
            elif k >= 4 * self.longest and k % self.longest == 0:
                meet = self._meeting(k + 1, best, back)
            else:
                continue
            if meet:
                yield self._ids(text, base, meet, back, piece)
                base += meet
                best = [s - best[meet] for s in best[meet:]]
                back, piece = [b - meet for b in back[meet:]], piece[meet:]

    @staticmethod
    def _meeting(first: int, best: list[float], back: list[int]) -> int:
        """The last boundary that the ways to all open boundaries share."""
        open_ = {at for at in range(first, len(best)) if best[at] > float("-inf")}
        while len(open_) > 1:
            last = max(open_)
            open_.remove(last)
            open_.add(back[last])
        return open_.pop()

    def _ids(self, text: str, base: int, end: int, back: list[int], piece: list[int]) -> list[int]:
        out = []
        while end > 0:
            if piece[end] == self.unknown[1] and self.byte_ids:
                raw = text[base + back[end] : base + end].encode("utf-8", "surrogatepass")
                out.extend(self.byte_ids[b] for b in reversed(raw))
            else:
                out.append(piece[end])
            end = back[end]
        return out[::-1]

    def _words(self, text: str) -> list[str]:
        """A normalised text cut where all ways meet: before every space mark that follows
        another character, and around line ends if no piece has one."""
        if self.line_ends and "\n" in text:
            out = []
            for line in text.split("\n"):
                out += self._words(line)
                out.append("\n")
            return out[:-1]
        parts = text.split(SPACE)
        out, marks = [parts[0]] if parts[0] else [], ""
        for part in parts[1:]:
            marks += SPACE
            if part:
                out.append(marks + part)
                marks = ""
        return [*out, marks] if marks else out

    def forget(self) -> None:
        """Drop the remembered words at the end of a task."""
        self._reset()
        release_memory()

    def _reset(self) -> None:
        self.known: dict[str, int] = {}
        self.known_apart: dict[tuple[int, int], bool] = {}
        self.flat, self.offsets, self.lengths = array("i"), array("q"), array("q")

    def _learn(self, words: list[str]) -> None:
        """Search words not met before, and remember their ids."""
        for k in range(0, len(words), STEP):
            some = [w for w in words[k : k + STEP] if len(w) <= WINDOW]
            ids, lengths, _, odd = self._window(some, np.full(len(some), -1), np.ones(len(some), bool))
            first = len(self.flat) + np.cumsum(lengths) - lengths
            self.flat.frombytes(ids.tobytes())
            self.known.update(zip(some, range(len(self.lengths), len(self.lengths) + len(some))))
            self.offsets.frombytes(first.astype(np.int64).tobytes())
            self.lengths.frombytes(lengths.astype(np.int64).tobytes())
            rest = [*(some[w] for w in np.flatnonzero(odd)), *(w for w in words[k : k + STEP] if len(w) > WINDOW)]
            for word, found in zip(rest, self.search(rest)):
                self.known[word] = len(self.lengths)
                self.offsets.append(len(self.flat))
                self.lengths.append(len(found))
                self.flat.frombytes(found.tobytes())

    def search(self, words: list[str]) -> list[np.ndarray]:
        """Ids of each word, as ``stream`` gives them: window by window, side by side."""
        out: list[list[np.ndarray]] = [[] for _ in words]
        left, start, last = list(range(len(words))), [0] * len(words), [-1] * len(words)

        def one_by_one(w: int) -> None:
            out[w] += [np.array(run, np.int32) for run in self.stream(words[w][start[w] :], last[w])]

        while left:
            if len(left) <= FEW:
                for w in left:
                    one_by_one(w)
                break
            parts = [words[w][start[w] : start[w] + WINDOW] for w in left]
            ends = [start[w] + WINDOW >= len(words[w]) for w in left]
            ids, lengths, met, odd = self._window(parts, np.array([last[w] for w in left]), np.array(ends))
            upto = np.cumsum(lengths)
            again = []
            for k, w in enumerate(left):
                if odd[k] or not (lengths[k] or ends[k]):  # characters outside the vocabulary, or ways that have not met in a window
                    one_by_one(w)
                    continue
                if lengths[k]:
                    out[w].append(ids[upto[k] - lengths[k] : upto[k]])
                    last[w] = int(out[w][-1][-1])
                    start[w] += int(met[k])
                if not ends[k]:
                    again.append(w)
            left = again
        return [x[0] if len(x) == 1 else np.concatenate([np.zeros(0, np.int32), *x]) for x in out]

    def _table(self) -> tuple[np.ndarray, ...]:
        """The trie as sorted (node, character) keys with the next node, and each node's score and id."""
        if self.arrays is None:
            keys, after, score, ids, todo = [], [], [0.0], [-1], [(0, self.trie)]
            for number, node in todo:
                for c, below in node.items():
                    if c != _END:
                        keys.append(number << 21 | ord(c))
                        after.append(len(ids))
                        found = below.get(_END, (0.0, -1))
                        score.append(found[0])
                        ids.append(found[1])
                        todo.append((after[-1], below))
            place = np.argsort(keys)
            self.arrays = np.array(keys, np.int64)[place], np.array(after, np.int64)[place], np.array(score), np.array(ids, np.int32)
        return self.arrays

    def _window(self, parts: list[str], last: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """One window of each word: the ids that are final, their number, the boundary up to which they go, and which parts have unknown characters.

        ``last`` is the piece before each part; a part that ``ends`` its word is final as a whole.
        """
        keys, after, score, ids = self._table()
        order = np.array(sorted(range(len(parts)), key=lambda w: -len(parts[w])), np.int64)
        sizes = np.array([len(parts[w]) for w in order], np.int64)
        points = np.frombuffer("".join(parts[w] for w in order).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        first = np.cumsum(sizes) - sizes
        end = np.repeat(first + sizes, sizes)
        most = int(sizes.max(initial=0))
        longest = min(self.longest, most)
        value = np.full((0 if self.merges else longest, len(points)), -np.inf)
        piece = np.full((longest, len(points)), -1, np.int32)
        live, node = np.arange(len(points)), np.zeros(len(points), np.int64)
        for n in range(longest):
            inside = live + n < end[live]
            live, node = live[inside], node[inside]
            wanted = node << 21 | points[live + n]
            at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
            hit = keys[at] == wanted
            live, node = live[hit], after[at[hit]]
            closed = ids[node] >= 0
            piece[n, live[closed]] = ids[node[closed]]
            if not self.merges:
                value[n, live[closed]] = score[node[closed]]
        unknown = piece[:1].reshape(-1) < 0
        piece[:1, unknown] = self.unknown[1]
        value[:1, unknown] = self.unknown[0]
        best = np.full((most + 1, len(parts)), -np.inf)
        best[0] = 0
        size = np.zeros((most + 1, len(parts)), np.int32)  # of the last piece on the best way to a boundary
        before = np.full((most + 1, len(parts)), -1, np.int32)  # that piece
        before[0] = last[order]
        for k in range(1, most + 1):
            m = int(np.searchsorted(-sizes, -k, side="right"))  # parts of k characters or more
            for n in range(min(k, longest), 0, -1):
                own = first[:m] + k - n
                if self.merges:
                    better = np.flatnonzero((piece[n - 1, own] >= 0) & (size[k, :m] == 0))
                    x, y = before[k - n, better].astype(np.int64), piece[n - 1, own[better]].astype(np.int64)
                    fits = x < 0
                    fits[~fits] = self.apart(x[~fits], y[~fits])
                    better = better[fits]
                else:
                    way = best[k - n, :m] + value[n - 1, own]
                    better = np.flatnonzero(way > best[k, :m])
                    best[k, better] = way[better]
                size[k, better] = n
                before[k, better] = piece[n - 1, own[better]]
        final = self._met(sizes, size, ends[order])
        rows, found, at = [], [], final.copy()
        left = np.flatnonzero(at > 0)
        while len(left):
            rows.append(left)
            found.append(before[at[left], left])
            at[left] -= size[at[left], left]
            left = left[at[left] > 0]
        row = np.concatenate(rows) if rows else np.zeros(0, np.int64)
        ids_of = np.concatenate(found) if found else np.zeros(0, np.int32)
        odd = np.bincount(np.repeat(order, sizes)[unknown], minlength=len(parts)) > 0
        word = order[row]
        place = np.lexsort((-np.arange(len(word)), word))  # the last piece was found first
        met = np.zeros(len(parts), np.int64)
        met[order] = final
        return ids_of[place].astype(np.int32), np.bincount(word, minlength=len(parts)), met, odd

    def _met(self, sizes: np.ndarray, size: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The boundary up to which each part is final: its end, or the last one that the ways to all boundaries share from which a piece may still begin."""
        out = sizes.copy()
        for w in np.flatnonzero(~ends):
            open_ = {k for k in range(max(0, int(sizes[w]) - self.longest + 1), int(sizes[w]) + 1) if size[k, w]}
            while len(open_) > 1:
                far = max(open_)
                open_.remove(far)
                open_.add(far - int(size[far, w]))
            out[w] = open_.pop() if open_ else 0
        return out

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, one after the other, and the number of each text."""
        texts = self.processor.normalize(texts.fill_null("").to_pylist())
        if not self.by_word:
            rows = [list(chain.from_iterable(self.stream(t))) for t in texts]
            return np.fromiter(chain.from_iterable(rows), np.int32), np.array([len(r) for r in rows], np.int64)
        if len(self.known) > self.max_words:
            self._reset()
        words = [self._words(t) for t in texts]
        counts = np.array([len(w) for w in words], np.int64)
        coded = pa.array(chain.from_iterable(words), pa.string(), size=int(counts.sum())).dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        found = list(map(self.known.get, distinct))
        new = [k for k, at in enumerate(found) if at is None]
        if new:
            self._learn([distinct[k] for k in new])
            for k in new:
                found[k] = self.known[distinct[k]]
        codes = np.array(found, np.int64)[coded.indices.to_numpy()] if found else np.zeros(0, np.int64)
        each = np.frombuffer(self.lengths, np.int64)[codes] if found else codes
        ends = np.cumsum(each)
        place = np.arange(int(ends[-1]) if len(ends) else 0)
        if found:
            place += np.repeat(np.frombuffer(self.offsets, np.int64)[codes] - (ends - each), each)
        total = np.concatenate([[0], ends])
        edges = np.concatenate([[0], np.cumsum(counts)])
        ids = np.frombuffer(self.flat, np.int32)[place] if len(place) else np.zeros(0, np.int32)
        return ids, total[edges[1:]] - total[edges[:-1]]

    def decode(self, ids: np.ndarray) -> str:
        """The text of the ids; byte pieces that are no UTF-8 give replacement characters."""
        text = b"".join(map(self.bytes_of.__getitem__, ids.tolist())).decode("utf-8", "replace")
        return text[1:] if self.prefixed and text.startswith(" ") else text


_models: dict[str, PieceModel] = {}


def model_for(path: str) -> PieceModel:
    """The worker's model, kept from task to task with the words it has met."""
    if path not in _models:
        _models[path] = PieceModel(path)
    return _models[path]


def encode_documents(docs: DataFrame, model_path: str, text_col: str = "text", out: str = "ids") -> DataFrame:
    """The documents with their ids, an array of int. No shuffle."""

    @F.arrow_udf("array<int>")
    def encoded(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = model_for(model_path)
        for texts in batches:
            parts = [model.encode(some) for some in text_runs(texts)]
            ids = np.concatenate([p[0] for p in parts]) if parts else np.zeros(0, np.int32)
            ends = np.cumsum(np.concatenate([[0], *[p[1] for p in parts]]))
            yield pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids))
        model.forget()

    return docs.withColumn(out, encoded(text_col))


def decode_documents(docs: DataFrame, model_path: str, ids_col: str = "ids", out: str = "decoded") -> DataFrame:
    """The documents with the text of their ids; null ids give an empty text."""

    @F.arrow_udf("string")
    def decoded(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = model_for(model_path)
        for rows in batches:
            yield pa.array([model.decode(r.values.to_numpy() if r.is_valid else np.zeros(0, np.int32)) for r in rows], pa.string())

    return docs.withColumn(out, decoded(ids_col))


def piece_digests(docs: DataFrame, model_path: str, text_col: str = "text") -> DataFrame:
    """The documents with n_ids, ids_crc32 (of the ids as little-endian 32-bit integers) and round_trip.

    ``round_trip`` says whether decoding the ids gives back the text (an empty
    one for null); it can fail only where the model's rules alter the text.
    """

    @F.arrow_udf("struct<n_ids:bigint, ids_crc32:bigint, round_trip:boolean>")
    def digested(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = model_for(model_path)
        for texts in batches:
            rows = []
            for some in text_runs(texts):
                ids, lengths = model.encode(some)
                ends = np.cumsum(lengths)
                for text, end, n in zip(some.to_pylist(), ends, lengths):
                    own = ids[end - n : end]
                    rows.append((int(n), zlib.crc32(own.astype("<u4").tobytes()), model.decode(own) == (text or "")))
            columns = list(zip(*rows)) if rows else [(), (), ()]
            kinds = (pa.int64(), pa.int64(), pa.bool_())
            yield pa.StructArray.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["n_ids", "ids_crc32", "round_trip"])
        model.forget()

    mark, fields = "__digested", ("n_ids", "ids_crc32", "round_trip")
    return docs.withColumn(mark, digested(text_col)).withColumns({f: F.col(f"{mark}.{f}") for f in fields}).drop(mark)
