"""N-gram Jaccard self-join of texts by chosen paths.

A text is the set of its five-word shingles; two texts are linked if the sets'
Jaccard similarity is at least the threshold. The join

1. takes texts with equal sets as one, with a weight;
2. sends every set down a random tree: a node picks one or two of 64 min-hash
   coordinates (1/threshold on average), by a hash of the node, and its sets
   part by the token that they have there. Nodes with one set end; nodes with up
   to ``leaf`` sets, and those that kept at least ``alike`` of the sets that were
   in the node above (these are near copies, which no split takes apart), are
   compared by brute force on the sketches; others are split again, up to
   ``max_depth`` times;
3. repeats runs of the tree until a pair at the threshold is missed with
   probability of at most 1 - ``recall``, given the depth that runs have needed,
   over the number of coordinates that the pair shares (only sets that have been
   in a split node take part in further runs);
4. joins candidates into groups, and compares all sets of a group exactly.

The last step counts the links of every text. Large leaves and groups are cut
into blocks by a hash, and each task compares two blocks, so that no task holds
more than about 2 x ``block`` sets and a pair is compared in one task only. Sets
of more than ``UNIT`` tokens count for several in the blocks of a group. A task
returns one row per set (its links there, and a root of the texts linked there),
not one per pair. Where only the classes are wanted, a large group's sets are
compared with one of each part that is already connected, and pairs within a part
are left out.

Defined cases: words are parts between ASCII white space, as written; a text of
one to four words is one shingle, a null or empty text has none and is linked to
nothing; a row with a null id has a null class and no links, and takes no part;
repeated rows count as copies of each other; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from tallyfold.llm.common import components, groups_in_order, release_memory, stored

WORDS = 5
THRESHOLD = 0.8
COORDINATES = 64
LEAF, BLOCK, MAX_DEPTH = 256, 1024, 5
#: Tokens of a set that count as one in the size of a block of sets to compare; a longer set counts for more.
UNIT = 4096
ALIKE = 0.5

_U = np.uint64
_P1, _P2, _P3 = _U(0x9E3779B97F4A7C15), _U(0xBF58476D1CE4E5B9), _U(0x94D049BB133111EB)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _P2
    x = (x ^ (x >> _U(27))) * _P3
    return x ^ (x >> _U(31))


_SEEDS = _mix(np.arange(1, COORDINATES + 1, dtype=np.uint64) * _P1) | _U(1)


def shingles(text: str | None, words: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's shingles."""
    parts = (text or "").encode("utf-8", "surrogatepass").split()
    if not parts:
        return np.zeros(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, parts), np.uint64, len(parts))
    size = min(words, len(parts))
    found = np.full(len(parts) - size + 1, size, np.uint64)
    for k in range(size):
        found = found * _P1 + hashes[k : k + len(found)]
    return np.unique(_mix(found))


def sketch(tokens: np.ndarray) -> np.ndarray:
    """The least token under each of the coordinates' orders, as 32 bits of it."""
    out = np.full(COORDINATES, np.iinfo(np.uint64).max, np.uint64)
    for k in range(0, len(tokens), 2048):
        some = tokens[k : k + 2048, None] * _SEEDS
        out = np.minimum(out, (some ^ (some >> _U(32))).min(axis=0))
    return out.astype(np.uint32)


def children(nodes: np.ndarray, sketches: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """(row, child node) for the coordinates that each row's node picks."""
    x = nodes.astype(np.uint64)
    wanted = 1 / threshold
    rows, out = [], []
    for k in range(math.ceil(wanted)):
        drawn = _mix(x ^ _mix(np.full_like(x, k + 1) * _P1))
        takes = np.flatnonzero((drawn >> _U(40)).astype(np.float64) / (1 << 24) < wanted - k)
        first = (_mix(x + _P3) % _U(COORDINATES)).astype(np.int64)
        step = 2 * ((_mix(x + _P2) % _U(COORDINATES // 2)).astype(np.int64)) + 1
        at = ((first + k * step) % COORDINATES)[takes]  # different coordinates for different k
        token = sketches[takes, at].astype(np.uint64)
        rows.append(takes)
        out.append(_mix(_mix(x[takes] * _P1 + at.astype(np.uint64)) + token))
    return np.concatenate(rows), np.concatenate(out).view(np.int64)


def missed(equal: float, depth: int, threshold: float | None = None) -> float:
    """Probability that no path of one run keeps a pair together down to the depth, if this share of their coordinates is equal."""
    wanted, gone = 1 / (threshold or equal), 0.0
    whole = math.floor(wanted)
    for _ in range(depth):
        one = 1 - equal + equal * gone
        gone = one**whole * ((1 - (wanted - whole)) + (wanted - whole) * one)
    return gone


def _equal_coordinates(threshold: float) -> list[float]:
    """Probability of each number of equal coordinates of a pair at the threshold."""
    return [math.comb(COORDINATES, e) * threshold**e * (1 - threshold) ** (COORDINATES - e) for e in range(COORDINATES + 1)]


def least_equal(threshold: float, recall: float) -> int:
    """The number of equal coordinates below which a pair is no candidate; a tenth of the pairs that may be missed fall below it, at most.

    Thresholds so low that more than these pairs share no coordinate at all are a ValueError.
    """
    share = 0.0
    for e, p in enumerate(_equal_coordinates(threshold)):
        share += p
        if share > (1 - recall) / 10:
            if not e:
                raise ValueError(f"{COORDINATES} coordinates do not give a recall of {recall} at {threshold}")
            return e
    return COORDINATES


def runs_needed(threshold: float, depth: int, recall: float) -> int:
    """Runs after which a pair at the threshold is missed with probability of at most 1 - recall.

    All runs pick from the same coordinates, so they are independent only given
    how many of these are equal: the mean is over that number, and pairs below
    ``least_equal`` count as missed.
    """
    if not 0 < recall < 1:
        raise ValueError(f"recall {recall} is not between 0 and 1")
    least, runs = least_equal(threshold, recall), 0
    chance = _equal_coordinates(threshold)
    one = [missed(e / COORDINATES, depth, threshold) if e else 1.0 for e in range(COORDINATES + 1)]
    while True:
        runs += 1
        if sum(chance[:least]) + sum(c * m**runs for c, m in zip(chance[least:], one[least:])) <= 1 - recall:
            return runs


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least member of each member's component, given links between members."""
    root = np.arange(n)
    while True:
        least = np.minimum(root[a], root[b])
        before = root.copy()
        np.minimum.at(root, a, least)
        np.minimum.at(root, b, least)
        root = root[root]
        if np.array_equal(before, root):
            return root


def _compared(n: int, block: np.ndarray) -> np.ndarray:
    """Which pairs (row before column) a task compares: all of one block, or those across two."""
    upper = np.triu(np.ones((n, n), bool), 1)
    return upper & (block[:, None] != block[None, :]) if block.min() != block.max() else upper


def _similar_sketches(sketches: np.ndarray, block: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    n = len(sketches)
    if n == 2:
        hit = (sketches[0] == sketches[1]).sum() >= least * COORDINATES
        return (np.array([0]), np.array([1])) if hit else (np.zeros(0, int), np.zeros(0, int))
    a, b = [], []
    for i in range(n - 1):
        same = (sketches[i + 1 :] == sketches[i]).sum(axis=1)
        found = np.flatnonzero(same >= least * COORDINATES) + i + 1
        a.append(np.full(len(found), i))
        b.append(found)
    a, b = np.concatenate(a), np.concatenate(b)
    if block.min() != block.max():
        across = block[a] != block[b]
        a, b = a[across], b[across]
    return a, b


def linked(sets: list[np.ndarray], block: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """The pairs of sets, of those to compare, with at least the threshold's similarity."""
    sizes = np.array([len(s) for s in sets])
    n = len(sets)
    tokens, counts = np.unique(np.concatenate(sets), return_counts=True)
    tokens = tokens[counts > 1]  # a token of one set is in no intersection
    common = np.zeros((n, n), np.float32)
    places = [np.searchsorted(tokens, s[np.isin(s, tokens, assume_unique=True)]) for s in sets]
    width = max(1, min(len(tokens), (4 << 20) // n))
    for k in range(0, len(tokens), width):
        part = np.zeros((n, width), np.float32)
        for i, p in enumerate(places):
            lo, hi = np.searchsorted(p, [k, k + width])
            part[i, p[lo:hi] - k] = 1
        common += part @ part.T
    either = sizes[:, None] + sizes[None, :] - common
    return np.nonzero((common >= threshold * either - 1e-6) & _compared(n, block))


def _dealt(df: DataFrame, key: str, member: str, size: str, block: int) -> DataFrame:
    """Rows with the task (key, i, j) that compares them: one per row up to ``block`` members, else one per block it meets."""
    n = F.ceil(F.col(size) / block).cast("int")
    own = F.pmod(F.xxhash64(member, F.lit(7)), n.cast("long")).cast("int")
    df = df.withColumn("own", F.when(n > 1, own).otherwise(0))
    one = df.where(F.col(size) <= block).withColumns({"i": F.lit(0), "j": F.lit(0)})
    more = df.where(F.col(size) > block).withColumn("other", F.explode(F.sequence(F.lit(0), n - 1)))
    more = more.withColumns({"i": F.least("own", "other"), "j": F.greatest("own", "other")}).drop("other")
    return one.unionByName(more)


class ChosenPathJoin:
    """The join of one table; see the module's text for its steps."""

    def __init__(self, threshold: float = THRESHOLD, words: int = WORDS, recall: float = 0.9999, leaf: int = LEAF, block: int = BLOCK, max_depth: int = MAX_DEPTH, alike: float = ALIKE):
        self.threshold, self.words, self.recall = threshold, words, recall
        self.leaf, self.block, self.max_depth, self.alike = leaf, block, max_depth, alike
        self.least = least_equal(threshold, recall) / COORDINATES

    def classes(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """doc_id, class_id (least id of the texts that links connect), n_links (other rows linked), n_linked_texts."""
        return self.classes_of_sets(docs, id_col, text_col).select("doc_id", "class_id", "n_links", "n_linked_texts")

    def classes_of_sets(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", counted: bool = True) -> DataFrame:
        """The columns of ``classes``, with set_id (0 for the empty set) and root, which tells classes of equal class_id apart.

        Links to other texts are left out of the counts if these are not asked for;
        the classes are the same.
        """
        docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
        members = stored(self._sketched(docs), "members")
        sets = stored(
            members.where("n > 0 and doc_id is not null").groupBy("set_id", "n").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("weight"), F.any_value("sketch").alias("sketch")),
            "sets",
        )
        groups = stored(self._groups(sets).withColumnRenamed("node", "set_id"), "groups")
        if counted:
            found = stored(self._verified(docs, sets, groups), "links")
        else:
            found = self._united(docs, sets, groups).withColumns({"links": F.lit(0), "texts": F.lit(0)})
        root = components(found.select(F.col("set_id").alias("a"), F.col("root").alias("b")))
        counts = found.groupBy("set_id").agg(F.sum("links").alias("links"), F.sum("texts").alias("texts"))
        of_set = sets.select("set_id", "first_id", "weight").join(root.withColumnRenamed("node", "set_id"), "set_id").join(counts, "set_id")
        least = of_set.groupBy("root").agg(F.min("first_id").alias("class_id"))
        of_set = of_set.join(least, "root").select("set_id", "root", "class_id", "links", "texts")
        own = sets.select("set_id", "first_id", "weight").join(of_set, "set_id", "left")
        own = own.select("set_id", F.coalesce("root", "set_id").alias("root"), F.coalesce("class_id", "first_id").alias("class_id"), (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.coalesce("texts", F.lit(0)).alias("n_linked_texts"))
        alone = members.where("n = 0 or doc_id is null").select("doc_id", F.col("doc_id").alias("class_id"), F.lit(0).cast("long").alias("n_links"), F.lit(0).cast("long").alias("n_linked_texts"), F.lit(0).cast("long").alias("set_id"), F.lit(0).cast("long").alias("root"))
        rest = members.where("n > 0 and doc_id is not null").select("doc_id", "set_id").join(own, "set_id").select("doc_id", "class_id", "n_links", "n_linked_texts", "set_id", "root")
        return rest.unionAll(alone)

    def _sketched(self, docs: DataFrame) -> DataFrame:
        words = self.words

        def sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                names, ns, sketches = [], [], []
                for text in batch.column(1):
                    tokens = shingles(text.as_py(), words)
                    names.append(_set_id(tokens))
                    ns.append(len(tokens))
                    sketches.append(sketch(tokens).tobytes())
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(names, pa.int64()), pa.array(ns, pa.int64()), pa.array(sketches, pa.binary())], names=["doc_id", "set_id", "n", "sketch"])
            release_memory()

        return docs.mapInArrow(sketched, "doc_id long, set_id long, n long, sketch binary")

    def _expanded(self, rows: DataFrame) -> DataFrame:
        """(set_id, node, above) of the children of each row's node, which has ``above`` sets."""
        threshold = self.threshold

        def expanded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if len(batch):
                    ids, nodes = batch.column(0).to_numpy(), batch.column(1).to_numpy()
                    at, child = children(nodes, _sketches(batch.column(2)), threshold)
                    yield pa.RecordBatch.from_arrays([pa.array(ids[at]), pa.array(child), batch.column(3).take(pa.array(at))], names=["set_id", "node", "above"])

        return rows.select("set_id", "node", "sketch", "size").mapInArrow(expanded, "set_id long, node long, above long")

    def _groups(self, sets: DataFrame) -> DataFrame:
        """(set_id, root) of the sets that some leaf holds with a similar one."""
        spark = sets.sparkSession
        part, depth, done, leaves = sets, 1, 0, []
        while done < (wanted := runs_needed(self.threshold, depth, self.recall)):
            roots = F.array(*[F.xxhash64(F.lit(r)) for r in range(done, wanted)])
            rows = part.select("set_id", F.explode(roots).alias("node"), "sketch", F.lit(1 << 60).alias("size"))
            done, open_ = wanted, []
            for level in range(1, self.max_depth + 1):
                paths = stored(self._expanded(rows), "paths")
                sizes = paths.groupBy("node").agg(F.count("*").alias("size")).where("size > 1")
                sized = stored(paths.join(sizes, "node"), "nodes")
                small = (F.col("size") <= self.leaf) | (F.col("size") >= F.col("above") * self.alike)
                leaves.append(sized if level == self.max_depth else sized.where(small))
                large = sized.where(~small)
                if large.isEmpty():
                    break
                depth = max(depth, level)
                if level < self.max_depth:
                    open_.append(large.select("set_id"))
                    rows = large.join(sets.select("set_id", "sketch"), "set_id")
                    depth = max(depth, level + 1)
            if not open_:
                break
            again = open_[0]
            for more in open_[1:]:
                again = again.unionAll(more)
            part = stored(sets.join(again.distinct(), "set_id", "left_semi"), "open")
        rows = leaves[0]
        for more in leaves[1:]:
            rows = rows.unionAll(more)
        rows = _dealt(rows.drop("above").join(sets.select("set_id", "sketch"), "set_id"), "node", "set_id", "size", self.block)
        least = self.least

        def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for table, bounds in groups_in_order(batches, 3):
                ids, own = table.column(3).to_numpy(), table.column(4).to_numpy()
                sketches = _sketches(table.column(5).combine_chunks())
                a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
                sizes = np.diff(bounds)
                twos = bounds[:-1][sizes == 2]
                twos = twos[(sketches[twos] == sketches[twos + 1]).sum(axis=1) >= least * COORDINATES]
                a.append(ids[twos])
                b.append(ids[twos + 1])
                for lo, hi in zip(bounds[:-1][sizes > 2], bounds[1:][sizes > 2]):
                    i, j = _similar_sketches(sketches[lo:hi], own[lo:hi], least)
                    if len(i):
                        root = _roots(hi - lo, i, j)
                        below = np.flatnonzero(root != np.arange(hi - lo))
                        a.append(ids[lo + below])
                        b.append(ids[lo + root[below]])
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], names=["a", "b"])
            release_memory()

        n_tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
        rows = rows.select("node", "i", "j", "set_id", "own", "sketch").repartition(n_tasks, "node", "i", "j").sortWithinPartitions("node", "i", "j")
        return components(rows.mapInArrow(compare, "a long, b long"))

    def _sized(self, sets: DataFrame, groups: DataFrame) -> DataFrame:
        """The sets of (root, set_id), with the size of each root's group in units of up to ``UNIT`` tokens."""
        rows = groups.join(sets.select("set_id", "first_id", "weight", "n"), "set_id")
        sizes = rows.groupBy("root").agg(F.ceil(F.sum(F.greatest(F.lit(1.0), F.col("n") / UNIT))).alias("size"))
        return rows.drop("n").join(sizes, "root")

    def _tokens(self, docs: DataFrame, wanted: DataFrame) -> DataFrame:
        """The wanted sets (set_id, first_id and other long columns) with their tokens in place of first_id."""
        words, kept = self.words, [c for c in wanted.columns if c != "first_id"]
        at = kept.index("set_id")

        def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found = [shingles(t.as_py(), words) for t in batch.column(len(kept))]
                right = pa.array([_set_id(t) == i for t, i in zip(found, batch.column(at).to_pylist())], pa.bool_())  # not another text of the same id
                yield pa.RecordBatch.from_arrays([*batch.columns[: len(kept)], pa.array([t.tobytes() for t in found], pa.binary())], names=[*kept, "tokens"]).filter(right)

        texts = docs.join(wanted.withColumnRenamed("first_id", "doc_id"), "doc_id").select(*kept, "text")
        return texts.mapInArrow(tokens, "".join(f"{c} long, " for c in kept) + "tokens binary")

    def _links(self, dealt: DataFrame) -> DataFrame:
        """(set_id, root, links, texts) of each set with a link, for each task (root, i, j) that finds one."""
        threshold = self.threshold

        def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for table, bounds in groups_in_order(batches, 3):
                for lo, hi in zip(bounds[:-1], bounds[1:]):
                    rows = table.slice(lo, hi - lo)
                    ids, first = np.unique(rows.column(3).to_numpy(), return_index=True)  # repeated rows once
                    own, weight = rows.column(4).to_numpy()[first], rows.column(5).to_numpy()[first]
                    raw = rows.column(6)
                    a, b = linked([np.frombuffer(raw[int(k)].as_buffer(), np.uint64) for k in first], own, threshold)
                    if len(a):
                        n = len(ids)
                        links = np.bincount(a, weight[b], n) + np.bincount(b, weight[a], n)
                        texts = np.bincount(a, minlength=n) + np.bincount(b, minlength=n)
                        has, root = np.flatnonzero(texts), ids[_roots(n, a, b)]
                        yield pa.RecordBatch.from_arrays([pa.array(ids[has]), pa.array(root[has]), pa.array(links[has].astype(np.int64)), pa.array(texts[has])], names=["set_id", "root", "links", "texts"])
            release_memory()

        n_tasks = int(dealt.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        rows = dealt.select("root", "i", "j", "set_id", "own", "weight", "tokens").repartition(n_tasks, "root", "i", "j").sortWithinPartitions("root", "i", "j")
        return rows.mapInArrow(verify, "set_id long, root long, links long, texts long")

    def _verified(self, docs: DataFrame, sets: DataFrame, groups: DataFrame) -> DataFrame:
        """(set_id, root, links, texts) of each set with a link, for each task that finds one: all pairs of each group are compared."""
        return self._links(_dealt(self._tokens(docs, self._sized(sets, groups)), "root", "set_id", "size", self.block))

    def _united(self, docs: DataFrame, sets: DataFrame, groups: DataFrame) -> DataFrame:
        """(set_id, root) of linked sets, as many as connect every class; not all pairs of a large group are compared.

        In a group of several blocks, the sets of each block are compared; then one
        set of each part that this connects; then the sets outside the group's
        largest part among themselves and with that part. Pairs that are left out
        are of one part, so the classes are those of all pairs.
        """
        wanted = stored(self._tokens(docs, self._sized(sets, groups)), "tokens")  # the texts are read once, whatever follows
        blocks = F.ceil(F.col("size") / self.block)
        own = F.pmod(F.xxhash64("set_id", F.lit(7)), blocks).cast("int")
        found = stored(self._links(wanted.withColumns({"i": own, "j": own, "own": own})).select("set_id", "root"), "inside")
        large = wanted.where(F.col("size") > self.block).select("root", "set_id")
        tokens = wanted.where(F.col("size") > self.block).select("set_id", "tokens")
        if large.isEmpty():
            return found
        heads = self._parts(large, found).where("set_id = part").select("root", "set_id")
        across = _dealt(self._sized(sets, heads).drop("first_id").join(tokens, "set_id"), "root", "set_id", "size", self.block)
        found = stored(found.unionAll(self._links(across).select("set_id", "root")), "heads")
        parts = self._parts(large, found)
        largest = parts.groupBy("root", "part").agg(F.count("*").alias("n")).groupBy("root").agg(F.max(F.struct("n", "part")).alias("top"), F.count("*").alias("parts"))
        parts = stored(parts.join(largest.where("parts > 1"), "root").select("root", "set_id", (F.col("part") == F.col("top.part")).alias("main")), "parts")
        if parts.isEmpty():
            return found
        rest, main = (stored(self._sized(sets, parts.where(side).select("root", "set_id")), "sides") for side in ("not main", "main"))
        rows = _dealt(rest.drop("first_id").join(tokens, "set_id"), "root", "set_id", "size", self.block).unionByName(self._dealt_across(tokens, rest, main), allowMissingColumns=True)
        return stored(found.unionAll(self._links(rows).select("set_id", "root")), "united")

    def _dealt_across(self, tokens: DataFrame, rest: DataFrame, main: DataFrame) -> DataFrame:
        """Tasks (root, i, j) that compare a block i of the one side with a block of the other; j is below zero."""
        sides = []
        for side, other, k in ((rest, main, 0), (main, rest, 1)):
            met = other.groupBy("root").agg(F.max("size").alias("met"))
            rows = side.drop("first_id").join(met, "root").join(tokens, "set_id")
            own = F.pmod(F.xxhash64("set_id", F.lit(7)), F.ceil(F.col("size") / self.block)).cast("int")
            rows = rows.withColumns({"block": own, "other": F.explode(F.sequence(F.lit(0), F.ceil(F.col("met") / self.block).cast("int") - 1))})
            i, j = ("block", "other") if k == 0 else ("other", "block")
            sides.append(rows.select("root", F.col(i).alias("i"), (-1 - F.col(j)).alias("j"), "set_id", F.lit(k).alias("own"), "weight", "tokens"))
        return sides[0].unionAll(sides[1])

    @staticmethod
    def _parts(groups: DataFrame, found: DataFrame) -> DataFrame:
        """(root, set_id, part) of the groups' sets; a part is what the links found so far connect, named by its least set."""
        links = found.join(groups.select("set_id"), "set_id", "left_semi").select(F.col("set_id").alias("a"), F.col("root").alias("b"))
        parts = components(links).select(F.col("node").alias("set_id"), F.col("root").alias("part"))
        return groups.join(parts, "set_id", "left").select("root", "set_id", F.coalesce("part", "set_id").alias("part"))


def _set_id(tokens: np.ndarray) -> int:
    """A hash of a set, the same for equal sets; 0 for the empty one."""
    if not len(tokens):
        return 0
    parts = np.array([tokens.sum(), np.bitwise_xor.reduce(_mix(tokens)), len(tokens)], np.uint64)
    return int(_mix(parts * _P1 + np.arange(3, dtype=np.uint64)).sum().view(np.int64))


def _sketches(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(-1, COORDINATES)


def similar_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """One row per document: doc_id, class_id, n_links, n_linked_texts."""
    return ChosenPathJoin(**how).classes(docs, id_col, text_col)


def one_of_each_class(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, **how) -> DataFrame:
    """The documents without those whose class has one with a smaller id.

    Rows with a null id stay; of rows with equal id and text one stays, as of
    rows with equal id whose texts are of one class. An id on texts of several
    classes is decided for each of them.
    """
    found = ChosenPathJoin(words=words, **how).classes_of_sets(docs, id_col, text_col, counted=False).where("doc_id is not null")
    classes = stored(found.select("doc_id", "set_id", "root", (F.col("doc_id") == F.col("class_id")).alias("first")), "classes")
    ids = classes.groupBy("doc_id").agg(F.count("*").alias("rows"), F.max("first").alias("first")).where("first")
    kept = docs.join(ids.where("rows = 1").select(F.col("doc_id").alias(id_col)), id_col, "left_semi").select(docs.columns)
    again = ids.where("rows > 1").select("doc_id")
    if not again.isEmpty():
        kept = kept.unionByName(_first_of_reused(docs, classes.join(again, "doc_id", "left_semi"), id_col, text_col, words))
    return kept.unionByName(docs.where(F.col(id_col).isNull()))


def _first_of_reused(docs: DataFrame, classes: DataFrame, id_col: str, text_col: str, words: int) -> DataFrame:
    """The rows to keep of the ids in ``classes``, which are on several rows: one for each class that the id is the first of."""

    @F.arrow_udf("bigint")
    def set_of(texts: pa.Array) -> pa.Array:
        return pa.array([_set_id(shingles(t.as_py(), words)) for t in texts], pa.int64())

    first = classes.where("first").groupBy("doc_id", "root").agg(F.min("set_id").alias("__set")).select(F.col("doc_id").alias(id_col), "__set")
    own = docs.join(classes.select(F.col("doc_id").alias(id_col)).distinct(), id_col, "left_semi").withColumn("__set", set_of(text_col))
    # texts without words have no class; equal ones are one
    own = own.join(first, [id_col, "__set"], "left_semi").withColumn("__blank", F.when(F.col("__set") == 0, F.col(text_col)))
    return own.dropDuplicates([id_col, "__set", "__blank"]).select(docs.columns)
