"""Token-id output: texts to ids, ids to patched frame-of-reference files, and back.

Each text is encoded with a public tokenizer, an end id is appended, and the
documents' ids are written to files in ascending document order. A file holds

* blocks of 512 ids: the block's minimum is subtracted, the differences are
  packed at the width that a percentile of them needs, and those that need more
  bits go to an exception list (position and high bits);
* an index: the byte offset of every block's start, and each document's id,
  first token and number of tokens;
* a trailer with the place and sizes of the index.

Files are written to the shared folder under names that no second attempt of a
task reuses; only files that the manifest of a finished write names are read.

Defined cases: a null text is an empty one and holds the end id alone; rows
with equal doc_id are all kept, in the order of their ids within a file; rows
with a null doc_id come first; an empty table gives no file and no rows; other columns are
ignored whatever their names.
"""

from __future__ import annotations

import os
import struct
import uuid
import zlib
from array import array
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from tallyfold.llm.common import file_system, scratch_dir, stored

MAGIC = b"TFPF0001"
BLOCK = 512
COARSE = 1000  # ranges of ids whose files are bounded each by themselves
TRAILER = struct.Struct("<QQQQ8s")  # index offset, blocks, documents, tokens, magic
HEADER = struct.Struct("<IBBH")  # minimum, width, high-bit flag, exceptions

MANIFEST = "path string, part int, n_docs long, n_tokens long, n_bytes long"
READ_BACK = "doc_id long, start long, n_tokens long, ids_crc32 long"

#: Two texts that a tokenizer with independent words encodes as their words.
_PROBES = ("Is it, 9 of one's  words\n\tor two?", "a  B\x0bc 12 x-y.\r\né ß l'été")


#: Latin letters that stay letters in lower case and when composed, then a point.
CLOSED = "^[A-Za-zÀ-ÖØ-öø-įĲ-ž]+[.,]$"


class WordEncoder:
    """Encodes texts with a tokenizer file, word by word where that is exact.

    If the tokenizer drops white space and never joins across it, a text's ids
    are its words' ids; each distinct word is then encoded once and kept, up to
    ``max_words`` of them. Any other tokenizer encodes the whole texts.
    """

    def __init__(self, path: str, end_id: int, max_words: int = 1_000_000):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.end_id, self.max_words = end_id, max_words
        self.by_word = all(self._ids(p) == [i for w in p.split() for i in self._ids(w)] for p in _PROBES)
        self.by_word &= all(self._ids(f"{w}{c}") == self._ids(w) + self._ids(c) for w in ("word", "é", "ž", "x") for c in ".,")
        self.folds_case = self.by_word and self._ids("AbZ") == self._ids("abz")
        closing = [(i, t.endswith("</w>")) for t, i in self.tokenizer.get_vocab().items()]
        self.closes = np.zeros(max(i for i, _ in closing) + 1, bool)
        self.closes[[i for i, c in closing if c]] = True
        self._reset()

    def _ids(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _reset(self) -> None:
        """The fixed codes: 0 a text's end, 1 nothing, 2 a full stop, 3 a comma."""
        self.index: dict[bytes | None, int] = {None: 0, b"": 1, b".": 2, b",": 3}
        self.flat, self.offsets, self.lengths = array("I"), array("q"), array("q")
        for ids in ([self.end_id], [], self._ids("."), self._ids(",")):
            self.offsets.append(len(self.flat))
            self.lengths.append(len(ids))
            self.flat.extend(ids)

    def _learn(self, words: list[bytes], plain: np.ndarray) -> None:
        """Encode words not met before: those of letters in runs, the rest alone."""
        letters = [words[k] for k in np.flatnonzero(plain)]
        other = [words[k] for k in np.flatnonzero(~plain)]
        for k in range(0, len(letters), 256):
            run = letters[k : k + 256]
            ids = self._ids(b" ".join(run).decode())
            ends = (np.flatnonzero(self.closes[ids]) + 1).tolist()
            if len(ends) == len(run):
                first, starts = len(self.flat), [0, *ends[:-1]]
                self.index.update(zip(run, range(len(self.lengths), len(self.lengths) + len(run))))
                self.offsets.extend([first + a for a in starts])
                self.lengths.extend([b - a for a, b in zip(starts, ends)])
                self.flat.extend(ids)
            else:  # a letter whose lower case has a mark, say
                other.extend(run)
        for word in other:
            ids = self._ids(word.decode())
            self.index[word] = len(self.lengths)
            self.offsets.append(len(self.flat))
            self.lengths.append(len(ids))
            self.flat.extend(ids)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, one after the other, and the number of each text."""
        texts = texts.fill_null("")
        if not self.by_word:
            found = self.tokenizer.encode_batch_fast(texts.to_pylist(), add_special_tokens=False)
            rows = [[*x.ids, self.end_id] for x in found]
            return np.fromiter(chain.from_iterable(rows), np.uint32), np.array([len(r) for r in rows], np.int64)
        if len(self.index) > self.max_words:
            self._reset()
        if self.folds_case:  # ASCII only; one entry for both cases
            texts = pc.if_else(pc.match_substring(texts, "<|"), texts, pc.ascii_lower(texts))
        split = pc.ascii_split_whitespace(texts)
        coded = split.flatten().dictionary_encode()
        # a full stop or comma after letters is a token of its own, so only the letters are looked up
        closed = pc.match_substring_regex(coded.dictionary, CLOSED)
        stems = pc.if_else(closed, pc.utf8_slice_codeunits(coded.dictionary, 0, -1), coded.dictionary).dictionary_encode()
        words = stems.dictionary.cast(pa.binary()).to_pylist()
        found = list(map(self.index.get, words))
        new = np.array([k for k, at in enumerate(found) if at is None], np.int64)
        if len(new):
            plain = pc.match_substring_regex(stems.dictionary.take(pa.array(new)), r"^\pL+$").to_numpy(zero_copy_only=False)
            self._learn([words[k] for k in new], plain)
            for k in new:
                found[k] = self.index[words[k]]
        stem = np.array(found, np.int64)[stems.indices.to_numpy()]
        comma = pc.ends_with(coded.dictionary, ",").to_numpy(zero_copy_only=False)
        point = np.where(closed.to_numpy(zero_copy_only=False), np.where(comma, 3, 2), 1)
        # two codes a word, its letters and its point or nothing, then one for the text's end
        counts = 2 * split.value_lengths().to_numpy().astype(np.int64) + 1
        last = np.cumsum(counts) - 1
        codes = np.zeros(int(counts.sum()), np.int64)
        inner = np.ones(len(codes), bool)
        inner[last] = False
        which = coded.indices.to_numpy()
        codes[inner] = np.stack([stem[which], point[which]], axis=1).reshape(-1)
        each = np.frombuffer(self.lengths, np.int64)[codes]
        ends = np.cumsum(each)
        place = np.arange(int(ends[-1])) + np.repeat(np.frombuffer(self.offsets, np.int64)[codes] - (ends - each), each)
        return np.frombuffer(self.flat, np.uint32)[place], np.add.reduceat(each, last - counts + 1)


_encoders: dict[tuple, WordEncoder] = {}


def encoder_for(path: str, end_id: int) -> WordEncoder:
    """The worker's encoder, kept from task to task with the words it has met."""
    if (path, end_id) not in _encoders:
        _encoders[path, end_id] = WordEncoder(path, end_id)
    return _encoders[path, end_id]


def pack(ids: np.ndarray, percentile: float = 90.0) -> tuple[bytes, np.ndarray]:
    """Ids as patched frame-of-reference blocks; the bytes, and each block's offset."""
    n_blocks = -(-len(ids) // BLOCK)
    if not n_blocks:
        return b"", np.zeros(0, np.uint64)
    padded = np.concatenate([ids, np.full(n_blocks * BLOCK - len(ids), ids[-1], np.uint32)]).reshape(n_blocks, BLOCK)
    least = padded.min(axis=1)
    rest = padded - least[:, None]
    most = np.percentile(rest, percentile, axis=1, method="higher").astype(np.uint32)
    widths = np.ceil(np.log2(most.astype(np.float64) + 1)).astype(np.int64)
    body: list[bytes] = [b""] * n_blocks
    for width in np.unique(widths):
        rows = np.flatnonzero(widths == width)
        bits = np.unpackbits(rest[rows].astype("<u4").view(np.uint8).reshape(len(rows), BLOCK, 4), axis=2, bitorder="little")
        packed = np.packbits(bits[:, :, :width].reshape(len(rows), -1), axis=1, bitorder="little")
        high = (rest[rows].astype(np.uint64) >> np.uint64(width)).astype(np.uint32)
        for k, row in enumerate(rows):
            at = np.flatnonzero(high[k])
            over = high[k, at]
            wide = bool(len(over)) and int(over.max()) > 0xFFFF
            body[row] = (
                HEADER.pack(int(least[row]), int(width), wide, len(at))
                + packed[k].tobytes() + at.astype("<u2").tobytes() + over.astype("<u4" if wide else "<u2").tobytes()
            )
    sizes = np.array([len(b) for b in body], np.uint64)
    return b"".join(body), np.cumsum(sizes) - sizes


def unpack(raw: bytes, offsets: np.ndarray, n: int) -> np.ndarray:
    """The first ``n`` ids of the blocks that start at the offsets."""
    out = np.zeros((len(offsets), BLOCK), np.uint32)
    heads = [HEADER.unpack_from(raw, int(o)) for o in offsets]
    widths = np.array([h[1] for h in heads], np.int64)
    for width in np.unique(widths):
        rows, size = np.flatnonzero(widths == width), int(width) * BLOCK // 8
        if width:
            data = np.stack([np.frombuffer(raw, np.uint8, size, int(offsets[r]) + HEADER.size) for r in rows])
            bits = np.zeros((len(rows), BLOCK, 32), np.uint8)
            bits[:, :, :width] = np.unpackbits(data, axis=1, bitorder="little").reshape(len(rows), BLOCK, width)
            out[rows] = np.packbits(bits, axis=2, bitorder="little").view("<u4")[:, :, 0]
        for r in rows:
            least, _, wide, n_over = heads[r]
            at = int(offsets[r]) + HEADER.size + size
            if n_over:
                places = np.frombuffer(raw, "<u2", n_over, at)
                out[r, places] += np.frombuffer(raw, "<u4" if wide else "<u2", n_over, at + 2 * n_over).astype(np.uint32) << np.uint32(width)
            out[r] += np.uint32(least)
    return out.reshape(-1)[:n]


#: Ids that are packed or unpacked in one step.
STEP = 256 * BLOCK


def write_file(uri: str, doc_ids: list[int | None], parts: list[np.ndarray]) -> int:
    """One file of whole documents; its size in bytes."""
    filesystem, path = file_system(uri)
    filesystem.create_dir(path.rpartition("/")[0], recursive=True)
    lengths = np.array([len(p) for p in parts], "<u8")
    ids = np.concatenate(parts) if parts else np.zeros(0, np.uint32)
    offsets, at = [], 0
    with filesystem.open_output_stream(path) as out:
        for k in range(0, len(ids), STEP):
            raw, where = pack(ids[k : k + STEP])
            out.write(raw)
            offsets.append(where + np.uint64(at))
            at += len(raw)
        starts = np.concatenate(offsets).astype("<u8") if offsets else np.zeros(0, "<u8")
        known = np.array([d is not None for d in doc_ids], np.uint8)
        names = np.array([d or 0 for d in doc_ids], "<i8")
        for table in (starts, known, names, np.cumsum(lengths) - lengths, lengths):
            out.write(table.astype(table.dtype, copy=False).tobytes())
        out.write(TRAILER.pack(at, len(starts), len(names), len(ids), MAGIC))
        return out.tell()


def read_file(uri: str) -> Iterator[tuple[int | None, int, np.ndarray]]:
    """(doc_id, first token in the file, ids) of each document, a step of blocks at a time."""
    filesystem, path = file_system(uri)
    with filesystem.open_input_file(path) as source:
        size = source.size()
        index, n_blocks, n_docs, n_tokens, magic = TRAILER.unpack(source.read_at(TRAILER.size, size - TRAILER.size))
        if magic != MAGIC:
            raise ValueError(f"{uri} is not a token file")
        raw = source.read_at(size - TRAILER.size - index, index)
        offsets = np.frombuffer(raw, "<u8", n_blocks)
        at = 8 * n_blocks
        known = np.frombuffer(raw, np.uint8, n_docs, at)
        names, firsts, lengths = np.frombuffer(raw, "<i8", 3 * n_docs, at + n_docs).reshape(3, n_docs)
        edges = np.append(offsets, index)
        held, base, block = np.zeros(0, np.uint32), 0, 0  # ids read but not handed out, and the first one's place
        for k in range(n_docs):
            end = int(firsts[k] + lengths[k])
            more = [held]
            while base + sum(map(len, more)) < end:
                upto = min(n_blocks, block + STEP // BLOCK)
                lo, hi = int(edges[block]), int(edges[upto])
                n = min(n_tokens, upto * BLOCK) - block * BLOCK
                more.append(unpack(source.read_at(hi - lo, lo), offsets[block:upto] - offsets[block], n))
                block = upto
            held = np.concatenate(more) if len(more) > 1 else held
            first = int(firsts[k]) - base
            yield (int(names[k]) if known[k] else None), int(firsts[k]), held[first : first + int(lengths[k])]
            if len(held) > 4 * STEP or first > STEP:
                held, base = held[end - base :], end


def file_ranges(docs: DataFrame, chars_per_file: int) -> tuple[np.ndarray, np.ndarray]:
    """Upper bounds of the files' id ranges, and the number of files of each range, the first being that of null ids.

    Bounds are approximate quantiles of the ids, in which a text counts once for
    each average length of a text that it holds. They are found in two levels, up
    to ``COARSE`` ranges first and then within each of these, so that no aggregate
    holds all of them. An id that is several quantiles has a range of its own, of
    as many files. One long a file reaches the driver. The texts are read once, for
    their lengths, which all passes take from a written table.
    """
    weighed = stored(docs.select("doc_id", F.length("text").alias("chars")), "text-lengths")
    known = F.col("doc_id").isNotNull()
    rows, chars, none = weighed.agg(F.count("*"), F.sum(F.when(known, F.col("chars"))), F.sum(F.when(~known, F.col("chars")))).first()
    n_files, of_null = max(1, -(-(chars or 0) // chars_per_file)), max(1, -(-(none or 0) // chars_per_file))
    if n_files == 1:
        return np.zeros(0, np.int64), np.array([of_null, 1])
    times = F.greatest(F.lit(1), F.ceil(F.coalesce("chars", F.lit(0)) * F.lit(rows / chars))).cast("int")
    ids = weighed.where(known).select("doc_id", F.explode(F.sequence(F.lit(1), times)).alias("time")).select("doc_id")
    coarse = max(1, min(COARSE, n_files // 16))
    fine = -(-n_files // coarse)

    def quantiles(n: int):
        return F.percentile_approx("doc_id", [k / n for k in range(1, n + 1)], 20 * n + 10_000)

    @F.arrow_udf("int")
    def range_of(names: pa.Array) -> pa.Array:
        return pa.array(np.searchsorted(edges, names.to_numpy(), side="left"), pa.int32())

    edges, times = np.unique(np.array(ids.agg(quantiles(coarse)).first()[0], np.int64), return_counts=True)
    often = edges[times > 1]
    cuts = ids.where(~F.col("doc_id").isin(often.tolist())).groupBy(range_of("doc_id").alias("range")).agg(quantiles(fine).alias("cuts"))
    values, counts = np.unique(cuts.select(F.explode("cuts").alias("cut")).toArrow().column(0).to_numpy(), return_counts=True)
    hot, parts = np.append(often, values[counts > 1]), np.append(times[times > 1] * fine, counts[counts > 1])
    bounds = np.unique(np.concatenate([edges, values, hot[hot > np.iinfo(np.int64).min] - 1]))
    files = np.ones(len(bounds) + 2, np.int64)
    files[0] = of_null
    files[1 + np.searchsorted(bounds, hot)] = parts
    return bounds, files


def write_token_files(
    docs: DataFrame, tokenizer_path: str, end_id: int, uri: str, id_col: str = "doc_id", text_col: str = "text",
    chars_per_file: int = 16_000_000,
) -> DataFrame:
    """Write every document's ids below ``uri`` and return the manifest, in order of ``part``.

    Documents are dealt to files by ranges of their id that hold about
    ``chars_per_file`` characters each, so the text is shuffled once, as ids,
    and each task writes one file. Rows with an id that fills several files, or
    with none, are spread over as many by a hash.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    bounds, files = file_ranges(docs, chars_per_file)
    first = np.cumsum(files) - files

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_for(tokenizer_path, end_id)
        seen: dict[tuple, int] = {}
        for batch in batches:
            for k in range(0, len(batch), 2000):
                some = batch.slice(k, 2000)
                names = some.column(0)
                ids, lengths = encoder.encode(some.column(1))
                ends = np.cumsum(lengths)
                ids = ids.astype("<u4")
                range_of = 1 + np.searchsorted(bounds, names.fill_null(0).to_numpy(zero_copy_only=False), side="left")
                range_of[names.is_null().to_numpy(zero_copy_only=False)] = 0
                narrow = ids.astype("<u2") if encoder.closes.size <= 1 << 16 else ids
                raw = [narrow[b - n : b].tobytes() for b, n in zip(ends, lengths)]
                part = first[range_of]
                for row in np.flatnonzero(files[range_of] > 1):
                    key = (names[row].as_py(), zlib.crc32(raw[row]))
                    seen[key] = seen.get(key, -1) + 1  # copies go to one file after the other, whatever their order
                    part[row] += (key[1] + seen[key]) % files[range_of[row]]
                yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), names, pa.array(raw, pa.binary())], names=["part", "doc_id", "ids"])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from tokenizers import Tokenizer

        wide = Tokenizer.from_file(tokenizer_path).get_vocab_size() > 1 << 16
        part, names, ids = 0, [], []
        for batch in batches:
            if len(batch):
                part = batch.column(0)[0].as_py()
                names += batch.column(1).to_pylist()
                ids += [np.frombuffer(x.as_buffer(), "<u4" if wide else "<u2").astype(np.uint32) for x in batch.column(2)]
        if names:
            path = f"{uri}/part-{part:06d}-{uuid.uuid4().hex}.tok"
            n_bytes = write_file(path, names, ids)
            yield pa.RecordBatch.from_pydict({"path": [path], "part": pa.array([part], pa.int32()), "n_docs": [len(names)], "n_tokens": [sum(map(len, ids))], "n_bytes": [n_bytes]})

    encoded = docs.mapInArrow(encode, "part int, doc_id long, ids binary")
    written = encoded.repartitionById(int(files.sum()), "part").sortWithinPartitions("doc_id", "ids").mapInArrow(write, MANIFEST)
    return stored(written, "token-manifest")


def read_token_files(manifest: DataFrame) -> DataFrame:
    """One row per document, from the files: doc_id, start, n_tokens, ids_crc32.

    ``start`` counts the ids of all documents before it. The window over the
    manifest has one row per file and is the only unpartitioned step.
    """
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    files = manifest.select("path", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("before"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                rows: list[tuple] = []
                for name, first, ids in read_file(path):
                    rows.append((name, base + first, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                    if len(rows) == 10_000:
                        yield _rows(rows)
                        rows = []
                yield _rows(rows)

    def _rows(rows: list[tuple]) -> pa.RecordBatch:
        names = ["doc_id", "start", "n_tokens", "ids_crc32"]
        columns = zip(*rows) if rows else ([] for _ in names)
        return pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in columns], names=names)

    n_tasks = max(2 * manifest.sparkSession.sparkContext.defaultParallelism, 1)
    return files.repartition(n_tasks, "path").mapInArrow(read, READ_BACK)


def token_files(docs: DataFrame, tokenizer_path: str, end_id: int = 1, **how) -> DataFrame:
    """Write the ids of all documents to a new folder and return what the files say."""
    uri = scratch_dir(docs.sparkSession, "tokens")
    return read_token_files(write_token_files(docs, tokenizer_path, end_id, uri, **how))
