"""Token-ID files: frequency-ranked ids in a byte-aligned variable-length code.

Ids are ranked by how often the corpus uses them (ties: smaller id), so that
frequent ids are small numbers, and the ranks are written as one to four bytes
each. The lengths stand apart: one control byte for four ranks, two bits each.
Reading looks each control byte up in a 256-row table of lengths and gathers
the first bytes of all codes at once in numpy, then the second ones, and so on.

The file format is Parquet, written by Spark: one row per block of consecutive
documents (columns: partition, block, doc_ids, counts, control, data, and the
number of ids of the partition before the block), in ascending document order, and
beside it the table of ranks. So the files live wherever Spark can write, a failed task's output is
never seen, and blocks are read back independently.

Tokenising happens once. Arrow splits a slice of texts and finds its distinct
words, since the vocabulary's normaliser and splitter never join characters
across an ASCII blank or line feed; each distinct piece is looked up once, and
the ids of all words are gathered. Words of Latin letters and closing marks are
two pieces, letters and marks, which go to the model alone, without the
library's normaliser and splitter, which cost more than the merges. Pieces are
cached within bounds per worker. Memory is bounded by a batch and one block.

Defined results: a null or empty text has only its end id; documents are
ordered by id, null ids first, equal ids by their ids' checksum; repeated rows
are written each; an empty table gives empty files; extra columns do not
matter. An id must be below 2^32.
"""

from __future__ import annotations

import os
import re
import string
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from sensorstream.session import checkpoint_root

from .common import cut, session, text_of

MOST_WORDS, MOST_PIECES = 800_000, 800_000
#: Small or, beyond ASCII, any Latin-1 letters, and ASCII marks: letters with marks after them are two pieces, which the normaliser changes in case only.
_LETTERS, _MARKS = "[a-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]*", string.punctuation
_PIECE = re.compile(f"{_LETTERS}|[{re.escape(_MARKS)}]*")
_LATIN = [chr(c) for c in range(0xC0, 0x100) if c not in (0xD7, 0xF7)]
COUNT_IDS = 1 << 20
SLICE_BYTES = 1 << 22
BLOCK_IDS = 1 << 16
#: Lengths of the four codes that a control byte describes, and their sum.
LENGTHS = np.array([[(c >> 2 * k & 3) + 1 for k in range(4)] for c in range(256)], np.uint8)
LENGTH_SUM = LENGTHS.sum(1)


def pack_codes(values: np.ndarray) -> tuple[bytes, bytes]:
    """(control bytes, data bytes) of numbers below 2^32."""
    v = values.astype("<u4")
    size = 1 + (v >= 1 << 8).astype(np.uint8) + (v >= 1 << 16) + (v >= 1 << 24)
    codes = np.concatenate([size - 1, np.zeros(-len(v) % 4, np.uint8)]).reshape(-1, 4)
    control = np.bitwise_or.reduce(codes << np.array([0, 2, 4, 6], np.uint8), axis=1)
    at = np.cumsum(size, dtype=np.int64)
    data = np.empty(at[-1] if len(v) else 0, np.uint8)
    at -= size
    data[at] = v & 0xFF
    # further bytes only of the numbers that have them
    for k in range(1, int(size.max(initial=1))):
        more = np.flatnonzero(size > k)
        data[at[more] + k] = v[more] >> 8 * k & 0xFF
    return control.tobytes(), data.tobytes()


def unpack_codes(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The ``n`` numbers again, by table lookup of the control bytes."""
    size = LENGTHS[np.frombuffer(control, np.uint8)].reshape(-1)[:n]
    at, raw = np.cumsum(size, dtype=np.int64) - size, np.frombuffer(data, np.uint8)
    out = raw[at].astype("<u4")
    for k in range(1, int(size.max(initial=1))):
        more = np.flatnonzero(size > k)
        out[more] |= raw[at[more] + k].astype("<u4") << 8 * k
    return out


def _byte_letters() -> dict[int, str]:
    """Each Latin-1 letter as the byte-level alphabet writes its small form's UTF-8 bytes."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letter = {b: chr(b) for b in own} | {b: chr(256 + k) for k, b in enumerate(b for b in range(256) if b not in own)}
    return {ord(c): "".join(letter[b] for b in c.lower().encode()) for c in _LATIN}


def _lower(text: str) -> str:
    """ASCII capitals as small letters."""
    return text.encode().lower().decode()


class _Words(dict):
    """Ids of words by the library's call and, in ``pieces``, of pieces by its model alone, made when first met; kept within bounds."""

    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark runs a worker per core already
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        # as in the library's plain call, an added token's string in a text is that token; any case, as some are matched after the normaliser
        self.strings = sorted((_lower(t.content) for t in self.tokenizer.get_added_tokens_decoder().values()), key=len, reverse=True)
        self.added = re.compile("|".join(map(re.escape, self.strings)) or "(?!)")
        self.pieces: dict[str, bytes] = {"": b""}
        self.letters, self.simple = _byte_letters(), True
        # only where the model alone gives what the library's plain call does: this splitter, normaliser and alphabet
        probes = ["a", "thing", "z\u00e9ro", *(f"{c}a{c.lower()}" for c in _LATIN), *(f"a{c}{c}" for c in _MARKS), "then..!", "!?", "it'", "''"]
        self.simple = all(x == self._ids(w) + b"\0\0\0\0" for w, x in zip(probes, self.encode(probes, 0), strict=True))
        self.clear()
        self.pieces = {"": b""}

    def _ids(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def __missing__(self, word: str) -> bytes:
        if len(self) >= MOST_WORDS:
            self.clear()
        found = self[word] = self._ids(word)
        return found

    def _piece(self, piece: str) -> bytes:
        """Letters or marks by the model alone, any other word by the library's call."""
        if not self.simple or not _PIECE.fullmatch(piece) or self.added.search(piece):
            return self[piece]
        if len(self.pieces) >= MOST_PIECES:
            self.pieces = {"": b""}
        ids = [t.id for t in self.model.tokenize(piece if piece.isascii() else piece.translate(self.letters))]
        found = self.pieces[piece] = struct.pack(f"<{len(ids)}I", *ids)
        return found

    def _held(self, low: pa.Array) -> np.ndarray:
        """Which small-letter strings hold an added token's."""
        held = np.zeros(len(low), bool)
        for x in self.strings:
            held |= pc.match_substring(low, x).to_numpy(zero_copy_only=False)
        return held

    def _pieces(self, words: pa.Array, held: np.ndarray) -> pa.DictionaryArray:
        """Two strings a word: letters and the marks after them, else the word and nothing."""
        letters = pc.ascii_rtrim(words, _MARKS)
        two = pc.match_substring_regex(letters, rf"\A{_LETTERS}\z").to_numpy(zero_copy_only=False) & ~held & self.simple
        # cut where they lie, in the words' own buffer
        _, starts, data = words.buffers()
        starts = np.frombuffer(starts, np.int32)[words.offset :][: len(words) + 1]
        middle = np.where(two, starts[:-1] + pc.binary_length(letters).to_numpy(), starts[1:])
        cuts = np.append(np.column_stack([starts[:-1], middle]), starts[-1:]).astype(np.int32)
        return pa.StringArray.from_buffers(2 * len(words), pa.py_buffer(cuts), data or pa.py_buffer(b"")).dictionary_encode()

    def encode(self, texts: list[str] | pa.Array, end: int) -> list[bytes]:
        """Each text's ids and the end id, as little-endian 32-bit numbers: each distinct piece is looked up once, then all are gathered."""
        texts = texts.cast(pa.string()) if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
        low = pc.ascii_lower(texts)
        some = bool(self._held(low).any())
        split = pc.split_pattern(pc.replace_substring(texts if some else low, "\n", " "), " ")
        coded = split.values.dictionary_encode()
        words, held = coded.dictionary, np.zeros(len(coded.dictionary), bool)
        if some:  # a word that holds an added token's string stays as it is
            low = pc.ascii_lower(words)
            held = self._held(low)
            words = pc.if_else(pa.array(held), words, low)
        pieces = self._pieces(words, held)
        names = pieces.dictionary.to_numpy(zero_copy_only=False).tolist()
        known = [*map(self.pieces.get, names)]
        ids = [self._piece(p) if x is None else x for p, x in zip(names, known, strict=True)]
        # the end id as a further word, at the end of each text
        ids = pa.array([*ids, np.array([end], "<u4").tobytes(), b""], pa.large_binary())
        _, bounds, data = ids.take(pa.array(np.append(pieces.indices.to_numpy(), [len(names), len(names) + 1]))).buffers()
        bounds = np.frombuffer(bounds, np.int64)[: 2 * len(words) + 3 : 2].copy()
        of_word = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(words) + 1, [None, pa.py_buffer(bounds), data])
        ends = split.offsets.to_numpy()[1:]
        _, bounds, data = of_word.take(pa.array(np.insert(coded.indices.to_numpy(), ends, len(words)))).buffers()
        stops = np.frombuffer(bounds, np.int64)[ends + np.arange(1, len(ends) + 1)].tolist()
        data = memoryview(data)
        return [data[a:b].tobytes() for a, b in zip([0, *stops], stops)]


_WORDS: dict[str, _Words] = {}


def _tokenise(path: str, end: int):
    """Each text's ids in 16 bits each, or 32 where one needs them, so that what is written and shuffled is small."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _WORDS:
            _WORDS[path] = _Words(path)
        for batch in batches:
            ids, texts, size, done = batch.column("id"), batch.column("text"), 0, 0
            for k, more in enumerate(pc.binary_length(texts).to_pylist()):
                size += more
                if size > SLICE_BYTES or k == len(texts) - 1:
                    out = _WORDS[path].encode(texts.slice(done, k + 1 - done), end)
                    narrow = [_narrow(np.frombuffer(x, "<u4")) for x in out]
                    yield pa.RecordBatch.from_arrays([
                        ids.slice(done, len(out)), pa.array([zlib.crc32(x) for x in out], pa.int64()), pa.array([len(x) // 4 for x in out], pa.int64()),
                        pa.array(narrow, pa.binary()),
                    ], names=["id", "crc", "n", "ids"])
                    done, size = k + 1, 0

    return run


def _narrow(ids: np.ndarray) -> bytes:
    return (ids.astype("<u2") if ids.max() < 1 << 16 else ids).tobytes()


def _ids_of(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
    for x, n in zip(batch.column("ids").to_pylist(), batch.column("n").to_pylist(), strict=True):
        yield np.frombuffer(x, "<u2" if len(x) == 2 * n else "<u4")


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences of each id in the partition (as many rows as it has distinct ids)."""
    total, waiting, held = np.zeros(0, np.int64), [], 0

    def add() -> None:
        nonlocal total, held
        c = np.bincount(np.concatenate(waiting), minlength=len(total))
        c[: len(total)] += total
        total, held = c, 0
        waiting.clear()

    for batch in batches:
        for x in _ids_of(batch):
            waiting.append(x)
            held += len(x)
            if held >= COUNT_IDS:
                add()
    if waiting:
        add()
    used = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(total[used], pa.int64())], names=["token", "times"])


def _write(rank_of: np.ndarray):
    """Blocks of a partition's documents, in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        part, block, before = TaskContext.get().partitionId(), 0, 0
        docs: list = []
        ids: list[np.ndarray] = []

        def flush() -> pd.DataFrame:
            nonlocal block, before
            flat = np.concatenate(ids)
            control, data = pack_codes(rank_of[flat])
            row = pd.DataFrame({
                "part": [part], "block": [block], "before": [before], "doc_ids": [list(docs)],
                "counts": [[len(x) for x in ids]], "control": [control], "data": [data],
            })
            block, before = block + 1, before + len(flat)
            docs.clear()
            ids.clear()
            return row

        waiting = 0
        for frame in batches:
            for d, found in zip(frame.column("id").to_pylist(), _ids_of(frame), strict=True):
                docs.append(d)
                ids.append(found)
                waiting += len(ids[-1])
                if waiting >= BLOCK_IDS:
                    yield pa.RecordBatch.from_pandas(flush(), schema=_SCHEMA, preserve_index=False)
                    waiting = 0
        if docs:
            yield pa.RecordBatch.from_pandas(flush(), schema=_SCHEMA, preserve_index=False)

    return run


_SCHEMA = pa.schema([("part", pa.int64()), ("block", pa.int64()), ("before", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("counts", pa.list_(pa.int64())), ("control", pa.binary()), ("data", pa.binary())])
_BLOCKS = "part long, block long, before long, doc_ids array<long>, counts array<long>, control binary, data binary"


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end: int, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write every text's ids and its end id under ``path`` (folders blocks and ranks)."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), text_of(text_col).alias("text"))
    ids = cut(rows.mapInArrow(_tokenise(tokenizer, end), "id long, crc long, n long, ids binary"), "tokens")
    counts = ids.select("n", "ids").mapInArrow(_count, "token long, times long").groupBy("token").agg(F.sum("times").alias("times"))
    # a row per id of the vocabulary that occurs: bounded by the vocabulary, not by the corpus
    ranks = counts.select("token", (F.row_number().over(W.orderBy(F.desc("times"), "token")) - 1).alias("rank"))
    ranks.write.parquet(f"{path}/ranks")
    rank_of = read_ranks(session(docs), path)
    back = np.zeros(int(rank_of.max()) + 1 if len(rank_of) else 1, np.int64)
    back[rank_of] = np.arange(len(rank_of))
    ordered = ids.repartitionByRange("id", "crc").sortWithinPartitions("id", "crc")
    ordered.select("id", "n", "ids").mapInArrow(_write(back), _BLOCKS).write.parquet(f"{path}/blocks")


def read_ranks(spark: SparkSession, path: str) -> np.ndarray:
    """The id of each rank (as many as the vocabulary has at most)."""
    rows = spark.read.schema("token long, rank int").parquet(f"{path}/ranks").orderBy("rank").select("token").toPandas()
    return rows["token"].to_numpy(np.int64)


def _read(id_of: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                row = {k: batch.column(k)[r].as_py() for k in ("doc_ids", "counts", "control", "data", "start")}
                counts = np.array(row["counts"], np.int64)
                ids = id_of[unpack_codes(row["control"], row["data"], int(counts.sum()))].astype("<u4")
                ends = np.cumsum(counts)
                raw = [ids[e - c : e].tobytes() for e, c in zip(ends, counts, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["doc_ids"], pa.int64()), pa.array(row["start"] + ends - counts, pa.int64()), pa.array(counts, pa.int64()), pa.array(raw, pa.binary())],
                    names=["doc_id", "start", "n_tokens", "ids"],
                )

    return run


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """One row per document from the files: doc_id, start, n_tokens, ids (little-endian 32-bit numbers)."""
    blocks = spark.read.schema(_BLOCKS).parquet(f"{path}/blocks")
    sums = blocks.groupBy("part").agg(F.sum(F.aggregate("counts", F.lit(0).cast("long"), lambda a, x: a + x)).alias("n"))
    before = F.coalesce(F.sum("n").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    offsets = sums.select(F.col("part").alias("p"), before.alias("earlier"))  # a row per written partition
    placed = blocks.join(offsets, F.col("part") == F.col("p")).withColumn("start", F.col("before") + F.col("earlier"))
    return placed.select("doc_ids", "counts", "control", "data", "start").mapInArrow(
        _read(read_ranks(spark, path)), "doc_id long, start long, n_tokens long, ids binary"
    )


def fresh_path(spark: SparkSession) -> str:
    """A new folder name under the shared checkpoint folder."""
    return f"{checkpoint_root(spark)}/token-files-{uuid.uuid4().hex[:12]}"
