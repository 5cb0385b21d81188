"""Byte-level BPE: encoding and decoding by DuckDB queries inside each partition.

A text is cut into pieces by the vocabulary's pattern; each distinct piece is
encoded once per worker and cached within bounds. Pieces that are not in the
vocabulary become (piece, position, token) rows, one per byte. A recursive
query joins neighbouring tokens to the merge table and contracts each piece's
leftmost pair of least rank, until no piece has a pair left. Decoding joins
the ids to the vocabulary and concatenates the bytes in an aggregate ordered
by position.

Pieces of more than ``LONG`` bytes (text without white space) would make the
recursion's result grow with the square of their length; they are contracted
one at a time by the same step as a temporary table, all occurrences of the
least pair in one statement, up to the first whose contraction makes a pair of
lower rank possible. That gives the same ids.

Spark deals the texts; nothing is shuffled, and a lost executor costs only its
tasks. Memory is bounded by the batch, the caches' sizes and the largest text.

Defined results: a null or empty text has no ids (an empty array) and decodes
to no bytes; repeated rows are encoded alike; an empty table gives an empty
result; extra columns are kept whatever their names, but for one called
``__bpe``, which the result replaces.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import others

#: White space as the pattern's own engine has it (Unicode White_Space).
SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
#: Coarser than the vocabulary's pattern: a word with the blank before it, or white space. Pieces never cross units.
UNITS = re.compile(f" ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")
LONG = 256
SLICE_CHARS = 1 << 21
SLICE_PIECES = 1 << 16
MOST_PIECES, MOST_UNITS = 500_000, 500_000

_RECURSION = """
WITH RECURSIVE step(wid, pos, tok, busy) AS (
  SELECT wid, pos, tok, true FROM start_rows
  UNION ALL
  (WITH pairs AS (
     SELECT wid, pos, tok, lead(tok) OVER o AS nxt, lead(pos) OVER o AS next_pos, lead(wid) OVER o AS next_wid
     FROM step WHERE busy WINDOW o AS (ORDER BY pos)),
   best AS (
     SELECT p.wid, min((m.merged::BIGINT << 32) | p.pos) AS b, arg_min(p.next_pos, (m.merged::BIGINT << 32) | p.pos) AS eaten
     FROM pairs p JOIN merges m ON m.l = p.tok AND m.r = p.nxt WHERE p.next_wid = p.wid GROUP BY p.wid)
   SELECT s.wid, s.pos, CASE WHEN s.pos = (b & 4294967295) THEN (b >> 32)::INT ELSE s.tok END, b IS NOT NULL
   FROM pairs s LEFT JOIN best ON best.wid = s.wid WHERE eaten IS DISTINCT FROM s.pos)
)
SELECT wid, pos, tok FROM step WHERE NOT busy ORDER BY pos
"""

_LONG_STEP = """
CREATE OR REPLACE TEMP TABLE long_next AS
WITH pairs AS (
  SELECT pos, tok, row_number() OVER o AS i, lead(tok) OVER o AS nxt, lead(tok, 2) OVER o AS after, lag(tok) OVER o AS before
  FROM long_rows WINDOW o AS (ORDER BY pos)),
ranked AS (SELECT p.*, m.merged FROM pairs p JOIN merges m ON m.l = p.tok AND m.r = p.nxt),
least AS (SELECT *, i - row_number() OVER (ORDER BY i) AS run FROM ranked WHERE merged = (SELECT min(merged) FROM ranked)),
apart AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY run ORDER BY i) AS k FROM least) WHERE k % 2 = 1 OR tok <> nxt),
sides AS (SELECT *, CASE WHEN lag(i) OVER (ORDER BY i) = i - 2 THEN merged ELSE before END AS left_tok FROM apart),
lower AS (
  SELECT s.*, sum(CASE WHEN a.merged < s.merged OR z.merged < s.merged THEN 1 ELSE 0 END) OVER (ORDER BY s.i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS stop
  FROM sides s LEFT JOIN merges a ON a.l = s.left_tok AND a.r = s.merged LEFT JOIN merges z ON z.l = s.merged AND z.r = s.after),
done AS (SELECT i, merged FROM lower WHERE coalesce(stop, 0) = 0)
SELECT p.pos, coalesce(d.merged, p.tok) AS tok FROM pairs p LEFT JOIN done d ON d.i = p.i
WHERE NOT EXISTS (SELECT 1 FROM done e WHERE e.i + 1 = p.i)
"""


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank (= id), from a rank file of base64 tokens."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def _spans(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Indexes of ``size`` places from each ``start`` on, one after the other."""
    ends = np.cumsum(size)
    return np.repeat(start - ends + size, size) + np.arange(ends[-1] if len(ends) else 0)


class _Numbers(dict):
    """Numbers strings in the order in which they are first asked for."""

    def __init__(self) -> None:
        super().__init__()
        self.fresh: list[str] = []

    def __missing__(self, key: str) -> int:
        self.fresh.append(key)
        n = self[key] = len(self)
        return n


class _Known:
    """Numbered strings, their ids in one flat array, and the bytes these decode to."""

    def __init__(self) -> None:
        self.number, self.back = _Numbers(), []
        self.flat, self.size, self.start = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def numbers(self, strings: list[str]) -> np.ndarray:
        return np.fromiter(map(self.number.__getitem__, strings), np.int64, len(strings))

    def new(self) -> list[str]:
        """Strings numbered since the last call."""
        fresh, self.number.fresh = self.number.fresh, []
        return fresh

    def add(self, ids: np.ndarray, size: np.ndarray, back: list[bytes]) -> None:
        """Ids and bytes of the next numbers."""
        if len(size):
            self.start = np.concatenate([self.start, len(self.flat) + np.cumsum(size) - size])
            self.size, self.flat = np.concatenate([self.size, size]), np.concatenate([self.flat, ids])
            self.back += back

    def ids_of(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the strings in order, and the number of ids of each."""
        size = self.size[numbers]
        return self.flat[_spans(self.start[numbers], size)], size


class Codec:
    """The merge table in an in-memory DuckDB, and what has been encoded so far."""

    def __init__(self, path: str, pattern: str) -> None:
        import duckdb
        import regex

        self.ranks = read_ranks(path)
        self.pattern = regex.compile(pattern.replace(r"[^\s", f"[^{SPACE}").replace(r"\s", f"[{SPACE}]").replace(r"\S", f"[^{SPACE}]"))
        self.single = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        pairs = [(x, y, k) for token, k in self.ranks.items() for i in range(1, len(token)) if (x := self.ranks.get(token[:i])) is not None and (y := self.ranks.get(token[i:])) is not None]
        self.db = duckdb.connect(":memory:", config={"threads": 1, "memory_limit": "400MB"})
        cols = np.array(pairs, np.int32).reshape(-1, 3)
        self.db.register("merge_rows", pa.table({"l": cols[:, 0], "r": cols[:, 1], "merged": cols[:, 2]}))
        self.db.execute("CREATE TABLE merges AS SELECT * FROM merge_rows")
        self.db.register("token_rows", pa.table({"tok": pa.array(list(self.ranks.values()), pa.int32()), "bytes": [t.hex() for t in self.ranks]}))
        self.db.execute("CREATE TABLE vocabulary AS SELECT * FROM token_rows")
        for name in ("merge_rows", "token_rows"):
            self.db.unregister(name)
        self._forget()

    def _forget(self) -> None:
        self.pieces, self.units = _Known(), _Known()

    def _contract_long(self, piece: bytes) -> np.ndarray:
        toks = self.single[np.frombuffer(piece, np.uint8)]
        self.db.register("start_rows", pa.table({"pos": np.arange(len(toks), dtype=np.int64), "tok": toks}))
        self.db.execute("CREATE OR REPLACE TEMP TABLE long_rows AS SELECT * FROM start_rows")
        n = len(toks)
        while True:
            self.db.execute(_LONG_STEP)
            self.db.execute("CREATE OR REPLACE TEMP TABLE long_rows AS SELECT * FROM long_next")
            now = self.db.execute("SELECT count(*) FROM long_rows").fetchall()[0][0]
            if now == n:
                return np.asarray(self.db.sql("SELECT tok FROM long_rows ORDER BY pos").to_arrow_table().column("tok"), np.int32)
            n = now

    def encode_pieces(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the pieces in order, and the number of ids of each."""
        whole = np.fromiter(map(self.ranks.get, pieces, repeat(-1)), np.int32, len(pieces))
        length = np.fromiter(map(len, pieces), np.int64, len(pieces))
        size = np.where(whole >= 0, 1, 0)
        found = [(np.flatnonzero(whole >= 0), whole[whole >= 0])]  # numbers of pieces, and their ids
        for k in np.flatnonzero((whole < 0) & (length > LONG)).tolist():
            ids = self._contract_long(pieces[k])
            size[k] = len(ids)
            found.append((np.array([k]), ids))
        rest = np.flatnonzero((whole < 0) & (length <= LONG))
        for at in range(0, len(rest), SLICE_PIECES):
            part = rest[at : at + SLICE_PIECES]
            flat = np.frombuffer(b"".join(map(pieces.__getitem__, part.tolist())), np.uint8)
            wid = np.repeat(np.arange(len(part), dtype=np.int32), length[part])
            self.db.register("start_rows", pa.table({"wid": wid, "pos": np.arange(len(flat), dtype=np.int64), "tok": self.single[flat]}))
            got = self.db.sql(_RECURSION).to_arrow_table()
            size[part] = np.bincount(got.column("wid").to_numpy(), minlength=len(part))
            found.append((part, got.column("tok").to_numpy()))
        ids, start = np.zeros(int(size.sum()), np.int32), np.cumsum(size) - size
        for k, toks in found:
            ids[_spans(start[k], size[k])] = toks
        return ids, size

    def decode(self, ids: np.ndarray, size: np.ndarray) -> list[bytes]:
        """Bytes of each run of ``size`` ids; no run is empty."""
        if not len(ids):
            return []
        self.db.register("id_rows", pa.table({"wid": np.repeat(np.arange(len(size)), size), "pos": np.arange(len(ids)), "tok": ids}))
        got = self.db.sql("SELECT string_agg(bytes, '' ORDER BY pos) AS hex FROM id_rows JOIN vocabulary USING (tok) GROUP BY wid ORDER BY wid").to_arrow_table()
        return list(map(bytes.fromhex, got.column("hex").to_pylist()))

    def _learn(self) -> None:
        """Encode the units that have a number, but no ids yet."""
        units = self.units.new()
        split = list(map(self.pattern.findall, units))
        codes = self.pieces.numbers(list(chain.from_iterable(split)))
        new = self.pieces.new()
        for at in range(0, len(new), SLICE_PIECES):
            ids, size = self.encode_pieces([p.encode() for p in new[at : at + SLICE_PIECES]])
            self.pieces.add(ids, size, self.decode(ids, size))
        ids, size = self.pieces.ids_of(codes)
        count = np.fromiter(map(len, split), np.int64, len(split))
        ends = np.concatenate([[0], np.cumsum(count)])
        back = list(map(self.pieces.back.__getitem__, codes.tolist()))
        whole = [back[i] if n == 1 else b"".join(back[i : i + n]) for i, n in zip(ends.tolist(), count.tolist(), strict=False)]
        upto = np.concatenate([[0], np.cumsum(size)])
        self.units.add(ids, upto[ends[1:]] - upto[ends[:-1]], whole)

    def encode_units(self, units: list[str]) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
        """All ids of the units in order, the number of ids of each unit, and each unit's decoded bytes."""
        full = len(self.units.number) > MOST_UNITS or len(self.pieces.number) > MOST_PIECES
        if full or any(len(x.number) != len(x.size) for x in (self.units, self.pieces)):  # the second: a call that failed
            self._forget()
        codes = self.units.numbers(units)
        self._learn()
        ids, size = self.units.ids_of(codes)
        return ids, size, list(map(self.units.back.__getitem__, codes.tolist()))


def _unit_slices(text: str) -> Iterator[list[str]]:
    """The text's units, about SLICE_CHARS at a time; the last unit of a slice is found again in the next, whole."""
    at, width = 0, SLICE_CHARS
    while at < len(text):
        units = UNITS.findall(text, at, at + width)
        if at + width < len(text):
            if len(units) < 2:
                width *= 2
                continue
            units.pop()
        yield units
        at, width = at + sum(map(len, units)), SLICE_CHARS


_CODECS: dict[tuple[str, str], Codec] = {}


def codec(path: str, pattern: str) -> Codec:
    """One codec per worker process."""
    if (path, pattern) not in _CODECS:
        _CODECS[path, pattern] = Codec(path, pattern)
    return _CODECS[path, pattern]


def _round_trip(path: str, pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path, pattern)
        for batch in batches:
            sizes = np.asarray(pc.fill_null(pc.utf8_length(batch.column("text")), 0))
            ends = np.cumsum(sizes) // SLICE_CHARS
            for at in np.split(np.arange(len(sizes)), np.flatnonzero(ends[1:] != ends[:-1]) + 1):  # about a slice of text at a time
                if len(at):
                    part = batch.slice(at[0], len(at))
                    ids, counts, back = _encoded(c, part.column("text").to_pylist())
                    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
                    lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids, pa.int32()))
                    yield pa.RecordBatch.from_arrays([part.column("row"), lists, pa.array(back, pa.binary())], names=["row", "ids", "decoded"])

    return run


def _encoded(c: Codec, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """All ids of the texts, ids per text, decoded bytes per text."""
    ids, counts, back = [np.zeros(0, np.int32)], np.zeros(len(texts), np.int64), [b""] * len(texts)
    waiting: list[tuple[int, list[str]]] = []

    def flush() -> None:
        found, size, out = c.encode_units([u for _, units in waiting for u in units])
        ids.append(found)
        upto, at = np.concatenate([[0], np.cumsum(size)]), 0
        for k, units in waiting:
            counts[k] += upto[at + len(units)] - upto[at]
            back[k] += b"".join(out[at : at + len(units)])
            at += len(units)
        waiting.clear()

    chars = 0
    for k, text in enumerate(texts):
        for units in _unit_slices(text or ""):
            waiting.append((k, units))
            chars += SLICE_CHARS if len(text) > SLICE_CHARS else len(text)
            if chars >= 2 * SLICE_CHARS:
                flush()
                chars = 0
    if waiting:
        flush()
    return np.concatenate(ids), counts, back


def encode_decode(docs: DataFrame, path: str, pattern: str, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns (default all) + a struct ``__bpe``: ids array<int>, decoded binary."""
    keep = others(docs.columns if keep is None else keep, "__bpe")
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in keep)).alias("row"), F.col(text_col).cast("string").alias("text"))
    kind = T.StructType([rows.schema["row"], T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("decoded", T.BinaryType())])
    out = rows.mapInArrow(_round_trip(path, pattern), kind)
    return out.select("row.*", F.struct("ids", "decoded").alias("__bpe"))
