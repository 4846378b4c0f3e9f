"""Byte-level BPE by recursive DuckDB queries inside each partition.

The pattern splits a text into pieces. A piece that is a token of its own needs no merges; every other distinct piece of
a batch starts as its byte tokens. A recursive query then lists the token-position rows of each unfinished piece, joins
them with the merge table and contracts the piece's leftmost pair of minimum rank, until no pair of it merges. ``USING
KEY`` keeps one row for each piece, so memory is bounded by the pieces of a chunk. Ids of distinct pieces are kept in a
cache of bounded bytes in the Python worker; a text's ids are those of its pieces in order. Decoding joins each text's
ids with the vocabulary and concatenates the bytes by an aggregation ordered by position. No shuffle: rows are independent.

A very long piece goes through the same query as overlapping blocks, which takes time and memory linear in its length.
Tokens are an encoding exactly if each two neighbours are the encoding of their own bytes, so two blocks may be joined at
any token that both have at the same place; where they share none, the right block is encoded again from a boundary of
the left one, and if that differs too, all bytes so far at once.

Defined results: a null text counts as empty and has no ids; ids outside the vocabulary fail to decode (null); lone
surrogates count as question marks; texts of any length are encoded and decoded whole.
"""

from __future__ import annotations

import base64
import hashlib
import tempfile
from collections.abc import Iterator
from struct import pack

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docframe.llm.common import give_back, read_table

CHUNK_BYTES = 400_000
CHUNK_IDS = 500_000
#: Bytes of text that are split at once, and of pieces and ids that a Python worker keeps (with 250 bytes for each piece).
SPLIT_BYTES = 8_000_000
CACHE_BYTES = 240_000_000
#: Pieces longer than two steps are encoded in blocks of two steps, a step apart. A multiple of 3 and of many powers of 2,
#: so that blocks of a run of one character begin in step with its tokens.
STEP = 96

ENCODE = """
WITH RECURSIVE state(w, toks) USING KEY (w) AS (
  SELECT w, list(tok ORDER BY pos) FROM start GROUP BY w
  UNION
  SELECT s.w, list_concat(list_concat(s.toks[:b.i - 1], [b.merged]), s.toks[b.i + 2:])
  FROM state s JOIN (
    SELECT w, min(m.merged) AS merged, min(m.merged::BIGINT << 32 | i) & 4294967295 AS i
    FROM (SELECT w, unnest(toks) AS a, unnest(toks[2:]) AS b, generate_subscripts(toks, 1) AS i FROM state) p
    JOIN merges m ON m.a = p.a AND m.b = p.b
    GROUP BY w) b ON s.w = b.w)
SELECT w, toks FROM state"""

DECODE = """
SELECT w, string_agg(v.hex, '' ORDER BY i) AS bytes
FROM ids LEFT JOIN vocabulary v USING (id)
GROUP BY w HAVING count(*) = count(v.hex)"""


class Encoder:
    """One per Python worker and vocabulary. Queries take a ``part`` of the usual sizes and the cache a quarter at least, which costs time and saves memory."""

    _made: dict[tuple, Encoder] = {}

    @classmethod
    def of(cls, path: str, pattern: str, part: int = 1) -> Encoder:
        if (path, pattern, part) not in cls._made:
            cls._made[path, pattern, part] = cls(path, pattern, part)
        return cls._made[path, pattern, part]

    def __init__(self, path: str, pattern: str, part: int = 1):
        import pyarrow as pa
        import regex

        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
        self.pattern = regex.compile(pattern)
        self.bytes = np.array([self.ranks[bytes([i])] for i in range(256)], np.int32)
        merges = np.array([(self.ranks[t[:k]], self.ranks[t[k:]], r) for t, r in self.ranks.items() for k in range(1, len(t)) if t[:k] in self.ranks and t[k:] in self.ranks], np.int32).reshape(-1, 3)
        self.tables = {
            "merges": pa.table({"a": merges[:, 0], "b": merges[:, 1], "merged": merges[:, 2]}),
            "vocabulary": pa.table({"id": pa.array(self.ranks.values(), pa.int32()), "hex": [t.hex() for t in self.ranks]}),
        }
        self._db = None
        self.chunk_bytes, self.chunk_ids, self.split_bytes = CHUNK_BYTES // part, CHUNK_IDS // part, SPLIT_BYTES // part
        self.share = min(part, 4)  # of CACHE_BYTES
        self.size = {rank: len(token) for token, rank in self.ranks.items()}
        self.cache: dict[str, bytes] = {}
        self.held = 0

    @property
    def db(self):
        """The database with the merge table and the vocabulary, opened when it is asked for."""
        import duckdb

        if self._db is None:
            self._db = duckdb.connect(config={"threads": 1, "memory_limit": "400MB", "temp_directory": tempfile.gettempdir()})
            for name, table in self.tables.items():
                self._db.register("given", table)
                self._db.execute(f"CREATE TABLE {name} AS SELECT * FROM given")
                self._db.unregister("given")
        return self._db

    def release(self, forget: bool = False) -> None:
        """Close the database, which gives back the memory of its queries: a Python worker outlives its task. The cache stays unless told to ``forget``."""
        if forget:
            self.cache.clear()
            self.held = 0
        if self._db is not None:
            self._db.close()
            self._db = None
        give_back()

    def merge(self, pieces: list[bytes]) -> list[list[int]]:
        """Ids of pieces that are no tokens themselves."""
        blocks = [(k, start, p[start : start + 2 * STEP]) for k, p in enumerate(pieces) for start in range(0, max(1, len(p) - STEP), STEP)]
        distinct = sorted({b for _, _, b in blocks})
        found = dict(zip(distinct, self._merge(distinct), strict=True))
        out: list[list[int]] = [[] for _ in pieces]
        for k, start, block in blocks:
            if start:
                self._stitch(pieces[k], out[k], start + STEP, found[block], start, start + len(block))
            else:
                out[k] = list(found[block])
        return out

    def _stitch(self, piece: bytes, left: list[int], left_end: int, right: list[int], start: int, end: int) -> None:
        """Extend ``left``, the ids of ``piece[:left_end]``, to those of ``piece[:end]``; ``right`` has those of ``piece[start:end]``."""
        places, at = {}, start
        for i, t in enumerate(right):
            places[at] = (t, i)
            at += self.size[t]
        at = left_end
        for j in range(len(left) - 1, -1, -1):
            at -= self.size[left[j]]
            if at < start:
                break
            t, i = places.get(at, (None, 0))
            if t == left[j]:
                left[j + 1 :] = right[i + 1 :]
                return
        at, j = left_end, len(left)
        while j > 1 and left_end - at < STEP // 2:
            j -= 1
            at -= self.size[left[j]]
        again = self._merge([piece[at:end]])[0]
        if again[0] == left[j]:
            left[j:] = again
        else:
            left[:] = self._merge([piece[:end]])[0]

    def _merge(self, pieces: list[bytes]) -> list[list[int]]:
        import pyarrow as pa

        out: list[list[int]] = [[]] * len(pieces)
        at = 0
        while at < len(pieces):
            end, size = at, 0
            while end < len(pieces) and (end == at or size + len(pieces[end]) <= self.chunk_bytes):
                size += len(pieces[end])
                end += 1
            lengths = np.fromiter((len(p) for p in pieces[at:end]), np.int64, end - at)
            starts = np.repeat(np.cumsum(lengths) - lengths, lengths)
            table = pa.table({"w": np.repeat(np.arange(at, end, dtype=np.int32), lengths), "pos": (np.arange(size) - starts).astype(np.int32), "tok": self.bytes[np.frombuffer(b"".join(pieces[at:end]), np.uint8)]})
            self.db.register("start", table)
            for w, toks in self.db.execute(ENCODE).fetchall():
                out[w] = toks
            self.db.unregister("start")
            at = end
        return out

    def join(self, ids: list[np.ndarray]) -> list[bytes | None]:
        """Bytes of arrays of ids; None where an id is unknown."""
        import pyarrow as pa

        parts = [(k, row[at : at + self.chunk_ids]) for k, row in enumerate(ids) for at in range(0, len(row), self.chunk_ids)]
        out: list[list[bytes | None]] = [[] for _ in ids]
        first = 0
        while first < len(parts):
            last, size = first, 0
            while last < len(parts) and (last == first or size + len(parts[last][1]) <= self.chunk_ids):
                size += len(parts[last][1])
                last += 1
            lengths = np.fromiter((len(row) for _, row in parts[first:last]), np.int64, last - first)
            self.db.register("ids", pa.table({"w": np.repeat(np.arange(last - first), lengths), "i": np.arange(size), "id": np.concatenate([row for _, row in parts[first:last]]).astype(np.int32)}))
            found = dict(self.db.execute(DECODE).fetchall())
            self.db.unregister("ids")
            for w, (k, _) in enumerate(parts[first:last]):
                out[k].append(bytes.fromhex(found[w]) if w in found else None)
            first = last
        return [None if None in x else b"".join(x) for x in out]

    def learn(self, pieces: set[str]) -> None:
        """Put the ids of pieces into the cache."""
        new = pieces.difference(self.cache)
        if not new:
            return
        if self.held > CACHE_BYTES // self.share:
            self.cache.clear()
            self.held = 0
            new = pieces
        ordered = sorted(new)
        raw = [p.encode("utf-8", "replace") for p in ordered]
        rest = [k for k, r in enumerate(raw) if r not in self.ranks]
        merged = dict(zip(rest, self.merge([raw[k] for k in rest]), strict=True))
        for k, piece in enumerate(ordered):
            ids = merged[k] if k in merged else [self.ranks[raw[k]]]
            self.cache[piece] = pack(f"<{len(ids)}I", *ids)
            self.held += 250 + 2 * len(raw[k]) + 4 * len(ids)

    def encode(self, texts: list[str | None]) -> Iterator[np.ndarray]:
        """Ids of each text."""
        at = 0
        while at < len(texts):
            split, seen, size = [], set(), 0
            while at < len(texts) and size < self.split_bytes:
                split.append(self.pattern.findall(texts[at] or ""))
                seen.update(split[-1])
                size += len(texts[at] or "")
                at += 1
            self.learn(seen)
            for pieces in split:
                yield np.frombuffer(b"".join([self.cache[p] for p in pieces]), "<u4")

    def texts(self, texts: list[str | None]) -> Iterator[tuple[np.ndarray, bytes | None]]:
        """Ids of each text and the bytes that they decode to."""
        group: list[np.ndarray] = []
        size = 0
        for ids in self.encode(texts):
            group.append(ids)
            size += len(ids)
            if size >= self.chunk_ids:
                yield from zip(group, self.join(group), strict=True)
                group, size = [], 0
        yield from zip(group, self.join(group), strict=True)

    def checked(self, batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        """Ids of each text and whether they decode to its own bytes. Between batches the memory of the queries is given back, at the end all of it."""
        try:
            for texts in batches:
                rows = [(ids.astype(np.int32), raw == (t or "").encode("utf-8", "replace")) for t, (ids, raw) in zip(texts, self.texts(texts.tolist()), strict=True)]
                self.release()
                yield pd.DataFrame(rows, columns=["ids", "decodes"])
        finally:
            self.release(forget=True)


def vocabulary() -> tuple[str, str]:
    """Path and pattern of the default vocabulary, a public file that is read where it is installed."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


def encode_column(text: Column, path: str, pattern: str) -> Column:
    """array<int> of token ids."""

    @F.pandas_udf("array<int>")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoder = Encoder.of(path, pattern)
        try:
            for texts in batches:
                yield pd.Series([ids.astype(np.int32) for ids in encoder.encode(texts.tolist())], dtype=object)
        finally:
            encoder.release()

    return of(text)


def checked_column(text: Column, path: str, pattern: str) -> Column:
    """struct(ids, decodes): the ids, and whether they decode to the text's own bytes; one Python worker does both.

    It is made for a pipeline, whose other stages need the executors' memory: small queries that leave nothing behind a batch, a small cache, and nothing is kept after a task.
    """

    @F.pandas_udf("ids array<int>, decodes boolean")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        yield from Encoder.of(path, pattern, part=16).checked(batches)

    return of(text)


def decode_column(ids: Column, path: str, pattern: str) -> Column:
    """Bytes of arrays of ids; null where the array is null or holds an unknown id."""

    @F.pandas_udf("binary")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoder = Encoder.of(path, pattern)
        try:
            for rows in batches:
                known = [i for i, x in enumerate(rows) if x is not None]
                out: list[bytes | None] = [None] * len(rows)
                for i, b in zip(known, encoder.join([np.asarray(rows.iloc[i], np.int64) for i in known]), strict=True):
                    out[i] = b
                yield pd.Series(out, dtype=object)
        finally:
            encoder.release()

    return of(ids)


def digest_column(text: Column, path: str, pattern: str) -> Column:
    """struct(n_tokens, ids_sha256, decoded_sha256)."""

    @F.pandas_udf("n_tokens long, ids_sha256 string, decoded_sha256 string")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        encoder = Encoder.of(path, pattern)
        try:
            for texts in batches:
                rows = [(len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256(raw).hexdigest()) for ids, raw in encoder.texts(texts.tolist())]
                yield pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])
        finally:
            encoder.release()

    return of(text)


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", digest_column(F.col("text"), *vocabulary()).alias("d"))
    return docs.select("doc_id", "d.*")


QUERIES = {"op7_bpe": op7_bpe}
ORACLE_SQL: dict[str, str] = {}
