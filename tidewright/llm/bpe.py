"""Byte-level BPE encoding and decoding as a monoid tree reduction.

A text is cut in halves until its leaves are short. A leaf is encoded alone and
two neighbours are joined by encoding a window around the cut again, growing
it until the tokens outside provably stay as they are:

* Texts. A chunk is white space followed by other characters. No match of the
  pattern crosses from a character that is not white space to one that is, and
  no match looks beyond the end of such a run, so chunks are encoded apart from
  each other. The window is the last chunk before the cut and the first after.
* Pieces (matches of the pattern) of many bytes. A sequence of tokens is the
  encoding of its bytes exactly if each two neighbours are the encoding of
  theirs: the first merge across a border would also be the first in that pair.
  Inside both halves and inside the window this holds, so only the two pairs at
  the window's ends are tested; while one fails, the window grows.

Decoding concatenates up the same tree."""

from __future__ import annotations

import base64
import hashlib
from array import array
from collections.abc import Iterator
from itertools import accumulate, chain

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches

#: Characters of a leaf of a text, bytes of a leaf of a piece, tokens of a leaf in decoding.
TEXT_LEAF, PIECE_LEAF, DECODE_LEAF = 1 << 13, 32, 1 << 14
#: Encodings that a worker remembers; beyond that it forgets them all and begins anew.
REMEMBERED = 100_000
#: The characters that \s of the pattern matches.
SPACE = "\t-\r \x85\xa0  -     　"


def load_ranks(data: bytes) -> dict[bytes, int]:
    """Lines of base64 and rank, as in .tiktoken files."""
    return {base64.b64decode(a): int(b) for a, b in (line.split() for line in data.splitlines() if line.strip())}


class Codec:
    """Encoder and decoder for a table of ranks and a pattern that splits text into pieces."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, text_leaf: int = TEXT_LEAF, piece_leaf: int = PIECE_LEAF) -> None:
        import re

        import regex
        import tiktoken

        #: Merges the bytes of a leaf or window: the pair of lowest rank, the leftmost of equals, until none is left.
        self._merge = tiktoken.Encoding("leaf", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})._core_bpe.encode_single_piece
        self.ranks, self.text_leaf, self.piece_leaf = ranks, max(1, text_leaf), max(1, piece_leaf)
        self.bytes_of = {v: k for k, v in ranks.items()}
        self.pieces = regex.compile(pattern).findall
        self.chunks = re.compile(f"[{SPACE}]*[^{SPACE}]+|[{SPACE}]+").findall
        self.space = re.compile(f"[{SPACE}]").match
        self.known_pieces: dict[str, tuple[int, ...]] = {}
        self.known_chunks: dict[str, tuple[int, ...]] = {}
        self.known_pairs: dict[tuple[int, int], bool] = {}

    # pieces

    def _stay(self, a: int, b: int) -> bool:
        """Whether the tokens a and b are the encoding of their bytes."""
        out = self.known_pairs.get((a, b))
        if out is None:
            if len(self.known_pairs) >= REMEMBERED:
                self.known_pairs.clear()
            out = self.known_pairs[a, b] = self._merge(self.bytes_of[a] + self.bytes_of[b]) == [a, b]
        return out

    def _join(self, left: list[int], right: list[int]) -> list[int]:
        i = j = 0  # tokens of either side in the window
        window: list[int] = []
        while True:
            a = window[0] if window else right[0]
            b = window[-1] if window else left[-1]
            fits_left = i == len(left) or self._stay(left[-i - 1], a)
            fits_right = j == len(right) or self._stay(b, right[j])
            if fits_left and fits_right:
                return left[: len(left) - i] + window + right[j:]
            if not window:
                i = j = 1
            else:
                i = i if fits_left else min(len(left), 2 * i)
                j = j if fits_right else min(len(right), 2 * j)
            window = self._merge(b"".join(self.bytes_of[t] for t in left[len(left) - i :] + right[:j]))

    def _tree(self, data: bytes) -> list[int]:
        if len(data) <= self.piece_leaf:
            return self._merge(data)
        half = len(data) // 2
        return self._join(self._tree(data[:half]), self._tree(data[half:]))

    def piece(self, text: str) -> tuple[int, ...]:
        out = self.known_pieces.get(text)
        if out is None:
            data = text.encode()
            whole = self.ranks.get(data)
            out = (whole,) if whole is not None else tuple(self._tree(data))
            if len(data) <= 64:
                if len(self.known_pieces) >= REMEMBERED:
                    self.known_pieces.clear()
                self.known_pieces[text] = out
        return out

    # texts

    def _chunk(self, chunk: str) -> tuple[int, ...]:
        out = self.known_chunks.get(chunk)
        if out is None:
            out = tuple(chain.from_iterable(map(self.piece, self.pieces(chunk))))
            if len(chunk) <= 32:
                if len(self.known_chunks) >= REMEMBERED:
                    self.known_chunks.clear()
                self.known_chunks[chunk] = out
        return out

    def _node(self, text: str, start: int, end: int) -> tuple[list[str], list[tuple[int, ...]]]:
        """Chunks of a stretch of text and the tokens of each."""
        if end - start <= self.text_leaf:
            chunks = self.chunks(text[start:end])
            return chunks, [self._chunk(c) for c in chunks]
        half = (start + end) // 2
        chunks, tokens = self._node(text, start, half)
        after, more = self._node(text, half, end)
        if not self.space(text[half]) or self.space(text[half - 1]):  # the cut is inside a chunk
            chunks[-1] += after[0]
            tokens[-1] = self._chunk(chunks[-1])
            after, more = after[1:], more[1:]
        chunks += after
        tokens += more
        return chunks, tokens

    def encode(self, text: str) -> list[int]:
        return list(chain.from_iterable(self._node(text, 0, len(text))[1])) if text else []

    def decode(self, ids: list[int]) -> bytes:
        """The bytes of ids; an id that has no bytes is an error."""
        if len(ids) <= DECODE_LEAF:
            return b"".join(map(self.bytes_of.__getitem__, ids))
        half = len(ids) // 2
        return self.decode(ids[:half]) + self.decode(ids[half:])


_codecs: dict[tuple[bytes, str], Codec] = {}


def _codec(data: bytes, pattern: str) -> Codec:
    """One codec a worker for each table, so that what it remembers lasts over tasks."""
    key = hashlib.sha256(data).digest(), pattern
    if key not in _codecs:
        _codecs.clear()
        _codecs[key] = Codec(load_ranks(data), pattern)
    return _codecs[key]


def _sent(df: DataFrame, ranks_path: str):
    with open(ranks_path, "rb") as f:  # the driver's file; workers get its bytes
        return df.sparkSession.sparkContext.broadcast(f.read())


def encode(docs: DataFrame, ranks_path: str, pattern: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, ids array<int>) for each row; a null or empty text has no ids.
    Texts may be of any length; equal rows give equal results. Other columns
    are not read. An empty table gives an empty one."""
    sent = _sent(docs, ranks_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(sent.value, pattern)
        for b in batches:
            ids = [codec.encode(t.as_py() or "") for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(ids, pa.list_(pa.int32()))], names=["doc_id", "ids"])

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, "doc_id long, ids array<int>")


def decode(tokens: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """(doc_id, decoded binary) for each row of (doc_id, ids); null ids decode to no bytes."""
    sent = _sent(tokens, ranks_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(sent.value, pattern)
        for b in batches:
            out = [codec.decode(x.as_py() or []) for x in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.binary())], names=["doc_id", "decoded"])

    return tokens.select(F.col("doc_id").cast("long").alias("doc_id"), "ids").mapInArrow(run, "doc_id long, decoded binary")


def round_trip(docs: DataFrame, ranks_path: str, pattern: str, doc_id: str = "doc_id", text: str = "text", with_ids: bool = False) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): each text encoded, its
    ids decoded, and both digested, in one pass; with_ids: the ids too. A null
    or empty text has no ids, texts may be of any length, equal rows give equal
    results, other columns are not read, and an empty table gives an empty one."""
    small_batches(docs.sparkSession)
    sent = _sent(docs, ranks_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(sent.value, pattern)
        sha = lambda data: hashlib.sha256(data).hexdigest()
        for b in batches:
            n, digests, decoded, lists = [], [], [], []
            for t in b.column(1):
                ids = codec.encode(t.as_py() or "")
                n.append(len(ids))
                digests.append(sha(",".join(map(str, ids)).encode()))
                decoded.append(sha(codec.decode(ids)))
                if with_ids:
                    lists.append(array("i", ids))
            columns = [b.column(0), pa.array(n, pa.int64()), pa.array(digests, pa.string()), pa.array(decoded, pa.string())]
            if with_ids:
                flat = array("i")
                for x in lists:
                    flat.extend(x)
                offsets = pa.array([0, *accumulate(n)], pa.int32())
                columns.append(pa.ListArray.from_arrays(offsets, pa.Array.from_buffers(pa.int32(), len(flat), [None, pa.py_buffer(flat)])))
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids"][: len(columns)])

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids)
