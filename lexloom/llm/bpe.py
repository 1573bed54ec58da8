"""Byte-level BPE encoding and decoding with a segment tree over byte positions.

A piece of text starts as single bytes. Leaf i of the tree holds the rank of the pair that the token at byte i makes
with its live right neighbour, packed as rank * width + i, so the root is the leftmost minimum. A merge takes the
root, joins the pair, and updates the leaves of the joined token, of the swallowed one and of the left neighbour:
three point updates of logarithmic cost, whatever the piece's length.

Pieces are what the rank file's pattern matches. Texts are first cut where the pattern can never match across
(before a single space or other white space that precedes a word), and each distinct cut is encoded once per worker
and remembered up to a fixed number of bytes' worth of entries.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexloom.llm._shared import small_batches, table

#: White space as the public pattern means it (Unicode White_Space; Python's own class has four controls more).
SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: Cuts of a text that no match of the pattern crosses: Latin words before common punctuation, else runs up to white space.
CUT = re.compile(f" ?[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+(?=[.,;:!?{SPACE}]|\\Z)| ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")
#: Cuts that a worker remembers at most, in two generations, and their greatest length. A cut is remembered when it
#: comes a second time; one that did not come for a whole generation is forgotten.
REMEMBERED, LONGEST = 400_000, 64
#: Slots that tell whether a cut may have come before.
SLOTS = 1 << 22
NONE = 1 << 62

_codecs: dict[tuple[str, str], ByteBpe] = {}


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Token ids of one piece: lowest rank first, leftmost of equals, until no neighbouring pair has a rank."""
    n = len(piece)
    if n == 1:
        return [ranks[piece]]
    width = 1 << (n - 1).bit_length()
    get = ranks.get
    tree = [NONE] * (2 * width)
    for i in range(n - 1):
        rank = get(piece[i : i + 2])
        if rank is not None:
            tree[width + i] = rank * width + i
    for k in range(width - 1, 0, -1):
        a, b = tree[2 * k], tree[2 * k + 1]
        tree[k] = a if a < b else b
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    while tree[1] != NONE:
        i = tree[1] % width
        gone = after[i]
        end = after[i] = after[gone]
        changes = [(width + gone, NONE)]
        if end < n:
            before[end] = i
            rank = get(piece[i : after[end]])
            changes.append((width + i, NONE if rank is None else rank * width + i))
        else:
            changes.append((width + i, NONE))
        if i:
            left = before[i]
            rank = get(piece[left:end])
            changes.append((width + left, NONE if rank is None else rank * width + left))
        for k, value in changes:
            tree[k] = value
            while k > 1:
                other = tree[k ^ 1]
                if other < value:
                    value = other
                k >>= 1
                if tree[k] == value:
                    break
                tree[k] = value
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i : after[i]]])
        i = after[i]
    return out


class ByteBpe:
    """A codec of one rank file: lines of a base64 token and its rank."""

    def __init__(self, path: str, pattern: str):
        import regex

        with open(path, "rb") as file:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        self.tokens = {rank: token for token, rank in self.ranks.items()}
        self.pattern = regex.compile(pattern)
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.seen = bytearray(SLOTS)

    def piece_ids(self, piece: bytes) -> list[int]:
        rank = self.ranks.get(piece)
        return [rank] if rank is not None else merge(piece, self.ranks)

    def _cut_ids(self, cut: str) -> bytes:
        return np.array([i for piece in self.pattern.findall(cut) for i in self.piece_ids(piece.encode())], dtype="<i4").tobytes()

    def encode_array(self, text: str) -> np.ndarray:
        """Ids of a whole text as 32-bit integers, special tokens being ordinary text."""
        if len(self.known) > REMEMBERED // 2:
            self.known, self.older, self.seen = {}, self.known, bytearray(SLOTS)
        known, older, seen, out = self.known, self.older, self.seen, []
        for cut in CUT.findall(text):
            ids = known.get(cut)
            if ids is None:
                ids = older.get(cut)
                if ids is not None:
                    known[cut] = ids
                else:
                    ids = self._cut_ids(cut)
                    slot = hash(cut) % SLOTS
                    if seen[slot] and len(cut) <= LONGEST:
                        known[cut] = ids
                    seen[slot] = 1
            out.append(ids)
        return np.frombuffer(b"".join(out), dtype="<i4")

    def encode(self, text: str) -> list[int]:
        """encode_array() as a list."""
        return self.encode_array(text).tolist()

    def decode(self, ids: Iterable[int]) -> bytes:
        """The bytes of ids; an id that the file lacks raises."""
        return b"".join(map(self.tokens.__getitem__, ids))


def codec(path: str, pattern: str) -> ByteBpe:
    """The worker's codec for a rank file and pattern."""
    if (path, pattern) not in _codecs:
        _codecs[(path, pattern)] = ByteBpe(path, pattern)
    return _codecs[(path, pattern)]


def encode_udf(path: str, pattern: str):
    """Arrow UDF text -> array of ids; null gives an empty array."""

    @F.arrow_udf(T.ArrayType(T.IntegerType()))
    def encode(text: pa.Array) -> pa.Array:
        use = codec(path, pattern)
        rows = [use.encode_array(x.as_py() or "") for x in text]
        ends = np.cumsum([0, *map(len, rows)], dtype=np.int32)
        values = np.concatenate(rows) if rows else np.empty(0, dtype=np.int32)
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(values, pa.int32()))

    return encode


def decode_udf(path: str, pattern: str):
    """Arrow UDF array of ids -> bytes; null gives no bytes."""

    @F.arrow_udf(T.BinaryType())
    def decode(ids: pa.Array) -> pa.Array:
        use = codec(path, pattern)
        rows = (use.decode(x.values.to_numpy(zero_copy_only=False).tolist()) if x.is_valid else b"" for x in ids)
        return pa.array(rows, pa.binary())

    return decode


#: Texts whose ids a worker holds at once where results are streamed.
AT_ONCE = 500


def _digests(path: str, pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        use = codec(path, pattern)
        for batch in batches:
            for start in range(0, batch.num_rows, AT_ONCE):
                part, rows = batch.slice(start, AT_ONCE), []
                for text in part.column(1):
                    ids = use.encode(text.as_py() or "")
                    printed = hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
                    rows.append((len(ids), printed, hashlib.sha256(use.decode(ids)).hexdigest()))
                columns = [pa.array(x, t) for x, t in zip(zip(*rows, strict=True), (pa.int64(), pa.string(), pa.string()), strict=True)]
                yield pa.RecordBatch.from_arrays([part.column(0), *columns], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return run


def _ids(path: str, pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        use = codec(path, pattern)
        for batch in batches:
            for start in range(0, batch.num_rows, AT_ONCE):
                part = batch.slice(start, AT_ONCE)
                rows = [use.encode_array(x.as_py() or "") for x in part.column(0)]
                sizes = np.array([len(x) for x in rows], dtype=np.int64)
                ids = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), pa.array(np.concatenate(rows), pa.int32()))
                decoded = pa.array([hashlib.sha256(use.decode(x.tolist())).hexdigest() for x in rows], pa.string())
                fields = [*batch.schema.names[1:], "ids", "n_tokens", "decoded_sha256"]
                yield pa.RecordBatch.from_arrays([*part.columns[1:], ids, pa.array(sizes), decoded], names=fields)

    return run


def bpe_encode(docs: DataFrame, path: str, pattern: str, name: str = "ids") -> DataFrame:
    """docs with a column ``name``, in place of one so named: the ids (array of int) of each whole text.

    Null and empty texts have no ids; every row stays, repeated ones too, and so do other columns; an empty table stays so.
    """
    small_batches(docs.sparkSession)
    return docs.withColumn(name, encode_udf(path, pattern)("text"))


def bpe_decode(encoded: DataFrame, path: str, pattern: str, ids: str = "ids", name: str = "decoded") -> DataFrame:
    """encoded with a column ``name``, in place of one so named: the bytes (binary) of the column of ids.

    An id that the file lacks fails the query; null has no bytes; every row stays, and so do other columns.
    """
    small_batches(encoded.sparkSession)
    return encoded.withColumn(name, decode_udf(path, pattern)(ids))


def bpe_rows(docs: DataFrame, path: str, pattern: str, keep: list[str]) -> DataFrame:
    """The columns to keep of docs with ids (array of int), n_tokens, and the SHA-256 of the bytes that the ids decode to.

    Results are streamed in small parts, so a worker holds few texts' ids. Null counts as the empty text; repeated rows
    and null ids are harmless; an empty table gives an empty result. Columns to keep must not be named like the new ones.
    """
    small_batches(docs.sparkSession)
    kept = docs.select("text", *keep)
    new = "ids array<int>, n_tokens long, decoded_sha256 string"
    schema = T.StructType([*kept.schema.fields[1:], *T.StructType.fromDDL(new).fields])
    return kept.mapInArrow(_ids(path, pattern), schema)


def bpe_round_trip(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Per row of docs(doc_id, text): doc_id, n_tokens, and SHA-256 of the printed ids and of the decoded bytes.

    Encoding and decoding run one after the other on a worker, so ids never travel. Null counts as the empty text;
    repeated rows, null ids and extra columns are harmless; an empty table gives an empty result.
    """
    small_batches(docs.sparkSession)
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(_digests(path, pattern), schema)


def op6_bpe(spark, sf_dir: str) -> DataFrame:
    """Every document's ids and decoded bytes by the public 50k byte-level ranks, as digests."""
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe_round_trip(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)
