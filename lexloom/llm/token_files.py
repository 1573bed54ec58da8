"""Token ids as Arrow files of fixed-size-list batches.

Layout: one Arrow IPC file per shard, shards numbered in ascending doc_id order. A row is one sequence:
``input_ids`` fixed_size_list<uint16 or uint32>[seq_len], ``mask`` fixed_size_list<bool>[seq_len] (false for padding),
``doc_ids`` list<int64>, the documents that end in the sequence, in order, and ``doc_ends`` list<int32>, where.
Every sequence has the same length and the file format keeps batch offsets in its footer, so a memory-mapped reader
reaches sequence i, ids and mask, without copying or parsing what lies before it. Documents run on across sequences;
only the last sequence of a shard is padded.

Scale: texts are dealt out by ranges of doc_id (one shuffle of the raw texts; the ids are made after it, once), each
attempt of a task streams its range into a file of its own name. The manifest, which Spark commits once per task, names
the files that count, so retried and speculative attempts need no renaming; files that it doesn't name are leftovers.
Files go to the folder that driver and executors share, through Arrow's file systems.
"""

from __future__ import annotations

import os
import re
import string
import uuid
import zlib
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexloom.llm._shared import scratch_path, table

SEQ_LEN = 2048
ROWS = 256
#: Words whose ids a worker remembers at most, in two generations. A word is remembered when it comes a second time;
#: one that did not come for a whole generation is forgotten.
REMEMBERED = 700_000
#: Slots that tell whether a word may have come before.
SLOTS = 1 << 22
#: Bytes of text that are split at once; the last text may go beyond.
BLOCK = 8 << 20


def _bytes(members: bytes) -> np.ndarray:
    """Whether each byte is a member."""
    return np.isin(np.arange(256), list(members))


_SPACE = _bytes(b" \t\n\r\x0b\x0c")
#: Where an ASCII letter or digit meets other ASCII punctuation than an apostrophe, pieces end, so texts can be cut there.
_ALNUM = _bytes(string.ascii_letters.encode() + string.digits.encode())
_PUNCT = _bytes(string.punctuation.replace("'", "").encode())
#: How a special token may begin; texts with it are not cut further than at white space.
_SPECIAL = b"<|"

_encoders: dict[tuple, WordEncoder] = {}


def offsets(texts: pa.LargeBinaryArray) -> np.ndarray:
    """Where each text begins in the array's bytes, and where the last one ends."""
    if not len(texts):
        return np.zeros(1, dtype=np.int64)
    return np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]


def split_words(texts: pa.LargeBinaryArray) -> tuple[pa.LargeBinaryArray, np.ndarray]:
    """The words of all texts in a row, and how many there are up to the end of each text."""
    at = offsets(texts)
    text = np.frombuffer(texts.buffers()[2] or b"", dtype=np.uint8)[at[0] : at[-1]]
    at = at - at[0]
    space = _SPACE[text]
    cut = _ALNUM[text[:-1]] & _PUNCT[text[1:]]
    special = np.flatnonzero((text[:-1] == _SPECIAL[0]) & (text[1:] == _SPECIAL[1]))
    for i in np.unique(np.searchsorted(at, special, side="right") - 1):
        cut[at[i] : at[i + 1]] = False
    first = np.ones(len(text), dtype=bool)
    first[1:] = space[:-1] | cut
    first[at[at < len(text)]] = True
    first &= ~space
    upto = np.searchsorted(np.flatnonzero(first), at[1:])
    kept = text[~space]
    starts = np.append(np.flatnonzero(first[~space]), len(kept))
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts) - 1, [None, pa.py_buffer(starts), pa.py_buffer(kept)])
    return words, upto


class WordEncoder:
    """Ids of whole texts by a tokenizer file of the tokenizers library whose pre-tokenizer splits at white space.

    A text's ids are those of its ASCII-white-space-separated parts in order, so each distinct part is encoded by
    the library once and remembered.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.type = np.dtype("<u2") if self.tokenizer.get_vocab_size() <= 1 << 16 else np.dtype("<u4")
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        self.seen = bytearray(SLOTS)

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Packed little-endian ids of each UTF-8 text."""
        ids, ends = self.pack(pa.array(texts, pa.large_binary()))
        return [x.tobytes() for x in np.split(ids, ends)[:-1]]

    def pack(self, texts: pa.LargeBinaryArray, end: bytes = b"") -> tuple[np.ndarray, np.ndarray]:
        """Ids of all UTF-8 texts in a row, the packed ids ``end`` behind each text's, and where each text's end.

        Words are split, told apart and replaced by their ids as whole arrays; only distinct ones become objects.
        """
        words, upto = split_words(texts)
        coded = words.dictionary_encode()
        packed = self._packed(coded.dictionary.to_numpy(zero_copy_only=False).tolist())
        places = np.insert(coded.indices.to_numpy(), upto, len(packed))
        found = pa.array([*packed, end], pa.large_binary()).take(pa.array(places))
        at = offsets(found)[np.insert(upto + np.arange(1, len(upto) + 1), 0, 0)] // self.type.itemsize
        return np.frombuffer(found.buffers()[2] or b"", dtype=self.type, count=at[-1]), at[1:]

    def _packed(self, words: list[bytes]) -> list[bytes]:
        """Packed ids of distinct words."""
        if len(self.known) > REMEMBERED // 2:
            self.known, self.older, self.seen = {}, self.known, bytearray(SLOTS)
        known, older, seen = self.known, self.older, self.seen
        out = list(map(known.get, words))
        new = []
        for i in [i for i, x in enumerate(out) if x is None]:
            if (x := older.get(words[i])) is None:
                new.append(i)
            else:
                known[words[i]] = out[i] = x
        for i, x in zip(new, self._word_ids([words[i] for i in new]), strict=True):
            out[i] = x
            slot = hash(words[i]) % SLOTS
            if seen[slot]:
                known[words[i]] = x
            seen[slot] = 1
        return out

    def _word_ids(self, words: list[bytes]) -> list[bytes]:
        """Ids of single words. Words of letters only are one piece each, so they are encoded many at a time: a piece
        ends where a token ends a word."""
        texts = [w.decode("utf-8", "replace") for w in words]
        out: list[bytes] = [b""] * len(words)
        plain = [i for i, t in enumerate(texts) if t.isalpha()] if self.ends.any() else []
        parts = [plain[start : start + 64] for start in range(0, len(plain), 64)]
        for start in range(0, len(parts), 64):
            some = parts[start : start + 64]
            found = self.tokenizer.encode_batch_fast([" ".join([texts[i] for i in part]) for part in some], add_special_tokens=False)
            for part, e in zip(some, found, strict=True):
                ids = np.array(e.ids, dtype=self.type)
                cuts = np.flatnonzero(self.ends[ids]) + 1
                if len(cuts) == len(part):
                    raw, size, at = ids.tobytes(), self.type.itemsize, 0
                    for i, cut in zip(part, cuts.tolist(), strict=True):
                        out[i] = raw[at : cut * size]
                        at = cut * size
        left = [i for i, x in enumerate(out) if not x]
        for start in range(0, len(left), 4096):
            part = left[start : start + 4096]
            found = self.tokenizer.encode_batch_fast([texts[i] for i in part], add_special_tokens=False)
            for i, e in zip(part, found, strict=True):
                out[i] = np.array(e.ids, dtype=self.type).tobytes()
        return out


def encoder(path: str) -> WordEncoder:
    """The worker's encoder for a tokenizer file."""
    if (path,) not in _encoders:
        _encoders[(path,)] = WordEncoder(path)
    return _encoders[(path,)]


def file_system(uri: str) -> tuple[pafs.FileSystem, str]:
    """Arrow's file system and path for a folder named as Spark names it."""
    if "://" not in uri and not uri.startswith("file:"):
        return pafs.LocalFileSystem(), uri
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), re.sub(r"^file:/+", "/", uri)
    return pafs.FileSystem.from_uri(uri)


def sequence_schema(dtype: np.dtype, seq_len: int) -> pa.Schema:
    ids = pa.uint16() if dtype.itemsize == 2 else pa.uint32()
    return pa.schema([("input_ids", pa.list_(ids, seq_len)), ("mask", pa.list_(pa.bool_(), seq_len)), ("doc_ids", pa.list_(pa.int64())), ("doc_ends", pa.list_(pa.int32()))])


class SequenceWriter:
    """Streams documents' ids into one Arrow file; holds one batch of sequences at most."""

    def __init__(self, sink, dtype: np.dtype, seq_len: int):
        self.schema, self.dtype, self.seq_len = sequence_schema(dtype, seq_len), dtype, seq_len
        self.out = pa.ipc.new_file(sink, self.schema)
        self.ids = np.zeros(ROWS * seq_len, dtype=dtype)
        self.filled, self.doc_ids, self.ends = 0, [], []
        self.n_docs = self.n_tokens = 0

    def add(self, doc_ids: pa.Array, ids: np.ndarray, ends: np.ndarray) -> None:
        """Appends documents of at least one id each: the ids of all in a row, and where each document's end."""
        self.n_docs += len(doc_ids)
        self.n_tokens += len(ids)
        done = told = 0
        while done < len(ids):
            n = min(len(ids) - done, len(self.ids) - self.filled)
            self.ids[self.filled : self.filled + n] = ids[done : done + n]
            upto = int(np.searchsorted(ends, done + n, side="right"))
            self.doc_ids += doc_ids[told:upto].to_pylist()
            self.ends += (ends[told:upto] - done + self.filled).tolist()
            self.filled += n
            done, told = done + n, upto
            if self.filled == len(self.ids):
                self.flush()

    def flush(self) -> None:
        rows = -(-self.filled // self.seq_len)
        if rows:
            used = rows * self.seq_len
            ends = np.array(self.ends, dtype=np.int32)
            rows_of = (ends - 1) // self.seq_len
            at = pa.array(np.searchsorted(rows_of, np.arange(rows + 1)), pa.int32())
            doc_ids = pa.ListArray.from_arrays(at, pa.array(self.doc_ids, pa.int64()))
            doc_ends = pa.ListArray.from_arrays(at, pa.array((ends - rows_of * self.seq_len).astype(np.int32)))
            mask = pa.array(np.arange(used) < self.filled)
            arrays = [pa.FixedSizeListArray.from_arrays(x, self.seq_len) for x in (pa.array(self.ids[:used].copy()), mask)]
            self.out.write_batch(pa.RecordBatch.from_arrays([*arrays, doc_ids, doc_ends], schema=self.schema))
        self.ids[:] = 0
        self.filled, self.doc_ids, self.ends = 0, [], []

    def close(self) -> None:
        self.flush()
        self.out.close()


def _write_shards(out_dir: str, tokenizer: str, end_id: int, seq_len: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        encode = encoder(tokenizer)
        end = np.array([end_id], dtype=encode.type).tobytes()
        shard = TaskContext.get().partitionId()
        fs, root = file_system(out_dir)
        fs.create_dir(root, recursive=True)
        name = f"shard-{shard:06d}-{uuid.uuid4().hex}.arrow"
        with fs.open_output_stream(f"{root}/{name}") as sink:
            writer = SequenceWriter(sink, encode.type, seq_len)
            for batch in batches:
                texts = batch.column(1).cast(pa.binary()).cast(pa.large_binary()).fill_null(b"")
                at = offsets(texts)
                cuts = np.unique([0, *np.searchsorted(at, np.arange(at[0], at[-1], BLOCK)), len(texts)]).tolist()
                for start, stop in pairwise(cuts):
                    writer.add(batch.column(0)[start:stop], *encode.pack(texts[start:stop], end))
            writer.close()
        yield pa.RecordBatch.from_pydict({"shard": [shard], "file": [name], "n_docs": [writer.n_docs], "n_tokens": [writer.n_tokens]})

    return run


def write_token_files(docs: DataFrame, out_dir: str, tokenizer: str, end_id: int = 2, seq_len: int = SEQ_LEN) -> DataFrame:
    """Writes docs(doc_id, text) below out_dir, which must be new; returns the manifest: shard, file, n_docs, n_tokens.

    Documents go by ascending doc_id, null ids first, rows of one id by a hash of their text and then the text. A
    null or empty text is the end id alone. An empty table writes shards without sequences. Extra columns are ignored.
    """
    spark = docs.sparkSession
    n = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text").asc()]
    ranged = docs.select(F.col("doc_id").cast("long"), "text").repartitionByRange(n, *order).sortWithinPartitions(*order, "text")
    manifest = ranged.mapInArrow(_write_shards(out_dir, tokenizer, end_id, seq_len), "shard long, file string, n_docs long, n_tokens long")
    manifest.write.parquet(f"{out_dir}/manifest")
    return spark.read.parquet(f"{out_dir}/manifest")


def open_shard(out_dir: str, file: str) -> pa.ipc.RecordBatchFileReader:
    """Random access to the sequences of one of the manifest's files; memory-mapped where the folder is a local one."""
    fs, root = file_system(out_dir)
    path = f"{root}/{file}"
    return pa.ipc.open_file(pa.memory_map(path) if isinstance(fs, pafs.LocalFileSystem) else fs.open_input_file(path))


def shard_documents(out_dir: str, file: str) -> Iterator[tuple[int | None, list[np.ndarray]]]:
    """(doc_id, pieces of its ids as uint32) of one file in its order, batch by batch."""
    reader = open_shard(out_dir, file)
    pending: list[np.ndarray] = []
    for i in range(reader.num_record_batches):
        batch = reader.get_batch(i)
        length = batch.schema.field("input_ids").type.list_size
        # padding only follows the last token
        ids = batch.column(0).flatten().to_numpy()[: batch.column(1).flatten().true_count].astype("<u4")
        sizes = np.diff(batch.column(3).offsets.to_numpy())
        ends = batch.column(3).flatten().to_numpy() + np.repeat(np.arange(len(sizes)) * length, sizes)
        begin = 0
        for doc_id, end in zip(batch.column(2).flatten().to_pylist(), ends, strict=True):
            yield doc_id, [*pending, ids[begin:end]]
            pending, begin = [], end
        if begin < len(ids):
            pending.append(ids[begin:])


def _read_shards(out_dir: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                rows: list[tuple] = []
                for doc_id, parts in shard_documents(out_dir, file):
                    n, crc = sum(map(len, parts)), 0
                    for x in parts:
                        crc = zlib.crc32(x, crc)
                    rows.append((doc_id, start, n, crc))
                    start += n
                    if len(rows) == 10_000:
                        yield _rows(rows)
                        rows = []
                yield _rows(rows)

    return run


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    names = ["doc_id", "start", "n_tokens", "ids_crc32"]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.int64()) for i in range(4)], names=names)


def read_token_files(spark: SparkSession, out_dir: str) -> DataFrame:
    """One row per document of the files below out_dir: doc_id, start, n_tokens, ids_crc32, all read from the files.

    The manifest has a row per shard; starts of shards are its running sums.
    """
    manifest = spark.read.parquet(f"{out_dir}/manifest")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    starts = manifest.select("file", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("start"))
    dealt = starts.repartition(max(1, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    return dealt.mapInArrow(_read_shards(out_dir), "doc_id long, start long, n_tokens long, ids_crc32 long")


def op3_token_files(spark, sf_dir: str) -> DataFrame:
    """Every document's place, length and checksum as read back from its token files."""
    import public_tokenizers

    out_dir = scratch_path(spark, "token-files")
    write_token_files(table(spark, sf_dir, "documents"), out_dir, public_tokenizers.path("word_bpe_49k.json"))
    return read_token_files(spark, out_dir)
