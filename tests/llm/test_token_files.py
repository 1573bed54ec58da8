import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
from tokenizers import Tokenizer

from lexloom.llm import token_files
from lexloom.llm._shared import scratch_path
from tests.llm.cases import frame, rows

PATH = public_tokenizers.path("word_bpe_49k.json")


def ids_of(text):
    return Tokenizer.from_file(PATH).encode(text or "", add_special_tokens=False).ids + [2]


def test_round_trip_equals_the_library(spark):
    some = [r for r in rows() if r[0] is not None and len(r[1] or "") < 30_000]
    some = list({r[0]: r for r in some}.values())
    out_dir = scratch_path(spark, "t")
    token_files.write_token_files(frame(spark, some), out_dir, PATH, seq_len=64)
    got = {r.doc_id: r for r in token_files.read_token_files(spark, out_dir).collect()}
    at = 0
    for r in sorted(some):
        ids = ids_of(r[1])
        row = got[r[0]]
        assert (row.start, row.n_tokens, row.ids_crc32) == (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)


def test_sequences_have_one_length_and_bit_masks(spark):
    out_dir = scratch_path(spark, "t")
    manifest = token_files.write_token_files(frame(spark).coalesce(1), out_dir, PATH, seq_len=32)
    tokens = 0
    for r in manifest.collect():
        reader = token_files.open_shard(out_dir, r.file)
        assert reader.schema.field("input_ids").type == pa.list_(pa.uint16(), 32)
        for i in range(reader.num_record_batches):
            tokens += reader.get_batch(i).column("mask").flatten().true_count
    assert tokens == sum(len(ids_of(r[1])) for r in rows())


def test_nulls_repeats_and_empty_tables(spark):
    out_dir = scratch_path(spark, "t")
    token_files.write_token_files(frame(spark), out_dir, PATH)
    back = token_files.read_token_files(spark, out_dir).orderBy("start").collect()
    assert len(back) == len(rows()) and back[0].doc_id is None and back[0].start == 0
    empty = scratch_path(spark, "t")
    token_files.write_token_files(frame(spark, []), empty, PATH)
    assert token_files.read_token_files(spark, empty).count() == 0


def test_files_of_other_attempts_count_for_nothing(spark):
    from pathlib import Path

    out_dir = scratch_path(spark, "t")
    token_files.write_token_files(frame(spark), out_dir, PATH)
    root = Path(token_files.file_system(out_dir)[1])
    for file in list(root.glob("shard-*.arrow")):
        (root / file.name.replace(".arrow", "0.arrow")).write_bytes(file.read_bytes()[:100])
    assert token_files.read_token_files(spark, out_dir).count() == len(rows())


def test_word_memory_forgets_without_changing_results(monkeypatch):
    monkeypatch.setattr(token_files, "REMEMBERED", 20)
    encode = token_files.WordEncoder(PATH)
    for r in rows()[:30]:
        assert np.frombuffer(encode.encode([(r[1] or "").encode()])[0], encode.type).tolist() == ids_of(r[1])[:-1]


def test_words_are_looked_up_once_a_block(monkeypatch):
    looked = []

    class Counting(dict):
        def get(self, word, default=None):
            looked.append(word)
            return super().get(word, default)

        def __getitem__(self, word):
            looked.append(word)
            return super().__getitem__(word)

    encode = token_files.WordEncoder(PATH)
    encode.known = Counting()
    text = "of that, the\nother Of thing " * 1000
    packed = encode.encode([text.encode()] * 20)
    assert {tuple(np.frombuffer(x, encode.type)) for x in packed} == {tuple(ids_of(text)[:-1])}
    assert len(looked) < 100


def test_blocks_equal_the_library():
    texts = ["", None, " a  b", "x=y̸ z<|endoftext|>w,v", "a<", "|b", "été l'été don't!'s", "\t\n", "1,234.5-6 It's \x00 中文", "<|startoftext|>a,b", "a,b́ ,c"]
    data = pa.array(["left out", *texts, "left out"], pa.large_string()).cast(pa.large_binary()).fill_null(b"")
    encode = token_files.WordEncoder(PATH)
    for _ in range(3):
        ids, ends = encode.pack(data[1:-1], b"\2\0")
        assert [x.tolist() for x in np.split(ids, ends)[:-1]] == [ids_of(x) for x in texts]
    for data in (pa.array([], pa.large_binary()), pa.array([b""], pa.large_binary())):
        ids, ends = encode.pack(data)
        assert len(ids) == 0 and ends.tolist() == [0] * len(data)


def test_documents_run_on_across_batches_of_the_file():
    sink = pa.BufferOutputStream()
    writer = token_files.SequenceWriter(sink, np.dtype("<u2"), 2)
    sizes = [1, 3, 508, 512, 2000, 1, 7]
    ids = np.arange(sum(sizes), dtype="<u2")
    writer.add(pa.array([None, 1, 2, 3], pa.int64()), ids[:1024], np.cumsum(sizes[:4]))
    writer.add(pa.array([4, 5, 6], pa.int64()), ids[1024:], np.cumsum(sizes[4:]))
    writer.close()
    reader = pa.ipc.open_file(sink.getvalue())
    batches = [reader.get_batch(i) for i in range(reader.num_record_batches)]
    assert np.concatenate([b.column(0).flatten().to_numpy() for b in batches])[: len(ids)].tolist() == ids.tolist()
    assert [x for b in batches for x in b.column(2).flatten().to_pylist()] == [None, 1, 2, 3, 4, 5, 6]
    at = [2 * (i + 256 * k) + e for k, b in enumerate(batches) for i, ends in enumerate(b.column(3).to_pylist()) for e in ends]
    assert at == np.cumsum(sizes).tolist() and (writer.n_docs, writer.n_tokens) == (7, len(ids))
