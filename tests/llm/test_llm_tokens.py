"""Token files and packing against the tokenizers library and plain checks."""
import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_cases import edge_rows, empty, frame
from tokenizers import Tokenizer

from ledgerlens.llm import packing, token_files, tokenise
from ledgerlens.llm.tokenise import tokenizer_file

WORD, BYTE = "word_bpe_49k.json", "byte_bpe_50k.json"


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2**32 - 1), max_size=30), max_size=8))
def test_codec_round_trip(documents):
    counts = np.array([len(d) for d in documents], np.int64)
    numbers = np.array([x for d in documents for x in d], np.uint32)
    control, data = token_files.pack(numbers, counts)
    back = token_files.unpack(np.frombuffer(b"".join(control), np.uint8), np.frombuffer(b"".join(data), np.uint8), counts)
    assert back.tolist() == numbers.tolist()
    assert [len(c) for c in control] == [(n + 3) // 4 for n in counts]


def expected(name, rows, end):
    ids = Tokenizer.from_file(tokenizer_file(name)).encode_batch([r[1] or "" for r in rows], add_special_tokens=False)
    return [(r[0], x.ids + [end]) for r, x in zip(rows, ids)]


def test_token_files_hold_all_ids_in_order(spark):
    for name, split in ((WORD, "drop"), (BYTE, "lead"), (BYTE, "whole")):
        rows = edge_rows()
        files = token_files.write_token_files(frame(spark, rows), name, 1, split)
        got = token_files.read_token_files(files).collect()
        want = expected(name, rows, 1)
        key = lambda x: (x[0] is not None, x[0] or 0, x[1])
        assert sorted(((r["doc_id"], np.frombuffer(r["ids"], "<u4").tolist()) for r in got), key=key) == sorted(want, key=key)
        got.sort(key=lambda r: r["start"])
        at = 0
        for r in got:
            assert r["start"] == at
            at += r["n_tokens"]
        ids = [r["doc_id"] for r in got]
        assert ids == sorted(ids, key=lambda x: (x is not None, x or 0))
        crc = {r["start"]: r["ids_crc32"] for r in token_files.with_crc(token_files.read_token_files(files)).collect()}
        assert all(crc[r["start"]] == zlib.crc32(r["ids"]) for r in got)


def test_whole_latin_texts_are_cut_as_the_tokenizers_do():
    every = [chr(i) for i in range(1, 256)]
    texts = ["".join(every) * 2, " ".join(every), "  ".join(every), "\n".join(every), "don't they'LL it's \"'s\" y's 'x '", "a\n\nb c \t d", " a" * 5 + "\u2019s", "x\x1c y\x1f\n\n z \xa0 \xa0q", "12,5\xb2 \xbd", "<|endoftext|>, x <|startoftext|>. <|", "\u0130.a \ufb01,x e\u0301", ""]
    rnd = np.random.default_rng(3)
    texts += ["".join(rnd.choice(["a", "Éx", " ", "'", "s", "\n", "4", ",", "\xa0", "!"], 40)) for _ in range(300)]
    for name, split in ((WORD, "drop"), (BYTE, "lead")):
        enc = tokenise.Encoder(name, split)
        want = expected(name, [(i, t) for i, t in enumerate(texts)], 7)
        assert [np.frombuffer(x, enc.dtype).tolist() for x in enc.encode(texts)] == [ids[:-1] for _, ids in want]


def test_bounded_memory_changes_no_ids(monkeypatch):
    monkeypatch.setattr(tokenise, "PIECES_KEPT", 3)
    texts = ["one two three four five one six two", "six five four one", "two seven"] * 3
    enc = tokenise.Encoder(WORD, "drop")
    assert [np.frombuffer(x, enc.dtype).tolist() for x in enc.encode(texts)] == [ids[:-1] for _, ids in expected(WORD, list(enumerate(texts)), 7)]
    assert len(enc.pieces) <= 3


def test_one_id_with_most_rows_fills_many_segments(spark, monkeypatch):
    monkeypatch.setattr(token_files, "SHARD_TOKENS", 40)
    monkeypatch.setattr(token_files, "READ_TOKENS", 30)
    rows = [(i % 5 if i % 2 else 7, f"word{i} the of", "en", "a", 10) for i in range(200)] + [(7, "the of", "en", "a", 10)] * 5
    files = token_files.write_token_files(frame(spark, rows), WORD, 1, "drop")
    shards = {}
    for x in files.manifest.collect():
        shards.setdefault(x["file"][:14], []).append(x["n_docs"])
    assert len(shards) > 12 and max(map(sum, shards.values())) < 60
    got = sorted(token_files.read_token_files(files).collect(), key=lambda x: x["start"])
    assert sorted((x["doc_id"], np.frombuffer(x["ids"], "<u4").tolist()) for x in got) == sorted(expected(WORD, rows, 1))
    assert [x["doc_id"] for x in got] == sorted(x["doc_id"] for x in got)
    assert [x["start"] for x in got] == [0, *np.cumsum([x["n_tokens"] for x in got])[:-1].tolist()]


def test_files_are_read_by_one_python_pass(spark):
    files = token_files.write_token_files(frame(spark, edge_rows()), WORD, 1, "drop")
    found = token_files.with_crc(token_files.read_token_files(files))
    assert dict(found.dtypes) == {"doc_id": "bigint", "start": "bigint", "n_tokens": "bigint", "ids_crc32": "bigint"}
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") - files.manifest._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1


def test_frequent_ids_take_one_byte(spark):
    files = token_files.write_token_files(frame(spark, [(i, "the of the", "en", "a", 10) for i in range(9)]), WORD, 1, "drop")
    from ledgerlens.llm.common import filesystem

    store, base = filesystem(files.folder)
    with store.open_input_stream(f"{base}/ranks.u32") as f:
        ranks = np.frombuffer(f.read(), "<u4")
    the = Tokenizer.from_file(tokenizer_file(WORD)).encode("the", add_special_tokens=False).ids
    assert ranks[0] == the[0]


def test_empty_tables(spark):
    assert token_files.read_token_files(token_files.write_token_files(empty(spark), WORD, 1, "drop")).count() == 0
    assert packing.pack(packing.pieces(empty(spark), BYTE, 0, 2048, "lead"), 2048).count() == 0


def check_packing(rows, capacity):
    bins = {}
    for r in rows:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for members in bins.values():
        at = 0
        for offset, length in sorted(members):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins)


def test_pieces_and_sequences(spark):
    rows, capacity = edge_rows(), 64
    got = packing.pack(packing.pieces(frame(spark, rows), BYTE, 0, capacity, "lead"), capacity, block_pieces=24).collect()
    want = []
    for key, ids in expected(BYTE, rows, 0):
        cuts = [0, *range(len(ids) % capacity or capacity, len(ids) + 1, capacity)]
        want += [(key, i, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())) for i, (a, b) in enumerate(zip(cuts, cuts[1:]))]
    key = lambda x: (x[0] is not None, x[0] or 0, *x[1:])
    assert sorted(((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got), key=key) == sorted(want, key=key)
    least = -(-sum(w[3] for w in want) // capacity)
    assert check_packing(got, capacity) <= least + 2


def test_many_blocks_meet_in_later_levels(spark):
    rnd = np.random.default_rng(5)
    lengths = [int(x) for x in rnd.integers(1, 400, 6000)] + [1100] * 50
    parts = spark.createDataFrame([(i, n) for i, n in enumerate(lengths)], "doc_id BIGINT, length BIGINT")
    got = packing.pack(parts, 2048, block_pieces=512).collect()
    assert sorted((r["doc_id"], r["length"]) for r in got) == sorted(enumerate(lengths))
    assert check_packing(got, 2048) <= -(-sum(lengths) // 2048) + 3


def test_genetic_steps_keep_every_item():
    rnd = np.random.default_rng(1)
    packer = packing.Packer(rnd.integers(200, 900, 120), 1000, 7)
    plain = packer.first(0)
    population = packer.evolve([], 4, 20)
    child = packer.mutate(packer.cross(packer.first(1), packer.first(2)))
    for bins in (plain, child, *population):
        assert sorted(i for b in bins for i in b) == list(range(120))
        assert max(packer.used(b) for b in bins) <= 1000
    assert len(population[0]) <= len(plain)
    tight = packing.Packer(np.array([6, 6, 5, 5, 5, 4, 4, 4, 4, 2, 2, 3]), 10, 1)  # best: five whole bins
    assert len(tight.evolve([], 4, 60)[0]) == 5
