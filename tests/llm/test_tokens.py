"""Encoding, decoding and the Re-Pair files against the tokenizers library."""

import hashlib
import random
import uuid
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from docforge.llm import encode, pack, repair
from docforge.llm.bpe import Encoder
from docforge.llm.queries import BYTE_BPE, WORD_BPE, op2_bpe, op8_repair
from docforge.session import shared_root

SF = "/root/testdata/sf0.001"

PARTS = ["'s", "'re", "'", "''", "  ", " ", "\n", "\t", "a", "B", "é", "Σ", "ΑΣ", "1", "23", "½", "²", "!!", "..", " ",
         "　", "日本", "İ", "<|endoftext|>", "<|startoftext|>", "’", "é", "​", "\U0001f600", "'ll", "x'vey",
         "don't", "\x1c", "\x85", "ẞ", "ﬁ", "the", " the", "\x00"]
ODD = ["", " ", "\n\n", "x" * 5000, "ab" * 3000 + " tail"] + [
    "".join(random.Random(k).choice(PARTS) for _ in range(k % 40)) for k in range(4000)]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_encoder_equals_library(name):
    path = public_tokenizers.path(name)
    enc, ref = Encoder(path), Tokenizer.from_file(path)
    ids, begins = enc.encode(ODD)
    for k, want in enumerate(ref.encode_batch(ODD, add_special_tokens=False)):
        got = ids[begins[k] : begins[k + 1]]
        assert got.tolist() == want.ids, ODD[k][:80]
        if name.startswith("byte"):
            assert enc.decode(got) == ref.decode(want.ids, skip_special_tokens=False)


def test_encoder_with_a_tiny_table(monkeypatch):
    import docforge.llm.bpe as bpe

    monkeypatch.setattr(bpe, "TABLE_WORDS", 8)
    monkeypatch.setattr(bpe, "PIECE_CHARS", 16)
    enc, ref = Encoder(BYTE_BPE), Tokenizer.from_file(BYTE_BPE)
    for text in ODD[:300]:
        ids, _ = enc.encode([text, None, text])
        assert ids.tolist() == 2 * ref.encode(text, add_special_tokens=False).ids


def thue_morse(n):
    """A word over a and b, and its complement: equal under any polynomial modulo 2**64 from 1,024 places on."""
    bits = [bin(k).count("1") & 1 for k in range(n)]
    return "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_words_that_collide_in_a_polynomial(name):
    path = public_tokenizers.path(name)
    enc, ref = Encoder(path), Tokenizer.from_file(path)
    for n in (1024, 2048, 4096):
        pair = list(thue_morse(n))
        ids, begins = enc.encode(pair)
        got = [ids[a:b].tolist() for a, b in zip(begins, begins[1:])]
        assert got == [e.ids for e in ref.encode_batch(pair, add_special_tokens=False)] and got[0] != got[1]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_every_code_point_equals_the_library(name):
    path = public_tokenizers.path(name)
    enc, ref = Encoder(path), Tokenizer.from_file(path)
    texts = [" ".join(f"a{chr(c)}b" for c in range(lo, lo + 512) if not 0xD800 <= c < 0xE000) for lo in range(0, 0x20000, 512)]
    ids, begins = enc.encode(texts)
    for k, want in enumerate(ref.encode_batch(texts, add_special_tokens=False)):
        assert ids[begins[k] : begins[k + 1]].tolist() == want.ids, hex(512 * k)


def test_files_and_packing_of_such_words(spark, tmp_path):
    pair = [(k, w) for k, w in enumerate(thue_morse(2048))]
    df = spark.createDataFrame(pair, "doc_id long, text string")
    for path in (WORD_BPE, BYTE_BPE):
        ref = Tokenizer.from_file(path)
        want = {d: [*ref.encode(t, add_special_tokens=False).ids, 1] for d, t in pair}
        out = str(tmp_path / path.split("/")[-1])
        repair.write(df, out, path, end_id=1, shards=1)
        assert {r.doc_id: np.frombuffer(r.ids, "<u4").tolist() for r in repair.read(spark, out).collect()} == want
        packed = {}
        for p in sorted(pack.pack(df, path, end_id=1, length=512).collect(), key=lambda p: p.start):
            packed.setdefault(p.doc_id, []).extend(np.frombuffer(p.ids, "<u4").tolist())
        assert packed == want


def test_decode_of_broken_bytes():
    enc, ref = Encoder(BYTE_BPE), Tokenizer.from_file(BYTE_BPE)
    rng = np.random.default_rng(3)
    for _ in range(200):
        ids = rng.integers(0, 400, 12)
        assert enc.decode(ids) == ref.decode(ids.tolist(), skip_special_tokens=False)


def test_op2_whole_table(spark):
    ref = Tokenizer.from_file(BYTE_BPE)
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = op2_bpe(spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = ref.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(ref.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_encode_nulls_repeats_and_clashing_columns(spark):
    rows = [(1, None, "x"), (1, "a b", "y"), (1, "a b", "y"), (None, "", None), (None, "c", "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    out = encode.decode(encode.encode(df, BYTE_BPE), BYTE_BPE).collect()
    assert sorted((r.doc_id or 0, r.decoded, r.n_tokens) for r in out) == [
        (0, "", 0), (0, "c", 1), (1, "", 0), (1, "a b", 2), (1, "a b", 2)]
    assert encode.encode(df.limit(0), BYTE_BPE).count() == 0
    only = encode.encode(df, BYTE_BPE, keep=("doc_id", "ids"), with_ids=False)
    assert only.columns == ["doc_id", "n_tokens"] and only.agg({"n_tokens": "sum"}).first()[0] == 5


@pytest.mark.parametrize("seed", range(6))
def test_repair_round_trip(seed):
    rng = np.random.default_rng(seed)
    ids = rng.integers(0, [3, 2, 50, 7, 1000, 4][seed], [4000, 999, 5000, 1, 3000, 0][seed]).astype(np.int32)
    symbols, grammar = repair.compress(ids, 1000, 1)
    pool, offset, length = grammar.expansions()
    got = np.concatenate([pool[offset[s] : offset[s] + length[s]] for s in symbols]) if len(symbols) else ids
    assert got.tolist() == ids.tolist()
    assert len(symbols) <= len(ids)


def test_repair_compresses_repeats():
    ids = np.tile(np.arange(2, 18), 500)
    symbols, _ = repair.compress(ids, 100, 1)
    assert len(symbols) < len(ids) / 8


def test_op8_whole_table(spark):
    ref = Tokenizer.from_file(WORD_BPE)
    texts = sorted((r.doc_id, r.text or "") for r in spark.read.parquet(f"{SF}/documents.parquet").collect())
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in op8_repair(spark, SF).collect()}
    start = 0
    for doc_id, text in texts:
        ids = [*ref.encode(text, add_special_tokens=False).ids, 1]
        assert got[doc_id] == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert len(got) == len(texts)


def test_files_of_odd_rows(spark):
    """Null ids and texts, quotes (id 1 inside a document), repeated ids, an empty table."""
    rows = [(5, '"quote" "'), (None, "n"), (5, '"quote" "'), (2, None), (9, "a " * 4000), (2, "")]
    ref = Tokenizer.from_file(WORD_BPE)
    for n, part in ((3, rows), (2, [])):
        path = f"{shared_root(spark)}/t-{uuid.uuid4().hex}"
        repair.write(spark.createDataFrame(part, "doc_id long, text string"), path, WORD_BPE, end_id=1, shards=n)
        got = repair.read(spark, path).collect()
        want = [(d, [*ref.encode(t or "", add_special_tokens=False).ids, 1]) for d, t in part]
        key = lambda x: (x[0] is not None, x[0] or 0, x[1])
        assert sorted(((r.doc_id, np.frombuffer(r.ids, "<u4").tolist()) for r in got), key=key) == sorted(want, key=key)
        assert repair.block_starts(spark, path).count() == len({(r.shard, r.block) for r in got})


def test_documents_and_ranges_are_read_alone(spark, tmp_path):
    rows = [(k, f"the quick brown fox {k % 3} jumps over the lazy dog " * (k % 5)) for k in range(40)] + [(None, "alone"), (7, "twice")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    path = str(tmp_path / "repair")
    repair.write(df, path, WORD_BPE, end_id=1, shards=4)
    whole = [(r.doc_id, r.n_tokens, bytes(r.ids)) for r in repair.read(spark, path).collect() if r.doc_id in (None, 7, 8, 39)]
    assert len(whole) == 5
    for start, stop in ((0, None), (0, 3), (5, 12), (13, 14), (4, 4), (10_000, None)):
        got = [(r.doc_id, r.n_tokens, bytes(r.ids)) for r in repair.read_some(spark, path, [7, None, 39, 8, 99], start, stop).collect()]
        assert sorted(got, key=str) == sorted([(d, n, x[4 * start : None if stop is None else 4 * stop]) for d, n, x in whole], key=str)
    assert repair.read_some(spark, path, [99]).collect() == []


def _plain(symbols, grammar):
    out = []
    for s in symbols.tolist():
        todo = [s]
        while todo:
            x = todo.pop()
            if x < grammar.terminals:
                out.append(x)
            else:
                todo += grammar.rules[x - grammar.terminals][::-1].tolist()
    return out


@pytest.mark.parametrize("terminals", [300, 62_000, 70_001])
def test_rounds_go_on_until_no_pair_pays(terminals):
    """A passage of 1000 ids copied 50 times among noise costs a few symbols a copy, whatever the symbols' width; what is left has no
    pair that is still frequent."""
    rng = np.random.default_rng(5)
    passage = rng.integers(2, terminals, 1000)
    ids = np.concatenate([np.concatenate([passage, rng.integers(2, terminals, 40), [1]]) for _ in range(50)])
    symbols, grammar = repair.compress(ids, terminals, 1)
    assert _plain(symbols, grammar) == ids.tolist()
    assert len(symbols) < 50 * (40 + 1 + 4) and grammar.lengths.max() >= 400
    left = {}
    for pair in zip(symbols.tolist(), symbols[1:].tolist()):
        if 1 not in pair:
            left[pair] = left.get(pair, 0) + 1
    assert max(left.values()) < repair.MIN_COUNT
    assert symbols.max() < 1 << 8 * repair.width_of(terminals)
    used = np.bincount(np.concatenate([symbols, grammar.rules.ravel()]), minlength=terminals + len(grammar.rules))[terminals:]
    assert used.min() >= 1  # every rule is used


def test_ids_beyond_two_bytes(spark, tmp_path):
    ref = Tokenizer.from_file(BYTE_BPE)
    rows = [(1, "a b a b a b " * 30), (2, None), (3, "a b a b a b " * 30)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = {d: [*ref.encode(t or "", add_special_tokens=False).ids, 1 << 16] for d, t in rows}
    repair.write(df, str(tmp_path / "wide"), BYTE_BPE, end_id=1 << 16, shards=1)
    assert {r.doc_id: np.frombuffer(r.ids, "<u4").tolist() for r in repair.read(spark, str(tmp_path / "wide")).collect()} == want
    some = repair.read_some(spark, str(tmp_path / "wide"), [3], 5, 9).collect()
    assert [np.frombuffer(r.ids, "<u4").tolist() for r in some] == [want[3][5:9]]
    packed = {}
    for p in sorted(pack.pack(df, BYTE_BPE, end_id=1 << 16, length=64).collect(), key=lambda p: p.start):
        packed.setdefault(p.doc_id, []).extend(np.frombuffer(p.ids, "<u4").tolist())
    assert packed == want
