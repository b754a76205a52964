"""Byte-level BPE in pieces against the library on whole texts, an own plain merge, and round trips."""

import base64
import hashlib
import random

import public_tokenizers
import pytest
import tiktoken

from docforge.llm import byte_bpe
from docforge.llm.queries import RANKS, op13_tiktoken

SF = "/root/testdata/sf0.001"
PATTERN = public_tokenizers.PATTERN
PARTS = ["'s", "'re", "'", "''", "'ll", "  ", " ", "\n", "\t", "a", "B", "é", "1", "23", "½", "²", "!!", "..", "?", " x", "　", "日本", "\x1c",
         "\x85", " ", "🙂", "​", "don't", " the", "\x00", "ᲊ", "<|endoftext|>"]


@pytest.fixture(scope="module")
def library():
    with open(RANKS, "rb") as f:
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=table, special_tokens={})


def test_pieces_give_the_ids_of_the_whole_text(library, monkeypatch):
    monkeypatch.setattr(byte_bpe, "PIECE_CHARS", 7)
    own = byte_bpe.Codec(RANKS, PATTERN, True)
    rng = random.Random(5)
    for k in range(6000):
        text = "".join(rng.choice(PARTS) for _ in range(k % 50))
        pieces = list(own.pieces(text))
        assert "".join(pieces) == text
        assert own.encode(text) == library.encode_ordinary(text), text


def test_runs_that_overflow_the_pattern(library):
    own = byte_bpe.codec(RANKS, PATTERN)
    blanks = " " * 2_000_000
    ids = own.encode("a" + blanks + "b c")
    assert ids == [*library.encode_ordinary("a"), *library._encode_single_piece(blanks[1:].encode()), *library.encode_ordinary(" b c")]
    assert own.encode(blanks) == library._encode_single_piece(blanks.encode())
    for text in ("x" * 300_000, "7" * 300_000, "ab 12 " * 50_000, "!" * 200_000 + "a", "\n" * 100_000 + "é"):
        assert own.encode(text) == library.encode_ordinary(text)


def test_merge_by_rank_written_out(library):
    """The ids of single words by the definition: always merge the pair of lowest rank."""
    ranks = library._mergeable_ranks
    for word in (" the", "unbelievable", "日本語", "aaaaaaa", "\x00\x01", " 🙂🙂"):
        parts = [bytes([b]) for b in word.encode()]
        while len(parts) > 1:
            best = min(range(len(parts) - 1), key=lambda i: ranks.get(parts[i] + parts[i + 1], 1 << 30))
            if parts[best] + parts[best + 1] not in ranks:
                break
            parts[best : best + 2] = [parts[best] + parts[best + 1]]
        assert byte_bpe.codec(RANKS, PATTERN).encoding._encode_single_piece(word.encode()) == [ranks[p] for p in parts]


def test_op13_whole_table(spark, library):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = op13_tiktoken(spark, SF).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        ids = library.encode_ordinary(texts[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_odd_rows(spark):
    rows = [(1, None, "x"), (1, "a b", "y"), (1, "a b", "y"), (None, "", None), (None, "🙂" * 70_000, "z"), (3, "<|endoftext|>", "n")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string").withColumn("n_tokens", byte_bpe.F.lit(7))
    out = byte_bpe.decode(byte_bpe.encode(df, RANKS, PATTERN, keep=("doc_id", "ids", "n_tokens")), RANKS, PATTERN)
    assert out.columns == ["doc_id", "n_tokens", "ids", "decoded"]
    got = sorted(((r.doc_id, bytes(r.decoded).decode()) for r in out.collect()), key=str)
    assert got == sorted(((d, t or "") for d, t, _ in rows), key=str)
    assert all(r.n_tokens == len(r.ids) for r in out.collect())
    assert byte_bpe.encode(df.limit(0), RANKS, PATTERN).count() == 0
    broken = spark.sql("select 1 as doc_id, cast(x'61ff62' as string) as text")
    assert bytes(byte_bpe.decode(byte_bpe.encode(broken, RANKS, PATTERN), RANKS, PATTERN).first().decoded).decode() == "a�b"
    nothing = spark.createDataFrame([(1, None)], "doc_id long, ids array<int>")
    assert byte_bpe.decode(nothing, RANKS, PATTERN).first().decoded is None
