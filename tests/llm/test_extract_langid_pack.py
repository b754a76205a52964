"""Page extraction, language ID and packing against hand-made cases and brute force."""

import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from docforge.llm import extract, hilbert, langid, pack
from docforge.llm.extract import main_text
from docforge.llm.queries import BYTE_BPE, op5_line_blocks, op6_ecoc, op9_hilbert_packing

SF = "/root/testdata/sf0.001"
LONG = "word " * 60


# -- pages ---------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("page, want", [
    (None, ""), ("", ""), ("<p></p>", ""), ("plain &amp; simple", "plain & simple"),
    ("<html><body><nav><a href=x>Home</a></nav><article><h1>T</h1><p>a  b\n c<b>d</b><br>e<p>f &lt;g&gt;</article><footer>z</footer>",
     "T\na b cd e\nf <g>"),
    ("<article><p>one</p><aside>no</aside><div class='ad-slot'>no</div><p>two</p><form>no<input></form></article>", "one\ntwo"),
    ("<article><p>one</p><section id=comments><article class=comment>no</article></section></article>", "one"),
    ("<script>var t='</p>';</script><style>p{}</style><!-- <p>x</p> --><article>yes</article><script>no", "yes"),
    (f"<div class=menu>no</div><div class='content with-sidebar'><p>{LONG}</p><p>short</p></div><div class=footer>no</div>",
     LONG.strip() + "\nshort"),
    (f"<header>no</header><div><p>{LONG}</p></div><div role=complementary>no</div><ul><li><a href=x>no</a></ul>", LONG.strip()),
    (f"<div class='page-wrapper layout-sidebar-right'><div class=main-nav>no</div><div class=cookie-container>no</div><div class=post-body>"
     f"<p>{LONG}</p></div><div class='article-comments'><p>{LONG}</p></div><div id=content-sidebar>no</div></div>", LONG.strip()),
    ("<article class='post comments-open'><p>yes</p><div class='comment-content'>no</div></article>", "yes"),
    ('<a title="a > b">x</a> <img alt="\'">y', "x y"),
    ("<article><header><h1>T</h1></header><p>x &copy &am</p></article>", "T\nx © &am"),
    ("<p unclosed", "<p unclosed"),
])
def test_main_text(page, want):
    assert main_text(page) == want


@pytest.mark.parametrize("page, want", [
    # teaser cards marked as articles do not take the story's place
    (f"<div class=content><h1>T</h1><p>{LONG}</p><p>{LONG}</p></div><article class=card>one</article><article class=card>two</article>",
     f"T\n{LONG.strip()}\n{LONG.strip()}"),
    # the distribution dives within an article
    (f"<article><p>{LONG}</p><ul>{'<li><a href=x>no</a>' * 4}</ul></article>", LONG.strip()),
    (f"<article><h1><a href=x>T</a></h1><p>{LONG}</p></article><div>no</div>", f"T\n{LONG.strip()}"),
    (f"<main><p>{LONG}</p></main><div><p>{LONG}</p></div><div class=ad>no</div><div>no</div>", f"{LONG.strip()}\n{LONG.strip()}"),
    ("<article><a href=x>nothing but links</a></article><div>no</div>", "nothing but links"),
    (f"<article><p>{LONG}</p></article><article>short</article>", f"{LONG.strip()}\nshort"),
])
def test_articles_are_evidence_only(page, want):
    assert main_text(page) == want


@pytest.mark.parametrize("page, want", [
    (f"<div><h2>T</h2><div class=ad>no</div><p>{LONG}</p><div class=ad>no</div><p>short</p></div><div>far</div>", f"T\n{LONG.strip()}\nshort\nfar"),
    (f"<div><p>{LONG}</p><form>no</form><p>last</p></div><div class=notice>no</div><div><div>no</div></div>", f"{LONG.strip()}\nlast"),
    (f"<body><div><h1>T</h1></div><div class=share>no</div><div><p>{LONG}</p></div><div class=ad>no</div><p>last</p></body>",
     f"T\n{LONG.strip()}\nlast"),
    (f"<div><div>{LONG}</div><div class=ad>no</div><div>last</div></div>", f"{LONG.strip()}\nlast"),
    (f"<div><p>{LONG}</p><article>quote</article><p>last</p></div><article>no</article>", f"{LONG.strip()}\nquote\nlast"),
])
def test_gaps_do_not_split_the_story(page, want):
    assert main_text(page) == want


def test_runs_of_the_distribution():
    lengths = np.array([5, 0, 0, 0, 9, 0, 7, 0, 0, 0, 1])
    assert [r[:2] for r in extract.runs_of(lengths)] == [(0, 1), (4, 7), (10, 11)]


def test_op5_rows(spark):
    rows = op5_line_blocks(spark, SF).collect()
    assert len(rows) == spark.read.parquet(f"{SF}/pages.parquet").count()
    assert all(r.n_chars == len(r.text) and "<" not in r.text for r in rows)


def test_extract_keeps_rows_and_ignores_other_columns(spark):
    df = spark.createDataFrame([(1, "u", None, "x"), (1, "u", "<p>a", "x"), (1, "u", "<p>a", "x"), (None, None, "", "y")],
                               "page_id long, url string, html string, text string")
    got = sorted((r.page_id or 0, r.text, r.n_chars) for r in extract.extract(df).collect())
    assert got == [(0, "", 0), (1, "", 0), (1, "a", 1), (1, "a", 1)]
    assert extract.extract(df.limit(0)).count() == 0


# -- languages -----------------------------------------------------------------------------------------------


def test_codewords_differ_and_every_bit_splits():
    for k in (2, 3, 4, 6, 9, 40):
        code = langid.codewords(k)
        assert len({tuple(r) for r in code.tolist()}) == k
        assert (np.abs(code.sum(axis=0)) < k).all()
    assert langid.codewords(1).shape == (1, 0)


def test_held_out_accuracy(spark):
    """Every text of the held-out quarter, at a size with some hundreds of them."""
    sf = "/root/testdata/sf0.01"
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = op6_ecoc(spark, sf).collect()
    assert len(rows) == len(truth)
    assert {r.doc_id for r in rows if r.held_out} == {d for d in truth if zlib.crc32(str(d).encode()) % 4 == 2}
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) / len(held) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_edge_cases(spark):
    rows = [(1, "the cat and the dog " * 5, "en"), (2, "der hund und die katze " * 5, "de"), (3, "le chien et le chat " * 5, "fr"),
            (4, None, "en"), (5, "12 34 !!", "de"), (6, "", None), (7, "the dog and a cat", None), (7, "und die katze", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumnRenamed("lang", "lang")
    model = langid.fit(df)
    got = sorted((r.doc_id, r.lang_pred) for r in langid.identify(df, model).collect())
    assert got == [(1, "en"), (2, "de"), (3, "fr"), (4, "und"), (5, "und"), (6, "und"), (7, "de"), (7, "en")]
    none = langid.fit(df.where("lang = 'xx'"))
    assert {r.lang_pred for r in langid.identify(df, none).collect()} == {"und"}
    one = langid.fit(df.where("lang = 'fr'"))
    assert {r.lang_pred for r in langid.identify(df, one).collect()} == {"fr", "und"}
    assert langid.identify(df.limit(0), model).count() == 0


def test_ambiguity_is_flagged(spark):
    df = spark.createDataFrame([(1, "aaa bbb", "x"), (2, "ccc ddd", "y")], "doc_id long, text string, lang string")
    model = langid.fit(df)
    mixed = spark.createDataFrame([(1, "aaa ccc"), (2, "aaa")], "doc_id long, text string")
    flags = {r.doc_id: r.ambiguous for r in langid.identify(mixed, model).collect()}
    assert flags == {1: True, 2: False}


# -- packing -------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("dims, bits", [(2, 4), (3, 3), (4, 2)])
def test_hilbert_curve_visits_each_cell_once_by_single_steps(dims, bits):
    side = 1 << bits
    cells = np.stack(np.meshgrid(*[np.arange(side)] * dims, indexing="ij"), -1).reshape(-1, dims)
    keys = hilbert.keys(cells, bits)
    assert sorted(keys.tolist()) == list(range(side**dims))
    assert (np.abs(np.diff(cells[np.argsort(keys)], axis=0)).sum(axis=1) == 1).all()


def check_pieces(pieces, texts, length):
    ref = Tokenizer.from_file(BYTE_BPE)
    ids = [np.array([*ref.encode(t or "", add_special_tokens=False).ids, 1], "<u4") for t in texts]
    sequences = {}
    for p in pieces:
        sequences.setdefault(p.sequence_id, []).append(p)
    for parts in sequences.values():
        parts.sort(key=lambda p: p.offset)
        assert parts[0].offset == 0
        assert all(a.offset + a.length == b.offset for a, b in zip(parts, parts[1:]))
        size = sum(p.length for p in parts)
        assert size == length or (size < length and size & (size - 1) == 0)
    assert sum(p.length for p in pieces) == sum(map(len, ids))
    return ids


def test_op9_whole_table(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    pieces = op9_hilbert_packing(spark, SF).collect()
    ids = dict(zip(texts, check_pieces(pieces, texts.values(), 2048)))
    of = {}
    for p in pieces:
        of.setdefault(p.doc_id, []).append(p)
        assert p.ids_crc32 == zlib.crc32(ids[p.doc_id][p.start : p.start + p.length].tobytes())
        assert p.doc_tokens == len(ids[p.doc_id])
    for d, parts in of.items():
        parts.sort(key=lambda p: p.start)
        assert [p.start for p in parts] == [0, *np.cumsum([p.length for p in parts])[:-1].tolist()]
        assert sum(p.length for p in parts) == len(ids[d])
    assert len(of) == len(texts)


def test_packing_edge_cases(spark):
    rows = [(1, None, 9), (1, "a b c", 9), (1, "a b c", 9), (None, "x" * 3000, 9), (4, "", 9), (5, "y z " * 700, 9)]
    df = spark.createDataFrame(rows, "doc_id long, text string, length int")
    check_pieces(pack.pack(df, BYTE_BPE, end_id=1, length=64).collect(), [r[1] for r in rows], 64)
    assert pack.pack(df.limit(0), BYTE_BPE, end_id=1).count() == 0
