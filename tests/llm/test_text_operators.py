"""Spelling variants, main text of pages and fill-in-middle against plain versions, and on unusual rows."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rankflow.llm import fim, html, spelling
from rankflow.llm.queries import QUERIES

DOCS = "doc_id long, text string, n long, form string, word string, output string, key int"


def rows_of(texts):
    return [(i, t, 7, "x", "y", "z", 1) for i, t in texts]


def prose(seed, n):
    random.seed(seed)
    return " ".join(random.choice(["house", "Garden", "öffnen", "ville", "x", "42", "don't", "𝒳"]) for _ in range(n))


@pytest.fixture(scope="module")
def docs(spark):
    texts = [(1, None), (2, ""), (3, "  \n"), (4, "a<P>b"), (5, prose(1, 300)), (5, prose(1, 300)), (6, prose(2, 60_000)), (None, "one two three"),
             (7, "é" * 50), (8, "x"), (9, "<P"), (10, "a<M>"), *((i, prose(i, i)) for i in range(11, 60))]
    return spark.createDataFrame(rows_of(texts), DOCS).repartition(3)


# --- 11 ---

def edits(a, b):
    """Levenshtein distance, the plain way."""
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def plain_words(texts, modulus=97, points=5, least=3):
    total = collections.Counter()
    for i, text in texts:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if modulus and h % modulus == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            total[run] += 1
    return {w: n for w, n in total.items() if len(w) >= points and n >= least}


def plain_variants(words):
    near = {w: [v for v in words if v != w and abs(len(v) - len(w)) < 2 and edits(v, w) == 1] for w in words}
    form = {}
    for w in words:
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best and words[best] >= 2 * words[w] else None

    def root(w):
        while form[w]:
            w = form[w]
        return w
    return {(w, n, len(near[w]), form[w], words[form[w]] if form[w] else None, root(w)) for w, n in words.items()}


def spelling_texts():
    random.seed(5)
    stems = ["aaaaa", "abcde", "niño", "niñoß", "tionär", "ÀÉÎÕÜ", "àéîõü", "strawberry", "mississippi"]
    texts = [(1, None), (2, ""), (3, "× ÷ ok?")]
    for i in range(400):
        words = []
        for _ in range(30):
            w = random.choice(stems)
            for _ in range(random.choice([0, 0, 0, 1, 2])):
                at, kind = random.randrange(len(w) + 1), random.randrange(3)
                c = random.choice("abñÉz")
                w = w[:at] + c + w[at:] if kind == 0 else w[:at] + w[at + 1:] if kind == 1 else w[:at] + c + w[at + 1:]
            words.append(w.upper() if random.random() < 0.1 and w.isascii() else w)
        texts.append((i % 300, random.choice([" ", "-", "𝒳", "Ā"]).join(words)))
    return texts


def test_words_and_variants(spark, monkeypatch):
    monkeypatch.setattr(spelling, "SLICE", 50)
    monkeypatch.setattr(spelling, "HELD_WORDS", 100)
    texts = spelling_texts()
    df = spark.createDataFrame(rows_of(texts), DOCS).repartition(3)
    for modulus in (None, 97, 3):
        words = spelling.count_words(df, typo_modulus=modulus)
        want = plain_words(texts, modulus)
        assert {r["word"]: r["n"] for r in words.collect()} == want
    words = spark.createDataFrame(list(want.items()), "word string, n long")
    got = spelling.spelling_variants(words).select("word", "n", "n_near", "form", "form_n", "root").collect()
    assert len(got) == len(want) and {tuple(r) for r in got} == plain_variants(want)
    assert any(r["form"] and r["root"] != r["form"] for r in got)  # chains are followed


def test_slices_cut_no_run():
    text = b"ab cd " * 30 + b"x" * 500 + b" y"
    old, spelling.SLICE = spelling.SLICE, 7
    try:
        parts = list(spelling._slices(text))
    finally:
        spelling.SLICE = old
    assert b"".join(parts) == text and b"x" * 500 in b"|".join(parts)
    assert [w for p in parts for w in spelling._RUN.findall(p)] == spelling._RUN.findall(text)


def test_short_words_and_no_rows(spark):
    words = {"a": 5, "b": 3, "ab": 9, "abc": 2, "": 1, "c" * 3000: 4, "c" * 3001: 9}
    got = spelling.spelling_variants(spark.createDataFrame(list(words.items()), "word string, n long"))
    assert {tuple(r[c] for c in ("word", "n", "n_near", "form", "form_n", "root")) for r in got.collect()} == plain_variants(
        {w: n for w, n in words.items() if len(w) < 9}) | {("c" * 3000, 4, 1, "c" * 3001, 9, "c" * 3001), ("c" * 3001, 9, 1, None, None, "c" * 3001)}
    none = spelling.count_words(spark.createDataFrame([], DOCS))
    assert none.count() == 0 and spelling.spelling_variants(none).count() == 0


def test_a_common_half_is_no_group(spark):
    """Words that share their ending meet only those with the same ending and most of the rest."""
    words = spark.createDataFrame([(f"{a}{b}{c}{d}tion", 3) for a in "abcdefgh" for b in "abcdefgh" for c in "abcdefgh" for d in "abcdefgh"],
                                  "word string, n long")
    pairs = spelling.near_pairs(words)
    assert pairs.count() == 8 ** 4 * 4 * 7 // 2
    size = F.length("word")
    biggest = words.select(F.explode(spelling._keys(F.col("word"), size, 0)).alias("key")).groupBy("key").count().agg(F.max("count")).first()[0]
    assert biggest == 64  # of 4,096 words


# --- 12 ---

LONG = "A sentence of the article that goes on for quite a while, as sentences do. " * 3
PARA = f"<p>{LONG}</p>"
TEXT = LONG.strip()


@pytest.mark.parametrize("page,text", [
    (None, ""), ("", ""), (" \n ", ""), ("plain &amp; simple", "plain & simple"),
    # what stands around an article, by element and by words
    (f"<title>t</title><body><header><h1>Site</h1></header><nav><a href=x>Home</a></nav><article><h1>T &lt;1&gt;</h1>{PARA}</article>"
     f"<aside>{PARA}</aside><footer>&copy; x</footer>", f"T <1>\n\n{TEXT}"),
    (f"<body><div class='site-header'>Site</div><div id=main><h2>T</h2>{PARA}{PARA}<div class='ad-box'>Buy</div>{PARA}</div>"
     f"<div class=sidebar>{PARA}</div><div id=comments>{PARA * 9}</div><div class='cookie-notice'>{LONG}</div>",
     "\n\n".join(["T", TEXT, TEXT, TEXT])),
    (f"<body><main><form>Name <input></form><h1>T</h1>{PARA}<section class=comments><article>{PARA * 4}</article></section></main>", f"T\n\n{TEXT}"),
    (f"<body><div class='layout with-sidebar'><article>{PARA}</article><div class=sidebar>x</div></div>", TEXT),
    # an article whose menu has no end, and two articles
    (f"<body><nav><ul><li><a href=a>Home</a><article><h1>T</h1>{PARA}</article>", f"T\n\n{TEXT}"),
    (f"<body><article>{PARA}</article><div class=promo>x</div><article>{PARA}</article>", f"{TEXT}\n\n{TEXT}"),
    # menus only
    ("<ul><li><a href=x>Home</a><li><a href=y>Blog</a></ul>", ""), ("<nav>Home</nav><script>var a = '<p>no</p>';</script>", ""),
    # marks, references, white space, comments
    (f"<article><p>AT&amp;T&nbsp;&#x41;&#66;\n\t <b>bo<i>ld</b> it</i> a<!-- <p>x</p> -->b x < y &unknown; &copy 1<br>z<style>p{{}}</style>w</p>{PARA}",
     f"AT&T AB bold it ab x < y &unknown; © 1 zw\n\n{TEXT}"),
    # missing and stray end tags, cut-off pages, odd attributes
    (f"<article><p>one<p class=it's>two</div></p><ul><li>three<li>four</ul><table><tr><td>five<td>six</table>{PARA}<p class='x", f"one\n\ntwo\n\nthree\n\nfour\n\nfive\n\nsix\n\n{TEXT}"),
    (f"<ARTICLE><P>Up</P><p title=\"a > b\">in</p><p hidden>no</p><p style='display: none'>no</p>{PARA}</article><noscript>no</noscript>", f"Up\n\nin\n\n{TEXT}"),
    (f"<article>{PARA}<script>if (a < b) {{ '</p>' }}", TEXT), (f"<article>{PARA}<!-- never closed <p>x</p>", TEXT),
    ("<div>" * 30_000 + "deep", "deep"),
])
def test_pages(page, text):
    assert html.extract(page) == text


def test_the_densest_part_is_chosen():
    """Without a semantic element or words: link lists and short lines lose against paragraphs."""
    links = "<div>" + "".join(f"<span><a href=x>Link number {i}</a> | </span>" for i in range(30)) + "</div>"
    page = f"<html><body>{links}<div><div>{PARA * 4}</div></div>{links}</body></html>"
    assert html.extract(page) == "\n\n".join([TEXT] * 4)


def test_density_formula():
    tree = html.parse("<body><div><p>12345678</p><p><a href=x>1234</a>5678</p></div></body>")
    kept = [True] * len(tree.name)
    c = html.count(tree, kept)
    density, total = html.densities(tree, kept, c)
    div, p, q = (tree.name.index("div"), tree.name.index("p"), tree.name.index("a") - 1)
    assert (c.chars[div], c.tags[div], c.link_chars[div], c.links[div]) == (16, 3, 4, 1)
    share = 4 / 16

    def plain(chars, tags, link_chars, links):
        lc, base = max(link_chars, 1), np.log(chars / max(chars - link_chars, 1) * max(link_chars, 1) + share * chars + np.e)
        return chars / max(tags, 1) * np.log(chars / lc * max(tags, 1) / max(links, 1)) / np.log(base)
    assert density[p] == pytest.approx(8 * np.log(8) / np.log(np.log(8 / 7 + 2 + np.e)))
    assert density[div] == pytest.approx(plain(16, 3, 4, 1)) and density[q] == pytest.approx(plain(8, 1, 4, 1))
    assert total[div] == pytest.approx(density[p] + density[q]) and total[p] == density[p]


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="<>/!-&;ap=\"' div", max_size=80))
def test_any_page_is_read(page):
    text = html.extract(page)
    assert text == "\n\n".join(" ".join(b.split()) for b in text.split("\n\n"))


def test_pages_as_rows(spark):
    rows = [(1, "u", f"<article>{PARA}</article>", 0, "old"), (1, "u", f"<article>{PARA}</article>", 0, "old"), (None, None, None, None, None), (2, "v", "é", 1, "")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, n_chars long, Text string")
    got = sorted(tuple(r) for r in html.main_texts(df).select("page_id", "text", "n_chars").na.fill({"page_id": -1}).collect())
    assert got == [(-1, "", 0), (1, TEXT, len(TEXT)), (1, TEXT, len(TEXT)), (2, "é", 1)]
    assert html.main_texts(df.where("false")).count() == 0


def test_given_pages(spark, sf_dir):
    """The given pages hold one article of headings and paragraphs, which a pattern can read."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").toPandas().set_index("page_id")
    got = QUERIES["op12_html"](spark, sf_dir).toPandas()
    assert list(got.columns) == ["page_id", "url", "text", "n_chars"] and len(got) == len(pages)
    import html as entities
    for i, text, n in zip(got.page_id, got.text, got.n_chars):
        article = re.search("<article>(.*)</article>", pages.html[i], re.S)[1]
        blocks = (" ".join(entities.unescape(re.sub("<br>", " ", re.sub("</?b>", "", b))).split()) for b in re.split("</?(?:p|h1)>", article))
        assert text == "\n\n".join(b for b in blocks if b) and n == len(text)


# --- 13 ---

def plain_fim(i, text):
    text = text or ""
    units = re.findall("[A-Za-z]+|[^A-Za-z]", text)
    digits = hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest()
    h = [int(digits[k:k + 8], 16) for k in range(0, 32, 8)]
    a, b = sorted(x % (len(units) + 1) for x in h[:2])
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or re.search("<[PSM]>", text) or h[2] % 100 >= 90:
        return (len(units), "plain", None, None, text, text)
    if h[3] % 100 < 20:
        return (len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}", text)
    return (len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}", text)


def test_fill_in_middle(docs, monkeypatch):
    monkeypatch.setattr(fim, "SLICE", 500)
    given = collections.Counter((r["doc_id"], *plain_fim(r["doc_id"], r["text"])) for r in docs.collect())
    made = fim.fill_in_middle(docs)
    assert "word" in made.columns and made.columns.count("form") == 1
    got = collections.Counter(tuple(r) for r in made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", "output", "restored").collect())
    assert got == given and {r[2] for r in got} == set(fim.FORMS)
    assert fim.fill_in_middle(docs.where("false")).count() == 0


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.text(alphabet="abZ é𝒳1\n-<>", max_size=30), st.integers(1, 2), st.integers(0, 99), st.integers(0, 99)), min_size=1, max_size=8),
       st.integers(3, 40))
def test_scatter_and_gather(cases, chunk):
    old, fim.CHUNK = fim.CHUNK, chunk  # chunks that cut texts, units and code points
    try:
        texts = [t for t, *_ in cases]
        buffer = fim.as_buffer(pa.array(texts))
        units = [re.findall("[A-Za-z]+|[^A-Za-z]", t) for t in texts]
        n = fim.count_units(buffer)
        assert n.tolist() == [len(u) for u in units]
        form = np.array([f if t else fim.PLAIN for t, f, *_ in cases])
        a, b = (np.array([c[k] for c in cases]) % (n + 1) for k in (2, 3))
        low, high = np.minimum(a, b), np.maximum(a, b)
        cut = fim.transform(buffer, form, low, high)
        for u, f, i, j, out, p, m in zip(units, form, low, high, fim.as_strings(cut.output).to_pylist(), cut.prefix, cut.middle):
            pre, mid, suf = "".join(u[:i]), "".join(u[i:j]), "".join(u[j:])
            assert out == ["".join(u), f"<P>{pre}<S>{suf}<M>{mid}", f"<S>{suf}<P>{pre}<M>{mid}"][f]
            assert (p, m) == (len(pre), len(mid))
        assert fim.as_strings(fim.restore(cut.output, form)).to_pylist() == texts
    finally:
        fim.CHUNK = old


def test_restoring_needs_the_markers():
    with pytest.raises(ValueError):
        fim.restore(fim.as_buffer(pa.array(["no marker"])), np.array([fim.PSM]))
