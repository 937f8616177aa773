"""Operators that work row by row, against the public libraries or brute force."""

import hashlib
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from grainfield.llm import bpe, html, licenses, tokenfiles
from grainfield.llm.queries import op1_mix, op5_token_files, op6_licenses, op7_bpe  # noqa: F401

SF = "/root/testdata/sf0.001"
ODD = [None, "", " ", "a", "don't I'LL 's", "x\x1cy  z", "é́ ﬁ", "日本 😀!!", "<|endoftext|> a", "A<|endoftext|>B, <|ENDOFTEXT|> <|startoftext|><|endoftext|>.", "  two  spaces \n\n new  line ", "a" * 3000, "word, word. " * 500, "12,34 ###$$$"]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, "n", 1) for i, t in enumerate(ODD)] + [(None, "null id", "n", 1), (3, "a", "n", 1)]
    return spark.createDataFrame(rows, "doc_id long, text string, n_tokens string, ids int")


def words(pattern, text):
    return re.findall(pattern, text or "")


def test_bpe_equals_the_library(spark, odd):
    import tiktoken

    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(open(path, "rb").read()), special_tokens={})
    docs = odd.select("doc_id", "text").union(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text"))
    want = sorted(repr((d, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest())) for d, t in map(tuple, docs.collect()) for ids in [library.encode_ordinary(t or "")])
    got = sorted(repr(tuple(r)) for r in bpe.encode_documents(odd.unionByName(docs.subtract(odd.select("doc_id", "text")), allowMissingColumns=True), path, public_tokenizers.PATTERN).collect())
    assert len(got) <= len(want) and set(got) == set(want)
    ids = bpe.encode_ids(odd.limit(5), path, public_tokenizers.PATTERN).collect()
    assert all(r["ids"] == library.encode_ordinary(ODD[r["doc_id"]] or "") for r in ids)
    assert bpe.encode_documents(odd.limit(0), path, public_tokenizers.PATTERN).count() == 0


def test_token_files_round_trip(spark, odd, tmp_path):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    docs = odd.filter("doc_id is not null").dropDuplicates(["doc_id"])
    files = tokenfiles.write_token_files(docs, path, 2, f"file://{tmp_path}/out")
    got = {r["doc_id"]: r for r in tokenfiles.read_token_files(files).collect()}
    start = 0
    for i, t in enumerate(ODD):
        ids = library.encode(t or "", add_special_tokens=False).ids + [2]
        assert (got[i]["start"], got[i]["n_tokens"], got[i]["ids_crc32"]) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    name = files.first()["file"].removeprefix("file://")
    data = bytearray(open(name, "rb").read())
    data[6] ^= 255
    open(tmp_path / "bad", "wb").write(data)
    with open(tmp_path / "bad", "rb") as f, pytest.raises(Exception):  # noqa: B017, PT011
        tokenfiles.TokenFileReader(f, len(data)).ids(0)
    assert tokenfiles.read_token_files(tokenfiles.write_token_files(odd, path, 2)).count() == len(ODD) + 2
    assert tokenfiles.read_token_files(tokenfiles.write_token_files(odd.limit(0), path, 2)).count() == 0


def test_license_phrases_tags_and_expressions(spark, odd):
    texts = ["Under the  MIT-License!", "under the mit license under the MIT license", "CC BY NC 4.0; Apache License, Version 2.0", "SPDX-License-Identifier: (MIT OR GPL-2.0-only) AND BSD-3-Clause\nx", "SPDX-License-Identifier: GPL-2.0 WITH Classpath-exception-2.0", "SPDX-License-Identifier: ) and", "nothing", None]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r for r in licenses.scan_licenses(rows).collect()}
    assert [got[i]["n_base"] for i in range(8)] == [1, 2, 2, 0, 0, 0, 0, 0]
    assert (got[1]["first_word"], got[1]["last_word"], got[1]["labels"]) == (0, 4, "mit")
    assert got[2]["base_labels"] == "apache-2,cc-by-nc"
    assert got[3]["labels"] == "bsd-3-clause,gpl-2.0-only,mit" and got[3]["permissive"] is True
    assert got[4]["labels"] == "gpl-2.0-with-classpath-exception-2.0" and got[4]["permissive"] is False
    assert got[5]["labels"] == "" and got[7]["score"] == 0 and got[7]["n_words"] == 0
    assert licenses.to_postfix("a or b and c with d".split()) == "a b c d with and or".split()
    assert licenses.to_postfix(["(", "a", "or"]) == []
    pattern = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    for r in op6_licenses(spark, SF).join(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text"), "doc_id").collect():
        own = words(pattern, "".join(c.lower() if "A" <= c <= "Z" else c for c in r["text"]))
        places = [i for i in range(len(own)) for p in licenses.BASE_PHRASES if own[i : i + len(p.split())] == p.split()]
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"]) == (len(own), len(places), min(places, default=None), max(places, default=None))
    tags = {
        "SPDX-License-Identifier: MIT SPDX-License-Identifier: GPL-2.0": "gpl-2.0,mit", "see SPDX-License-Identifier: MIT.": "mit", "SPDX-License-Identifier: MIT or later text": "mit",
        "spdx license identifier (Apache-2.0 OR LicenseRef-own) and x": "apache-2.0,licenseref-own", "SPDX-License-Identifier: what it is": "", "xspdx-license-identifier: MIT": "",
    }
    finder = licenses.automaton({**licenses.BASE_PHRASES, **licenses.MORE_PHRASES, licenses.TAG: ""})
    assert {t: licenses.scan(t.encode(), finder)[5] for t in tags} == tags
    assert all(map(licenses.permits, ("cc-by", "cc-by-4.0", "mit"))) and not any(map(licenses.permits, ("cc-by-nc-4.0", "gpl-3.0")))
    long = b"cc by nc " * 400_000 + b"x" * 6_000_000 + b" spdx-license-identifier: mit or" * 10_000
    assert licenses.scan(long, finder)[:6] == (1_200_001 + 50_000, 400_000, 0, 1_199_997, "cc-by-nc", "cc-by-nc,mit")
    assert licenses.scan_licenses(odd).count() == len(ODD) + 2 and licenses.scan_licenses(odd.limit(0)).count() == 0


PARAGRAPH = "<p>A long paragraph with many words in it, and &amp; a <a href=x>link</a> too, so that it is dense enough.</p><p>Second\n paragraph,  also rather long and plain, with nothing else in it at all.</p>"
PLAIN = "A long paragraph with many words in it, and & a link too, so that it is dense enough.\nSecond paragraph, also rather long and plain, with nothing else in it at all."


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (f"<html><head><title>t</title></head><body><nav><a>n</a></nav><article><h1>T</h1>{PARAGRAPH}</article><footer>f</footer></body></html>", "T\n" + PLAIN),
        (f"<body><div class=menu><a>a</a><a>b</a></div><div><div id=content><h2>T</h2>{PARAGRAPH}<ul><li>one<li>two</ul></div><div class=sidebar>s</div></div><div class=comments><p>A comment that is long and dense but not of the article itself at all.</p></div></body>", f"T\n{PLAIN}\none\ntwo"),
        (f"<body><article><header><h1>T</h1></header>{PARAGRAPH}<aside>x</aside><form>q</form><script>var a='</p>';</script><section id=comments><p>c</p></section></article></body>", "T\n" + PLAIN),
        ("plain text", "plain text"), ("<p>a < b &lt; c &#x41;</p>", "a < b < c A"), ("", ""), (None, ""), ("<div>" * 2000 + "deep", "deep"), ("<nav>only a menu</nav>", ""),
    ],
)
def test_main_text(page, text):
    assert html.main_text(page) == text


@pytest.mark.parametrize("name", ["elementor-widget", "content has-sidebar", "no-sidebar", "widget"])
def test_class_words_do_not_drop_the_article(name):
    page = f"<body><div class='{name}'><article><h1 class='entry-header'>T</h1>{PARAGRAPH}<div class=post-share><p>A section on shares.</p></div></article></div><div class=sidebar>s</div></body>"
    assert html.main_text(page) == f"T\n{PLAIN}\nA section on shares."


@pytest.mark.parametrize(
    "part",
    ["<div class='layout no-sidebar'>{}</div>", "<div class=has-ads>{}</div>", "<div data-id=share>{}</div>", "<article><h1>T</h1><section class='related work'>{}</section></article>", "<div title='the hidden valley' data-role='navigation'>{}</div>",
     "<article><div class=post-header><h1>T</h1></div>{}</article>", "<article><p class=notice-period>Three months.</p>{}</article>", "<div data-x='class=ad hidden'>{}</div>"],
)
def test_attributes_are_told_apart(part):
    text = html.main_text(f"<body><div class='ad'>Buy this.</div>{part.format(PARAGRAPH)}<div id='sidebar' hidden>s</div><ul class=related><li><a href=x>l</a></ul></body>")
    head = "T\n" if "<h1>" in part else "Three months.\n" if "notice" in part else ""
    assert text == head + PLAIN


def test_deep_and_misnested_pages_take_linear_time():
    import time

    for page in ("<b>x" * 40_000, "<div>" * 40_000 + "</p>" * 40_000, "<li><b>x" * 20_000, "<p><i>x</i>" * 20_000, "<div class=widget>a" * 20_000, "<td><dt><li><p>" * 10_000):
        began = time.time()
        html.main_text(page)
        assert time.time() - began < 8


def test_density_decides_without_an_article(spark):
    pages = [r["html"] for r in spark.read.parquet(f"{SF}/pages.parquet").collect()]
    found = 0
    for page in pages:
        bare = page.replace("<article>", "<div><div>").replace("</article>", "</div></div>").replace(' class="ad"', "").replace("<nav>", "<div>").replace("</nav>", "</div>")
        body = html.measure(html.parse(bare))
        found += "\n".join(html.blocks_of(html.main_node(body), 0.0)) == html.main_text(page)
    assert found >= 0.9 * len(pages)  # with no mark left, the largest density sum is where the article was; all but very short ones


def test_text_beside_the_densest_container_is_kept():
    first, second = ([f"{w} " * 60 + f"{i}." for i in range(5)] for w in ("one", "two"))
    sections = "".join("<section>" + "".join(f"<p>{t}</p>" for t in texts) + "</section>" for texts in (first, second))
    links = "<ul>" + "".join(f"<li><a href=x>link {i}</a></li>" for i in range(9)) + "</ul>"
    assert html.main_text(f"<body><h1>T</h1><p>A lead.</p><div>{sections}</div>{links}</body>") == "\n".join(["T", "A lead.", *first, *second])


def test_pages(spark):
    from html import unescape

    pages = spark.read.parquet(f"{SF}/pages.parquet")
    for r in html.extract_pages(pages.withColumn("text", F.lit(1))).join(pages.select("page_id", "html"), "page_id").collect():
        inner = re.search(r"<article>(.*?)</article>", r["html"], re.S)[1]
        blocks = [" ".join(unescape(re.sub(r"<[^>]+>", "", b)).split()) for b in re.split(r"</?(?:p|h1|br|ul|li)[^>]*>", inner)]
        assert r["text"] == "\n".join(b for b in blocks if b) and r["n_chars"] == len(r["text"])
    assert html.extract_pages(pages.limit(0)).count() == 0
