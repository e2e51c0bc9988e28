"""Pages of any length and nesting are parsed in time that follows their length; the query gives what the model gives."""

import time

import pytest
from conftest import SF

from quayload.llm import html_extract
from quayload.llm.html_training import labelled_pages
from quayload.llm.registry import LLM_REGISTRY

LONG = {
    "nested and closed twice": "<div>" * 100_000 + "x" + "</span></p></div>" * 100_000,
    "closed without being open": "<div>" * 50_000 + "</p>" * 200_000,
    "never closed": "<object>" * 200_000 + "text",
    "no end of markup": "<" * 500_000,
    "no end of a declaration": "<!" * 300_000,
    "quotes left open": '<a href="x>' * 200_000,
}


@pytest.mark.parametrize("name", LONG)
def test_twice_the_page_takes_about_twice_as_long(name):
    def seconds(page):
        start = time.process_time()
        html_extract.parse(page)
        return time.process_time() - start

    page = LONG[name]
    half = min(seconds(page[: len(page) // 2]) for _ in range(2))
    assert seconds(page) < 5 * half + 1


def test_what_end_tags_close():
    tree = html_extract.parse("<div>a<p>b</span>c<ul><li>d</div>e</p>f<h2>g</h4>h</div>i")
    texts = [(tree.text[i], tree.tag[tree.parent[i]]) for i in range(len(tree.text)) if tree.text[i]]
    assert texts == [("a", "div"), ("bc", "p"), ("d", "li"), ("e", "html"), ("f", "html"), ("g", "h2"), ("h", "html"), ("i", "html")]


def test_query_is_the_model_on_every_page(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    model = html_extract.train(labelled_pages())
    want = {r.page_id: (r.url, html_extract.main_text(r.html or "", model)) for r in pages.collect()}
    found = LLM_REGISTRY["op5_html_extract"].run(spark, SF).collect()
    assert len(found) == len(want) and {r.page_id: (r.url, r.text) for r in found} == want
    assert all(r.n_chars == len(r.text) for r in found)
