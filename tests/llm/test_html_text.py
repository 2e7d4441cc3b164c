"""Deep and broken pages, pages without marks and names, and what an article's own header counts as."""

import re
import time

import pytest

from cardfeat.llm import html_text
from tests.conftest import SMALL
from tests.llm import brute

DEEP = {
    "nested": "<div>x" * 170_000,
    "unclosed": "<b>x" * 250_000,
    "inline end tags": "<i><div>" + "<b>x" * 120_000 + "</i>" * 120_000,
    "paragraphs": "<p>x" * 250_000,
    "lists": "<li>x<ul>" * 110_000,
    "scripts": "<script/>" * 110_000,
    "cells": "<table><tr><td>x" * 60_000,
    "end tags": "</div></b></p>" * 70_000,
}


@pytest.mark.parametrize("kind", DEEP)
def test_a_megabyte_of_tags(kind):
    start = time.process_time()
    html_text.main_text(DEEP[kind])
    assert time.process_time() - start < 20  # some seconds; it grew with the square of the tags once


def test_paths():
    tree = html_text.Paths()
    a = tree.child(0, "div.x")
    b, c = tree.child(a, "p"), tree.child(a, "a")
    d = tree.child(0, "aside")
    assert tree.child(a, "p") == b and tree.tag(a) == "div" and tree.depth == [0, 1, 2, 2, 1]
    order = sorted(range(5), key=tree.ranks().__getitem__)
    assert order == [0, d, a, c, b]


def test_an_articles_header_is_a_header():
    """Headers are left out wherever they stand, also with the headline in them."""
    story = "Some sentence, long enough to count. And one more, so that it is a paragraph."
    page = f"<article><header><h1>Headline</h1><p>By someone</p></header><h2>Inner title</h2><p>{story}</p><footer>Tags</footer></article>"
    assert html_text.main_blocks(page) == ["Inner title", story]


def _without_marks(page):
    return re.sub(r'\s(class|id|role|itemprop)="[^"]*"', "", re.sub(r"</?(article|main)[^>]*>", "", page))


def _only_divs(page):
    return re.sub(r"<(/?)(nav|header|footer|aside|form)\b", r"<\1div", _without_marks(page))


@pytest.mark.parametrize("strip, precision, recall", [(_without_marks, 0.95, 0.99), (_only_divs, 0.8, 0.99)])
def test_ratios_alone(strip, precision, recall):
    """The given pages without the marks and names that tell the article: the ratios have to."""
    right = found = wanted = 0
    for (page,) in brute.table(SMALL, "pages", "html"):
        want, got = set(html_text.main_blocks(page)), set(html_text.main_blocks(strip(page)))
        right, found, wanted = right + len(want & got), found + len(got), wanted + len(want)
    assert right >= precision * found and right >= recall * wanted
