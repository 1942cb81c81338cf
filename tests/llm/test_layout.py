"""Visible text of pages: expected layouts, broken markup, and words against a plain reading."""

from __future__ import annotations

import re
import time

import pytest

from forecourt.llm import layout, queries
from conftest import SF


def page(html):
    return layout.Layout().page(html)


CASES = {
    "blocks": ("<p>One  two\n three</p><p>Four<br>five</p><div>six</div>seven", "One two three\n\nFour\nfive\n\nsix\nseven"),
    "implied p and li": ("<p>a<p>b<ul><li>c<li>d<ul><li>e</ul><li>f</ul>g", "a\n\nb\n\n- c\n- d\n  - e\n- f\n\ng"),
    "ordered": ("<ol start=3><li>x<li value=9>y<li>z</ol><ol reversed><li>u<li>v", "3. x\n9. y\n10. z\n\n1. u\n0. v"),
    "hidden": ("<head><title>t</title></head><script>if (a<b) x('</p>')</script><p hidden>no</p><p style='color:red; display:none'>no"
               "<b>no</p><span style=visibility:hidden>no</span>yes<template>no</template><noscript>no</noscript>", "yes"),
    "pre": ("<pre>\n a\n   b  c\n</pre>d", " a\n   b  c\n\nd"),
    "table": ("<table><caption>Cap</caption><tr><th>Name<th>Qty<tr><td>apple pie<td>3<tr><td colspan=2>all of it<tr><td>x<td>y</table>",
              "Cap\nName       Qty\napple pie  3\nall of it\nx          y"),
    "rowspan": ("<table><tr><td rowspan=2>a</td><td>b</td></tr><tr><td>c</td></tr></table>", "a  b\n   c"),
    "two lines in a cell": ("<table><tr><td>a<br>bb</td><td>c<p>d</td></tr></table>", "a   c\nbb\n    d"),
    "nested table": ("<table><tr><td><table><tr><td>1<td>2</table><td>3</table>", "1  2  3"),
    "entities": ("a&nbsp;b &lt;c&gt; &eacute; &#8364; &unknown; &amp", "a\xa0b <c> é € &unknown; &"),
    "overlap": ("<b><p>x</b> y</p>z", "x y\n\nz"),
    "hidden overlap": ("<p>a<span hidden>no<b>no</span>yes<div>b<b hidden>no<i>no</b>c</div>", "ayes\n\nbc"),
    "stray": ("</p>a</div></td>b<td>c</b> 1 < 2 <3 <", "abc 1 < 2 <3 <"),
    "comments": ("a<!-- <p> -->b<!doctype x>c<?php ?>d<![CDATA[e]]>f<!-- open <p>gone", "abcdf"),
    "attributes": ("<a title=\"x>y\" data='<b>'>t</a><a title=\"open>u</a>", "tu"),
    "stray quotes": ("<p class=it's>Hello 'world' bye</p><p>next</p>", "Hello 'world' bye\n\nnext"),
    "quote after a value": ("<img alt=\"5\" tall\">swallowed <b title=\"x\">kept</b>", "swallowed kept"),
    "quotes in end tags and names": ("a</b \">b<i 'x>c</i y='>'>d<u a = '>' b=\"it's\">e</u><s x=y=\"z>f</s>", "abcdef"),
    "hidden beside stray quotes": ("<p a=it's hidden>no</p><p b\"c hidden=''>no</p><p d='hidden'>yes", "yes"),
    "definition": ("<dl><dt>t<dd>d<dt>u<dd>e</dl>", "t\n  d\nu\n  e"),
    "quote": ("<blockquote>said <q>it</q></blockquote>x", "  said “it”\n\nx"),
    "unfinished": ("a <b", "a"),
}


@pytest.mark.parametrize("name", CASES)
def test_layouts(name):
    html, text = CASES[name]
    assert page(html) == text


def test_long_and_deep_pages_take_linear_time():
    start = time.process_time()
    assert page("<div>" * 100_000 + "x") == "x"
    assert page("<ul><li>" * 20_000 + "x").endswith("x")
    assert page("<a \"" * 100_000) == "" and page("<a b=\"c>" * 100_001 + "x") == "x" and page("<a =" * 100_000) == "" and page("<!--" * 100_000) == "" and page("<" * 200_000) == "<" * 200_000
    assert len(page("<p>word " * 100_000).split()) == 100_000
    assert page("<table>" * 3_000 + "x").strip() == "x"
    page("<b>" * 50_000 + "</p>" * 1000)
    assert time.process_time() - start < 60


def test_whole_query_keeps_every_visible_word(spark):
    rows = {r.page_id: r for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    out = queries.html_extraction(spark, SF).collect()
    assert sorted(r.page_id for r in out) == sorted(rows)
    for r in out:
        html = re.sub(r"(?is)<!--.*?-->|<(head|script|style|title|noscript|template|iframe)\b.*?</\1>", " ", rows[r.page_id].html)
        from html import unescape

        plain = re.sub(r"\s", "", unescape(re.sub(r"<[^>]*>", "", html)))
        shown = re.sub(r"\s", "", re.sub(r"(?m)^ *- ", "", r.text))
        assert shown == plain or re.sub("[-–]", "", shown) == re.sub("[-–]", "", plain)


def test_odd_rows(spark):
    frame = spark.createDataFrame([(1, None, "old"), (2, "", "old"), (2, "", "old"), (3, "<p>é", "old")], "page_id bigint, html string, text string")
    assert sorted((r.page_id, r.text) for r in layout.extract(frame).collect() if r.text is not None) == [(2, ""), (2, ""), (3, "é")]
    assert layout.extract(frame.limit(0)).count() == 0
