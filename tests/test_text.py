import html

import pytest
from pyspark.sql import functions as F

from vacanta.functions import text as t


def run(spark, values, function):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r.o for r in df.select("i", function(F.col("v")).alias("o")).orderBy("i").collect()]


REFERENCES = [
    "AT&amp;T &copy2020 &pound;5 &#39;x&#39; &#128512; &notit; a&b &#x80; &Aacute",
    "&amp;lt; &#38;lt; &#; &#xZ; &#99999999999; &#0; &#x0d; &#11; &#xfdd0; &#xfffe;",
    "R&D & more",
    "plain",
    "&ampx &nosuch; &lt &lt;&am&amp;p;",
    "&#x1F600;&#1114112;&#55296;&ngE; &#0065; &#x110000;",
    "",
    "&" * 5 + "&;",
    "&nbsp;&eacute;&hellip;&CounterClockwiseContourIntegral;",
]


def test_unescape_is_the_standard_decoding(spark):
    assert run(spark, REFERENCES, t.unescape) == [html.unescape(x) for x in REFERENCES]


@pytest.mark.parametrize("part", range(4))
def test_every_known_name_is_decoded(spark, part):
    names = sorted(html.entities.html5)[part::4]
    texts = [f"x&{n} y" for n in names]
    assert run(spark, texts, t.unescape) == [html.unescape(x) for x in texts]


def test_strip_html(spark):
    cases = {
        "<div>Two <em>plain</em> words</div>": "Two plain words",
        "<script>var a='<p>';</script>x<style>p{}</style>": "x",
        "<script>never closed": "",
        "a<!-- <b>c</b> -->d": "a d",
        '<img alt="a>b" src=x>q': "q",
        "1 < 2 and 3 > 2": "1 < 2 and 3 > 2",
        "<!DOCTYPE html><br/>x<?php y ?>": "x",
        "<ruby>k<rp>(</rp><rt>r</rt></ruby>": "k",
        "a\xa0 b\x1cc\n\nd": "a b c d",
        "<scripted>kept</scripted>": "kept",
    }
    assert run(spark, list(cases), t.strip_html) == list(cases.values())


def test_clean_description(spark):
    cases = {
        "<div>Tea &amp; trains.</div> Write to http://firm.invalid/a?b=1 soon.": "Tea & trains. Write to soon.",
        "&lt;b&gt;bold&lt;/b&gt; &amp;lt;i&amp;gt;": "bold <i>",
        "a • b * c · d": "a \n- b \n- c \n- d",
        "": "",
        "   ": "",
        "•••": "- \n- \n-",
        "x\n\n\n\ny": "x y",
    }
    assert run(spark, list(cases), t.clean_description) == list(cases.values())
    assert run(spark, [None], t.clean_description) == [""]


def test_normalize_whitespace_caps_blank_lines(spark):
    assert run(spark, ["one \t two\n\n\n\n\nthree  "], t.normalize_whitespace) == ["one two\n\nthree"]


def test_clean_title(spark):
    cases = {
        "BI Lead (Leeds, 2 days) - Harbour & Finch": "BI Lead - Harbour & Finch",
        "ML Engineer [remote) x": "ML Engineer x",
        "A (b) c (d) e": "A c e",
        "R&amp;D <i>Lead</i>": "R&D Lead",
    }
    assert run(spark, list(cases), t.clean_title) == list(cases.values())
    assert run(spark, [None], t.clean_title) == [""]


def test_patterns_run_only_on_texts_that_can_hold_them(spark):
    df = spark.createDataFrame([("a",)], "v string")

    def plan(c):
        return df.select(c.alias("o"))._jdf.queryExecution().analyzed().numberedTreeString()

    assert ", <)" in plan(t.strip_html(F.col("v")))
    assert ", ()" in plan(t.clean_title(F.col("v")))
    assert "https?://|[" in plan(t.clean_description(F.col("v")))
