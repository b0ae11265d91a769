"""Document type declarations: reading, content models, rules."""

import re

from pyspark.sql import functions as F

from citecube import catalog_more
from citecube.functions.entities import LATIN1_ENTITIES
from citecube.sources import dtd

TEXT = """<!-- <!ELEMENT gone (x)> -->
<!ENTITY % field "author|title">
<!ELEMENT rec (%field;|year)*>
<!ELEMENT seq (author+, title?, (year | (volume, number))*)>
<!ELEMENT title (#PCDATA|i|sub)*>
<!ELEMENT author (#PCDATA)> <!ELEMENT year (#PCDATA)> <!ELEMENT volume (#PCDATA)> <!ELEMENT number (#PCDATA)>
<!ELEMENT i (#PCDATA)> <!ELEMENT sub (#PCDATA)> <!ELEMENT none EMPTY> <!ELEMENT free ANY>
<!ATTLIST rec key CDATA #REQUIRED
              kind (a|b) "a" when CDATA #IMPLIED>
<!ENTITY uuml "&#252;"> <!ENTITY alpha "&#x3b1;">"""


def test_declarations():
    d = dtd.parse_dtd(TEXT)
    assert "gone" not in d.elements and d.elements["rec"] == "(author|title|year)*"
    assert d.required == {"rec": ["key"]} and d.entities == {"uuml": "\u00fc", "alpha": "\u03b1"}
    assert d.inline() == {"i", "sub"} and d.children("seq") == {"author", "title", "year", "volume", "number"}


def test_entities_of_the_reader_are_those_of_the_decoder():
    assert dtd.parse_dtd(catalog_more._dtd_text()).entities == LATIN1_ENTITIES


def test_content_models():
    d = dtd.parse_dtd(TEXT)

    def fits(element, *children):
        return re.fullmatch(d.model(element), "".join(f"{c};" for c in children)) is not None

    assert fits("rec") and fits("rec", "year", "author", "author") and not fits("rec", "volume")
    assert fits("seq", "author") and fits("seq", "author", "author", "title", "year", "volume", "number", "year")
    assert not fits("seq") and not fits("seq", "title", "author") and not fits("seq", "author", "volume")
    assert not fits("seq", "author", "title", "title") and not fits("seq", "authors")
    assert fits("title", "i", "sub", "i") and fits("none") and not fits("none", "i") and fits("free", "x", "y")


def test_long_sequences_and_rules(spark):
    d = dtd.parse_dtd(TEXT)
    many = "<author>A</author>" * 20000
    cases = [("seq", "<seq>", many + "<title>a <i>b</i></title>", []), ("seq", "<seq>", many + "<title/><title/>", ["content_model"]),
             ("rec", '<rec kind="b">', "", ["missing_attribute"]), ("rec", "<rec key = '1'>", "<new/>", ["undeclared_element"]),
             ("rec", 'k1">', "<volume/>", ["misplaced_element"]), ("rec", 'k1">', "<![CDATA[<volume/> &no;]]>&uuml;&amp;", []),
             ("rec", 'k1">', "<title>&beta; &uuml;</title>", ["undeclared_entity"]), ("", 'k1"><title>', "", ["unclosed_record"])]
    df = spark.createDataFrame([(i, *c) for i, c in enumerate(cases)], "i int, kind string, raw string, body string, want array<string>")
    got = df.select("i", "want", dtd.record_rules(F.col("kind"), F.col("raw"), F.col("body"), d, ("rec", "seq")).alias("rules"))
    for r in got.collect():
        assert r.rules == r.want, (r.i, r.rules, r.want)
