"""Character entities.

The bibliography DTD declares the ISO Latin-1 entity set (plus a few
symbols inside it); the table is built from that rule - every HTML 4 named
entity whose code point lies in U+00A0..U+00FF - rather than listed by hand.
Decoding is one pass: the text is cut into entity / non-entity tokens and
each entity token is looked up in a literal map (no UDF, no chain of
replacements)."""

from __future__ import annotations

import html.entities

from pyspark.sql import Column
from pyspark.sql import functions as F

LATIN1_ENTITIES = {name: chr(cp) for name, cp in sorted(html.entities.name2codepoint.items())
                   if 0xA0 <= cp <= 0xFF}
# The five entities every XML parser knows; kept for the parser
# when decoding before XML parsing, decoded (ampersand last) for HTML text.
PREDEFINED = {"lt": "<", "gt": ">", "quot": '"', "apos": "'", "amp": "&"}

_TOKEN = r"&[A-Za-z][A-Za-z0-9]*;|[^&]++|&"


def _map(table: dict[str, str]) -> Column:
    pairs = []
    for name, ch in table.items():
        pairs += [F.lit(f"&{name};"), F.lit(ch)]
    return F.create_map(*pairs)


def decode_entities(c: Column, include_predefined: bool = False) -> Column:
    """Replace named entities by their characters.  With
    ``include_predefined`` the XML five are decoded too (for HTML text);
    otherwise they stay for a later XML parse."""
    table = dict(LATIN1_ENTITIES)
    if include_predefined:
        table.update(PREDEFINED)
    m = _map(table)
    tokens = F.regexp_extract_all(c, F.lit(_TOKEN), F.lit(0))
    decoded = F.array_join(F.transform(tokens, lambda t: F.coalesce(F.try_element_at(m, t), t)), "")
    return F.when(F.contains(c, F.lit("&")), decoded).otherwise(c)


def xml_escape(c: Column) -> Column:
    """Text -> XML character data (ampersand first)."""
    s = F.replace(c, F.lit("&"), F.lit("&amp;"))
    s = F.replace(s, F.lit("<"), F.lit("&lt;"))
    return F.replace(s, F.lit(">"), F.lit("&gt;"))


def sql_decode_chain(expr: str, include_predefined: bool = True) -> str:
    """The same decoding as nested SQL ``replace`` calls (oracle side);
    ``&amp;`` is replaced last so that ``&amp;copy;`` stays ``&copy;``."""
    out = expr
    items = list(LATIN1_ENTITIES.items())
    if include_predefined:
        items += [(k, v) for k, v in PREDEFINED.items() if k != "amp"] + [("amp", "&")]
    for name, ch in items:
        lit = ch.replace("'", "''")
        out = f"replace({out}, '&{name};', '{lit}')"
    return out
