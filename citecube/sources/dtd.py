"""Validation of XML records against a document type definition.

The declarations are read once (a small file): elements with their content
models, attributes, entities.  A content model is an automaton over the names of
a record's children; XML asks models to be deterministic, so a possessive regular
expression over the child sequence is exact and needs no backtracking, however
long the sequence.  Records are judged with built-in expressions only."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.entities import PREDEFINED
from ..session import materialize
from .xml_chunks import judge_chunks, read_chunks, whole_records

_NAME = r"[A-Za-z_:][\w.:-]*"


@dataclass
class Dtd:
    """``elements``: name -> content model as written; ``attributes``: element ->
    names of its required ones; ``entities``: name -> text."""
    elements: dict[str, str] = field(default_factory=dict)
    required: dict[str, list[str]] = field(default_factory=dict)
    entities: dict[str, str] = field(default_factory=dict)

    def model(self, element: str) -> str:
        """The content model as a regular expression over ``name;name;...``."""
        text = self.elements[element].replace(" ", "")
        if text in ("EMPTY", "(#PCDATA)"):
            return ""
        if text == "ANY":
            return r"(?:[^;]+;)*+"
        tokens = re.findall(_NAME + r"|#PCDATA|[(),|?*+]", text)
        out = []
        for t in tokens:
            if t == "(":
                out.append("(?:")
            elif t in ")|":
                out.append(t)
            elif t in "?*+":
                out.append(t + "+")
            elif t not in (",", "#PCDATA"):
                out.append(f"(?:{re.escape(t)};)")
        return "".join(out).replace("(?:|", "(?:")     # #PCDATA is no child

    def children(self, element: str) -> set[str]:
        return set(re.findall(_NAME, self.elements[element].replace("#PCDATA", ""))) - {"EMPTY", "ANY"}

    def inline(self) -> set[str]:
        """Elements that stand within text."""
        return {c for e, model in self.elements.items() if "#PCDATA" in model for c in self.children(e)}


def parse_dtd(text: str) -> Dtd:
    """Reads element, attribute and general entity declarations; parameter
    entities are replaced first, comments are skipped."""
    text = re.sub(r"(?s)<!--.*?-->", "", text)
    for name, value in re.findall(r"<!ENTITY\s+%\s+(" + _NAME + r")\s+\"([^\"]*)\"\s*>", text):
        text = text.replace(f"%{name};", value)
    out = Dtd()
    for name, model in re.findall(r"<!ELEMENT\s+(" + _NAME + r")\s+([^>]+?)\s*>", text):
        out.elements[name] = re.sub(r"\s+", "", model)
    for element, body in re.findall(r"<!ATTLIST\s+(" + _NAME + r")\s+([^>]*)>", text):
        out.required.setdefault(element, []).extend(
            re.findall(r"(" + _NAME + r")\s+(?:" + _NAME + r"|\([^)]*\))\s+#REQUIRED", body))
    for name, value in re.findall(r"<!ENTITY\s+(" + _NAME + r")\s+\"([^\"]*)\"\s*>", text):
        out.entities[name] = re.sub(r"&#(x[0-9A-Fa-f]+|\d+);", lambda m: chr(
            int(m[1][1:], 16) if m[1][0] == "x" else int(m[1])), value)
    return out


def read_dtd(spark: SparkSession, path: str) -> Dtd:
    return parse_dtd(spark.read.text(path, wholetext=True).first()[0])       # one small file


# Every rule of ``violations``.
RULES = ("unclosed_record", "missing_attribute", "undeclared_element", "misplaced_element", "content_model", "undeclared_entity",
         "unknown_record")


def record_rules(kind: Column, raw: Column, body: Column, dtd: Dtd, records: tuple[str, ...]) -> Column:
    """The rules that a record breaks, each once.  ``raw`` is the record from its
    key or from its start tag on, ``body`` what stands between its tags."""
    inline = sorted(dtd.inline(), key=len, reverse=True)
    plain = F.regexp_replace(body, r"(?s)<!--.*?-->|<!\[CDATA\[.*?\]\]>", "")
    flat = F.regexp_replace(plain, r"</?(?:" + "|".join(inline or ["-"]) + r")(?:\s[^>]*)?/?>", "")
    children = F.regexp_extract_all(flat, F.lit(r"<(" + _NAME + r")"), F.lit(1))
    names = F.array(*map(F.lit, sorted(dtd.elements)))
    undeclared = F.size(F.array_except(children, names)) > 0
    sequence = F.concat(F.array_join(children, ";"), F.lit(";"))
    sequence = F.when(F.size(children) == 0, "").otherwise(sequence)
    misplaced, model, missing = F.lit(False), F.lit(False), F.lit(False)
    tag = F.regexp_extract(raw, r"^[^>]*", 0)
    full = raw.startswith("<")
    for r in (r for r in records if r in dtd.elements):
        allowed = F.array(*map(F.lit, sorted(dtd.children(r)))) if dtd.children(r) else F.array().cast("array<string>")
        alien = F.size(F.array_except(children, allowed)) > 0
        misplaced = misplaced | ((kind == r) & alien)
        model = model | ((kind == r) & ~alien & ~sequence.rlike(r"\A" + dtd.model(r) + r"\z"))
        for a in dtd.required.get(r, []):
            # a record that was found by its key has it; the rest of its start tag may stand before the key
            missing = missing | ((kind == r) & full & ~tag.rlike(r"\s" + re.escape(a) + r"\s*="))
    references = F.regexp_extract_all(plain, F.lit(r"&(" + _NAME + r");"), F.lit(1))
    entities = F.array(*map(F.lit, sorted({*dtd.entities, *PREDEFINED})))
    rules = {"unclosed_record": kind == "", "missing_attribute": missing, "undeclared_element": (kind != "") & undeclared,
             "misplaced_element": misplaced & ~undeclared, "content_model": model,
             "undeclared_entity": (kind != "") & (F.size(F.array_except(references, entities)) > 0)}
    return F.filter(F.array(*[F.when(broken, F.lit(rule)) for rule, broken in rules.items()]), lambda r: r.isNotNull())


def violations(spark: SparkSession, path: str, dtd: Dtd, records: tuple[str, ...], sep: str, parse) -> DataFrame:
    """(rule, type, key): what breaks the declarations in the XML files under
    ``path``.  ``records`` are the record elements and ``parse`` cuts whole chunks
    into (type, key, body, raw).  An element with a key that is no record counts
    as ``unknown_record``."""
    chunks = read_chunks(spark, path, sep)
    judged = materialize(judge_chunks(chunks, records), "dtd-judged")
    found = parse(whole_records(chunks, judged, sep))
    rules = record_rules(F.col("type"), F.col("raw"), F.col("body"), dtd, records)
    strange = judged.where("mode = 0 AND NOT head AND opened != ''").select(
        F.lit("unknown_record").alias("rule"), F.col("opened").alias("type"), F.lit(None).cast("string").alias("key"))
    return found.select(F.explode(rules).alias("rule"), "type", F.nullif("key", F.lit("")).alias("key")).unionByName(strange)
