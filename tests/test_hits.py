"""Search answers: quotes, nesting, what cannot be read."""

from __future__ import annotations

import json
import re

import pytest
from pyspark.sql import functions as F

from tidemark.sources.hits import explode_hits, parse_entry

GOOD = [
    ("{'Namespace':'a.b','Key':'k','Value':{'n':1,'t':'x'}}", ("a.b", "k", {"n": "1", "t": "x"})),
    (r"{'Namespace':'a','Key':'it\'s','Value':{}}", ("a", "it's", {})),
    ("{'Namespace':'a','Key':'it's','Value':{'o':'the dogs' bone'}}", ("a", "it's", {"o": "the dogs' bone"})),
    ("{'Namespace':'a','Key':'say \"hi\"','Value':{'d':{'e':[1,{'f':'g'}]},'h':null,'i':false}}", ("a", 'say "hi"', {"d": '{"e":[1,{"f":"g"}]}', "h": None, "i": "false"})),
    ('{"Namespace":"a","Key":"k"}', ("a", "k", {})),
    ("{ 'Key' : 'k' , 'Other' : 3 , 'Namespace' : 'a' , 'Value' : { 'x' : 'y, z: {w}' } }", ("a", "k", {"x": "y, z: {w}"})),
    ("{'Namespace':'å','Key':'日本','Value':{'é':'ü'}}", ("å", "日本", {"é": "ü"})),
]
BAD = ["", "no entry", "{'Namespace':'a','Key':", "{'Namespace':'a'}", "{'Key':'k','Value':{}}", "{'Namespace':'a','Key':'k','Value':5}", "[1, 2]", "null"]


@pytest.mark.parametrize("text,want", GOOD)
def test_entries(spark, text, want):
    row = spark.createDataFrame([(text,)], "t string").select(parse_entry("t").alias("e")).first().e
    assert (row.namespace, row.key, row.value) == want and row.bad is None


@pytest.mark.parametrize("text", BAD)
def test_what_is_no_entry_is_put_aside(spark, text):
    row = spark.createDataFrame([(text,)], "t string").select(parse_entry("t").alias("e")).first().e
    assert (row.namespace, row.key, row.value, row.bad) == (None, None, None, text)


def test_documents(spark):
    one = "{'Namespace':'a','Key':'k','Value':{'n':1}}"
    answers = [
        (1, json.dumps({"s1": [one, one.replace("'k'", "'l'")], "s2": [one], "s3": [], "s4": ["?"]})),
        (2, json.dumps(["s5", "s6"])),
        (3, "no document"),
        (4, None),
        (5, "{}"),
        (6, " [ ] "),
        (7, json.dumps({"s7": [{"Namespace": "a", "Key": "it's", "Value": {"n": [1]}}]})),
    ]
    got = explode_hits(spark.createDataFrame(answers, "doc int, answer string"), keep=["doc"])
    rows = sorted((r.doc, r.series_id or "", r.key or "", r.bad or "") for r in got.collect())
    assert rows == [(1, "s1", "k", ""), (1, "s1", "l", ""), (1, "s2", "k", ""), (1, "s3", "", ""), (1, "s4", "", "?"),
                    (2, "s5", "", ""), (2, "s6", "", ""), (3, "", "", "no document"), (7, "s7", "it's", "")]
    assert got.where("doc = 7").select(F.col("value")["n"].alias("n")).first().n == "[1]"
    assert got.columns == ["doc", "series_id", "namespace", "key", "value", "bad"]


def test_work_in_proportion_to_the_hits(spark):
    """A large document: nothing but a hit's own part goes into its rows, and each parse is there once."""
    one = "{'Namespace':'a','Key':'k','Value':{'n':1}}"
    answers = spark.createDataFrame([(1, json.dumps({f"s{n}": [one, one] for n in range(2_000)}))], "doc int, answer string")
    got = explode_hits(answers, keep=["doc"])
    assert got.filter("namespace = 'a' and value['n'] = '1' and bad is null").count() == 4_000
    node, carried = got._jdf.queryExecution().optimizedPlan(), []
    assert node.toString().count("from_json(") == 4
    while node.children().size():
        if node.nodeName() == "Generate":
            carried.append(re.findall(r"(\w+)#", node.requiredChildOutput().toString()))
        node = node.children().apply(0)
    assert carried == [["doc", "_unread", "series_id"], ["doc", "_unread"]]
