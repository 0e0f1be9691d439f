import json

import random

from lontar.operators.nested import Automaton, Number, _parse_deep, flatten, items, layout, parse, tables, text, variant, variants

LINKED = {"structure": [{"node_id": "a", "parent_id": None, "path": ["x", 6, None], "refs_out": {"raw": "r"}}, {"node_id": "b", "parent_id": "a", "extraction": {"flags": "f"}}]}
NESTED = {"structure": [{"node_id": "a", "path": "x", "children": [{"node_id": "b", "parent_id": "zz", "refs_out": [{"type": "t"}, {"raw": ""}], "children": [{"node_id": "c"}]}]}]}
PARTS = {"structure": {"p": [{"node_id": "a", "path": []}], "q": [{"node_id": "b", "extraction": {"flags": ["f", "g"]}}]}}


def test_variants_and_items():
    assert flatten(json.dumps(LINKED)) == [("a", "node", 0, ""), ("a", "path", 0, "x"), ("a", "path", 1, "6"), ("a", "path", 2, ""), ("a", "ref", 0, "r"), ("b", "node", 0, "a"), ("b", "flag", 0, "f")]
    assert flatten(json.dumps(NESTED)) == [("a", "node", 0, ""), ("a", "path", 0, "x"), ("b", "node", 0, "a"), ("b", "ref", 0, ""), ("b", "ref", 1, ""), ("c", "node", 0, "b")]
    assert [x[0] for x in flatten(json.dumps(PARTS))] == ["a", "b", "b", "b"]
    assert variant(json.dumps(LINKED)) == ("linked+single_ref+single_flag", 2)
    assert variant(json.dumps(NESTED))[0] == "nested+single_path"
    assert variant(json.dumps(PARTS))[0] == "parts"


def test_broken_records():
    for raw in (None, "", "{", "[]", "1", '{"structure": NaN}', '{"structure": 3}', json.dumps(LINKED)[:-2], '{"a": 1} x'):
        assert flatten(raw) == [] and variant(raw) is None
    deep = '{"structure": ' + "[" * 300 + "]" * 300 + "}"
    assert flatten(deep) == []
    assert flatten('{"structure": [{"node_id": null, "children": [{"node_id": 7}]}]}') == [("7", "node", 0, "")]
    assert flatten('{"structure": [{"node_id": "\\ud800"}]}')[0][1] == "node"


def test_rows(spark):
    rows = [(1, json.dumps(LINKED), 5), (1, json.dumps(LINKED), 6), (2, None, 5), (3, "{", 5), (None, json.dumps(PARTS), 5), (4, json.dumps({"structure": [{"node_id": "n", "path": ["x" * 200_000]}]}), 5)]
    d = spark.createDataFrame(rows, "raw_id long, raw string, item_no int")
    got = items(d, "raw_id", "raw")
    assert got.count() == 7 + 4 + 2 and variants(d, "raw_id", "raw").count() == 3
    assert items(d.limit(0), "raw_id", "raw").count() == 0


def test_numbers_and_depth_are_kept():
    raw = '{"structure": [{"node_id": 1.50, "path": [1e2, -0, ' + "7" * 5000 + ', [1.0, {"a": "é"}]]}]}'
    assert [x[3] for x in flatten(raw)] == ["", "1e2", "-0", "7" * 5000, '[1.0, {"a": "é"}]'] and flatten(raw)[0][0] == "1.50"
    deep = '{"structure": [{"node_id": "a", "path": ' + "[" * 20_000 + "5" + "]" * 20_000 + '}, {"node_id": "b"}]}'
    got = flatten(deep)
    assert [x[:3] for x in got] == [("a", "node", 0), ("a", "path", 0), ("b", "node", 0)] and got[1][3] == "[" * 19_999 + "5" + "]" * 19_999
    inside = '{"node_id": "n", "children": [' * 5000 + "]}" * 5000
    assert len(flatten('{"structure": [' + inside + "]}")) == 5000


def plainly(value):
    if isinstance(value, Number):
        return ("number", value.text)
    if isinstance(value, dict):
        return {k: plainly(v) for k, v in value.items()}
    return [plainly(v) for v in value] if isinstance(value, list) else value


def test_parser_for_any_depth_equals_the_decoder():
    rnd = random.Random(3)
    pieces = ["{", "}", "[", "]", ",", ":", '"a"', '"\\u00e9"', "1", "-2.5e3", "01", "true", "null", " ", "NaN", '"x', "\n", "1.", '"b": ', "[1, 2]", '{"k": []}']
    tried = [''.join(rnd.choice(pieces) for _ in range(rnd.randint(1, 8))) for _ in range(30_000)]
    tried += ['{"a": [1, {"b": [[], {}, [null, "x"]]}], "a": 2} ', "[]", "{}", ' "s" ', "[1,]", "{,}", '{"a":}', "[1 2]", "]", ""]
    for raw in tried:
        try:
            mine = plainly(_parse_deep(raw))
        except ValueError:
            mine = None
        assert mine == plainly(parse(raw)), raw


def test_layouts_are_routed_by_state():
    of = lambda raw: (lambda top: layout(top, Automaton().run(top)[id(top)]))(parse(raw))
    assert of('[{"node_id": 1}, {"node_id": 2, "children": []}]') == of("[]") == "linked"
    assert of('[[{"node_id": 1}]]') == of('{"p": [{"node_id": 1}]}') == of('[{"node_id": 1}, 4]') == "parts"
    assert of('{"p": {"q": [{"node_id": 1, "children": [{"node_id": 2}]}]}}') == "nested"


def test_typed_tables(spark):
    rows = [(i, json.dumps(r)) for i, r in enumerate((LINKED, NESTED, PARTS))]
    t = tables(spark.createDataFrame(rows, "raw_id long, raw string"), "raw_id", "raw")
    rows_of = lambda name: sorted(tuple(r) for r in t[name].collect())
    assert rows_of("linked_nodes") == [("0", "a", ""), ("0", "b", "a")]
    assert rows_of("nested_nodes") == [("1", "a", "", 0), ("1", "b", "a", 1), ("1", "c", "b", 2)]
    assert rows_of("part_nodes") == [("2", "a", "p", ""), ("2", "b", "q", "")]
    assert rows_of("refs") == [("0", "a", 0, "r", None, None), ("1", "b", 0, "", None, "t"), ("1", "b", 1, "", None, None)]
    assert {(r.record, r.node_id, r.parent_id, r.layout) for r in t["nodes"].collect()} == {("0", "a", "", "linked"), ("0", "b", "a", "linked"), ("1", "a", "", "nested"), ("1", "b", "a", "nested"), ("1", "c", "b", "nested"), ("2", "a", "", "parts"), ("2", "b", "", "parts")}
    assert text([1, "a"]) == '[1, "a"]'
