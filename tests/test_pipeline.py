"""Tools, plugins, scripts and stream decoders."""

import sys

import pytest

from quern.operators import assembly as A
from quern.operators import pipeline as P
from quern.streaming.decoders import EventBus, HandleDecoder, JsonFieldDecoder


def test_tools():
    t = P.Tools(most=20)
    t.add(P.Tool("add", "adds", {"required": ["a"], "properties": {"a": {"type": "integer"}, "b": {"type": "array", "items": {"type": "integer"}}}}, lambda a, b=(): {"sum": a + sum(b)}))
    t.add(P.Tool("long", "", {}, lambda: "x" * 50))
    assert t.call("add", '{"a": "2", "b": 3}') == '{"sum": 5}' and t.call("add", "{}").startswith("error: a: missing") and t.call("add", "{").startswith("error") and t.call("none", {}).startswith("error")
    assert "30 characters left out" in t.call("long", {}) and [d["name"] for d in t.describe()] == ["add", "long"]
    with pytest.raises(ValueError):
        t.add(P.Tool("add", "", {}, print))


def test_plugins_and_transforms():
    p = P.Plugins()
    p.register(lambda s, nxt: nxt([*s, "a"]), ["x", "y"])
    p.register(lambda s, nxt: [*nxt(s), "z"], ["x"])
    p.register(lambda s, nxt: [*s, "stop"], ["x"])
    p.register(lambda s, nxt: nxt([*s, "never"]), ["x"])
    assert p.trigger("x", []) == ["a", "stop", "z"] and p.trigger("y", []) == ["a"] and p.trigger("none", [1]) == [1]
    t = P.Transforms()
    t.add("up", 1, str.upper)
    t.add("up", 2, str.lower)
    assert t.get("up")("A") == "a" and t.get("up", 1)("a") == "A" and t.get("identity")("x") == "x"
    for bad in (("up", 3), ("no", None)):
        with pytest.raises(KeyError):
            t.get(*bad)


def test_scripts(spark):
    code = "import json,sys,time; d=json.load(sys.stdin); d['n']=='slow' and time.sleep(9); print(json.dumps({'got': d['n']}) if d['n']!='bad' else 'no json') if d['n']!='fail' else sys.exit('broke')"
    df = spark.createDataFrame([('{"n": "ok"}',), ('{"n": "bad"}',), ('{"n": "fail"}',), ('{"n": "slow"}',)], "j string")
    got = [(r.output, r.error) for r in P.run_script(df.coalesce(1), "j", [sys.executable, "-c", code], seconds=3).collect()]
    assert got[0] == ('{"got": "ok"}', None) and got[1] == (None, "output is no JSON") and "broke" in got[2][1] and got[3] == (None, "timed out")


@pytest.mark.parametrize("n", [1, 2, 3, 7, 100])
def test_decoders_do_not_depend_on_the_pieces(n):
    pieces = lambda s: [s[i : i + n] for i in range(0, len(s), n)]
    text = "see [[c1]] and [[no]] or [ [[c2]][x[[" + "y" * 60 + "]]"
    d = HandleDecoder({"c1": "<one>", "c2": "<two>"})
    assert "".join(map(d.feed, pieces(text))) + d.close() == text.replace("[[c1]]", "<one>").replace("[[c2]]", "<two>") and d.used == ["c1", "c2"]
    j = JsonFieldDecoder()
    assert "".join(map(j.feed, pieces('{"other": "x", "answer" : "a\\n\\"b\\" \\u00e9 \\ud83d\\ude00 \\\\", "more": "y"}'))) == 'a\n"b" é 😀 \\' and j.done


def test_events():
    b, seen = EventBus(), []
    b.on("a", seen.append)
    b.on("a", lambda e: 1 / 0)
    b.on("a", lambda e: seen.append("after"))
    with pytest.raises(ZeroDivisionError):
        b.emit("a", {"x": 1})
    assert seen == [{"x": 1}, "after"] and b.emit("none", {}) == []


def test_requests():
    k = A.knn_request([1.0], 5, 0.2, {"tag": ["b"], "empty": []})
    assert k["min_score"] == 0.2 and k["query"]["knn"]["embedding"]["filter"]["bool"]["filter"] == [{"terms": {"tag": ["b"]}}]
    assert "min_score" not in A.match_request("q", 3) and A.match_request("q", 3)["query"]["bool"]["must"] == [{"match": {"content": "q"}}]
