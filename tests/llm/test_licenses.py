"""License scans: own lines, licence files and inheritance."""

import pytest

from runlens.llm import licenses


def table(spark, rows):
    return spark.createDataFrame([(*r, "old", 1) for r in rows], "path string, text string, licence string, file int")


def scan(spark, rows):
    out = licenses.scan(table(spark, rows))
    assert out.columns == ["path", "file", "licence", "licence_score", "licence_line", "licence_from"]
    return {r["path"]: (r["licence"], r["licence_line"], r["licence_from"]) for r in out.collect()}


FILLER = [(f"other/{i}.txt", f"Some words of prose number {i} about the work and the version of a thing.") for i in range(60)]


def test_own_and_inherited(spark):
    rows = FILLER + [
        ("LICENSE", "Released under the MIT License."),
        ("a/LICENSE.txt", "Copyright someone\n\nLicensed under the\nApache License, Version 2.0."),
        ("a/copying", "nothing to see"),
        ("a/b/x.c", "int main;\r\n// Licensed under CC BY-NC 4.0.\r\nreturn"),
        ("a/b/y.c", "plain text"),
        ("a/b/c/z.c", None),
        ("ab/w.c", ""),
        ("v.c", "licensed under nothing at all in particular, says the author of the work"),
        ("q/LICENSE", "This work is licensed under the GNU General Public License, version 3."),
        ("q/NOTICE", "Released under the MIT License."),
        ("q/f", "x"),
        ("long/l", "word " * 50_000 + "\nReleased under the MIT License.\n" + "word " * 50_000),
    ]
    got = scan(spark, rows)
    assert got["LICENSE"] == ("MIT", 0, "LICENSE")
    assert got["a/LICENSE.txt"][0] == "Apache-2.0"
    assert got["a/copying"] == ("Apache-2.0", None, "a")
    assert got["a/b/x.c"] == ("CC-BY-NC-4.0", 2, "a/b/x.c")
    assert got["a/b/y.c"] == got["a/b/c/z.c"] == ("Apache-2.0", None, "a")
    assert got["ab/w.c"] == got["v.c"] == got["other/1.txt"] == ("MIT", None, "")
    assert got["q/f"][0] in ("GPL-3.0", "MIT") and got["q/f"][2] == "q"
    assert got["long/l"] == ("MIT", 2, "long/l")


def test_versions_are_told_apart(spark):
    rows = FILLER + [(f"t/{kind}/{k}/LICENSE", text) for k, (_, kind, text) in enumerate(licenses.TEMPLATES)]
    got = scan(spark, rows)
    for k, (name, kind, _) in enumerate(licenses.TEMPLATES):
        assert got[f"t/{kind}/{k}/LICENSE"][:2] == (name, 0)
    assert got["other/3.txt"] == (None, None, None)


def test_edges(spark):
    assert scan(spark, []) == {}
    rows = licenses.scan(table(spark, [(None, "Released under the MIT License."), (None, "x"), ("p", "Released under the MIT License."), ("p", "Released under the MIT License.")])).collect()
    assert sorted((r["path"] or "", r["licence"] or "") for r in rows) == [("", ""), ("", "MIT"), ("p", "MIT"), ("p", "MIT")]
    plan = licenses.scan(table(spark, FILLER))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan


def test_light_terms_cannot_reach_the_threshold():
    w = licenses.Weights(licenses.TEMPLATES, 1000, {"the": 900, "this": 500, "under": 300, "is": 800}, 0.8)
    by = {}
    for template, _, kind, term, weight in w.vectors:
        if kind == licenses.NOTICE:
            by.setdefault(template, {})[term] = weight
    assert len(by) == 10
    for own in by.values():
        assert sum(x * x for t, x in own.items() if t not in w.heavy) < 0.64


MIT = """The MIT License (MIT)

Copyright (c) 2024 Some Person and others

Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation
the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and
to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions
of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO
THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT,
TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE.
"""


def test_whole_licence_files(spark):
    """A licence file as it is found, with its copyright line; the same text in another file is no licence of its own."""
    by = {(name, kind): text for name, kind, text in licenses.TEMPLATES}
    wrapped = by["BSD-3-Clause", "text"].replace(". ", ".\n").replace("Copyright (c)", "Copyright (c) 2019, The Someone Project Authors")
    rows = FILLER + [("m/LICENSE", MIT), ("m/src/a.c", "int x;"), ("b/COPYING.txt", wrapped), ("p/prose.txt", MIT), ("b/x/y.c", None)]
    got = scan(spark, rows)
    assert got["m/LICENSE"] == ("MIT", 0, "m/LICENSE") and got["m/src/a.c"] == ("MIT", None, "m")
    assert got["b/COPYING.txt"][0] == "BSD-3-Clause" and got["b/x/y.c"] == ("BSD-3-Clause", None, "b")
    assert got["p/prose.txt"] == (None, None, None)


def test_templates_from_a_table(spark):
    own = [("House", "notice", "Property of the house, not to be passed on."), (None, "notice", "x"), ("Empty", "notice", "..."), ("Long", "text", "the house rules in full " * 3)]
    table_of = lambda rows: spark.createDataFrame(rows, "licence string, kind string, text string")
    rows = FILLER + [("a/f.c", "// Property of the House; not to be passed on"), ("b/LICENSE", "The house rules, in full."), ("b/g", "x")]
    out = licenses.scan(table(spark, rows), templates=table_of(own)).collect()
    got = {r["path"]: r["licence"] for r in out if r["licence"]}
    assert got == {"a/f.c": "House", "b/LICENSE": "Long", "b/g": "Long"}
    for bad in ([("A", "other", "x y")], [("A", "text", " ".join(f"w{i}" for i in range(3000)))]):
        with pytest.raises(ValueError):
            licenses.scan(table(spark, rows), templates=table_of(bad))
    assert licenses.scan(table(spark, rows), templates=[]).where("licence is not null").count() == 0
