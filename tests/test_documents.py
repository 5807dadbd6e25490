"""Reading documents with the union of their keys, against a plain parser."""

import json
import random

from cohortium.sources import documents as D


def frame(spark, texts):
    return spark.createDataFrame([(t,) for t in texts], "doc string")


def test_union_of_random_documents(spark):
    rnd = random.Random(4)
    values = {"n": lambda: rnd.randrange(-9, 9), "x": lambda: rnd.randrange(9) + 0.25, "s": lambda: rnd.choice(["a", "", "é \" \\"]),
              "b": lambda: rnd.random() < 0.5, "mixed": lambda: rnd.choice([1, "1", True, 2.5]), "o": lambda: {"k": rnd.randrange(3)},
              "l": lambda: [1, "x"], "nothing": lambda: None, "a.b": lambda: 1, "it's": lambda: "q", 'say "x"': lambda: 2,
              "_id": lambda: "dropped", "both'\"": lambda: "z", "n_or_x": lambda: rnd.choice([1, 1.5])}
    docs = [{k: f() for k, f in values.items() if rnd.random() < 0.5} for _ in range(300)]
    got = D.read_union(frame(spark, [json.dumps(d) for d in docs]), "doc")
    assert set(got.columns) == set(values) - {"_id"}
    kinds = {f.name: f.dataType.simpleString() for f in got.schema.fields}
    assert kinds == {"n": "bigint", "x": "double", "s": "string", "b": "boolean", "mixed": "string", "o": "string", "l": "string",
                     "nothing": "string", "a.b": "bigint", "it's": "string", 'say "x"': "bigint", "both'\"": "string", "n_or_x": "double"}

    def shown(key, v):
        if v is None:
            return None
        if kinds[key] == "string" and not isinstance(v, str):
            return json.dumps(v, separators=(",", ":"))
        return v

    def order(rows):
        return sorted(rows, key=repr)

    want = order([tuple(shown(k, d.get(k)) for k in got.columns) for d in docs])
    assert order(map(tuple, got.collect())) == want


def test_profile_counts_kinds(spark):
    texts = ['{"a":1,"b":null}', '{"a":"x"}', '{"a":[1]}', '{"a":{"c":1}}', '{"a":null}', "junk", None, "[1,2]", "3", "{}", '{"a":1,"a":2}']
    got = {r.key: (r.n_docs, r.n_null, r.kinds) for r in D.key_profile(frame(spark, texts), "doc").collect()}
    assert got == {"a": (5, 1, "array,integer,object,text"), "b": (1, 1, "")}


def test_rows_without_keys_stay(spark):
    got = D.read_union(frame(spark, ["junk", None, "[1]", "{}", '{"k":"v"}']), "doc", {"absent": "double"})
    assert got.columns == ["absent", "k"] and sorted((r.k or "" for r in got.collect())) == ["", "", "", "", "v"]
    assert D.read_union(frame(spark, []), "doc", {"a": "long"}).columns == ["a"]


def test_large_and_decimal_numbers(spark):
    got = D.read_union(frame(spark, ['{"big":12345678901234567890123,"x":1}', '{"big":7,"x":2.5}', '{"x":1e400}']), "doc")
    rows = {(str(r.big), r.x) for r in got.collect()}
    assert rows == {("12345678901234567890123", 1.0), ("7", 2.5), ("None", float("inf"))} or ("None", None) in rows


def test_columns_that_differ_by_case(spark):
    assert D.column_names(["customerId", "customerID", "a", "A", "A_"]) == {
        "customerId": "customerId", "customerID": "customerID_", "A": "A", "A_": "A_", "a": "a__"}
    got = D.read_union(frame(spark, ['{"a":1,"A":"x"}', '{"a":2}']), "doc")
    assert {(r["a_"], r["A"]) for r in got.collect()} == {(1, "x"), (2, None)}
