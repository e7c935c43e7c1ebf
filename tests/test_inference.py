import json

from pyspark.sql import functions as F

from vigilake.functions.names import first_name
from vigilake.operators import inference as I
from vigilake.operators import linkage as L
from vigilake.plans.reference import strength_and_form


def test_batches_answers_and_bad_answers(spark):
    def make():
        def model(texts):
            assert len(texts) <= 2
            return [json.dumps([{"ingredients": [t, None], "strength": 5}]) if t != "bad" else "no json" for t in texts]

        return model

    df = spark.createDataFrame([("a",), ("a",), ("bad",), (None,), ("c",)], "name string").repartition(1)
    out = {r.name: (r.ingredients, r.strength) for r in I.infer(df, "name", make, 2).collect()}
    assert out == {"a": (["a"], "5"), "bad": (None, None), "c": (["c"], "5")}


def test_stand_in(spark):
    df = spark.createDataFrame([("FOO 10 MG TABLET",), ("BAR",), ("",)], "name string")
    out = {r.name: (r.ingredients, r.strength, r.dosage_form) for r in I.infer(df, "name", strength_and_form).collect()}
    assert out == {"FOO 10 MG TABLET": (["FOO "], "10 MG", "TABLET"), "BAR": (["BAR"], None, None), "": (None, None, None)}


def test_statuses_and_name_blocks(spark):
    table = spark.createDataFrame([("aspirin", "1")], "name string, rxcui string")
    df = spark.createDataFrame([("k", ["Aspirin", "aspirine", "zzz"]), ("e", [])], "k string, names array<string>")
    assert {r.k: r.statuses for r in L.ingredient_status(df, "names", table, "k").collect()} == {"k": ["exact", "approx", "not_found"], "e": None}
    block = spark.createDataFrame([("ENTRY  D1\nNAME        Foo bar (JAN);\n            Other\n",), ("x",)], "b string")
    assert [r[0] for r in block.select(first_name(F.col("b"))).collect()] == ["Foo bar", None]
