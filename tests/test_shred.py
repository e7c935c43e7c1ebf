import json
import random

from vigilake.operators import shred as S


def frame(spark, payloads):
    return spark.createDataFrame([(i, p, "x") for i, p in enumerate(payloads)], "record_id bigint, payload string, fields string")


def brute(payloads):
    """Child rows by plain walking."""
    out = set()
    as_list = lambda x: [x] if isinstance(x, dict) else x if isinstance(x, list) else []
    for i, p in enumerate(payloads):
        try:
            x = json.loads(p)
        except (TypeError, ValueError):
            continue
        if not isinstance(x, dict):
            continue
        for r in x["results"] if isinstance(x.get("results"), list) else [x]:
            if not isinstance(r, dict):
                continue
            k = r.get("safetyreportid")
            k = None if k is None else str(k)
            patient = r.get("patient") if isinstance(r.get("patient"), dict) else {}
            reaction = patient.get("reaction")
            if isinstance(reaction, str):
                try:
                    reaction = json.loads(reaction)
                except ValueError:
                    reaction = []
            out |= {(i, k, "reaction", n, -1) for n, y in enumerate(as_list(reaction)) if y is not None}
            for n, drug in enumerate(as_list(patient.get("drug"))):
                if drug is None:
                    continue
                out.add((i, k, "drug", n, -1))
                substance = drug.get("activesubstance")
                for name, items in (("activesubstance", [substance] if isinstance(substance, str) else as_list(substance)), ("drugrecurrence", as_list(drug.get("drugrecurrence")))):
                    out |= {(i, k, name, n, m) for m, y in enumerate(items) if y is not None}
    return out


def found(spark, payloads, **more):
    return {tuple(r) for r in S.children(S.shred(frame(spark, payloads), **more)).collect()}


def test_shapes(spark):
    payloads = [
        '{"safetyreportid": 5, "patient": {"drug": {"activesubstance": "A"}, "reaction": "[{\\"reactionmeddrapt\\": \\"R\\"}, null]"}}',
        '{"results": [{"safetyreportid": "7", "patient": {"drug": [null, {"drugrecurrence": {"drugrecuraction": "x"}}, {"activesubstance": [{"activesubstancename": "B"}, null, {}]}]}}, null, {"safetyreportid": "8"}]}',
        '{"patient": {"reaction": []}}', '{"patient": null}', "{}", "[]", "null", "3", "", None, '{"a": 1', '{"safetyreportid": NaN}', '{"patient": {"reaction": "no json"}}',
        '{"safetyreportid": "\\ud800", "patient": {"reaction": {"reactionmeddrapt": "\\ud800 x"}}}',
    ]
    assert found(spark, payloads[:-1]) == brute(payloads[:-1])
    for node in (S.REACTION, S.DRUG, S.SUBSTANCE, S.RECURRENCE):
        assert found(spark, payloads[:-1], only=node) == {r for r in brute(payloads[:-1]) if r[2] == node.name}
    assert S.table(S.shred(frame(spark, payloads[-1:])), S.REACTION).first().reactionmeddrapt.endswith(" x")


def test_random_records(spark):
    rng = random.Random(1)
    pick = lambda *x: rng.choice(x)()
    leaf = lambda: rng.choice(["a", 1, 2.5, None, True, {"k": [1]}])
    node = lambda *names: {n: leaf() for n in names if rng.random() < 0.7}
    many = lambda make: pick(lambda: None, lambda: [], make, lambda: [rng.choice([None, make()]) for _ in range(rng.randrange(4))])

    def drug():
        x = node("medicinalproduct", "x")
        x["activesubstance"] = rng.choice(["S", many(lambda: node("activesubstancename"))])
        x["drugrecurrence"] = many(lambda: node("drugrecuraction"))
        return x

    def report():
        return {"safetyreportid": rng.choice(["1", 2, None]), "patient": rng.choice([None, {"drug": many(drug), "reaction": rng.choice([many(lambda: node("reactionmeddrapt")), json.dumps([{}, None])])}])}

    payloads = [json.dumps(rng.choice([report(), {"results": [rng.choice([report(), None]) for _ in range(rng.randrange(4))]}])) for _ in range(700)]
    assert found(spark, payloads) == brute(payloads)


def test_tables_link_and_hold_leaves(spark):
    p = {"safetyreportid": "9", "patient": {"patientsex": 2, "drug": [{"medicinalproduct": "D", "activesubstance": ["S", {"activesubstancename": "T"}]}]}}
    s = S.shred(frame(spark, [json.dumps(p), json.dumps({"results": [p, p]})]))
    assert [r.patientsex for r in S.table(s, S.REPORT).collect()] == ["2"] * 3
    subs = {tuple(r) for r in S.table(s, S.SUBSTANCE).collect()}
    assert (0, 0, "9", 0, 1, "T") in subs and (1, 1, "9", 0, 0, "S") in subs and len(subs) == 6
    assert S.table(s, S.DRUG).filter("record_id = 1").count() == 2


def test_depth_beside_the_leaves(spark):
    deep = "[" * 60_000 + "]" * 60_000
    texts = ['{"safetyreportid": "1", "x": %s, "patient": {"drug": [{"medicinalproduct": "D", "openfda": %s}, null]}}' % (deep, deep), '{"x": %s}' % deep[:-1], '{"x": %s, "y"}' % deep]
    rows = S.shred(frame(spark, texts)).collect()
    assert [(r.table, r.entry) for r in rows] == [("report", -1), ("drug", 0)] and rows[1].fields["medicinalproduct"] == "D" and rows[1].fields["openfda"] is None


def test_parser_without_recursion():
    import pytest

    good = ['{"a": [1, -2.5e3, "x\\"\\u00e9", {}, [], {"b": null, "b": true}], "c": {"d": false}} ', "[]", ' "x"', "3", "null", "[[],[[]]]"]
    for t in good:
        assert S._loads_deep(t) == json.loads(t)
    for t in ["", "[", "{", "[1,]", '{"a"}', '{"a":}', '{"a":1,}', "[1 2]", "]", "{]", "[}", "01", '{"a" 1}', "[1]x", '"\n"', "NaN", ",", "{1:2}", '[1}', '"\\x"']:
        with pytest.raises(ValueError):
            S._loads_deep(t)


def test_openfda_blocks_as_rows(spark):
    p = {"safetyreportid": "9", "patient": {"drug": [{"openfda": {"rxcui": ["1", "2", None], "route": "ORAL", "x": None, "n": 5}}, {"openfda": "text"}, {}]}}
    rows = S.openfda_rows(S.tables(frame(spark, [json.dumps(p)]))["drug"]).collect()
    assert {tuple(r) for r in rows} == {("rxcui", "1", "9", 0), ("rxcui", "2", "9", 0), ("route", "ORAL", "9", 0), ("n", "5", "9", 0)}


def test_real_records_and_empty(spark, small):
    raw = spark.read.parquet(f"{small}/raw_reports.parquet")
    payloads = [(r.record_id, r.payload) for r in raw.collect()]
    expected = {(payloads[i][0], *rest) for i, *rest in brute([p for _, p in payloads])}
    assert {tuple(r) for r in S.children(S.shred(raw)).collect()} == expected
    assert S.shred(frame(spark, [])).count() == 0


def test_levels():
    s = S.Shredder(S.REPORT, {"report": (("safetyreportid",),)})
    s.add([{"safetyreportid": "1", "patient": {"drug": [{}, {"activesubstance": ["a", "b"]}]}}, None])
    c = s.columns["activesubstance", ("activesubstancename",)]
    assert (c.reps, c.defs, c.values) == ([0, 2, 3, 1], [4, 7, 7, 1], ["a", "b"])
