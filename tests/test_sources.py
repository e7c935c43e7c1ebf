import gzip
import json
from datetime import date

import pytest
from pyspark.sql import functions as F

from vigilake.functions import lexicons as X
from vigilake.operators.shred import REACTION, children, shred
from vigilake.plans import runner
from vigilake.plans import stages as P
from vigilake.sources import readers, writers
from vigilake.streaming.landing import land, landed


def test_delimited_files_with_differing_headers(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,name\n1,x\n2,NA\n")
    with gzip.open(tmp_path / "b.csv.gz", "wt") as f:
        f.write("name,extra,id\ny,?,3\n")
    with gzip.open(tmp_path / "c.csv.gzip", "wt") as f:
        f.write("id,name\nbad,z\n")
    out = readers.read_delimited(spark, str(tmp_path), ["id", "name", "absent"], {"id": "bigint"})
    assert sorted((tuple(r) for r in out.collect()), key=str) == sorted([(1, "x", None), (2, None, None), (3, "y", None), (None, "z", None)], key=str)
    with pytest.raises(FileNotFoundError):
        readers.list_files(spark, str(tmp_path / "none"))


def test_damaged_files_are_named(spark, tmp_path):
    good = gzip.compress(b"key,value\nrxcui,1\n" * 500)
    (tmp_path / "cut.csv.gz").write_bytes(good[: len(good) // 2])
    (tmp_path / "good.csv.gz").write_bytes(gzip.compress(b"key,value\nrxcui,1\n"))
    (tmp_path / "empty.csv").write_text("key,value\n")
    (tmp_path / "other.csv").write_text("key,value\nx,1\n")
    (tmp_path / "columns.csv").write_text("a,b\n1,2\n")
    out = {r.file.rsplit("/", 1)[1]: r.reason for r in readers.diagnose(spark, str(tmp_path), ["key"], ("key", ["rxcui"])).collect()}
    assert out == {"cut.csv.gz": "gzip_corrupt_or_truncated", "good.csv.gz": None, "empty.csv": "empty_csv", "other.csv": "empty_after_filter", "columns.csv": "missing_cols"}


def test_headers_read_one_line(spark, tmp_path):
    """A file that is damaged further on, and one whose line would be unreadable, still give their header."""
    import random

    body = b"".join(random.Random(1).randbytes(40).hex().encode() + b",1\n" for _ in range(30_000))
    whole = gzip.compress(b"id,name\n" + body)
    (tmp_path / "a.csv.gz").write_bytes(whole[: len(whole) // 2] + b"\0" * 5000)
    (tmp_path / "b.csv").write_bytes(b"x,y\r\n" + b"\xff" * 100)
    (tmp_path / "c.csv").write_bytes(b"")
    files = readers.list_files(spark, str(tmp_path))
    assert [readers.headers(spark, files)[f] for f in files] == ["id,name", "x,y", ""]


def test_results_are_split_as_they_come():
    import random

    rng, one = random.Random(2), {"safetyreportid": "1", "x": ['a "q" \\\\ {[', {"results": [1]}], "y": "]}"}
    for doc, expected in (
        ({"meta": {"results": 3, "n": [1]}, "results": [one, {}, one], "after": [one]}, [one, {}, one]), ({"results": []}, []), ({"results": [one]}, [one]), (one, [one]), ([one], [[one]]), ({"results": {"a": 1}}, [{"results": {"a": 1}}]),
        ({"a": "results", "b": [one]}, [{"a": "results", "b": [one]}]),
    ):
        for text in (json.dumps(doc), json.dumps(doc, indent=1)):
            for size in (1, 2, 3, 7, len(text)):
                assert [json.loads(x) for x in readers.split_results(text[i : i + size] for i in range(0, len(text), size))] == expected, (text, size)
    assert list(readers.split_results(['{"results": [{"a": 1}, {"b"'])) == ['{"a": 1}', '{"b"'] and list(readers.split_results([])) == [] and rng


def test_large_report_file_is_streamed(spark, tmp_path):
    from vigilake.sources import readers as module

    with gzip.open(tmp_path / "big.json.gz", "wt", compresslevel=1) as f:
        f.write('{"meta": {}, "results": [')
        pad = "x" * 3000
        f.write(",".join(json.dumps({"safetyreportid": str(i), "pad": pad, "patient": {"reaction": [{}]}}) for i in range(6000)))
        f.write("]}")
    rows = readers.read_reports(spark, str(tmp_path))
    assert 6000 * 3000 > 2 * module.BATCH_BYTES
    assert rows.count() == 6000 == rows.select("record_id").distinct().count()
    assert children(shred(rows)).select("safetyreportid").distinct().count() == 6000


def test_vocabulary_and_fallback(spark, tmp_path):
    (tmp_path / "v.tsv").write_text('concept_id\tname\n1\ta "quoted" name\nx\t\n')
    out = readers.read_vocabulary(spark, str(tmp_path / "v.tsv"), "concept_id bigint, name string").collect()
    assert [tuple(r) for r in out] == [(1, 'a "quoted" name'), (None, None)]
    (tmp_path / "t.csv").write_text("a,b\n1,2\n")
    assert readers.read_first_of(spark, [str(tmp_path / "t.parquet"), str(tmp_path / "t.csv")], ["b"]).first().b == "2"
    with pytest.raises(FileNotFoundError, match="t.parquet"):
        readers.read_first_of(spark, [str(tmp_path / "t.parquet")])
    assert readers.request_key("GET", "u") != readers.request_key("GET", "v")


def test_json_files_to_tables(spark, tmp_path):
    import zipfile

    record = {"results": [{"safetyreportid": "1", "patient": {"reaction": [{"reactionmeddrapt": "R"}]}}]}
    (tmp_path / "a.json").write_text(json.dumps(record))
    with zipfile.ZipFile(tmp_path / "b.zip", "w") as z:
        z.writestr("b.json", json.dumps(record))
    out = children(shred(readers.read_reports(spark, str(tmp_path))))
    assert out.count() == 2 and out.select("record_id").distinct().count() == 2


def test_synonyms(spark, tmp_path):
    (tmp_path / "s.tsv").write_text("9\tfoo\n2\tFoo\n2\tother\n")
    (tmp_path / "t.tsv").write_text("2\tTwo\n9\tNine\n")
    names = spark.createDataFrame([("FOO",)], "n string")
    assert [tuple(r) for r in readers.synonyms(spark, str(tmp_path / "s.tsv"), str(tmp_path / "t.tsv"), names).collect()] == [("foo", "Two")]
    table = spark.read.csv(str(tmp_path / "s.tsv"), sep="\t", schema="id bigint, text string")
    assert readers.all_synonyms(table, names).count() == 3


def test_write_resume_manifest(spark, tmp_path):
    df = spark.range(10).withColumn("p", F.col("id") % 2)
    path = str(tmp_path / "out")
    assert writers.write(df, path, partition_by=("p",)) == 10
    assert writers.write(df, path, resume=True) is None and writers.exists(spark, path)
    assert writers.write(df, str(tmp_path / "c"), kind="csv") == 10
    writers.manifest(spark, str(tmp_path / "m.json"), "s", {"out": 10})
    assert json.loads((tmp_path / "m.json").read_text())["outputs"] == {"out": 10}
    assert "| percent | 0.00 |" in writers.quality_summary("t", 0, 0, {})
    assert writers.summary(spark.createDataFrame([(1,), (None,)], "a int"), ("a",)).first().n_unique_a == 2
    assert writers.write(df, str(tmp_path / "two")) == 10
    assert writers.merge_batches(spark, [str(tmp_path / "two")], "id").count() == 10


def test_stream_takes_each_file_once(spark, tmp_path):
    source, target, mark = (str(tmp_path / x) for x in ("in", "out", "mark"))
    payload = json.dumps({"safetyreportid": "1", "patient": {"reaction": {"reactionmeddrapt": "R"}}})
    for n in (1, 2):
        spark.createDataFrame([(n, payload)], "record_id bigint, payload string").write.mode("append").parquet(source)
        land(spark, source, target, mark).awaitTermination()
        assert landed(spark, target).filter(F.col("table") == REACTION.name).count() == n
    land(spark, source, target, mark).awaitTermination()
    assert landed(spark, target).filter(F.col("table") == "report").count() == 2


def test_stages_run_and_resume(spark, small, tmp_path):
    c = runner.Context(spark, small, str(tmp_path), resume=True)
    first = runner.run(c)
    assert set(first) == set(runner.STAGES) and all(n is not None for t in first.values() for n in t.values())
    assert all(n is None for t in runner.run(c).values() for n in t.values())
    with pytest.raises(ValueError):
        runner.run(c, "nothing")
    report = json.loads((tmp_path / "drug_mapping_input_quality_report.json").read_text())
    assert report["pass"] and report["total_rows"] == first["mapping"]["drug_mapping_input"] and 0 < report["coverage"]["medicinal_product"] <= 100
    assert f"rows before | {first['mapping']['drug_mapping_input']} |" in (tmp_path / "_summary/mapping.md").read_text()
    assert "- Adult rows: " in (tmp_path / "README.md").read_text()


def test_vocabulary_stage(spark, tmp_path):
    concepts = [(1, "P1", "Pain", "PT"), (2, "H1", "Pains", "HLT"), (3, "G1", "General", "HLGT"), (4, "S1", "Body", "SOC"), (5, "S2", X.EXCLUDED_CLASSES[0], "SOC"), (6, "P2", "Alone", "PT")]
    spark.createDataFrame(concepts, "concept_id bigint, concept_code string, concept_name string, concept_class string").write.parquet(f"{tmp_path}/in/vocabulary_concepts.parquet")
    spark.createDataFrame([(1, 2), (2, 3), (3, 4), (3, 5), (1, 4)], "from_id bigint, to_id bigint").write.parquet(f"{tmp_path}/in/vocabulary_relations.parquet")
    c = runner.Context(spark, f"{tmp_path}/in", f"{tmp_path}/out")
    assert runner.run(c, "vocabulary") == {"vocabulary": {"hierarchy_paths": 2, "hierarchy_lists": 2}}
    rows = {r.pt_name: r for r in c.table("hierarchy_lists").collect()}
    assert (rows["Pain"].soc_names, rows["Pain"].hlt_codes, rows["Alone"].soc_ids) == (["Body"], ["H1"], None)
    assert runner.run(runner.Context(spark, str(tmp_path), str(tmp_path)), "vocabulary") == {"vocabulary": {}}


def test_events_of_both_cohorts_reach_the_fact(spark, tmp_path):
    table = lambda rows, kind, name: spark.createDataFrame(rows, kind).withColumn("load_ts", F.lit("2024-01-01").cast("timestamp")).write.parquet(f"{tmp_path}/in/{name}.parquet")
    table([(i, "20200101", "20200101", "20200101") for i in ("1", "2", "3", "4")], "safetyreportid string, mostrecent_receive_date string, receive_date string, lastupdate_date string", "report")
    table([("1", 40.0, "Male"), ("2", 5.0, None), ("3", 50.0, "Male"), ("4", 50.0, "Male")], "safetyreportid string, patient_custom_master_age double, patient_sex string", "patient")
    lines = [("1", "FOO TABLET", "A"), ("2", "FOO TABLET", "A"), ("3", "UNKNOWN ZZZ", None), ("4", "FOO TABLET", "A")]
    drug = "safetyreportid string, entry bigint, medicinal_product string, drug_characterization string, drug_administration string, drug_indication string, drug_dosage_form string, drug_authorization_number string, action_drug string, active_substance_name string"
    table([(i, 1, p, "Suspect", None, None, None, None, None, a) for i, p, a in lines], drug, "drugcharacteristics_extended")
    table([(i, "drug-induced LIVER", "Fatal") for i in ("1", "2", "3", "4")], "safetyreportid string, reaction_meddrapt string, reaction_outcome string", "reactions")
    table([("Drug-induced liver", 7, "c", ["s"], ["t"])], "meddra_concept_name string, meddra_concept_id bigint, meddra_concept_code string, meddra_soc_names array<string>, meddra_soc_codes array<string>", "pt_soc_dictionary")
    table([("foo", "11", ["Bar"])], "basename string, rxcui string, rxnorm_ingredients array<string>", "adult_drugs_enriched")
    about = ", ".join(f"{c} {'string' if c.startswith('reporter') else 'int'}" for c in P.ABOUT)
    rest = "receive_date date, drug_characterization string, patient_sex string, reaction_outcome string, ingredient array<string>, faers_ingredients array<string>, mapping_method string, meddra_concept_id bigint, meddra_concept_code string, meddra_soc_names array<string>, meddra_soc_codes array<string>, medicinal_product string, reaction_meddrapt string, rxcui string"
    ready = [date(2020, 1, 1), "Suspect", None, None, ["bar"], [], "basename", 7, "c", None, None]
    row = lambda i, who, *key: (i, 1, *[0] * 6, "US", None, who, *ready, *(key or [None] * 3))
    landed = [row("1", "Physician"), row("4", X.EXCLUDED_REPORTERS[0]), row("1", "Physician", "FOO TABLET", "DRUG-INDUCED LIVER", "11"), row("9", "Physician", "FOO TABLET", "Drug-Induced Liver", "11")]
    table(landed, f"safetyreportid string, {about}, {rest}", "adult_fact")
    c = runner.Context(spark, f"{tmp_path}/in", f"{tmp_path}/out")
    for stage in ("cohorts", "products", "linkage", "finalise", "package"):
        if stage == "cohorts":
            for name, f, source in (("er_report", P.reports, "report"), ("er_patient", P.patients, "patient"), ("er_drug", P.drug_lines, "drugcharacteristics_extended"), ("er_reaction", P.reaction_lines, "reactions")):
                f(spark.read.parquet(f"{tmp_path}/in/{source}.parquet")).write.parquet(f"{tmp_path}/out/{name}")
        runner.run(c, stage)
    fact = {r.safetyreportid: r for r in c.table("fact").collect()}
    assert c.table("fact").count() == 3 and set(fact) == {"1", "2", "9"} and fact["1"].cohort != fact["2"].cohort and fact["2"].patient_sex == "Unknown"
    assert {(r.rxcui, r.meddra_concept_id, tuple(r.ingredient), tuple(r.faers_ingredients), r.mapping_method) for r in fact.values()} == {("11", 7, ("bar",), (), "basename")}
    assert (fact["1"].serious, fact["2"].serious) == (1, 0)
    assert [r.medicinal_product for r in c.table("quarantined_products").collect()] == ["UNKNOWN ZZZ"] and c.table("dim_reaction").count() == 3
