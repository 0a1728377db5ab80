"""Landing: uniqueness, completeness, partitions and the stream."""

import json

import pytest
from pyspark.sql import functions as F

from rollbook.plans import trainees as TR
from rollbook.session import shared_folder
from rollbook.sources import catalog as K, landing as L
from rollbook.streaming import land

BATCH = "id int, k string, m string, name string"


def test_append_rules(spark):
    rows = [(1, "a", "x", "n"), (2, "a", "x", "n"), (3, None, "x", "n"), (4, None, "x", "n"), (5, "b", "x", None), (6, "c", "x", "n"), (7, "d", "x", "n"), (7, "d", "x", "n")]
    existing = spark.createDataFrame([("c", "x"), (None, "x")], "k string, m string")
    kept, refused = L.split_new(spark.createDataFrame(rows, BATCH), ["k", "m"], ["name"], "id", existing)
    assert {r["id"] for r in kept.collect()} == {1, 3, 4, 7} and kept.count() == 4
    assert {(r["id"], r["reason"], r["copies"]) for r in refused.collect()} == {
        (2, "duplicate in batch", 1), (5, "missing name", 1), (6, "already loaded", 1), (7, "duplicate in batch", 1)}


def test_rows_with_null_values_still_win(spark):
    rows = [(1, "a", None), (1, "a", None), (2, "a", "z")]
    kept, refused = L.split_new(spark.createDataFrame(rows, "id int, k string, v string"), ["k"], ["k"], "id")
    assert [tuple(r) for r in kept.select("id", "k", "v").collect()] == [(1, "a", None)]
    assert refused.agg(F.sum("copies")).first()[0] == 2


def test_completeness(spark):
    loaded = spark.createDataFrame([("ITI", 2018, None)] * 2 + [("Diploma", 2018, 1)] * 3 + [("Diploma", 2018, 2)], "module string, academic_year int, admission_type int")
    expected = spark.createDataFrame([("ITI", 2018, None, 2), ("Diploma", 2018, 1, 2), ("Diploma", 2018, 2, 2), ("ITI", 2019, None, 1)],
                                     "module string, academic_year int, admission_type int, count int")
    out = L.completeness(loaded, expected, ["module", "academic_year", "admission_type"], "admission_type")
    assert {(r["module"], r["academic_year"], r["admission_type"]): r["status"] for r in out.collect()} == {
        ("ITI", 2018, 0): "done", ("Diploma", 2018, 1): "excess", ("Diploma", 2018, 2): "missing", ("ITI", 2019, 0): "missing"}
    assert L.still_to_load(out).count() == 2
    assert len(L.expected_plan({"ITI": (2018, 2019)}, {})) == 2
    assert len(L.expected_plan({"Diploma": (2018, 2019)}, {"Diploma": [1, 2]})) == 4


def test_records_are_normalised(spark):
    raw = spark.createDataFrame([(" B1", "n", "[1]", "2020", "zzz"), (None, "m", "[2]", None, "y")],
                                "Barcode string, StudentName string, HSSOptionDetails string, Year string, Extra string")
    out = L.normalise_records(raw, "HSS", 2023).orderBy("student_name").collect()
    assert [r["hss_option_details"] for r in out] == ["[2]", "[1]"] and [r["year"] for r in out] == [0, 2020]
    assert "Extra" not in out[0].asDict() and out[0]["module"] == "HSS"
    bad = raw.select(L.barcode_problem(F.col("Barcode"))).collect()
    assert [r[0] for r in bad] == [None, "barcode is blank"]
    assert spark.range(1).select(L.barcode_problem(F.lit(" 123.0"))).first()[0] == "barcode is a decimal number"


def test_lines_may_mix_spellings(spark):
    lines = spark.createDataFrame([('{"Barcode":"1","HssOptionDetails":[{"a":1}]}',), ('{"Barcode":"2","HSSOptionDetails":[]}',)], "value string")
    out = L.normalise_lines(lines, "DEG", 2022).orderBy("barcode").collect()
    assert [r["hss_option_details"] for r in out] == ['[{"a":1}]', "[]"] and out[0]["academic_year"] == 2022 and out[0]["year"] == 0


def test_missing_log_wants_one_load(spark):
    rows = spark.createDataFrame([("ITI", 2020, "NA"), ("ITI", 2020, "x")], "module string, academic_year int, v string")
    assert [tuple(r) for r in L.missing_log(rows, ["v", "module"]).collect()] == [("ITI", 2020, 2, "v", 1)]
    mixed = rows.unionByName(rows.withColumn("academic_year", F.lit(2021)))
    with pytest.raises(Exception, match="constant"):
        L.missing_log(mixed, ["v"]).collect()


def test_partition_is_dropped(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(1, "ITI", 2020), (2, "ITI", 2021)], "i int, module string, academic_year int").write.partitionBy("module", "academic_year").parquet(path)
    assert L.drop_partition(spark, path, "ITI", 2020) and not L.drop_partition(spark, path, "ITI", 2020)
    assert [r["i"] for r in spark.read.parquet(path).collect()] == [2]
    frame = spark.createDataFrame([("ITI", 2020, 1), ("ITI", 2020, 2), ("ITI", None, 1)], "module string, academic_year int, admission_type int")
    assert L.without_slice(frame, "ITI", 2020, 1).count() == 2


def _write(folder, name, rows):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(json.dumps(r) for r in rows))


def test_two_stream_runs_equal_one_batch(spark, tmp_path):
    source, work = tmp_path / "in", shared_folder(spark, "test")
    page = lambda ks, extra="": [{"Barcode": k, "StudentName": f"n{k}{extra}", "Year": "1", "AdmissionStatus": "x"} for k in ks]
    prepare = lambda df: L.normalise_lines(df, "ITI", 2020)
    key = ["barcode", "module", "academic_year"]
    run = lambda: land.land_files(
        spark, str(source), "value string", f"{work}/t", f"{work}/c", key,
        ["barcode", "student_name", "module", "academic_year"], "student_name", ["module", "academic_year"], fmt="text", files_per_batch=1, prepare=prepare).awaitTermination()
    _write(source, "a.json", page(["1", "2", "2"]))
    run()
    _write(source, "b.json", page(["2", "3"], "z") + [{"Barcode": "4"}])
    run()
    run()
    out = land.landed(spark, f"{work}/t").select("barcode", "student_name").collect()
    assert sorted(tuple(r) for r in out) == [("1", "n1"), ("2", "n2"), ("3", "n3z")]
    reasons = spark.read.parquet(f"{work}/t/rejects").groupBy("reason").agg(F.sum("copies").alias("n")).collect()
    assert {r["reason"]: r["n"] for r in reasons} == {"duplicate in batch": 1, "already loaded": 1, "missing student_name": 1}
    assert [r["total"] for r in land.load_log(spark, f"{work}/t").orderBy("batch").collect()] == [3, 6]


def test_rerun_of_a_batch_changes_nothing(spark):
    table = f"{shared_folder(spark, 'test')}/t"
    batch = spark.createDataFrame([(1, "a"), (2, None)], "id int, k string")
    for _ in range(2):
        land.land_batch(batch, 0, table, ["k"], [], "id", ["k"])
    assert land.landed(spark, table).count() == 2


def test_half_a_batch_is_never_seen(spark, monkeypatch):
    table = f"{shared_folder(spark, 'test')}/t"
    rows = lambda ks: spark.createDataFrame([(k, f"v{k}") for k in ks], "k int, v string")
    land.land_batch(rows([1, 2]), 0, table, ["k"], [], "v", [])
    monkeypatch.setattr(land, "_commit", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        land.land_batch(rows([2, 3]), 1, table, ["k"], [], "v", [])
    assert sorted(r.k for r in land.landed(spark, table).collect()) == [1, 2] and land.load_log(spark, table).count() == 1
    monkeypatch.undo()
    land.land_batch(rows([2, 3]), 1, table, ["k"], [], "v", [])
    assert sorted(r.k for r in land.landed(spark, table).collect()) == [1, 2, 3]
    assert [r.reason for r in spark.read.parquet(f"{table}/rejects").collect()] == ["already loaded"]


def test_new_keys_read_no_landed_rows(spark, monkeypatch):
    table = f"{shared_folder(spark, 'test')}/t"
    rows = lambda a, b, m="x": spark.range(a, b).select(F.col("id").alias("k"), F.lit(m).alias("m"), F.lit("v").alias("v"))
    land.land_batch(rows(0, 20000).unionByName(rows(0, 10, "y")), 0, table, ["k", "m"], [], "v", ["m"])
    land.land_batch(rows(50000, 50100), 1, table, ["k", "m"], [], "v", ["m"])
    seen = []
    part = land._part
    monkeypatch.setattr(land, "_part", lambda *a, **b: seen.append(a[2]) or part(*a, **b))
    land.land_batch(rows(20000, 20200, "y"), 2, table, ["k", "m"], [], "v", ["m"])
    assert seen == ["keys"]
    near = land.may_hold(rows(50000, 50001), ["k", "m"], ["m"], part(spark, table, "keys"))
    assert [tuple(r) for r in near.collect()] == [(1, "x")]
    # Some of many new keys pass a filter by chance, and the exact comparison lets them all in.
    land.land_batch(rows(100000, 120000).unionByName(rows(0, 7)).unionByName(rows(5, 12, "y")), 3, table, ["k", "m"], [], "v", ["m"])
    assert land.landed(spark, table).count() == 20010 + 100 + 200 + 20000 + 2
    filters = land.key_filters(rows(0, 20000), ["k", "m"], ["m"]).withColumn("batch", F.lit(0))
    asked = [rows(k, k + 1) for k in (0, 777, 19999)]
    assert all(not land.may_hold(a, ["k", "m"], ["m"], filters).isEmpty() for a in asked)
    counts = {r.m: r["count"] for r in land.landed_counts(spark, table, ["m"]).collect()}
    assert counts == {r.m: r["count"] for r in land.landed(spark, table).groupBy("m").count().collect()}


def test_a_killed_run_goes_on_with_the_next_page(spark, tmp_path, monkeypatch):
    work, source = shared_folder(spark, "test"), tmp_path / "pages"
    found = lambda part, kind="string": F.regexp_extract("_metadata.file_path", f"{part}=([^/.]+)", 1).cast(kind)
    position = {"module": found("m"), "year": found("y", "int"), "page": found("page", "int")}

    def page(module, year, number, ks):
        folder = source / f"m={module}" / f"y={year}"
        folder.mkdir(parents=True, exist_ok=True)
        (folder / f"page={number}.json").write_text("\n".join(json.dumps({"k": k}) for k in ks))

    def run():
        land.land_files(spark, f"{source}/*/*/*.json", "k int", f"{work}/t", f"{work}/c", ["k"], ["k"], "k", [], files_per_batch=1, position=position).awaitTermination()

    for n in range(3):
        page("ITI", 2020, n, [10 * n, 10 * n + 1])
    real, calls = land._commit, []

    def commit(spark_, table, batch_id):
        if len(calls) == 1:
            raise RuntimeError("executor was stopped")
        calls.append(batch_id)
        real(spark_, table, batch_id)

    monkeypatch.setattr(land, "_commit", commit)
    with pytest.raises(Exception, match="executor was stopped"):
        run()
    assert land.landed(spark, f"{work}/t").count() == 2
    monkeypatch.undo()
    page("DEG", 2021, 0, [77])
    run()
    assert sorted(r.k for r in land.landed(spark, f"{work}/t").collect()) == [0, 1, 10, 11, 20, 21, 77]
    pages = land.next_pages(spark, f"{work}/t", ["module", "year"], "page")
    assert {tuple(r) for r in pages.collect()} == {("ITI", 2020, 3), ("DEG", 2021, 1)}


def test_catalog(spark, tmp_path):
    registry = K.default_registry(str(tmp_path))
    assert registry["iti_vacancies"].layer == "processed" and "hss_first_choice_admissions" in registry
    df = spark.createDataFrame([(1, "a")], "i int, s string")
    for fmt in K.FORMATS:
        target = K.Dataset("t", fmt, str(tmp_path / fmt), "interim")
        K.save(df, target)
        assert [tuple(r) for r in K.load(spark, target, df.schema).collect()] == [(1, "a")]
    for bad in ("excel", "feather"):
        with pytest.raises(ValueError):
            K.load(spark, K.Dataset("t", bad, "x", ""))
        with pytest.raises(ValueError):
            K.save(df, K.Dataset("t", bad, "x", ""))
    with pytest.raises(ValueError):
        K.publish(([df], ["a", "b"]), str(tmp_path / "out"))
    assert len(K.publish({"a": df, "b": df}, str(tmp_path / "out"))) == 2
    (tmp_path / "r.yaml").write_text("datasets:\n  x:\n    type: parquet\n    path: p\n    layer: raw\n")
    try:
        import yaml  # noqa: F401
    except ImportError:
        return
    assert K.read_registry(str(tmp_path / "r.yaml"))["x"].fmt == "parquet"


def test_trainee_files(spark, tmp_path):
    (tmp_path / "AdmittedTrainee2018.csv").write_text("Roll_Num,ITI_Code,Trade_Name,Gender\n'R1',N1,Fitter,Male\n'R2',N1,Fitter,Female\n")
    (tmp_path / "AdmittedTrainee2019_2.csv").write_text("Roll_Num,ITI_Code,Trade_Name,Gender\n'R3',N1,Welder,Male\n")
    (tmp_path / "ExamResultSheet_2018_Year1.csv").write_text("Roll No,Overall Result\n'R1',Pass with merit\n")
    admitted = TR.clean_admitted(TR.read_admitted(spark, str(tmp_path / "AdmittedTrainee*.csv")))
    results = TR.clean_results(TR.read_results(spark, str(tmp_path / "ExamResultSheet*.csv")))
    assert [tuple(r) for r in results.collect()] == [("R1", "pass", 2018, 1)]
    institutes = spark.createDataFrame([("N1", "Govt.")], "ncvtmis_code string, type_of_institute string")
    trades = spark.createDataFrame([("Fitter (NSQF)", "1 Year"), ("Fitter (NSQF)", "2 Years"), ("Welder", "1 Year")], "reported_branch_or_trade string, course_period string")
    out = {r["roll_num"]: r for r in TR.with_outcome(TR.combine(admitted, results), institutes, trades).collect()}
    assert {k: (r["year"], r["dropout"], r["passed"]) for k, r in out.items()} == {"R1": (2018, False, True), "R2": (2018, True, False), "R3": (2019, True, False)}
    assert TR.with_outcome(TR.combine(admitted, results), institutes, trades, compat=True).count() == 5
