"""Literal cases of the scalar functions."""

import datetime
from collections import Counter

import pytest
from pyspark.sql import functions as F

from rollbook.functions import categories as C, identity as I, nulls as N, payload as Y, text as X, values as V
from rollbook.functions.geo import distance_km
from rollbook.functions.similarity import common_subsequence, indel_ratio, osa_distance


def test_null_rules(values):
    assert values(N.null_strict, ["NA", "", " ", "value", None]) == [None, None, None, "value", None]
    assert values(N.null_school, ["   ", "n/a", "null", "x"]) == [None, None, None, "x"]
    assert values(N.null_tokens, [" -- ", "NaN", "None", "x "]) == [None, None, None, "x "]
    assert values(lambda c: N.null_tokens(c, ["gone"]), ["Gone", "na"]) == [None, "na"]
    assert values(N.real_id, [N.HASHED_EMPTY_ID, " ", "a1"]) == [None, None, "a1"]


def test_dates(values):
    good = ["2024-08-26", "26-08-2024", "08/26/2024", "26 Aug 2024", "August 26, 2024", "2024-08-26 15:30:00"]
    out = values(V.checked_date, [*good, "invalid date"])
    assert [r["ok"] for r in out] == [True] * 6 + [False]
    assert {r["value"].date() for r in out[:6]} == {datetime.date(2024, 8, 26)}
    assert values(V.to_timestamp_or_null, ["2023-01-01", "2023-12-31", "invalid"]) == [
        datetime.datetime(2023, 1, 1), datetime.datetime(2023, 12, 31), None]
    assert values(V.to_date_day_first, ["03/04/2001", "2001-04-03", "1999", "04/25/2001", "x"]) == [
        datetime.date(2001, 4, 3), datetime.date(2001, 4, 3), datetime.date(1999, 1, 1), datetime.date(2001, 4, 25), None]
    assert values(lambda c: V.to_date_day_first(c, False), ["1999"]) == [None]


def test_numbers(values):
    assert values(V.passing_year, ["2010", "1960", "2030", "abcd"]) == [2010.0, None, None, None]
    assert values(V.percentage_in_range, ["90", "110", "-5"]) == [90.0, None, None]
    assert values(V.number, ["450", "invalid"]) == [450.0, None]
    assert values(V.marks_percentage, [("450", "500"), ("400", "0"), ("600", "500")], "s string, t string") == [90.0, None, None]
    assert values(V.grade_point_percentage, [("8", "10"), ("450", "500")], "s string, t string") == [76.0, 90.0]
    assert values(lambda c: V.round_half_even(c, 1), [2.25, 2.35, -0.25], "x double") == [2.2, 2.4, -0.2]
    assert values(V.yes_no, ["Yes", "No", "yes", None]) == [True, False, None, None]
    assert values(V.yes_no_any_case, [" YES", "no ", "maybe"]) == [True, False, None]
    assert values(V.utilisation_class, [(12, 10), (8, 10), (10, 10), (3, 0)], "a int, s int") == [
        "Overutilized", "Underutilized", "Balanced", "Overutilized"]
    assert values(V.gap_class, [0, 3, 4], "x int") == ["Fresh graduate", "1-3 years", "> 3 years"]
    assert values(lambda c: V.fixed_decimals(c), [12.345], "x double") == ["12.3"]


@pytest.mark.parametrize("raw,want", [
    ("camelCase", "camel_case"), ("FOOBar", "foo_bar"), ("ABC", "abc"), ("alreadySnakeCase", "already_snake_case"),
    ("ThisIsATest", "this_isa_test"), ("TypeofInstitute", "type_of_institute"), ("ReportedBranchORTrade", "reported_branch_or_trade"),
    ("S_DomicileCategory", "s_domicile_category"), ("COMPSubject", "comp_subject"), ("SAMSCode", "sams_code"), ("cuttoff", "cutoff"),
    ("YearofPassing", "yearof_passing"), ("hadTwoYearFullTimeWorkExpAfterTength", "had_two_year_full_time_work_exp_after_tenth"),
])
def test_snake(values, raw, want):
    assert X.snake_name(raw) == want
    assert values(X.snake, [raw]) == [want]


def test_spelling():
    assert [X.fix_spelling(w) for w in ["Tength", "tength", "OR", "normalText"]] == ["Tenth", "tenth", "Or", "normalText"]


def test_addresses(values):
    full = ("123 Main St", "Block A", "District B", "State C", "123456")
    cases = [full, ("123 Main St, Rest", "", "", "", "123456"), ("", *full[1:]), (None, *full[1:]), ("1", None, None, None, None)]
    assert values(X.address_line, cases, "a string, b string, d string, s string, p string") == [
        "123 Main St, Block A, District B, State C 123456", "123 Main St, , ,  123456",
        ", Block A, District B, State C 123456", "Block A, District B, State C 123456", "1, , ,  "]
    assert values(X.tidy_address, ["a-b  12th, , o'neil ,x", "", None]) == ["A - B 12Th, O'Neil, X", None, None]
    assert values(X.normalise_text, [" Some  Text-here ", "", "CamelCase x"]) == ["some_text_here", None, "camel_case_x"]
    assert values(X.block_name, ["Cuttack (Sadar) Sadar", "Banki"]) == ["cuttack", "banki"]
    assert values(lambda c: X.tidy_name(c, True), ["  a &amp;  b "]) == ["A & B"]
    assert values(X.roll_tail, ["X123"]) == ["00123"]
    assert values(X.strip_quote, ["'12'"]) == ["12"]


def test_qualification(values):
    raw = ["BA", "b.tech", "diploma", "12th", "10th", "matric", "iti", "Diploma (Civil)", "Honours Degree", "CHSE", "odd one", None]
    assert values(C.standard_qualification, raw) == [
        "Graduate and above", "Graduate and above", "Diploma", "12th", "10th", "10th", "ITI", "Diploma",
        "Graduate and above", "12th", "odd one", None]
    assert values(C.titled_qualification, ["+2 SCIENCE", "b.a. pass"]) == ["+2 Science", "B.A. Pass"]


def test_highest_exam(spark):
    rows = [(1, ["10th", "12th"]), (2, ["10th", "ITI"]), (3, ["ITI", "COE"]), (4, ["+2 Science", "ITI"]), (5, ["ITI", "Diploma"])]
    df = spark.createDataFrame(rows, "i int, n array<string>").orderBy("i")
    assert [r[0] for r in df.select(C.highest_exam(F.col("n"))).collect()] == ["12th", "ITI", "ITI", "12th", "Diploma"]
    assert [r[0] for r in df.select(C.highest_exam(F.col("n"), compat=True)).collect()] == ["12th", "ITI", "ITI", "12th", "ITI"]


def test_categories(values):
    schema = "c string, orphan boolean, gc boolean, ph string, es boolean, ews boolean"
    rows = [("General", True, None, "No", None, None), ("SC", None, None, None, None, None), ("SC", False, False, "Yes", True, True),
            ("General", False, False, "No", False, True), ("OBC/SEBC", False, False, "No", False, False), ("ST", None, False, "No", None, None)]
    assert values(C.reservation_category, rows, schema) == ["ORPHAN", "SC", "PWD", "EWS", "UR", "ST"]
    labels = ["Loc10thPassUR_M", "8thFailSC_F", "EWS", "IMC", "OMC"]
    assert values(C.cutoff_is_local, labels) == [True, False, False, False, False]
    assert values(C.cutoff_qualification, labels) == ["10th Pass", "8th Fail", None, None, None]
    assert values(C.cutoff_category, labels) == ["UR", "SC", "EWS", "IMC", None]
    assert values(C.cutoff_gender, labels) == ["Male", "Female", None, None, None]
    assert values(C.strength_category, ["Strength_UR", "StrengthTotal", "__X"]) == ["UR", "Total", "X"]
    assert values(lambda c: C.income_label(c, "Diploma"), ["Upto 2.5 lakh", "--", "y"]) == ["0-2,50,000", "OTHER", "y"]
    places = [("Cuttack", "cuttack "), ("BBSR", "bbsr"), (None, "bbsr")]
    assert values(lambda a, b: C.same_place(a, b, True), places, "a string, b string") == [True, True, False]


def test_roll_numbers(values):
    key = "an example key of 32 characters!"
    seal = lambda c: F.base64(F.aes_encrypt(c, F.lit(key), F.lit("ECB"), F.lit("PKCS")))
    assert values(lambda c: I.decrypt_roll(seal(c), key), ["123456789"]) == ["123456789"]
    assert values(lambda c: I.decrypt_roll(c, key), ["not base64 !", "", None, "AAAA"]) == ["NA"] * 4
    rows = [("123456789", "BOARD OF SECONDARY EDUCATION, ODISHA"), ("1234", "BSE, Odisha"), ("1234", "ICSE"),
            ("12345678", "CHSE, Odisha"), ("123", "Council of Higher Secondary Education, Odisha"), ("1", None)]
    assert values(I.valid_roll, rows, "r string, b string") == ["123456789", "NA", "1234", "12345678", "NA", "1"]
    assert values(I.key_part, [' "Ab" ', "NA", "", None]) == ["ab", "NA", "MISSING", "MISSING"]
    assert values(I.student_key, [("A", None)], "a string, b string") == ["a_MISSING"]
    assert values(I.strict_student_key, [("A", "B"), ("A", None)], "a string, b string") == ["A-B", None]


def test_payload_edges(values):
    texts = [None, "null", "[]", "", "junk", '[{"A":"1"},{"A":"2"}]', "[null]", '{"A":"1"}']
    assert values(lambda c: Y.list_size(Y.json_records(c, ["A"])), texts) == [0, 0, 0, 0, 0, 2, 1, 0]
    assert values(lambda c: Y.first_value(Y.json_records(c, ["A"]), "A"), texts) == [None] * 5 + ["1", None, None]
    options = '[{"S":"NOT SELECTED","N":"1"},{"S":"ADMITTED","N":"2"},{"S":"ADMITTED","N":"3"}]'
    pick = lambda c: Y.preferred_record(Y.json_records(c, ["S", "N"]), "S", C.OPTION_PREFERENCE)["N"]
    assert values(pick, [options, '[{"S":"x"}]', None]) == ["2", None, None]


def test_distance(values):
    schema = "a double, b double, c double, d double"
    km = values(distance_km, [(28.6139, 77.2090, 19.0760, 72.8777), (91.0, 181.0, 0.0, 0.0), (10.0, 10.0, 10.0, 10.0), (0.0, 0.0, 0.0, 1.0), (0.0, 0.0, 10.0, 0.0)], schema)
    assert abs(km[0] - 1163) < 20
    # One degree of the equator and ten degrees of a meridian are known lengths.
    assert km[1] is None and km[2] == 0 and abs(km[3] - 111.3195) < 0.001 and abs(km[4] - 1105.8548) < 0.01


def test_similarity():
    assert common_subsequence("bananas", "banana") == 6
    assert indel_ratio("x", "x") == 100 and indel_ratio("ab", "cd") == 0
    assert indel_ratio("apple", "appl") == indel_ratio("appl", "apple") == pytest.approx(800 / 9)
    assert osa_distance("ca", "ac") == 1 and osa_distance("ca", "abc") == 3 and osa_distance("kitten", "sitting") == 3


def test_numbers_are_plain_decimals(values):
    from rollbook.functions import values as V

    got = values(V.number, ["5d", "5f", "0x1p3", "1990d", "NaN", "Infinity", "", "1e", ".", "5", " 5.5 ", "-.5e2", "+3.", None])
    assert got == [None] * 9 + [5.0, 5.5, -50.0, 3.0, None]
    assert values(V.passing_year, ["1990d", "1990"]) == [None, 1990.0]


def test_long_texts_stay_whole(values):
    from rollbook.functions import categories as C, text as X

    assert values(X.roll_tail, ["r" + "x" * 5000]) == ["00" + "x" * 5000]
    assert len(values(C.titled_qualification, ["+2 " + "ab " * 2000])[0]) >= 5999


def test_distances_are_the_published_ones(values):
    from rollbook.functions.geo import distance_km

    # Published lengths of geodesics on WGS-84, in kilometres.
    cases = [
        ((40.6, -73.8, 51.6, -0.5), 5551.759400, 1e-6), ((0.0, 0.0, 0.0, 90.0), 10018.754171394, 1e-6), ((0.0, 10.0, 90.0, 77.0), 10001.965729, 1e-6),
        ((40.0, 0.0, 41.79331020506, 137.84490004377), 10000.0, 1e-6), ((0.0, 0.0, 0.0, 180.0), 20003.931459, 1e-6), ((-30.0, 0.0, 29.9, 179.8), 19989.832827610, 5e-6),
        ((20.0, 85.0, 20.0, 85.0), 0.0, 1e-9), ((90.0, 0.0, -90.0, 50.0), 20003.931459, 1e-6), ((0.0, 0.0, 0.0, 1.0), 111.319490793, 1e-6), ((10.0, 179.9, 10.0, -179.9), 21.929, 2e-3),
    ]
    got = values(distance_km, [c[0] for c in cases], "a double, b double, c double, d double")
    for x, (where, km, off) in zip(got, cases):
        assert abs(x - km) <= off, (where, x, km)
    hard = [(91.0, 0.0, 0.0, 0.0), (None, 0.0, 0.0, 0.0), (0.0, 0.0, 0.0, None), (0.0, 0.0, 0.5, 179.7), (0.0, 0.0, 0.5, 179.5), (0.0, 0.0, 0.0, 179.9), (1e-9, 0.0, -1e-9, 179.99)]
    out = values(distance_km, hard, "a double, b double, c double, d double")
    assert out[:3] == [None] * 3 and abs(out[3] - 19944.127421) < 5e-6 and abs(out[4] - 19936.288579) < 5e-6 and all(19980 < x < 20004 for x in out[5:])
    back = values(distance_km, [(c, d, a, b) for a, b, c, d in hard[3:]], "a double, b double, c double, d double")
    assert all(abs(x - y) < 1e-6 for x, y in zip(out[3:], back))


def test_distances_of_a_small_table_are_shared_out(spark, tmp_path):
    import __spark_entry__ as entry_point

    spark.createDataFrame([(i, i % 2, float(i)) for i in range(400)], "c_custkey long, c_nationkey int, c_acctbal double").coalesce(1).write.parquet(f"{tmp_path}/customer.parquet")
    spark.createDataFrame([(i, i % 2, 10.0 * i) for i in range(20)] + [(20, None, 1.0)], "s_suppkey long, s_nationkey int, s_acctbal double").coalesce(1).write.parquet(f"{tmp_path}/supplier.parquet")
    out = entry_point.queries()["distance"](spark, str(tmp_path))
    rows = out.withColumn("task", F.spark_partition_id()).collect()
    assert len(rows) == 4000 and len({r["task"] for r in rows}) > 1
    assert {r["task"] for r in rows if r["km"] is None} == set()


def test_distances_of_one_nation_are_shared_out_without_broadcast(spark, tmp_path):
    import __spark_entry__ as entry_point

    spark.createDataFrame([(i // 2, 3, float(i)) for i in range(600)] + [(999, None, 0.0)], "c_custkey long, c_nationkey int, c_acctbal double").write.parquet(f"{tmp_path}/customer.parquet")
    spark.createDataFrame([(i, 3, 10.0 * i) for i in range(20)] + [(20, None, 1.0), (21, 4, 1.0)], "s_suppkey long, s_nationkey int, s_acctbal double").write.parquet(f"{tmp_path}/supplier.parquet")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = entry_point.queries()["distance"](spark, str(tmp_path)).withColumn("task", F.spark_partition_id()).collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # All pairs of the nation were made by one task.
    made = Counter(r["task"] for r in rows)
    assert len(made) > 1 and max(made.values()) < 0.8 * len(rows)
    assert Counter((r["c_custkey"], r["s_suppkey"]) for r in rows) == {(c, s): 2 for c in range(300) for s in range(20)}


def test_distances_of_missing_and_unknown_places(values):
    nan = float("nan")
    got = values(distance_km, [(None, 1.0, 2.0, 3.0), (1.0, None, 2.0, 3.0), (nan, 1.0, 2.0, 3.0), (1.0, nan, 2.0, 3.0), (0.0, 0.0, 0.0, 180.0)], "a double, b double, c double, d double")
    assert got[:3] == [None] * 3 and got[3] != got[3] and got[4] == pytest.approx(20003.931, abs=0.001)
