"""Dataset jobs on small literal tables."""

import json

from pyspark.sql import functions as F

from rollbook.plans import higher as H, identity as ID, vocational as VO


def _students(spark, rows):
    base = dict.fromkeys(
        ["barcode", "aadhar_no", "academic_year", "module", "student_name", "dob", "date_of_application", "address", "block", "district", "state", "pin_code",
         "institute_district", "annual_income", "highest_qualification", "sams_code", "mark_data", "option_data", "tfw", "nationality", "domicile", *VO.FLAGS])
    schema = ", ".join(f"{c} {'int' if c == 'academic_year' else 'string'}" for c in base)
    return spark.createDataFrame([tuple({**base, **r}.values()) for r in rows], schema)


def test_enrollments(spark):
    marks = json.dumps([{"ExamName": "10th", "YearofPassing": "2015"}, {"ExamName": "ITI", "YearofPassing": "2017"}])
    df = _students(spark, [
        dict(barcode="1", aadhar_no="a", academic_year=2020, dob="2001-02-03", gc="Yes", address="12 St, X", block="B", district="D", state="S", pin_code="7",
             institute_district="D", annual_income="Above 8 lakh", sams_code="S1", mark_data=marks),
        dict(barcode="2", aadhar_no="b", academic_year=2020, sams_code="NA", mark_data="[]")])
    out = VO.enrollments(df, "Diploma").collect()
    assert len(out) == 1
    row = out[0]
    assert (row["gc"], row["local"], row["address"], row["annual_income"]) == (True, True, "12 St, B, D, S 7", "Above 8,00,000")
    assert (row["tenth_passing_year"], row["highest_qualification"], row["dob"].year) == ("2015", "ITI", 2001)
    assert "student_name" not in row.asDict() and "tfw" not in row.asDict()


def test_marks_keep_the_first_of_each_exam(spark):
    marks = json.dumps([{"ExamName": "10th", "SecuredMarks": "450", "TotalMarks": "500", "YearofPassing": "2015"}, {"ExamName": "10th", "SecuredMarks": "1", "TotalMarks": "500"},
                        {"ExamName": "12th", "SecuredMarks": "600", "TotalMarks": "500", "CompartmentalStatus": "No"}])
    df = _students(spark, [dict(barcode="1", aadhar_no="a", academic_year=2020, mark_data=marks)])
    out = {r["exam_name"]: r for r in VO.marks(df).collect()}
    assert out["10th"]["percentage"] == 90.0 and out["10th"]["year_of_passing"] == "2015"
    assert out["12th"]["percentage"] is None and out["12th"]["compartmental_status"] is False


def test_applications_take_the_largest_option_number(spark):
    options = lambda *ns: json.dumps([{"Option_No": n, "Trade": "t"} for n in ns])
    df = _students(spark, [dict(barcode="1", option_data=options("1", "3", "x")), dict(barcode="1", option_data=options("4")), dict(barcode="2", option_data="[]")])
    out = VO.applications(df, ["barcode"]).collect()
    assert {(r["barcode"], r["num_applications"]) for r in out} == {("1", 4), ("2", 0)} and len(out) == 5


def test_hss_jobs(spark):
    options = json.dumps([{"OptionNo": "1", "Year": "2020", "Stream": "Arts", "AdmissionStatus": " admitted "}])
    df = spark.createDataFrame([("1", 2020, "HSS", options, '[{"COMPSubject": "Math"}]'), ("2", 2020, "HSS", None, "null"), ("3", 2020, "ITI", None, None)],
                               "barcode string, academic_year int, module string, hss_option_details string, hss_compartments string")
    apps = H.hss_applications(df.where("module = 'HSS'"))
    assert {(r["barcode"], r["Stream"]) for r in apps.collect()} == {("1", "Arts"), ("2", None)}
    first = H.first_choice_admissions(apps)
    assert first.columns[:2] == ["barcode", "academic_year"] and "Year" not in first.columns and first.count() == 1
    assert {r["barcode"]: r["comp_subject"] for r in H.hss_marks(df).collect()} == {"1": "Math", "2": None}
    assert [tuple(r) for r in H.stream_trends(df).collect()] == [("2020", "Arts", 1)]
    assert H.hss_enrollments(df).count() == 2


def test_deg_jobs(spark):
    options = lambda *ns: json.dumps([{"OptionNo": n} for n in ns])
    df = spark.createDataFrame(
        [("1", "a", 2020, "DEG", options("1", None), "YES", " main  road ,x", None, None), ("1", "a", 2020, "DEG", options("2"), "no", "--", "Puri", None), ("2", None, 2020, "DEG", "[]", "x", None, None, None)],
        "barcode string, aadhar_no string, academic_year int, module string, deg_option_details string, ph string, address string, block string, phase string")
    assert {(r["barcode"], r["option_no"], r["num_applications"]) for r in H.deg_applications(df).collect()} == {("1", "1", 2), ("1", None, 2), ("1", "2", 2), ("2", None, 0)}
    out = H.deg_enrollments(df).collect()
    assert {(r["ph"], r["address"]) for r in out} == {(True, "Main Road, X"), (False, "Puri")} and "phase" in out[0].asDict()


def test_vacancies_count_total_seats_once(spark):
    enrolled = spark.createDataFrame([("S1", 2020, "Fitter", "Govt.", "a"), ("S1", 2020, "Fitter", "Govt.", "b")],
                                     "sams_code string, academic_year int, reported_branch_or_trade string, type_of_institute string, aadhar_no string")
    raw = spark.createDataFrame([("S1", "Fitter", None, "ITI", 2020, '{"Strength_UR":"6","StrengthTotal":"10"}')], "sams_code string, trade string, branch string, module string, academic_year int, strength string")
    row = VO.vacancies(enrolled, VO.institutes_strength(raw)).first()
    assert (row["enrollment"], row["strength"], row["vacancies"], row["vacancy_ratio"]) == (2, 10, 8, 0.8)


def test_admission_summary_counts_each_person_once(spark):
    rows = [(2020, "a", "ADMITTED"), (2020, "a", "NOT SELECTED"), (2020, "b", "tc taken"), (2020, "c", "odd"), (2021, "a", None)]
    out = {r["academic_year"]: r.asDict() for r in ID.admission_summary(spark.createDataFrame(rows, "academic_year int, aadhar_no string, admission_status string")).collect()}
    assert (out[2020]["applications"], out[2020]["admitted"], out[2020]["tc_taken"], out[2020]["unknown"]) == (4, 1, 1, 1)
    assert out[2021]["unknown"] == 1


def test_overlap(spark):
    keys = spark.createDataFrame([("k", "HSS"), ("k", "Diploma"), ("l", "ITI")], "unique_key string, module string")
    overlap = ID.module_overlap(keys)
    assert {r["unique_key"]: r["total_applied"] for r in overlap.collect()} == {"k": 2, "l": 1}
    assert ID.overlap_count(overlap, "applied_diploma", "applied_hss").first()[0] == 1


def test_line_items_are_thinned_out_before_they_are_shuffled(spark, tmp_path):
    import datetime
    import re

    from queries import base, standins

    day = datetime.date(1998, 5, 1)
    given = {
        "region": ("r_regionkey int, r_name string", [(0, "ASIA")]),
        "nation": ("n_nationkey int, n_name string, n_regionkey int", [(i, f"N{i}", 0) for i in range(25)]),
        "supplier": ("s_suppkey long, s_name string, s_nationkey int, s_acctbal double", [(i, f"s{i}", i % 25, 100.0 * i) for i in range(100)]),
        "customer": ("c_custkey long, c_name string, c_nationkey int, c_mktsegment string, c_acctbal double", [(1, "c", 1, "BUILDING", 1.0)]),
        "part": ("p_partkey long, p_brand string, p_type string, p_size int", [(1, "Brand#11", "PROMO", 3), (2, "Brand#22", "SMALL", 30)]),
        "orders": (
            "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate date, o_orderpriority string",
            [(1, 1, "F", 5e4, day, "1-URGENT"), (2, 1, "O", 5e4, day, "4-NOT SPECIFIED"), (3, 1, "O", 5e4, day, None)]),
        "lineitem": (
            "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_tax double,"
            " l_returnflag string, l_linestatus string, l_shipdate date",
            [(k, 1 + n % 2, 10 * k + n, n, 5.0, 1.0, 0.0, "R", "F", day) for k in (1, 2, 3) for n in (2, 1)]),
    }
    for name, (schema, rows) in given.items():
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")
    # Suppliers are small enough to be sent to all tasks, what Spark expects of a join with nations is not.
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100KB")
    try:
        t = base.Tables(spark, str(tmp_path))
        degree, trades = standins.students(t, "DEG"), standins.institutes(t, "ITI")
        for df in (degree, trades):
            # Groups of suppliers, trades and years are no join.
            assert not re.search(r"hashpartitioning\(l_suppkey#\w+, \d+\)", df._jdf.queryExecution().executedPlan().toString())
        everyone = standins.students(t)
        of_degree = lambda df: sorted(map(str, df.where("module = 'DEG'").select(*sorted(df.columns)).collect()))
        assert of_degree(degree) == of_degree(everyone) and degree.count() == 1
        first = degree.select("sams_code", "reported_branch_or_trade", "institute_district").first()
        assert tuple(first) == ("S21", "Brand#22", "N21")
        whole = sorted(map(str, standins.institutes(t).where("module = 'ITI'").collect()))
        assert sorted(map(str, trades.collect())) == whole and len(whole) == 3
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_items_are_shuffled_without_names_and_unread_columns(spark, tmp_path):
    """Institutes that share a key add up or stay apart, and the first item is the first of those that have a place."""
    import datetime
    import json
    import re

    from queries import base, standins

    day = datetime.date(2001, 5, 1)
    given = {
        "region": ("r_regionkey int, r_name string", [(0, "ASIA")]),
        "nation": ("n_nationkey int, n_name string, n_regionkey int", [(1, "N1", 0)]),
        "supplier": ("s_suppkey long, s_name string, s_nationkey int, s_acctbal double",
                     [(1, "s1", 1, 100.0), (1, "s1", 1, 100.0), (2, "s2", 1, 9000.0), (2, "s2", 1, 100.0), (3, "s3", None, 1.0), (None, "s", 1, 1.0)]),
        "customer": ("c_custkey long, c_name string, c_nationkey int, c_mktsegment string, c_acctbal double", [(1, "c", 1, "BUILDING", 1.0)]),
        "part": ("p_partkey long, p_brand string, p_type string, p_size int", [(1, "Brand#11", "PROMO", 3), (2, "Brand#22", "SMALL", 30), (None, "Brand#11", "SMALL", 1)]),
        "orders": (
            "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate date, o_orderpriority string",
            [(1, 1, "F", 5e4, day, "1-URGENT"), (2, 1, "O", 5e4, day, "1-URGENT"), (3, 1, "F", 5e4, day, "1-URGENT")]),
        "lineitem": (
            "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_tax double,"
            " l_returnflag string, l_linestatus string, l_shipdate date",
            [(1, 1, 3, 1, 5.0, 1.0, 0.0, "R", "F", day), (1, None, 1, 2, 5.0, 1.0, 0.0, "R", "F", day), (1, 1, 2, 3, 7.0, 1.0, 0.0, "A", "F", day),
             (1, 1, 1, 4, 4.0, 1.0, 0.0, "A", "O", day), (2, 2, 1, 1, 5.0, 1.0, 0.0, "R", "F", day), (2, 1, 1, 2, 6.0, 1.0, 0.0, "A", "F", day)]),
    }
    for name, (schema, rows) in given.items():
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")
    t = base.Tables(spark, str(tmp_path))
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    people, trades = standins.students(t, "ITI"), standins.institutes(t, "ITI")
    assert "l_tax" in plan(people.select("mark_data")) and "l_tax" not in plan(people.select("sams_code", "type_of_institute"))
    assert re.search(r"hashpartitioning\(l_suppkey#\w+, p_brand#\w+, academic_year#\w+, \d+\)", plan(trades))
    first = people.orderBy("barcode").select("sams_code", "type_of_institute", "course_period", "compartmental_status").collect()
    assert [tuple(r) for r in first] == [("S2", "Govt.", "1 Year", "NO"), ("S1", "Pvt.", "2 Years", "YES"), (None, None, "2 Years", "NO")]
    found = {(r["sams_code"], r["type_of_institute"]): (json.loads(r["strength"]), json.loads(r["cutoff"])[0].get("10thPassUR_F")) for r in trades.collect()}
    assert found == {
        ("S1", "Pvt."): ({"Strength_UR": 4, "Strength_Total": 4}, 6),
        ("S2", "Govt."): ({"Strength_UR": 1, "Strength_Total": 1}, 7), ("S2", "Pvt."): ({"Strength_UR": 1, "Strength_Total": 1}, 7)}


def test_items_are_thinned_out_by_a_filter_and_shuffled_once(spark, tmp_path):
    """At a size where nothing is broadcast by itself, a module's items alone are shuffled, as given, and by one plan for all passes."""
    import datetime
    import re

    from pyspark.sql import functions as F

    from queries import base, standins

    day = datetime.date(2001, 5, 1)
    given = {
        "region": ("r_regionkey int, r_name string", [(0, "ASIA")]),
        "nation": ("n_nationkey int, n_name string, n_regionkey int", [(1, "N1", 0)]),
        "supplier": ("s_suppkey long, s_name string, s_nationkey int, s_acctbal double", [(1, "s1", 1, 100.0), (None, "s", 1, 1.0)]),
        "customer": ("c_custkey long, c_name string, c_nationkey int, c_mktsegment string, c_acctbal double", [(1, "c", 1, "BUILDING", 1.0)]),
        "part": ("p_partkey long, p_brand string, p_type string, p_size int", [(1, "Brand#11", "PROMO", 3), (2, None, "SMALL", 30), (3, "Brand#22", "SMALL", 3)]),
        "orders": (
            "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate date, o_orderpriority string",
            [(k, 1, "F", 5e4, day, "1-URGENT" if k % 5 == 0 else "5-LOW") for k in range(-100, 100)] + [(5, 1, "F", 5e4, None, "1-URGENT"), (None, 1, "F", 5e4, day, "1-URGENT")]),
        "lineitem": (
            "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_tax double,"
            " l_returnflag string, l_linestatus string, l_shipdate date",
            [(k, p, s, 1, 5.0, 1.0, 0.0, "R", "F", day) for k in [None, *range(-100, 100)] for p in (1, 2, 3) for s in (1, None)]),
    }
    for name, (schema, rows) in given.items():
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        t = base.Tables(spark, str(tmp_path))
        plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
        people = standins.students(t, "ITI")
        assert re.search(r"BroadcastHashJoin .*LeftSemi", plan(people)) and not re.search(r"SortMergeJoin .*LeftSemi", plan(people))
        # Items are shuffled before their institute's name is there.
        assert re.search(r"Exchange hashpartitioning\(l_orderkey#\w+, \d+\), REPARTITION_BY_NUM", plan(people))
        everyone = standins.students(t).where("module = 'ITI'")
        of = lambda df: sorted(map(str, df.select(*sorted(df.columns)).collect()))
        assert of(people) == of(everyone) and people.count() == 42 and people.where("sams_code = 'S1'").count() == 41
        seats = standins.strength(t, "ITI")
        one_year = seats.where((F.col("academic_year") == 2023) & (F.col("category") == "Total"))
        assert re.search(r"ReusedExchange \[l_orderkey#\w+, l_suppkey#\w+, l_returnflag#\w+, p_brand#\w+\]", plan(one_year.join(
            people.select("sams_code", F.col("reported_branch_or_trade").alias("trade")).distinct(), ["sams_code", "trade"])))
        totals = lambda df: {(r["trade"], r["academic_year"], r["strength"]) for r in df.where("category = 'Total'").collect()}
        assert totals(seats) == {("Brand#11", None, 1.0), ("Brand#11", 2023, 200.0)}
        assert totals(standins.strength(t, "Diploma")) == {(trade, *rest) for trade in (None, "Brand#22") for rest in ((None, 1.0), (2023, 200.0))}
    finally:
        for name in settings:
            spark.conf.unset(name)


def test_a_filter_of_keys_drops_no_wanted_row(spark):
    from pyspark.sql import functions as F

    from rollbook.operators import joins as J

    rows = spark.range(-3000, 3000).select(F.col("id").alias("k"), (F.col("id") % 7).alias("v"))
    wanted = rows.where("k % 10 = 0").select(F.col("k").cast("int").alias("o"))
    few = J.perhaps_among(rows.union(rows), "k", wanted.union(wanted), "o")
    kept = few.groupBy("k").count().collect()
    assert {r["count"] for r in kept} == {2} and {k for k in range(-3000, 3000, 10)} <= {r["k"] for r in kept} and len(kept) < 700
    assert few.columns == ["k", "v"]
    old, J.FILTER_WORDS = J.FILTER_WORDS, 1
    try:  # a filter that is full lets all rows through
        assert J.perhaps_among(rows, "k", wanted, "o").count() == 6000
    finally:
        J.FILTER_WORDS = old


def test_a_join_in_tiles_is_a_join(spark):
    from pyspark.sql import functions as F

    from rollbook.operators import joins as J

    # Keys of many and of few rows, rows that repeat, keys of one side only and no key.
    left = spark.createDataFrame([(None if i % 9 == 8 else i % 5 // 2, i // 3) for i in range(400)] + [(7, 1)], "a int, x long")
    right = spark.createDataFrame([(None if i % 4 == 3 else i % 3, i // 2) for i in range(90)] + [(8, 1)], "b int, y long")
    rows = lambda df: sorted(tuple(r) for r in df.select("a", "x", "b", "y").collect())
    want = rows(left.join(right, F.col("a") == F.col("b")))
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    old, J.TILE_ROWS = J.TILE_ROWS, 8
    try:
        for name in [None, *settings]:
            if name:
                spark.conf.set(name, settings[name])
            tiled = J.join_in_tiles(left, right, "a", "b", 5)
            assert tiled.columns == ["a", "x", "b", "y"] and rows(tiled) == want and len(want) > 1000
            assert len({r["p"] for r in tiled.select(F.spark_partition_id().alias("p")).collect()}) == 5
        assert rows(J.join_in_tiles(left, right.where("b > 7"), "a", "b", 5)) == rows(J.join_in_tiles(left.where("a > 99"), right, "a", "b", 5)) == []
    finally:
        J.TILE_ROWS = old
        for name in settings:
            spark.conf.unset(name)
