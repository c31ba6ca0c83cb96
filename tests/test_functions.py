"""Label, coercion and classification functions on literal cases."""

import datetime

import pytest
from pyspark.sql import functions as F

from annalist.catalog import SchemaCatalog
from annalist.functions import classify, codes, coerce, labels


def apply(spark, f, values, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}").select("i", f(F.col("v")).alias("out"))
    return [r["out"] for r in df.orderBy("i").collect()]


YEAR_GROUPS = {
    "Y11 201819 Census": (11, "11 2018 - 2019"),
    "AS Y11 1819 at 011119": (11, "11 2018 - 2019"),
    "Y11 202122 Attendance 17_18": (11, "11 2017 - 2018"),
    "Y8 201819 Jan 16 Census": (8, "8 2015 - 2016"),
    "Y10 in Y7 (2020_21)": (7, "7 2020 - 2021"),
    "2024 Y11 - Excl from Y9 (21_22)": (11, "11 2021 - 2022"),
    "2018_19 (Y7)": (7, "7 2018 - 2019"),
    "Y11 in Y10 (Jan 23 Census)": (10, "10 2022 - 2023"),
    "All Susp and Perm Excl 18-19": (11, "11 2018 - 2019"),
    "When Y10 in 202223": (10, "10 2022 - 2023"),
    "Y10 2024 Oct 23 Census": (10, "10 2020 - 2024"),
    "Sheet1": (None, None),
    None: (None, None),
}


def test_year_groups(spark):
    got = apply(spark, labels.year_group, list(YEAR_GROUPS))
    assert [(r["year_group"], r["label"]) if r else (None, None) for r in got] == list(YEAR_GROUPS.values())


@pytest.mark.parametrize(("style", "name", "want"), [("MMM YY", "X Mar 18.csv", "2018 Mar"), ("YYYY_YY", "X 2018_19 y.xlsx", "2018 - 2019"), ("YYYY", "X 1819 y", "2018 - 2019"), ("YYYY_YY", "X (Y11 2018)", "2017 - 2018"), ("YYYY_YY", "X", None), ("YYYY_YY", None, None)])
def test_cohorts(spark, style, name, want):
    assert apply(spark, lambda c: labels.cohort_label(c, style), [name]) == [want]


def test_cohort_curation(spark):
    rows = [(7, None, "2022 - 2023"), (6, "6 2022 - 2023", "2022 - 2023"), (11, "11 2022 - 2023", "2022 - 2023"), (None, None, "2022 - 2023"), (11, "11 2021 - 2022", "2023 - 2024"), (9, "unreadable", "2022 - 2023"), (9, "9 2020 - 2021", None)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, g int, raw string, final string")
    got = [tuple(r["x"]) for r in df.select("i", labels.curated_cohort(F.col("g"), F.col("raw"), F.col("final")).alias("x")).orderBy("i").collect()]
    assert got == [(7, "Y7 2018 - 2019"), (6, "Y6 2017 - 2018"), (11, "Y11 2022 - 2023"), (None, None), (9, "Y9 2021 - 2022"), (9, "unreadable"), (9, None)]


def test_names(spark):
    assert apply(spark, labels.snake_case, ["dateOfBirth", "already_There", "UPPER", "ABCdef", "x"]) == ["date_Of_Birth", "already_There", "UPPER", "ABCdef", "x"]
    assert apply(spark, labels.is_mixed_case, ["abCD", "AB cd", "Abc", "ABcd"]) == [True, False, False, True]
    assert labels.standard_column_names(["Date of Birth", "dateOfBirth", "Abs % (all)", "A&B", "__x__"]) == ["date_of_birth", "date_of_birth", "abs_%_all", "aand_b", "x"]
    assert labels.base_name("a.1") == "a" and labels.base_name("a.b") == "a.b"
    assert labels.resolve_column(["b", "a"], ["x_a"], ["x"]) == "x_a" and labels.resolve_column("x_a", ["a"], ["x"]) == "a" and labels.resolve_column("q", ["a"], ["x"]) is None
    assert labels.validated_name_format(["data_category", "cohort_y11_ay", "year_group", "cohort_yg_ay"]) == ["data_category", "cohort_y11_ay", "year_group"]
    with pytest.raises(ValueError):
        labels.validated_name_format(["data_category", "year_group", "cohort_yg_ay"])


def test_coercion(spark):
    assert apply(spark, coerce.boolean, [" Yes ", "1.0", "n", "<NA>", "maybe", None]) == [True, True, False, None, None, None]
    assert apply(spark, coerce.is_unknown_boolean, ["maybe", "<NA>", "y"]) == [True, False, False]
    assert apply(spark, coerce.category, ["white british", "wbri", "3.0", " ", "n/a", "o'neil smith-jones", "1.5"]) == ["White British", "wbri", "3", None, None, "O'Neil Smith-Jones", "1.5"]
    assert apply(spark, coerce.numeric, ["1.5", " 2 ", "x", "NaN", None]) == [1.5, 2.0, None, None, None]
    assert apply(spark, coerce.integer, ["1.0", "1.5", "7"]) == [1, None, 7]
    d = datetime.date
    assert apply(spark, coerce.date, ["2018-03-05T10:00:00Z", "05/03/2018", "5-3-2018 10:11", "Mar-18", "Mar-95", "StudID", "31/02/2018", None]) == [d(2018, 3, 5), d(2018, 3, 5), d(2018, 5, 3), d(2018, 3, 1), d(1995, 3, 1), None, None, None]
    assert apply(spark, coerce.normalise_name, ["The  Hill School ", "N/A", None, "theatre"]) == ["hill school", None, None, "theatre"]
    assert apply(spark, lambda c: coerce.coerce(c, "string"), ["1.0", "a.0", "2.50"]) == ["1", "a.0", "2.50"]


def test_school_types(spark):
    cases = {"CY": "Community School", "Academy sponsored, special": "Academy - Sponsor Led Special", "an academy (AP)": "Academy - Alternative Provision", "Academy map": "Academy", "Free schools UTC": "Free School - UTC", "university technical college": "Free School - UTC", "community_special": "Community Special School", "Independent school": "Independent School", " Other ": "Other", None: None}
    assert apply(spark, lambda c: classify.classify(c, classify.SCHOOL_TYPES), list(cases)) == list(cases.values())


def test_catalog(spark):
    cat = SchemaCatalog({"census": {"age": "double", "census_flag": "bool"}, "ks2": {"score": "Int64"}}, {"ks2": "ks2"})
    df = cat.prefix("census", cat.apply("census", spark.createDataFrame([("s", "1.5", "yes", "x")], "id string, age string, flag string, other string")), "id")
    assert df.dtypes == [("id", "string"), ("census_age", "double"), ("census_flag", "boolean"), ("census_other", "string")]
    assert cat.type_of("ks2_score") == "Int64" and cat.type_of("nothing") is None
    with pytest.raises(ValueError):
        SchemaCatalog({"a": {"b": "matrix"}})


def test_codes(spark):
    assert apply(spark, codes.activity_level, [210, 540, 550, 530, 381, 211, None], "int") == ["Education", "NEET", "Employment", "Re-engagement activites", "Employment", None, None]
    assert apply(spark, lambda c: codes.label(c, codes.SCHOOL_TYPE), [57, 1], "int") == ["Free School - UTC", None]
    assert codes.as_table(spark, codes.GENDER).count() == 2
    groups = codes.background_columns(["census_gender", "ks2_idaci", "sen_provision_x", "other"])
    assert groups["demographics"] == ["census_gender"] and groups["socioeconomic"] == ["ks2_idaci", "sen_provision_x"] and len(groups["all"]) == 3
