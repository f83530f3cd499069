"""Scalar parsing traps on literal fixtures."""

from pyspark.sql import functions as F

from econ_lake.functions import exprs as X


def _one(spark, expr, value, schema="x string"):
    return spark.createDataFrame([(value,)], schema).select(expr(F.col("x")).alias("y")).first()["y"]


def test_number_parse_rejects_suffixes_and_nan(spark):
    cases = {"1.0d": None, "5f": None, "nan": None, "1,234": 1234.0, " 12 ": 12.0, "(NA)": None, "": None,
             "1e3": 1000.0, "5.": 5.0, "-2.5": -2.5}
    for text, want in cases.items():
        assert _one(spark, X.parse_number, text) == want, text
    assert _one(spark, X.parse_number, "inf") == float("inf")


def test_unit_exponent_truncates_and_defaults(spark):
    assert _one(spark, X.parse_int_or_zero, "6") == 6
    assert _one(spark, X.parse_int_or_zero, "6.7") == 6
    assert _one(spark, X.parse_int_or_zero, None) == 0
    assert _one(spark, X.parse_int_or_zero, "x") == 0


def test_zfill_never_truncates(spark):
    assert _one(spark, X.zfill2, "1") == "01"
    assert _one(spark, X.zfill2, "01") == "01"
    assert _one(spark, X.zfill2, "123") == "123"


def test_strip_removes_tabs(spark):
    assert _one(spark, X.strip, "\t a b \n") == "a b"


def test_line_code_splits_on_first_dash(spark):
    assert _one(spark, X.after_first_dash, "A-1-2") == "1-2"
    assert _one(spark, X.after_first_dash, "ABC") == "ABC"


def test_period_parse(spark):
    df = spark.createDataFrame([(v,) for v in ["2024", " 2024m02 ", "2024M13", "2024Q1", "24", "2024\n"]], "x string")
    p = X.period_parts(F.col("x"))
    got = [(r.f, r.y, r.m) for r in df.select(p["frequency"].alias("f"), p["year"].alias("y"),
                                              p["month"].alias("m")).collect()]
    assert got == [("A", 2024, None), ("M", 2024, 2), ("", None, None), ("Q", 2024, None), ("", None, None),
                   ("A", 2024, None)]


def test_label_parse_and_json(spark):
    labels = ["[SAPCE4] Total personal consumption expenditures: Life insurance",
              "[SAPCE1] Goods: Durable goods: Motor vehicles and parts",
              "Personal consumption expenditures", "", "[X]", "A: : B", 'Say "hi"']
    df = spark.createDataFrame([(v,) for v in labels], "x string")
    path = X.label_path(F.col("x"))
    rows = df.select(X.label_series_name(path).alias("s"), X.label_function_name(path).alias("f"),
                     X.json_text_list(path).alias("j")).collect()
    assert (rows[0].s, rows[0].f) == ("Total personal consumption expenditures", "Life insurance")
    assert rows[1].j == '["Goods", "Durable goods", "Motor vehicles and parts"]'
    assert (rows[2].s, rows[2].f) == ("", "Personal consumption expenditures")
    assert (rows[3].s, rows[3].f, rows[3].j) == ("", "", "[]")
    assert rows[4].j == "[]"
    assert rows[5].j == '["A", "B"]'
    assert rows[6].j == '["Say \\"hi\\""]'


def test_control_characters_in_labels_stay_valid_json(spark):
    import json

    label = 'a\x08b\x01c"\\\x0c: d\te'
    path = X.label_path(F.col("x"))
    got = spark.createDataFrame([(label,)], "x string").select(X.json_text_list(path).alias("j")).first().j
    assert json.loads(got) == ['a\x08b\x01c"\\', "d\te"]
    assert "\\u0001" in got and "\\b" in got


def test_labels_beyond_ascii_are_escaped_as_json_does(spark):
    import json

    labels = ["Café", "住宅 🏠 ½", "".join(map(chr, range(1, 0x250))).replace(":", ""), "\U0001F600\uffff\u2028x\x7f~"]
    rows = spark.createDataFrame([(k, [t]) for k, t in enumerate(labels)], "k int, path array<string>")
    got = {r.k: r.j for r in rows.select("k", X.json_text_list(F.col("path")).alias("j")).collect()}
    assert got == {k: json.dumps([t]) for k, t in enumerate(labels)}


def test_year_and_strip_edges(spark):
    assert _one(spark, X.parse_year, "2023") == 2023 and _one(spark, X.parse_year, "2023.0") == 2023
    assert _one(spark, X.parse_year, "2023.7") is None
    assert _one(spark, X.strip, "\x1c a\x1f\n") == "a"
