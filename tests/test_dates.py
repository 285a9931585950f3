from conftest import day
from pyspark.sql import functions as F

from barloom.functions import dates as D


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


def test_text_forms(spark):
    d = F.lit(day("2018-02-05"))
    assert value(spark, D.ddmmyy(d)) == "050218"
    assert value(spark, D.ddmmyyyy(d)) == "05022018"
    assert value(spark, D.ddMMMyyyy(d)) == "05FEB2018"
    assert (value(spark, D.yyyy(d)), value(spark, D.mm_int(d)), value(spark, D.MMM(d))) == ("2018", 2, "FEB")
    assert (value(spark, D.weekday(d)), value(spark, D.dayofweek(d))) == (0, "Monday")


def test_arithmetic(spark):
    d = F.lit(day("2016-02-29"))
    assert value(spark, D.relativedate(d, years=1)) == day("2017-02-28")
    assert value(spark, D.relativedate(d, months=-1, days=3)) == day("2016-02-01")
    assert value(spark, D.setdate(d, month=3, day=31)) == day("2016-03-31")
    assert value(spark, D.setdate(d, year=2015)) is None
    assert value(spark, D.datediff(d, F.lit(day("2016-02-01")))) == 28
    assert value(spark, D.datediff(F.array(d, F.lit(day("2016-03-01"))))) == -1


def test_parsing(spark):
    text = lambda s: F.lit(s)
    assert value(spark, D.todate(text("20180205"))) == day("2018-02-05")
    assert value(spark, D.todate(text("20180230"))) is None
    assert value(spark, D.yyyy_mm_dd_to_yyyymmdd(text("2018-02-05"))) == "20180205"
    assert value(spark, D.yyyymmdd_to_yyyy_mm_dd(text("20180205"))) == "2018-02-05"
    assert value(spark, D.mm_dd_yyyy_to_yyyy_mm_dd(text("02/05/2018"))) == "2018-02-05"
    assert value(spark, D.mm_dd_yyyy_to_yyyy_mm_dd(text("02-05-2018"), "/")) == "2018/02/05"
    assert value(spark, D.ddmmyy_to_yyyy_mm_dd(text("050260"))) == "2060-02-05"
    assert value(spark, D.ddmmyy_to_yyyy_mm_dd(text("050261"))) == "1961-02-05"
    assert value(spark, D.ddMMMyyyy_to_yyyy_mm_dd(text("05Feb2018"))) == "2018-02-05"
    assert value(spark, D.dd_MMM_yyyy_to_yyyy_mm_dd(text("05-FEB-2018"))) == "2018-02-05"
    assert value(spark, D.ddmmyyyy_to_yyyy_mm_dd(text("05022018"))) == "2018-02-05"
    assert value(spark, D.dd_mm_yyyy_to_yyyymmdd(text("05.02.2018"))) == "20180205"


def test_month_names(spark):
    assert [value(spark, D.mm(F.lit(m))) for m in ("sep", "September", "MAY", "Sept")] == ["09", "09", "05", None]
    forms = [value(spark, D.months(F.lit(9), f)) for f in ("x", "Mmm", "MMM", "mmm", "other")]
    assert forms == ["September", "Sep", "SEP", "sep", "September"]
    assert [value(spark, D.months(F.lit(n))) for n in ("01", "12", "13", "0", "-1")] == ["January", "December", None, None, None]
