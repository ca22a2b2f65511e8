import pytest

from granary.operators.quality import QualityError, require_absent, require_columns
from granary.operators.windows import in_lots_of
from granary.sources import sinks


def test_columns_are_required_with_their_kinds(spark):
    df = spark.createDataFrame([(1, "a")], "a int, b string")
    assert require_columns(df, {"a": "int"}) is df
    with pytest.raises(QualityError, match="c is missing; b is string, not bigint"):
        require_columns(df, {"c": "int", "b": "bigint"})


def test_forbidden_keys(spark):
    df, bad = spark.createDataFrame([(1,), (2,), (None,)], "k int"), spark.createDataFrame([(2,), (None,), (2,)], "k int")
    with pytest.raises(QualityError, match="left: 2$"):
        require_absent(df, bad, "k")
    assert require_absent(df.filter("k = 1"), bad, "k").count() == 1


def test_lots(spark):
    df = spark.createDataFrame([(k % 3, k) for k in range(10)], "a int, k int")
    got = {r["k"]: r["lot"] for r in in_lots_of(df, 4, "a", ["k"]).collect()}
    assert got == {k: i // 4 for i, k in enumerate(sorted(range(10), key=lambda k: (k % 3, k)))}


def test_a_table_handed_on(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    with pytest.raises(FileNotFoundError):
        sinks.take_over(spark, path)
    sinks.hand_off(spark.createDataFrame([(1, None)], "a int, b date"), path)
    assert sinks.take_over(spark, path, {"b": "date"}).dtypes == [("a", "int"), ("b", "date")]
    (tmp_path / "t" / "_SUCCESS").unlink()
    with pytest.raises(FileNotFoundError):
        sinks.take_over(spark, path)
