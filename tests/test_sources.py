"""Explicit-schema readers, materialize, export."""

from pyspark.sql import functions as F

from paths import SF_SMALL
from riskspark.schema import APPLICATION_COLUMNS
from riskspark.session import scratch_path
from riskspark.sources.cache import export, keep_hot, materialize
from riskspark.sources.fixtures import application
from riskspark.sources.tables import read_application, write_application


def test_csv_with_bad_number_reads_as_null(spark):
    path = scratch_path(spark, "bad-csv")
    header = ",".join(APPLICATION_COLUMNS)
    row = {c: "" for c in APPLICATION_COLUMNS}
    row.update({"SK_ID_CURR": "1", "TARGET": "1", "AMT_CREDIT": "not-a-number", "DAYS_BIRTH": "-10000"})
    good = dict(row, SK_ID_CURR="2", AMT_CREDIT="1500.5")
    lines = [header] + [",".join(r[c] for c in APPLICATION_COLUMNS) for r in (row, good)]
    spark.sparkContext.parallelize(lines, 1).saveAsTextFile(path)
    df = read_application(spark, path)
    got = {r.SK_ID_CURR: r.AMT_CREDIT for r in df.select("SK_ID_CURR", "AMT_CREDIT").collect()}
    assert got == {1: None, 2: 1500.5}
    # a numeric filter drops the null credit, as in the reference
    from riskspark.operators.filters import PortfolioFilters
    assert PortfolioFilters(min_credit=0.0).apply(df).count() == 1


def test_roundtrips(spark):
    app = application(spark, SF_SMALL)
    n = app.count()
    csv = scratch_path(spark, "rt-csv")
    write_application(app.drop("TARGET"), csv)
    assert read_application(spark, csv, with_target=False).count() == n
    hot = materialize(app, "rt-parquet", columns=["SK_ID_CURR", "TARGET"], partitions=3)
    assert hot.columns == ["SK_ID_CURR", "TARGET"] and hot.count() == n
    cached = keep_hot(app, ["SK_ID_CURR"])
    assert cached.is_cached and cached.count() == n
    cached.unpersist()
    out = export(app.groupBy("CODE_GENDER").count(), scratch_path(spark, "rt-json"))
    assert spark.read.json(out).agg(F.sum("count")).first()[0] == n
