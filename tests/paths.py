"""What several test modules share: the driver's tables, and small application tables."""

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


def app_rows(spark, rows):
    """A small application DataFrame: ``rows`` are dicts of the columns to set, others null."""
    from riskspark.schema import APPLICATION
    full = [tuple(r.get(f.name) for f in APPLICATION.fields) for r in rows]
    return spark.createDataFrame(full, APPLICATION)
