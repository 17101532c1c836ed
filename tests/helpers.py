"""Helpers that several test modules share."""


def col_values(spark, values, expr_fn, schema="v string"):
    """Evaluate a Column expression over a one-column frame of literal values."""
    df = spark.createDataFrame([(v,) for v in values], schema)
    return [r[0] for r in df.select(expr_fn(df.columns[0])).collect()]
