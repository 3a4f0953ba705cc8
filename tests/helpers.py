import datetime as dt

from pyspark.sql import types as T

D = dt.date


def factors_df(spark, dates, values_by_date, name="return_5d", version="v1"):
    rows = [
        (f"{i + 1:06d}.SZ", d, None if v is None else float(v), name, version)
        for d, values in zip(dates, values_by_date)
        for i, v in enumerate(values)
    ]
    schema = "ts_code string, trade_date date, factor_value double, factor_name string, factor_version string"
    return spark.createDataFrame(rows, schema).select("ts_code", "trade_date", "factor_name", "factor_value", "factor_version")


def labels_df(spark, dates, values_by_date):
    rows = [
        (f"{i + 1:06d}.SZ", d, None if v is None else float(v))
        for d, values in zip(dates, values_by_date)
        for i, v in enumerate(values)
    ]
    return spark.createDataFrame(rows, "ts_code string, trade_date date, forward_return_5d double")


def strings(spark, columns, rows):
    schema = T.StructType([T.StructField(c, T.StringType(), True) for c in columns])
    return spark.createDataFrame(rows, schema)
