"""Helpers that several test modules import."""


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)
