"""Standard scaling over a whole table."""

from __future__ import annotations

from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.sql import functions as F

from obsflow.functions.scalar import number


def standard_scale(df, column, with_mean=False):
    """A column over its sample deviation, both moments read in one scalar subquery.

    As the scaler below: a column without spread becomes 0.
    """
    x = number(column)
    moments = df.agg(F.struct(F.avg(x).alias("mean"), F.stddev_samp(x).alias("sd")).alias("m")).scalar()
    shifted = x - moments["mean"] if with_mean else x
    return df.withColumn(
        f"{column}_norm", F.when(moments["sd"] == 0, F.lit(0.0)).otherwise(shifted / moments["sd"])
    )


def fit_scaler(df, columns, output="features_norm", with_mean=False):
    """A fitted scaler to keep and apply to later batches, with the assembled input."""
    assembled = VectorAssembler(inputCols=list(columns), outputCol="features", handleInvalid="skip").transform(df)
    scaler = StandardScaler(inputCol="features", outputCol=output, withMean=with_mean)
    return scaler.fit(assembled), assembled
