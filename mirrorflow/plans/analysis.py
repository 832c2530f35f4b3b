"""Specification tests and side-by-side coefficients of the two models."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mirrorflow.functions import semantics as S
from mirrorflow.operators import ols, ppml

METRICS = "metric string, value double"


def coefficient_comparison(
    spark: SparkSession, fit: ols.Fit, poisson: ppml.PoissonFit
) -> DataFrame:
    """Estimate, error, statistic and p-value per model and term."""
    rows = [("ols", *r) for r in ols.coefficient_rows(fit)]
    measures = zip(
        poisson.terms, poisson.estimate, poisson.std_error, poisson.statistic, poisson.p_value
    )
    rows += [("ppml", *r) for r in measures]
    return spark.createDataFrame(rows, f"model string, {ols.COEFFICIENTS}")


def negative_fits(
    df: DataFrame, ols_model: ols.LinearModel, ppml_model: ols.LinearModel,
    ols_bound: float = 0.0, ppml_bound: float = 1.0,
) -> DataFrame:
    """Rows whose fitted value lies below the bound of each model; one row."""
    out = ols.predict(df, ols_model, "_ols")
    out = ols.predict(out, ppml_model, "_index").withColumn("_ppml", F.exp("_index"))
    return out.agg(
        F.count_if(S.nan_to_null("_ols") < ols_bound).alias("ols_negative_fitted"),
        F.count_if(S.nan_to_null("_ppml") < ppml_bound).alias("ppml_negative_fitted"),
    )


def model_analysis(
    ols_rows: DataFrame,
    ppml_rows: DataFrame,
    fit: ols.Fit,
    poisson: ppml.PoissonFit,
    reset_weight: str | None = None,
) -> DataFrame:
    """Tests and measures of both models as (metric, value), each over the rows of its fit."""
    spark = ppml_rows.sparkSession
    below_ols = negative_fits(ols_rows, fit.model, fit.model).first()["ols_negative_fitted"]
    below_ppml = negative_fits(ppml_rows, poisson.model, poisson.model).first()["ppml_negative_fitted"]
    values = [
        ("ols_reset_pvalue", ols.reset_test(ols_rows, fit, reset_weight)["p_value"]),
        ("ppml_reset_pvalue", ppml.reset_ppml(ppml_rows, poisson)["p_value"]),
        ("ppml_pseudo_rsq", poisson.pseudo_r_squared),
        ("ols_r_squared", fit.r_squared),
        ("ols_n", float(fit.n)),
        ("ppml_n", float(poisson.n)),
        ("ols_negative_fitted", float(below_ols)),
        ("ppml_negative_fitted", float(below_ppml)),
    ]
    return spark.createDataFrame(values, METRICS)


def save_analysis(metrics: DataFrame, table: DataFrame, path: str) -> None:
    """Store the metrics of ``model_analysis`` and the table of ``coefficient_comparison`` under ``path``."""
    metrics.coalesce(1).write.mode("overwrite").parquet(f"{path}/metrics")
    table.coalesce(1).write.mode("overwrite").parquet(f"{path}/coefficients")


def load_analysis(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """The stored metrics and coefficients."""
    metrics = spark.read.schema(METRICS).parquet(f"{path}/metrics")
    return metrics, spark.read.schema(f"model string, {ols.COEFFICIENTS}").parquet(f"{path}/coefficients")
