"""Whole pipelines: training table, imputation, model analysis, summaries."""
