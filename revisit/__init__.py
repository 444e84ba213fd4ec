"""Cohort and readmission-rate analytics on Spark DataFrames."""
