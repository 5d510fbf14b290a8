"""Distributed onboarding checks for raw data exports, built on Spark DataFrames."""
