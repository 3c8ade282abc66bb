"""Fractional-credit bibliometrics and corpus operators on Spark DataFrames."""
