"""Spark-first analytics for immune repertoires and training corpora.

Every operator takes DataFrames and returns a DataFrame; nothing here runs a
job on import.
"""
