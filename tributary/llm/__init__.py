"""Operators of a training-data pipeline: cleaning, dedup, scoring, encoding
and search over text collections.  Nothing outside this folder imports it.

Every operator takes and returns a Spark ``DataFrame``.  Work inside a task is
numpy over Arrow batches of bounded size; Spark deals and joins the rows.
``queries`` registers one thin query per operator.
"""
