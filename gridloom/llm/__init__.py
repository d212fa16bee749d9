"""Operators of a training-data pipeline on tables of documents.

Every operator is a `DataFrame -> DataFrame` function. A null text counts as empty
unless an operator says otherwise; columns an operator adds replace input columns of
the same name (compared without case); all other columns are carried along.
"""
