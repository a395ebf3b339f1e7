"""Operators of a training-data pipeline, each one a Spark job.

Every operator takes DataFrames and returns DataFrames; ``queries`` binds
them to the tables of a corpus folder. Nothing else in the library imports
this subpackage.
"""
