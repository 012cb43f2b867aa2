"""Operators of a training-data pipeline over a ``documents`` table.

Nothing outside this folder, its tests and ``corpus_pipeline.py`` imports it.
Every operator takes DataFrames and returns DataFrames; the ``op*`` queries
of ``queries.py`` apply them to whole tables with production parameters.
"""
