"""Operators of a training-data pipeline; nothing outside this folder imports it.

``llm.queries`` registers one query per operator, ``corpus_pipeline.py`` at the
repository top chains five of them.
"""
