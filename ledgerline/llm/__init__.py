"""Operators for training-data pipelines, each a DataFrame -> DataFrame step.

Nothing else in the library imports this subpackage; its queries are listed in
``ledgerline.llm.queries``.
"""
