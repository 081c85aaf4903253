"""Operators of a training-data pipeline over documents, pages and conversations.

One module per operator; ``queries`` binds them to the driver's tables. Nothing outside this
subpackage imports it, apart from the guarded import in ``__spark_entry__.py`` and
``corpus_pipeline.py``.
"""
