"""Operators of a training-data pipeline over ``documents``, ``embeddings`` and ``labels``.

Nothing outside this subpackage imports it; ``__spark_entry__.py`` adds its
queries only where it can be imported.
"""
