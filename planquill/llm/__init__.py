"""Operations of a training-data pipeline over document tables.

Every operator takes DataFrames and returns DataFrames; ``queries`` binds them to the
tables ``documents``, ``labels`` and ``embeddings``.
"""
