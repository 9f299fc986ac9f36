"""Operations of a training-data pipeline: thirteen operators on ``documents``,
``benchmark``, ``embeddings`` and ``pages`` tables, each re-usable on its own.

Nothing else in the library imports this subpackage.
"""
