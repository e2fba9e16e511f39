"""Operators for large training-corpus pipelines.

Thirteen operators over ``documents``, ``pages`` and ``embeddings``; each module
holds one operator with its own interface.  ``queries`` binds them to the
registered query keys.  Nothing outside this package imports it.
"""
