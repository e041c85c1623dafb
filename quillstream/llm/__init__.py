"""Operators for large-scale training-data preparation.

Nothing outside this subpackage imports it; ``quillstream.llm.registry`` lists its queries.
"""
