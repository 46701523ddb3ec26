"""Operators for large-scale training-data preparation.

Nothing outside this subpackage imports it; ``__spark_entry__`` registers
:func:`quarryline.llm.registry.queries` when the subpackage is present.
"""
