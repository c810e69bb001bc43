"""Operators for training-data pipelines; ``hearth.llm.queries`` registers them."""
