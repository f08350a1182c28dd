"""Scalar expressions: identifiers, text, Markdown tables, sizes. All are Columns inside code generation."""
