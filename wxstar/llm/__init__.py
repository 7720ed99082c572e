"""Operators for preparing training data at corpus scale: one module per operator.

Nothing outside this subpackage imports it. Every operator takes and returns DataFrames;
``queries`` holds the registered queries and their SQL.
"""
