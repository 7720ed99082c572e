"""Tests of wxstar.llm."""
