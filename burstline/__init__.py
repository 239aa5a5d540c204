"""Violation analytics over large event tables, written as Spark DataFrame plans."""
