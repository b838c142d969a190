"""Chronolex: labelled text collections over time, as Spark DataFrame operators."""
