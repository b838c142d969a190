"""Operators over DataFrames; none of them runs an action unless its docstring says so."""
