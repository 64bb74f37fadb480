"""curul: DataFrame operators for semi-structured legislative records.

Every operator takes DataFrames and column names and returns a lazy DataFrame;
nothing is collected unless its docstring states the bound.
"""
