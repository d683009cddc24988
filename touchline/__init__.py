"""touchline: match-data lakehouse operators as plain PySpark functions.

Every operator takes DataFrames and returns a DataFrame; nothing here keeps state
"""
