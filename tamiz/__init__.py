"""tamiz - data-quality and cleaning transforms for PySpark DataFrames.

Text, code and phone normalisation as Column functions; profiling, catalogue
standardisation, duplicate detection and quality expectations as DataFrame
transforms. Nothing here holds state: every function takes a DataFrame or a
Column and returns one.
"""
