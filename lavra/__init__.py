"""lavra: Spark operators that turn a harvested thesis catalogue into clean tables and training text.

Every operator is a function from DataFrames to a DataFrame. The subpackage ``lavra.llm`` holds the
operators for training text; nothing outside it imports it.
"""

__version__ = "0.1.0"
