"""tradewind: retail and customer-behaviour analytics as lazy Spark operators.

Every operator takes DataFrames and returns a DataFrame; nothing runs until the
caller writes or collects.  See README.md for the layout.
"""
