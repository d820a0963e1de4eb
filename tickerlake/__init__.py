"""tickerlake: a Spark-native market-analytics warehouse.

Raw stock bars, news articles and city weather go through staging, a star
schema (dimensions, facts, bridges) and feature marts that end in a 0-100 score
with a BUY/HOLD/SELL label.  Every model is a function from DataFrames to a
DataFrame; nothing is collected to the driver.
"""

__version__ = "0.1.0"
