"""wattline: Spark-native electricity-load analytics.

Load delimited readings, clean and cast them, aggregate to hourly features,
keep keyed tables, and train, score and version regression models, all as
DataFrame plans.
"""

__version__ = "0.1.0"
