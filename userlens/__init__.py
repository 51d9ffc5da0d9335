"""userlens: user-profile and behaviour-log analytics jobs on Spark DataFrames."""

__version__ = "0.1.0"
