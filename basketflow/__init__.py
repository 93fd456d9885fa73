"""Clickstream analytics as lazy Spark DataFrame plans.

One shopping event log goes in; co-purchase pairs, category affinity, source
items, recommendation profiles, abandoned-cart targeting and batched lookups
come out.  Every operator is a function from DataFrames to a DataFrame.
"""
