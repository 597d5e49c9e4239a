"""Terrier: property-sale analytics as Spark DataFrame plans.

Layers: ``sources`` read raw data, ``functions`` are Column expressions, ``operators`` are reusable
DataFrame steps, ``plans`` compose them into the tables and reports of the star schema.
"""
