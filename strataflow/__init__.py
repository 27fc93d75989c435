"""Spark-native building blocks for layered data warehouses.

Landing, raw, cleansed, conformed and serving layers are written as
``DataFrame -> DataFrame`` operators; see the README for the map.
"""

__version__ = "0.1.0"
