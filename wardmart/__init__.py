"""Hospital star schema built with Spark DataFrames.

``sources``    raw tables, CSV ingest, the Parquet table store
``functions``  column expressions, skew-aware joins, dense keys
``operators``  staging, intermediate, dimension, fact and quality transforms
``plans``      the star build and every query answered from it
"""
