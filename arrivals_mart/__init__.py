"""arrivals_mart: a star-schema data mart for travel arrivals, built on Spark DataFrames.

Subpackages:
    sources    file readers and the label dictionary parser
    functions  column expressions: tolerant casts, dates, code decoding, hashing
    operators  lookups, dense keys, windows, quality checks, sinks
    plans      table builds, analyses, the whole-run pipeline, registered queries
    streaming  incremental (per new file batch) run of the fact build
"""

__version__ = "0.1.0"
