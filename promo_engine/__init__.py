"""promo_engine: coupon-redemption analytics as Spark DataFrame jobs.

Layout
------
sources/    readers (driver tables, coupon adapter, CSV/text files), sinks
functions/  column expressions (discount parsing, dates, ratios, vectors)
operators/  cleaning, feature blocks, reports, dataset assembly, clustering, model
plans/      split windows and the end-to-end jobs (pipeline, clustering, reports)
streaming/  the cleaning/label stage over a file stream
"""

__version__ = "0.1.0"
