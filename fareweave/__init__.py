"""fareweave — fare-market, price-calendar and itinerary analytics as Spark jobs.

Every operator is a plain function ``f(df, *, column names, params) -> DataFrame``
built from the DataFrame API, so Catalyst plans the whole chain at once.
"""

__version__ = "0.1.0"
