"""Spark-native regional economic statistics lake.

Landed JSON payloads -> typed Silver rows -> conformed observations -> a
vintage-aware star schema -> serving views and a weighted price-level study,
all expressed as DataFrame / Spark SQL plans.
"""

__version__ = "0.1.0"
