"""tributary: ETL table and stream operators as Spark DataFrame / SQL plans.

Subpackages: ``sources``, ``sinks``, ``operators``, ``functions``,
``streaming`` (the library), ``plans`` (registered queries over the driver
tables with their oracle SQL); ``jobs`` holds job-level entry points and
``session`` the scale settings and shared scratch locations.
"""

__version__ = "0.1.0"
