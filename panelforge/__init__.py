"""panelforge — a Spark-native toolkit for time-series panels.

Long entity-by-time tables are the canonical form.  Everything is expressed
with DataFrame / SQL built-ins so Catalyst can prune, push down and plan the
shuffles; grouped pandas code is used only for user-supplied models and for
the k>2 least-squares solve on one row per fit unit.

Sub-packages
------------
sources    reading and writing tables, test-data bindings, dataset registry,
           holiday calendars
functions  column expressions and aggregate expressions
operators  DataFrame -> DataFrame operators (clean, panel, forecast, score, ...)
plans      specs, end-to-end pipelines and the registered queries
"""

__version__ = "0.1.0"
