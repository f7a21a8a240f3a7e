"""tessera: Spark-native catalogue ETL and document analytics.

Stages (each a Spark job): collect pages -> clean raw text -> load nested
documents by keyed patch-upsert -> query. See README.md for the layout and
``python -m tessera --help`` for the command line.
"""

__version__ = "0.1.0"
