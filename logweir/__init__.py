"""logweir: security-log analytics as Spark DataFrame operators.

Every operator takes DataFrames and returns a lazy DataFrame.  The packages are

* ``sources``   readers for log and entity tables, field catalogue, report export
* ``functions`` Column expressions: derived dimensions, networks, text, tokens
* ``plans``     what is decided before a plan is built: names, windows, conditions
* ``operators`` paging, breakdowns, views, statistics, correlation, scoring, masking
* ``streaming`` windowed counts over arriving logs
* ``catalog``   the registered queries and their SQL twins over the test tables
"""

from logweir.session import build_session

__all__ = ["build_session"]
