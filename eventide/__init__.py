"""eventide: event-stream analytics as plain Spark DataFrame functions.

Every operator takes and returns a DataFrame; Catalyst plans the work.
"""

__version__ = "0.1.0"
