"""millrace: relational, changelog and event-time operators for PySpark.

Every operator is a plain ``DataFrame -> DataFrame`` function; the caller owns
the session.  ``millrace.plans`` holds one named query per operator, each with
an independent SQL statement of the same result.
"""

__version__ = "0.1.0"
