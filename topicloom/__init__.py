"""Sort very large volumes of short free text into a two-level taxonomy with PySpark."""
