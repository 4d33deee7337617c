"""millrace: Spark jobs for moving, checking and reshaping tables and documents.

Every operator takes and returns Spark DataFrames (or Columns).  Nothing in the
package pulls table rows to the driver; only sizes, bounds and schema facts do.
"""
