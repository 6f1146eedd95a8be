"""sortlane: Spark-native record-log sorting.

Decode record lines, publish a snapshot in three total orders with a global
position and an offset-accurate layout, produce and compact sorted runs from
batch tables and streams, generate reproducible records, and verify all of it
with distributed checks.  See README.md for the module map.
"""

__version__ = "0.1.0"
