"""zonekit: a Spark-native landing -> formatted -> exploitation zone toolkit.

Everything is expressed as DataFrame transformations so that Catalyst can
prune, push down and plan the work; nothing is collected to the driver
except small, size-checked lookups and single-row metrics.
"""

__version__ = "0.1.0"
