"""flowlab: network-flow analytics on PySpark."""
