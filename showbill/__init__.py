"""showbill: a Spark-native analytics engine for catalogues of dated, located events."""
