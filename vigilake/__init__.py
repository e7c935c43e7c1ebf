"""vigilake: a Spark-native analytics engine for spontaneous adverse-event reports."""
