"""wildtally: Spark-native analytics for motion-triggered wildlife photography."""
