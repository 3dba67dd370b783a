"""Order analytics for omnichannel retail, written as Spark DataFrame jobs."""
