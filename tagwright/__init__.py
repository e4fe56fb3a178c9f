"""Learn topic tags for short posts with Spark, and serve them to batches and streams."""
