"""Sky survey analytics on Spark: operators over plain DataFrames of exposures, detections, tracklets and orbits."""
