"""placemill: build, de-duplicate and audit point-of-interest tables on Spark."""
