"""quirestone: document evidence and training-data operators on Spark."""
