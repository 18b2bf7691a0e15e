"""Panel analytics on Spark: cleaning, features, snapshots and questions over entity x date tables."""
