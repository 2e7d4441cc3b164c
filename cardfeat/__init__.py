"""Feature building and scoring for card-transaction logs on Spark."""
