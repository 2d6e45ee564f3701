"""Training-data pipeline operators (see README, "Training-data operators")."""
