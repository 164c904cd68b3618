"""Jobs (bootstrap, retrain) and the registered query catalog."""
