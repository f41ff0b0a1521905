"""MLlib stages: features, tuned classifiers, importances, batch scoring."""
