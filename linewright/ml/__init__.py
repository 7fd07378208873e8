"""Feature pipelines, classifiers and the search over their settings, all on the cluster."""
