"""Plans: the query catalogue, model training, the results bundle and sinks."""
