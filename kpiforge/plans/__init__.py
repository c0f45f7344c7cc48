"""Plans: wide tables assembled from operators."""
