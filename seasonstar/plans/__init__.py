"""Facts, reports and the layered build assembled from the operators."""
