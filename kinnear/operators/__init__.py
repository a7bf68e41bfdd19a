"""DataFrame → DataFrame operators of the k-NN predictor."""
