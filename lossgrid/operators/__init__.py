"""DataFrame-to-DataFrame operators, one module per area of the loss-analytics chain."""
