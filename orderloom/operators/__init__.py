"""DataFrame-to-DataFrame operators and the sinks that commit them."""
