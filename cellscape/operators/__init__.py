"""DataFrame operators over the sparse matrix contract (``cellscape.matrix``)."""
