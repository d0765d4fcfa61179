"""Column functions on DNA sequences and alignments."""
