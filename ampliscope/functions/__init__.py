"""Column expressions: DNA, homology, CIGAR, intervals, statistics."""
