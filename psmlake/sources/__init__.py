"""Readers and writers at the edge: tab-separated tables, FASTA, mzML, project files."""
