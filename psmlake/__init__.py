"""psmlake: peptide-spectrum-match analytics as Spark DataFrames."""

__version__ = "0.1.0"
