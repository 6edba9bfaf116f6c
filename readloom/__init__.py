"""Analytics for barcoded short-read sequencing data, written as Spark DataFrame plans."""
