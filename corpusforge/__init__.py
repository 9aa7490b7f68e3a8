"""corpusforge: training-corpus operators as DataFrame-to-DataFrame transformations on Spark."""
