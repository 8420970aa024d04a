"""tessera: information-theoretic feature selection, factor-model recommendation
and linear SVM training, written as Spark DataFrame jobs."""

__version__ = "0.1.0"
