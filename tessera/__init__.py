"""tessera: Spark-native feature engineering, training and scoring.

Every operator takes a DataFrame and returns a DataFrame built from native
Spark expressions; fitted stages are pyspark.ml Estimator/Model pairs.
"""

__version__ = "0.1.0"
