"""Spark-native burst analytics: catalog, task DAG, spike-train operators, intervals and reports as DataFrames."""
