"""ebbline: churn and behaviour analytics on Spark DataFrames.

Every public operator takes and returns DataFrames; nothing is collected to
the driver except scalars that steer control flow (retrain decisions).
"""
__version__ = "0.1.0"
