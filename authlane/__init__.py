"""Login-security analytics on Spark: normalize, store, detect, alert, report."""
