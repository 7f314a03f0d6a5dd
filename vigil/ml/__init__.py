"""MLlib pipelines: random forest bundle, scalers, isolation forest, LR / GBT ensemble."""
