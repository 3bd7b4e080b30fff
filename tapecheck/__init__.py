"""tapecheck: trade-tape candles on Spark, and the checks that prove them right."""
