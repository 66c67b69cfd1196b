"""Entity resolution on Spark DataFrames: clean, stage, block, score, group, keep stable entity numbers."""
