"""Spark jobs for profiling, preparing and classifying wide numeric tables with a rare positive label."""
