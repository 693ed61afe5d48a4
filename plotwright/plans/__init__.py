"""The four stages of the daily run, and the checks that run them over the test tables."""
