"""Sources, sinks and the fixture views of the test tables."""
