"""Named jobs over the test tables and their reference SQL."""
