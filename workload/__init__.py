"""The supplied tables as click events, the queries over them, and an independent SQL statement for each."""
