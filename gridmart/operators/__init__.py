"""Row-level operators: cleaning, de-duplication, joins and the three-feed union."""
