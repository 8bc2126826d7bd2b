"""Change-data-capture streams."""
