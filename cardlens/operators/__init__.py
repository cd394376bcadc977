"""``DataFrame -> DataFrame`` operators over the canonical transaction table."""
