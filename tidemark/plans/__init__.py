"""Compositions: the batch pipeline, the query catalogue, plan inspection."""
