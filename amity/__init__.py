"""Amity: batch analytics on a social network, written as Spark DataFrame jobs."""
