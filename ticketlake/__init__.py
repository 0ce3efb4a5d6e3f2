"""Ticketlake: a batch and incremental lake for service-request records on Spark."""
