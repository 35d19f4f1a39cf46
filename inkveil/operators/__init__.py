"""DataFrame -> DataFrame operators. All lazy; none collects to the driver."""
