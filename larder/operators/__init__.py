"""DataFrame -> DataFrame operators. No operator collects data to the driver."""
