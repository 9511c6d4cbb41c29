"""kilovela: DataFrame operators for versioned, hourly and daily measurement data on Spark."""
