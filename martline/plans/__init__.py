"""Job bodies (shipment mart, variability mart, shipping-point dimension), end-to-end loads,
the query catalogue and its DuckDB oracle."""
