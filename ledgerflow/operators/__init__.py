"""DataFrame -> DataFrame operators of the ledger, one module per layer."""
