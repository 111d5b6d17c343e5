"""Job plans: versioned publish, load audit, contract loads, seed rebuild, query catalogue."""
