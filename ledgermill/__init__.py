"""ledgermill: audit-grade order and inventory analytics as Spark DataFrame plans."""
