"""Three-way reconciliation of account balances as Spark DataFrame operators."""
