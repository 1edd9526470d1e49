"""storeledger: where a retail store's money goes, as PySpark DataFrame operators."""
