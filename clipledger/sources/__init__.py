"""Tables, folders and archives the ledger reads and writes."""
