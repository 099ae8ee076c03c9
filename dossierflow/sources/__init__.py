"""Reading page tables, writing JSON, and the keyed profile store."""
