"""Tables: declared schemas, readers, adapters and the table writer."""
