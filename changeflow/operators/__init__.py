"""DataFrame-to-DataFrame operators over change events and the tables built from them."""
