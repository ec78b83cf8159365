"""Change events in: envelopes, capture, decoding, routing and topics."""
