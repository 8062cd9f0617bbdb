"""Query plans: the registered catalog (batch and streamed keys) and runners."""
