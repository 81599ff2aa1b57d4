"""Table definitions and the flows that tie sources, operators and sinks together."""
