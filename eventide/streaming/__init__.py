"""Structured Streaming forms of the operators: file-replay and service
sources, watermarked windows, ``transformWithState`` processors, late-row
splitting and a restartable query runner."""
