"""Structured Streaming builders: trade stream scan, landing sink with dead
letters, streaming dedupe, and watermarked 1-minute OHLCV bars."""
